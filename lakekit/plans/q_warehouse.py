"""Registered warehouse reporting queries (entry 2 of the reference: SQL procedure + analytics)."""

from __future__ import annotations

from lakekit.plans import fixtures as fx
from lakekit.plans import warehouse as wh
from lakekit.plans.registry import query

REPORT_YEAR = 1997


@query("sales_by_customer", f"""
WITH {fx.SQL_SALES}
SELECT CustomerName, CAST(SUM(UnitPrice * Quantity) AS DECIMAL(38,6)) AS TotalSales
FROM sales WHERE YEAR(OrderDate) = {REPORT_YEAR}
GROUP BY CustomerName ORDER BY TotalSales DESC""")
def q_sales_by_customer(spark, sf_dir):
    return wh.sales_by_customer(fx.sales(spark, sf_dir), REPORT_YEAR)


@query("sales_by_item", f"""
WITH {fx.SQL_SALES}
SELECT Item AS ItemName, CAST(SUM(UnitPrice * Quantity) AS DECIMAL(38,6)) AS TotalSales
FROM sales WHERE YEAR(OrderDate) = {REPORT_YEAR}
GROUP BY Item ORDER BY TotalSales DESC""")
def q_sales_by_item(spark, sf_dir):
    return wh.sales_by_item(fx.sales(spark, sf_dir), REPORT_YEAR)


def _sql_totals(pattern: str, name: str, before: tuple[str, ...]) -> str:
    """Totals per customer of the items with ``pattern`` in their name and none of those before."""
    others = "".join(f" AND NOT contains(Item, '{x}')" for x in before)
    return f"""SELECT '{name}' AS Category, CustomerName, sum(UnitPrice * Quantity) AS Total FROM sales
  WHERE contains(Item, '{pattern}'){others} AND OrderDate BETWEEN DATE '{REPORT_YEAR}-01-01' AND DATE '{REPORT_YEAR}-12-31'
  GROUP BY CustomerName"""


# by definition: the totals that equal their category's largest, the first name among equals
@query("top_customer_per_category", f"""
WITH {fx.SQL_SALES},
totals AS ({_sql_totals("bolt", "Bolt", ())} UNION ALL {_sql_totals("gear", "Gear", ("bolt",))}
           UNION ALL {_sql_totals("ring", "Ring", ("bolt", "gear"))}),
largest AS (SELECT Category, max(Total) AS Total FROM totals GROUP BY Category)
SELECT l.Category, min(t.CustomerName) AS CustomerName, CAST(l.Total AS DECIMAL(38,6)) AS TotalSales
FROM largest l JOIN totals t ON t.Category = l.Category AND t.Total = l.Total
GROUP BY l.Category, l.Total""")
def q_top_customer_per_category(spark, sf_dir):
    return wh.top_customer_per_category(fx.sales(spark, sf_dir), REPORT_YEAR)


@query("distinct_members", f"""
WITH {fx.SQL_SALES}
SELECT DISTINCT CustomerName, Email FROM sales WHERE YEAR(OrderDate) = {REPORT_YEAR}""")
def q_distinct_members(spark, sf_dir):
    return wh.distinct_members(fx.sales(spark, sf_dir), REPORT_YEAR)
