"""Warehouse reporting queries over the sales star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.scalar import MONEY_SUM, year_range

# Item categories matched by substring, first match wins.
CATEGORY_PATTERNS = (("%bolt%", "Bolt"), ("%gear%", "Gear"), ("%ring%", "Ring"))
REPORT_CATEGORIES = ("Bolt", "Gear", "Ring")


def _line_sales() -> F.Column:
    return (F.col("UnitPrice") * F.col("Quantity")).cast(MONEY_SUM)


def sales_by_customer(sales: DataFrame, year: int) -> DataFrame:
    """Total sales per customer for one calendar year, largest first."""
    return (sales.filter(year_range("OrderDate", year))
            .groupBy("CustomerName")
            .agg(F.sum(_line_sales()).cast(MONEY_SUM).alias("TotalSales"))
            .orderBy(F.desc("TotalSales"), "CustomerName"))


def sales_by_item(sales: DataFrame, year: int) -> DataFrame:
    """Total sales per item for one calendar year, largest first."""
    return (sales.filter(year_range("OrderDate", year))
            .groupBy(F.col("Item").alias("ItemName"))
            .agg(F.sum(_line_sales()).cast(MONEY_SUM).alias("TotalSales"))
            .orderBy(F.desc("TotalSales"), "ItemName"))


def categorize(item_col: str = "Item", patterns=CATEGORY_PATTERNS) -> F.Column:
    """CASE WHEN item LIKE p1 THEN c1 ... ELSE 'Other' (case-sensitive, first match wins)."""
    expr = None
    for pat, name in patterns:
        cond = F.col(item_col).like(pat)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("Other")


def top_customer_per_category(sales: DataFrame, year: int, categories=REPORT_CATEGORIES,
                              patterns=CATEGORY_PATTERNS) -> DataFrame:
    """Best customer per item category for a year.

    Group first (partial + final aggregate), then rank inside each category; the
    ``rn = 1`` filter lets Catalyst add a WindowGroupLimit so only one row per
    category and partition crosses the shuffle.  Ties break on the customer name.
    """
    categorized = (sales.filter(year_range("OrderDate", year))
                   .select(categorize("Item", patterns).alias("Category"), "CustomerName",
                           _line_sales().alias("Sales")))
    grouped = (categorized.filter(F.col("Category").isin(list(categories)))
               .groupBy("Category", "CustomerName")
               .agg(F.sum("Sales").cast(MONEY_SUM).alias("TotalSales")))
    w = Window.partitionBy("Category").orderBy(F.desc("TotalSales"), F.asc("CustomerName"))
    return (grouped.withColumn("SalesRank", F.row_number().over(w))
            .filter(F.col("SalesRank") == 1)
            .select("Category", "CustomerName", "TotalSales")
            .orderBy(F.desc("TotalSales"), "Category"))


def distinct_members(sales: DataFrame, year: int) -> DataFrame:
    """``SELECT DISTINCT CustomerName, Email`` for one year."""
    return sales.filter(year_range("OrderDate", year)).select("CustomerName", "Email").distinct()


def union_all_stores(*stores: DataFrame) -> DataFrame:
    """``SELECT * FROM a UNION ALL SELECT * FROM b`` across stores: by position, duplicates kept."""
    widths = {len(s.columns) for s in stores}
    if len(widths) != 1:
        raise ValueError("UNION ALL inputs must have the same number of columns")
    out = stores[0]
    for s in stores[1:]:
        out = out.union(s)
    return out


def compare_stores(a: DataFrame, b: DataFrame, names=("a", "b")) -> DataFrame:
    """Rows of one store missing from the other, duplicates counted (``EXCEPT ALL`` both ways),
    tagged with the store they come from.  Columns bind by position, as in the union."""
    if len(a.columns) != len(b.columns):
        raise ValueError("stores must have the same number of columns")
    b = b.toDF(*a.columns)
    only_a = a.exceptAll(b).withColumn("only_in", F.lit(names[0]))
    only_b = b.exceptAll(a).withColumn("only_in", F.lit(names[1]))
    return only_a.unionByName(only_b)
