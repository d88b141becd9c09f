"""Registered medallion queries: silver job, star build, year load, cleaning helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakekit.functions.scalar import null_or_empty_default, split_word, word_or_empty
from lakekit.llm.common import shuffles_deleted
from lakekit.operators.quality import null_violations, orphan_facts
from lakekit.plans import fixtures as fx
from lakekit.plans import medallion as md
from lakekit.plans.registry import query
from lakekit.plans.warehouse import categorize
from lakekit.session import sort_tasks, work_dir
from lakekit.sources.snapshots import SnapshotTable
from lakekit.sources.tables import load

# Fixed values of the demo runs.
FLAG_BEFORE = dt.date(1998, 8, 1)
AUDIT_TS1 = dt.datetime(2001, 8, 2)
AUDIT_TS2 = dt.datetime(2001, 8, 3)
LOAD_YEAR = 1997
DROP_PARTS = 4              # parts of many orders whose lines are written one after the other: a part's shuffle files go with it
DROP_LINES = 100_000        # lines in a file of a drop at most (one that is compressed is read by one task)

_INPUTS: dict[tuple[str, str, str], str] = {}


def _input(spark, sf_dir, name, write) -> str:
    """Path of an input made from the driver tables, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _INPUTS:
        path = work_dir(spark, name)
        with shuffles_deleted(spark):
            write(path)
        _INPUTS[key] = path
    return _INPUTS[key]


SQL_SILVER_COLS = """SalesOrderNumber, SalesOrderLineNumber, OrderDate,
  CASE WHEN CustomerName IS NULL OR CustomerName = '' THEN 'Unknown' ELSE CustomerName END AS CustomerName,
  Email, Item, Quantity, UnitPrice, Tax, COALESCE(OrderDate < DATE '1998-08-01', FALSE) AS IsFlagged"""


@query("silver_enrich", f"""WITH {fx.SQL_SALES}
SELECT {SQL_SILVER_COLS}, TIMESTAMP '2001-08-02 00:00:00' AS CreatedTS, TIMESTAMP '2001-08-02 00:00:00' AS ModifiedTS
FROM sales""")
def q_silver_enrich(spark, sf_dir):
    return md.silver_enrich(fx.sales(spark, sf_dir), flag_before=FLAG_BEFORE, as_of=AUDIT_TS1)


@query("bronze_to_silver", f"""WITH {fx.SQL_SALES}
SELECT {SQL_SILVER_COLS},
  CASE WHEN OrderDate < DATE '1998-01-01' THEN TIMESTAMP '2001-08-02 00:00:00'
       ELSE TIMESTAMP '2001-08-03 00:00:00' END AS CreatedTS,
  TIMESTAMP '2001-08-03 00:00:00' AS ModifiedTS
FROM sales""")
def q_bronze_to_silver(spark, sf_dir):
    """Two drops as compressed CSV; run 1 loads drop A, run 2 gets A again plus B (re-delivery)."""
    def drops(path):
        drop = F.when(F.col("OrderDate") < F.lit(dt.date(1998, 1, 1)), "sales_a.csv").otherwise("sales_b.csv")
        parts = DROP_PARTS if sort_tasks(load(spark, sf_dir, "lineitem")) else 1
        for k in range(parts):
            (fx.sales(spark, sf_dir, (k, parts)).withColumn("drop", drop).write.mode("append").partitionBy("drop")
             .option("maxRecordsPerFile", DROP_LINES).option("header", True).csv(path, compression="gzip"))

    bronze = _input(spark, sf_dir, "bronze", drops)
    silver = SnapshotTable(spark, work_dir(spark, "silver"))
    md.bronze_to_silver(spark, f"{bronze}/drop=sales_a.csv", silver, flag_before=FLAG_BEFORE, as_of=AUDIT_TS1)
    md.bronze_to_silver(spark, f"{bronze}/drop=*", silver, flag_before=FLAG_BEFORE, as_of=AUDIT_TS2)
    return silver.read().drop("FileName")


@query("bronze_quarantine", f"""WITH {fx.SQL_SALES}
SELECT 'silver' AS side, SalesOrderNumber || '-' || SalesOrderLineNumber AS row_key FROM sales WHERE SalesOrderLineNumber <> 3
UNION ALL
SELECT 'quarantine', SalesOrderNumber || '-' || SalesOrderLineNumber FROM sales WHERE SalesOrderLineNumber = 3""")
def q_bronze_quarantine(spark, sf_dir):
    """Every third line of an order has a quantity that is no number: it is kept apart, the rest is loaded."""
    def drops(path):
        sales = fx.sales(spark, sf_dir)
        quantity = F.when(F.col("SalesOrderLineNumber") == 3, F.lit("many")).otherwise(F.col("Quantity").cast("string"))
        sales.withColumn("Quantity", quantity).write.option("header", True).csv(path)

    silver, quarantine = (SnapshotTable(spark, work_dir(spark, n)) for n in ("silver", "quarantine"))
    md.bronze_to_silver(spark, _input(spark, sf_dir, "bronze-bad", drops), silver, flag_before=FLAG_BEFORE, as_of=AUDIT_TS1,
                        bad_rows="quarantine", quarantine=quarantine)
    key = F.concat_ws("-", F.split("line", ",")[0], F.split("line", ",")[1])
    good = silver.read().select(F.lit("silver").alias("side"), F.concat_ws("-", "SalesOrderNumber", F.col("SalesOrderLineNumber").cast("string")).alias("row_key"))
    return good.unionByName(quarantine.read().select(F.lit("quarantine").alias("side"), key.alias("row_key")))


@query("flag_legacy_orders", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS OrderDate,
       COALESCE(CAST(o_orderdate AS DATE) < DATE '1998-08-01', FALSE) AS IsFlagged FROM orders""")
def q_flag_legacy_orders(spark, sf_dir):
    return md.flag_legacy_orders(load(spark, sf_dir, "orders"), FLAG_BEFORE)


@query("null_or_empty_default", """
SELECT c_custkey, string_split(c_name, ' ')[1] AS First,
       CASE WHEN string_split(c_name, ' ')[2] IS NULL OR string_split(c_name, ' ')[2] = '' THEN 'Unknown'
            ELSE string_split(c_name, ' ')[2] END AS Last
FROM customer""")
def q_null_or_empty_default(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", split_word("c_name", 0).alias("First"),
                    null_or_empty_default(split_word("c_name", 1)).alias("Last"))


@query("split_name", """
SELECT c_custkey, c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR) AS CustomerName,
       string_split(c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR), ' ')[1] AS First,
       string_split(c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR), ' ')[2] AS Last
FROM customer""")
def q_split_name(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    name = F.concat_ws(" ", "c_mktsegment", F.col("c_custkey").cast("string"))
    return c.select("c_custkey", name.alias("CustomerName"), split_word(name, 0).alias("First"),
                    split_word(name, 1).alias("Last"))


@query("split_item", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS ItemName,
       CASE WHEN string_split(p_name, ' ')[2] IS NULL OR string_split(p_name, ' ')[2] = '' THEN ''
            ELSE string_split(p_name, ' ')[2] END AS ItemInfo
FROM part""")
def q_split_item(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", split_word("p_name", 0).alias("ItemName"), word_or_empty("p_name", 1).alias("ItemInfo"))


@query("categorize_items", """
SELECT p_partkey, p_name,
       CASE WHEN p_name LIKE '%bolt%' THEN 'Bolt' WHEN p_name LIKE '%gear%' THEN 'Gear'
            WHEN p_name LIKE '%ring%' THEN 'Ring' ELSE 'Other' END AS Category
FROM part""")
def q_categorize_items(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", "p_name", categorize("p_name").alias("Category"))


@query("assert_not_null", """
SELECT c_custkey, string_split(c_name, ' ')[1] AS First, string_split(c_name, ' ')[2] AS Last
FROM customer WHERE string_split(c_name, ' ')[2] IS NULL""")
def q_assert_not_null(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    named = c.select("c_custkey", split_word("c_name", 0).alias("First"), split_word("c_name", 1).alias("Last"))
    return null_violations(named, ["Last"])


# ------------------------------------------------------------------ gold

SQL_DIMS = fx.SQL_SALES + """,
k1 AS (SELECT DISTINCT CustomerName, Email FROM sales WHERE OrderDate < DATE '1998-01-01'),
d1 AS (SELECT CustomerName, Email, row_number() OVER (ORDER BY CustomerName, Email) AS CustomerID FROM k1),
k2 AS (SELECT DISTINCT CustomerName, Email FROM sales s
       WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.CustomerName = s.CustomerName AND d1.Email = s.Email)),
dc AS (SELECT CustomerName, Email, CustomerID FROM d1
       UNION ALL
       SELECT CustomerName, Email, (SELECT COALESCE(max(CustomerID), 0) FROM d1)
                                   + row_number() OVER (ORDER BY CustomerName, Email) FROM k2),
items AS (SELECT DISTINCT Item, OrderDate < DATE '1998-01-01' AS early FROM sales),
parts AS (SELECT string_split(Item, ' ')[1] AS ItemName, COALESCE(NULLIF(string_split(Item, ' ')[2], ''), '') AS ItemInfo,
                 early FROM items),
p1 AS (SELECT DISTINCT ItemName, ItemInfo FROM parts WHERE early),
q1 AS (SELECT ItemName, ItemInfo, row_number() OVER (ORDER BY ItemName, ItemInfo) AS ItemID FROM p1),
p2 AS (SELECT DISTINCT ItemName, ItemInfo FROM parts p
       WHERE NOT EXISTS (SELECT 1 FROM q1 WHERE q1.ItemName = p.ItemName AND q1.ItemInfo = p.ItemInfo)),
dp AS (SELECT ItemName, ItemInfo, ItemID FROM q1
       UNION ALL
       SELECT ItemName, ItemInfo, (SELECT COALESCE(max(ItemID), 0) FROM q1)
                                  + row_number() OVER (ORDER BY ItemName, ItemInfo) FROM p2)"""


def silver_table(spark, sf_dir):
    """The silver table the gold build reads (``spark.read.table("sales_silver")``), written once."""
    path = _input(spark, sf_dir, "sales-silver", lambda p: SnapshotTable(spark, p).write(fx.sales(spark, sf_dir)))
    return SnapshotTable(spark, path).read()


def _gold_tables(spark):
    return {n: SnapshotTable(spark, work_dir(spark, f"gold-{n}"))
            for n in ("dim_date", "dim_customer", "dim_product", "fact")}


def _two_loads(spark, sf_dir):
    """Gold built in two runs: orders before the cut first, then everything."""
    sales = silver_table(spark, sf_dir)
    tables = _gold_tables(spark)
    first = md.build_star(sales.filter(F.col("OrderDate") < F.lit(fx.FIRST_LOAD_CUT)), tables=tables)
    return sales, first, md.build_star(sales, first, tables)


@query("dim_date", f"""WITH {fx.SQL_SALES}
SELECT OrderDate, CAST(day(OrderDate) AS INTEGER) AS Day, CAST(month(OrderDate) AS INTEGER) AS Month,
       CAST(year(OrderDate) AS INTEGER) AS Year, strftime(OrderDate, '%b-%Y') AS mmmyyyy,
       strftime(OrderDate, '%Y%m') AS yyyymm
FROM (SELECT DISTINCT OrderDate FROM sales)""")
def q_dim_date(spark, sf_dir):
    _, _, star = _two_loads(spark, sf_dir)
    return star.dim_date


@query("dim_customer", f"""WITH {SQL_DIMS}
SELECT CustomerName, Email, string_split(CustomerName, ' ')[1] AS First, string_split(CustomerName, ' ')[2] AS Last,
       CAST(CustomerID AS BIGINT) AS CustomerID FROM dc""")
def q_dim_customer(spark, sf_dir):
    _, _, star = _two_loads(spark, sf_dir)
    return star.dim_customer


@query("dim_product", f"""WITH {SQL_DIMS}
SELECT ItemName, ItemInfo, CAST(ItemID AS BIGINT) AS ItemID FROM dp""")
def q_dim_product(spark, sf_dir):
    _, _, star = _two_loads(spark, sf_dir)
    return star.dim_product


SQL_FACT_SELECT = """
SELECT s.SalesOrderNumber, s.SalesOrderLineNumber, CAST(dc.CustomerID AS BIGINT) AS CustomerID,
       CAST(dp.ItemID AS BIGINT) AS ItemID, s.OrderDate, s.Quantity, s.UnitPrice, s.Tax
FROM sales s
LEFT JOIN dc ON s.CustomerName = dc.CustomerName AND s.Email = dc.Email
LEFT JOIN dp ON string_split(s.Item, ' ')[1] = dp.ItemName
            AND COALESCE(NULLIF(string_split(s.Item, ' ')[2], ''), '') = dp.ItemInfo"""


@query("build_fact_sales", f"WITH {SQL_DIMS} {SQL_FACT_SELECT}")
def q_build_fact_sales(spark, sf_dir):
    _, _, star = _two_loads(spark, sf_dir)
    return star.fact


@query("build_star", f"""WITH {fx.SQL_SALES},
dc AS (SELECT CustomerName, Email, row_number() OVER (ORDER BY CustomerName, Email) AS CustomerID
       FROM (SELECT DISTINCT CustomerName, Email FROM sales)),
dp AS (SELECT ItemName, ItemInfo, row_number() OVER (ORDER BY ItemName, ItemInfo) AS ItemID
       FROM (SELECT DISTINCT string_split(Item, ' ')[1] AS ItemName,
                    COALESCE(NULLIF(string_split(Item, ' ')[2], ''), '') AS ItemInfo FROM sales))
{SQL_FACT_SELECT}""")
def q_build_star(spark, sf_dir):
    """Gold build run twice over the same silver data: the second run adds nothing."""
    sales = silver_table(spark, sf_dir)
    tables = _gold_tables(spark)
    once = md.build_star(sales, tables=tables)
    twice = md.build_star(sales, once, tables)
    return twice.fact


@query("orphan_facts", f"""WITH {SQL_DIMS},
dc1 AS (SELECT * FROM d1),
dpa AS (SELECT ItemName, ItemInfo, row_number() OVER (ORDER BY ItemName, ItemInfo) AS ItemID
        FROM (SELECT DISTINCT string_split(Item, ' ')[1] AS ItemName,
                     COALESCE(NULLIF(string_split(Item, ' ')[2], ''), '') AS ItemInfo FROM sales))
SELECT s.SalesOrderNumber, s.SalesOrderLineNumber, CAST(NULL AS BIGINT) AS CustomerID,
       CAST(dpa.ItemID AS BIGINT) AS ItemID, s.OrderDate, s.Quantity, s.UnitPrice, s.Tax
FROM sales s
LEFT JOIN dpa ON string_split(s.Item, ' ')[1] = dpa.ItemName
             AND COALESCE(NULLIF(string_split(s.Item, ' ')[2], ''), '') = dpa.ItemInfo
WHERE NOT EXISTS (SELECT 1 FROM dc1 WHERE dc1.CustomerName = s.CustomerName AND dc1.Email = s.Email)""")
def q_orphan_facts(spark, sf_dir):
    """Facts of all years checked against the customer dim of the first load only."""
    sales = silver_table(spark, sf_dir)
    dim1 = md.dim_customer(sales.filter(F.col("OrderDate") < F.lit(fx.FIRST_LOAD_CUT)))
    fact = md.build_fact_sales(sales, dim1, md.dim_product(sales))
    return orphan_facts(fact, dim1, "CustomerID")


SQL_YEAR = f"""{fx.SQL_SALES},
yr AS (SELECT * FROM sales WHERE YEAR(OrderDate) = {LOAD_YEAR}),
dc AS (SELECT CustomerName, EmailAddress, row_number() OVER (ORDER BY CustomerName, EmailAddress) AS CustomerID
       FROM (SELECT DISTINCT CustomerName, Email AS EmailAddress FROM yr)),
di AS (SELECT ItemName, row_number() OVER (ORDER BY ItemName) AS ItemID FROM (SELECT DISTINCT Item AS ItemName FROM yr))"""


@query("load_year", f"""WITH {SQL_YEAR}
SELECT CAST(dc.CustomerID AS BIGINT) AS CustomerID, CAST(di.ItemID AS BIGINT) AS ItemID, y.SalesOrderNumber,
       CAST(y.SalesOrderLineNumber AS INTEGER) AS SalesOrderLineNumber, CAST(y.OrderDate AS DATE) AS OrderDate,
       CAST(y.Quantity AS INTEGER) AS Quantity, CAST(y.Tax AS DOUBLE) AS TaxAmount,
       CAST(y.UnitPrice AS DOUBLE) AS UnitPrice
FROM yr y JOIN dc ON y.CustomerName = dc.CustomerName AND y.Email = dc.EmailAddress
JOIN di ON y.Item = di.ItemName""")
def q_load_year(spark, sf_dir):
    return md.load_year(fx.sales(spark, sf_dir), LOAD_YEAR).fact


@query("load_year_customers", f"""WITH {SQL_YEAR}
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CustomerName, EmailAddress FROM dc""")
def q_load_year_customers(spark, sf_dir):
    return md.load_year(fx.sales(spark, sf_dir), LOAD_YEAR).dim_customer


@query("load_year_items", f"""WITH {SQL_YEAR} SELECT CAST(ItemID AS BIGINT) AS ItemID, ItemName FROM di""")
def q_load_year_items(spark, sf_dir):
    return md.load_year(fx.sales(spark, sf_dir), LOAD_YEAR).dim_product


SQL_HOLED = fx.SQL_SALES + """,
holed AS (SELECT SalesOrderNumber, SalesOrderLineNumber, OrderDate, CustomerName,
                 CASE WHEN SalesOrderLineNumber % 3 <> 0 THEN Email END AS Email,
                 CASE WHEN SalesOrderLineNumber % 4 <> 0 THEN Item END AS Item, Quantity, UnitPrice, Tax FROM sales)"""


@query("build_star_null_keys", f"""WITH {SQL_HOLED},
dc AS (SELECT CustomerName, Email, row_number() OVER (ORDER BY CustomerName NULLS FIRST, Email NULLS FIRST) AS CustomerID
       FROM (SELECT DISTINCT CustomerName, Email FROM holed)),
i AS (SELECT *, string_split(Item, ' ')[1] AS ItemName, COALESCE(NULLIF(string_split(Item, ' ')[2], ''), '') AS ItemInfo FROM holed),
dp AS (SELECT ItemName, ItemInfo, row_number() OVER (ORDER BY ItemName NULLS FIRST, ItemInfo NULLS FIRST) AS ItemID
       FROM (SELECT DISTINCT ItemName, ItemInfo FROM i))
SELECT i.SalesOrderNumber, i.SalesOrderLineNumber, CAST(dc.CustomerID AS BIGINT) AS CustomerID,
       CAST(dp.ItemID AS BIGINT) AS ItemID, i.OrderDate, i.Quantity, i.UnitPrice, i.Tax
FROM i LEFT JOIN dc ON i.CustomerName IS NOT DISTINCT FROM dc.CustomerName AND i.Email IS NOT DISTINCT FROM dc.Email
LEFT JOIN dp ON i.ItemName IS NOT DISTINCT FROM dp.ItemName AND i.ItemInfo IS NOT DISTINCT FROM dp.ItemInfo""")
def q_build_star_null_keys(spark, sf_dir):
    """Lines without an email or an item find their members, and a second build adds none."""
    line = F.col("SalesOrderLineNumber")
    sales = silver_table(spark, sf_dir).withColumns({"Email": F.when(line % 3 != 0, F.col("Email")),
                                                     "Item": F.when(line % 4 != 0, F.col("Item"))})
    tables = _gold_tables(spark)
    once = md.build_star(sales, tables=tables)
    return md.build_star(sales, once, tables).fact
