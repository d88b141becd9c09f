"""Derived inputs: how the driver tables stand in for the reference's inputs.

Each builder returns a lazy DataFrame; the matching ``SQL_*`` text is the same
derivation for an independent SQL engine (used by the oracle queries).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekit.functions.scalar import MONEY
from lakekit.session import sort_tasks
from lakekit.sources.tables import load

# Fixed values of the stand-in data (see FIXTURES.md §3).
SCD_CUT = dt.date(1998, 1, 1)          # dimension state "as of" this date, staging after it
FIRST_LOAD_CUT = dt.date(1998, 1, 1)   # first gold load takes orders before this date
PRIORITY_DIM = "o_orderpriority"
DIMENSION_ROWS = 2_000_000             # members from which a join deals out both sides (fewer are mostly broadcast)


def sales(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Sales lines (bronze/silver/staging shape) from lineitem ⋈ orders ⋈ customer ⋈ part.

    The line number is renumbered per order (ordered by line number, part, supplier)
    because ``(l_orderkey, l_linenumber)`` repeats in the driver data; the window runs
    right after the order-key join so it reuses that join's partitioning.  Many lines are dealt
    out by their number, so that a task's sorts stay the same size however large the tables are.
    ``part`` (k, n): only the lines of the k-th of n parts of the orders, dealt by their keys.
    """
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                "l_quantity", "l_tax")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    tasks, (k, n) = sort_tasks(li), part
    if n > 1:
        tasks = -(-tasks // n)
        li, o = (d.where(F.pmod(F.xxhash64(d[key].cast("long")), F.lit(n)) == k) for d, key in ((li, "l_orderkey"), (o, "o_orderkey")))
    if tasks:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    lines = li.join(o, li.l_orderkey == o.o_orderkey)
    # o_orderdate is constant within an order: adding it to the partition keeps the numbering
    # but lets date filters on the result be pushed below the window to the orders scan
    w = Window.partitionBy("l_orderkey", "o_orderdate").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    lines = lines.withColumn("line_no", F.row_number().over(w).cast("int"))
    if tasks and c.count() > DIMENSION_ROWS:
        lines, c = lines.repartition(tasks, "o_custkey"), c.repartition(tasks, "c_custkey")
    j = lines.join(c, lines.o_custkey == c.c_custkey)
    if tasks and p.count() > DIMENSION_ROWS:
        j, p = j.repartition(tasks, "l_partkey"), p.repartition(tasks, "p_partkey")
    j = j.join(p, j.l_partkey == p.p_partkey)
    return j.select(
        F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
        F.col("line_no").alias("SalesOrderLineNumber"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("c_name").alias("CustomerName"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("Email"),
        F.col("p_name").alias("Item"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
        F.col("l_tax").cast(MONEY).alias("Tax"),
    )


SQL_SALES = """
sales AS (
  SELECT 'SO' || CAST(o.o_orderkey AS VARCHAR) AS SalesOrderNumber,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey
                                 ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) AS INTEGER)
           AS SalesOrderLineNumber,
         CAST(o.o_orderdate AS DATE) AS OrderDate,
         c.c_name AS CustomerName,
         'c' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS Email,
         p.p_name AS Item,
         CAST(l.l_quantity AS INTEGER) AS Quantity,
         CAST(p.p_retailprice AS DECIMAL(24,6)) AS UnitPrice,
         CAST(l.l_tax AS DECIMAL(24,6)) AS Tax
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as employees: hire date = first order date (partial+final aggregate)."""
    c = load(spark, sf_dir, "customer")
    first = (load(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.min("o_orderdate").cast("date").alias("hire_date")))
    return c.join(first, c.c_custkey == first.o_custkey, "left").select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("department_id"),
        F.col("hire_date"),
        (F.abs(F.col("c_acctbal").cast("decimal(18,2)")) * 10).cast("decimal(18,2)").alias("salary"),
    )


SQL_EMPLOYEES = """
employees AS (
  SELECT c.c_custkey AS employee_id, c.c_name AS name, c.c_nationkey AS department_id,
         f.hire_date,
         CAST(abs(CAST(c.c_acctbal AS DECIMAL(18,2))) * 10 AS DECIMAL(18,2)) AS salary
  FROM customer c
  LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS hire_date
             FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey
)"""


def taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as taxi trips; ``passenger_count`` is ``props.k``."""
    return trips_from_events(load(spark, sf_dir, "events"))


def trips_from_events(e: DataFrame) -> DataFrame:
    """The trip mapping for any events frame, batch or stream."""
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("event_type").alias("vendor_id"),
        F.col("ts").alias("pickup_datetime"),
        F.col("value").alias("fare_amount"),
        F.get_json_object("props", "$.k").cast("bigint").alias("passenger_count"),
    )


SQL_TRIPS = """
trips AS (
  SELECT event_id AS trip_id, event_type AS vendor_id, ts AS pickup_datetime, value AS fare_amount,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS passenger_count
  FROM events
)"""


def events_as_of(spark: SparkSession, sf_dir: str):
    """The clock for relative-time filters: the newest event time, fetched once (one
    aggregate, one value) and used as a literal so ``ts > now - span`` is pushed to the
    Parquet scan and skips row groups (a scalar subquery would only filter after the scan).
    In production the clock is simply a literal ``as_of`` or ``current_timestamp()``."""
    newest = load(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return F.lit(newest).cast("timestamp_ntz")


SQL_EVENTS_AS_OF = "(SELECT max(ts) FROM events)"


def customer_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change feed from orders: one staged row per order."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col(PRIORITY_DIM).alias("address"),
        F.col("o_orderdate").cast("date").alias("last_updated"),
        F.col("o_orderkey").alias("seq"),
    )


SQL_STAGING = """
staging AS (
  SELECT o.o_custkey AS customer_id, c.c_name AS name,
         'c' || CAST(o.o_custkey AS VARCHAR) || '@example.com' AS email,
         o.o_orderpriority AS address, CAST(o.o_orderdate AS DATE) AS last_updated,
         o.o_orderkey AS seq
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""
