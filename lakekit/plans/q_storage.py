"""Registered storage queries: snapshots (time travel, clone, truncate, restore) and file loaders.

Each query stages files from the driver tables in a fresh folder under the shared
checkpoint area, runs the operator, and returns the table it produced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from lakekit.plans.registry import query
from lakekit.session import work_dir
from lakekit.sources import files as fs
from lakekit.sources import layout
from lakekit.sources import tables as tb
from lakekit.sources.snapshots import SnapshotTable, as_of

# Fixed snapshot times of the demo table.
T1 = dt.datetime(2025, 4, 18, 19, 39, 35)
T_BETWEEN = dt.datetime(2025, 4, 19, 12, 29, 0)
T2 = dt.datetime(2025, 4, 19, 14, 24, 10)
T3 = dt.datetime(2025, 4, 20, 9, 0, 0)
T4 = dt.datetime(2025, 4, 20, 10, 0, 0)
CUT = dt.datetime(1998, 1, 1)

SQL_FIRST_LOAD = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"


def _orders_table(spark, sf_dir) -> SnapshotTable:
    """Orders loaded in two versions: T1 holds orders before 1998, T2 all orders."""
    o = tb.load(spark, sf_dir, "orders")
    t = SnapshotTable(spark, work_dir(spark, "orders-snap"))
    t.write(o.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")), at=T1)
    t.write(o, at=T2)
    return t


@query("as_of", SQL_FIRST_LOAD)
def q_as_of(spark, sf_dir):
    return _orders_table(spark, sf_dir).read(as_of=T_BETWEEN)


@query("clone_table", SQL_FIRST_LOAD)
def q_clone_table(spark, sf_dir):
    t = _orders_table(spark, sf_dir)
    clone = t.clone(work_dir(spark, "orders-clone"), as_of=T_BETWEEN)
    return clone.read()


@query("truncate", "SELECT * FROM orders WHERE FALSE")
def q_truncate(spark, sf_dir):
    t = _orders_table(spark, sf_dir)
    t.truncate(at=T3)
    return t.read()


@query("restore", "SELECT * FROM orders")
def q_restore(spark, sf_dir):
    t = _orders_table(spark, sf_dir)
    full = t.snapshot_at(T2)
    t.truncate(at=T3)
    t.restore(full, at=T4)
    return t.read()


# ------------------------------------------------------------------ file loaders

def _customer_csv(spark, sf_dir, header=True, sep=","):
    c = tb.load(spark, sf_dir, "customer")
    path = work_dir(spark, "customer-csv")
    c.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return c.schema, path


@query("read_csv_typed", "SELECT * FROM customer")
def q_read_csv_typed(spark, sf_dir):
    schema, path = _customer_csv(spark, sf_dir)
    return fs.read_csv_typed(spark, path, schema, bad_rows="fail")


@query("copy_into", "SELECT * FROM customer")
def q_copy_into(spark, sf_dir):
    schema, path = _customer_csv(spark, sf_dir, sep="|")
    target = work_dir(spark, "copy-target") + "/customer"
    tb.ensure_table(spark, target, schema)
    return fs.copy_into(spark, target, path, schema, file_type="CSV", field_terminator="|", first_row=2)


@query("file_to_table", "SELECT * FROM customer")
def q_file_to_table(spark, sf_dir):
    schema, path = _customer_csv(spark, sf_dir)
    return tb.file_to_table(spark, path, work_dir(spark, "file-table") + "/customer", schema=schema)


@query("ctas", "SELECT * FROM customer")
def q_ctas(spark, sf_dir):
    return tb.ctas(tb.load(spark, sf_dir, "customer"), work_dir(spark, "ctas") + "/gold_customer")


@query("drop_table", "SELECT * FROM nation")
def q_drop_table(spark, sf_dir):
    """A table created, dropped and created anew under its name with other columns."""
    path = work_dir(spark, "drop") + "/t"
    tb.ctas(tb.load(spark, sf_dir, "customer"), path)
    assert tb.drop_table(spark, path) and not tb.drop_table(spark, path)
    return tb.ctas(tb.load(spark, sf_dir, "nation"), path)


@query("append_rows", "SELECT * FROM region")
def q_append_rows(spark, sf_dir):
    """``INSERT ... VALUES`` of the region with the least key, ``INSERT ... SELECT`` of the others, into a table created empty."""
    region = tb.load(spark, sf_dir, "region")
    path = work_dir(spark, "values") + "/region"
    tb.ensure_table(spark, path, region.schema)
    least = F.col("r_regionkey").eqNullSafe(F.lit(region.agg(F.min("r_regionkey")).first()[0]))
    tb.append_rows(spark, path, region.where(least).collect(), region.schema)
    tb.append_query(region.where(~least), path)
    return spark.read.schema(region.schema).parquet(path)


@query("view_as_of", """
SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS newest FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
GROUP BY o_orderpriority""")
def q_view_as_of(spark, sf_dir):
    """A view over a table, read as of a time between its two versions."""
    def view(orders):
        return orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("newest"))

    return view(**as_of({"orders": _orders_table(spark, sf_dir)}, T_BETWEEN))


def _bad_csv(spark, sf_dir):
    """Customers as CSV, every 10th with a nation key that is no number."""
    c = tb.load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    path = work_dir(spark, "bad-csv")
    nation = F.when(F.col("c_custkey") % 10 == 0, F.lit("none")).otherwise(F.col("c_nationkey").cast("string"))
    c.withColumn("c_nationkey", nation).write.option("header", True).csv(path)
    return c.schema, path


@query("csv_bad_rows_null", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS c_nationkey, c_acctbal FROM customer""")
def q_csv_bad_rows_null(spark, sf_dir):
    schema, path = _bad_csv(spark, sf_dir)
    return fs.read_csv_typed(spark, path, schema, bad_rows="null")


@query("csv_bad_rows_drop", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 10 <> 0")
def q_csv_bad_rows_drop(spark, sf_dir):
    schema, path = _bad_csv(spark, sf_dir)
    return fs.read_csv_typed(spark, path, schema, bad_rows="drop")


@query("csv_bad_rows_quarantine", """
SELECT c_custkey, c_custkey % 10 = 0 AS quarantined FROM customer""")
def q_csv_bad_rows_quarantine(spark, sf_dir):
    """Every row is in one of the two frames; the bad one keeps the raw line."""
    schema, path = _bad_csv(spark, sf_dir)
    good, bad = fs.read_csv_typed(spark, path, schema, bad_rows="quarantine")
    raw_key = F.split(fs.CORRUPT, ",")[0].cast(schema["c_custkey"].dataType)
    return (good.select("c_custkey", F.lit(False).alias("quarantined"))
            .unionByName(bad.select(raw_key.alias("c_custkey"), F.lit(True).alias("quarantined"))))


DROP_SCHEMA = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                          StructField("OrderDate", DateType())])


def _dated_drops(spark, sf_dir):
    """Orders dropped as one dated file per year (``orders_YYYY-01-01.csv``)."""
    o = tb.load(spark, sf_dir, "orders")
    root = work_dir(spark, "drops")
    drops = o.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("OrderDate"),
                     F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit("-01-01.csv"))
                     .alias("drop"))
    drops.write.partitionBy("drop").option("header", True).csv(root)
    return root


SQL_DATED = """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS OrderDate,
       make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS file_date"""


@query("read_dated_files", f"{SQL_DATED} FROM orders")
def q_read_dated_files(spark, sf_dir):
    """The drops read back in one scan, the date found by pattern."""
    return fs.read_dated_files(spark, _dated_drops(spark, sf_dir), DROP_SCHEMA, name_col=None)


@query("read_dated_files_offset", f"{SQL_DATED} FROM orders")
def q_read_dated_files_offset(spark, sf_dir):
    """The date cut out by place, as ``substring(name, offset, length)`` does (folder names start with ``drop=``)."""
    return fs.read_dated_files(spark, _dated_drops(spark, sf_dir), DROP_SCHEMA, name_col=None, offset=len("drop=orders_"))


@query("read_with_lineage", """
SELECT o_orderkey, 'drop=orders_' || CAST(year(o_orderdate) AS VARCHAR) || '-01-01.csv' AS folder FROM orders""")
def q_read_with_lineage(spark, sf_dir):
    """The file each row came from, by its folder."""
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).schema(DROP_SCHEMA).csv(_dated_drops(spark, sf_dir))
    return fs.with_lineage(rows).select("o_orderkey", F.element_at(F.split("FileName", "/"), -2).alias("folder"))


@query("append_query", "SELECT * FROM orders")
def q_append_query(spark, sf_dir):
    """``INSERT INTO t SELECT ...`` twice into a table created empty with a declared schema."""
    o = tb.load(spark, sf_dir, "orders")
    path = work_dir(spark, "append") + "/orders"
    tb.ensure_table(spark, path, o.schema)
    cut = F.lit(CUT).cast("timestamp_ntz")
    tb.append_query(o.filter(F.col("o_orderdate") < cut), path)
    tb.append_query(o.filter(F.col("o_orderdate") >= cut), path)
    return spark.read.schema(o.schema).parquet(path)


@query("clustered_filter", """
SELECT 'user' AS by, event_id, user_id, ts FROM events WHERE user_id BETWEEN 10 AND 14
UNION ALL
SELECT 'ts', event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""")
def q_clustered_filter(spark, sf_dir):
    """Events laid out in Morton order of user and time, then filtered by either."""
    path = work_dir(spark, "clustered")
    layout.write_clustered(tb.load(spark, sf_dir, "events"), path, ["user_id", "ts"], files=16)
    laid = spark.read.parquet(path)
    by = lambda name, cond: laid.filter(cond).select(F.lit(name).alias("by"), "event_id", "user_id", "ts")
    day = [F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz") for d in (10, 11)]
    return by("user", F.col("user_id").between(10, 14)).unionByName(by("ts", (F.col("ts") >= day[0]) & (F.col("ts") < day[1])))
