"""Bronze -> silver -> gold.

The silver job reads a CSV glob with a fixed schema, adds lineage/audit/flag
columns, and upserts into a snapshot table.  The gold build derives a date, a
customer and a product dimension (dense surrogate keys continuing from the current
maximum) and a fact table keyed on the sales line, so a re-run inserts nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType, BooleanType, TimestampNTZType)

from lakekit.functions.scalar import MONEY_SCALE, before_date, null_or_empty_default, split_word, word_or_empty, year_range
from lakekit.llm.common import release, shuffles_deleted, staged
from lakekit.operators.keys import assign_surrogate_keys, max_key
from lakekit.operators.merge import assert_unique_keys, merge_insert_only, merge_upsert
from lakekit.session import reliable_checkpoint, sort_tasks
from lakekit.sources.files import CORRUPT, read_csv_typed
from lakekit.sources.snapshots import SnapshotTable

MERGE_SLICES = 4        # parts of a large silver table's keys that are merged one after the other

# Unit prices and taxes keep six places (the files hold up to four).
MEASURE = DecimalType(24, MONEY_SCALE)

BRONZE_SCHEMA = StructType([
    StructField("SalesOrderNumber", StringType()),
    StructField("SalesOrderLineNumber", IntegerType()),
    StructField("OrderDate", DateType()),
    StructField("CustomerName", StringType()),
    StructField("Email", StringType()),
    StructField("Item", StringType()),
    StructField("Quantity", IntegerType()),
    StructField("UnitPrice", MEASURE),
    StructField("Tax", MEASURE),
])

SILVER_SCHEMA = StructType(list(BRONZE_SCHEMA.fields) + [
    StructField("FileName", StringType()),
    StructField("IsFlagged", BooleanType()),
    StructField("CreatedTS", TimestampNTZType()),
    StructField("ModifiedTS", TimestampNTZType()),
])

LINE_KEY = ("SalesOrderNumber", "SalesOrderLineNumber")
CUSTOMER_KEY = ("CustomerName", "Email")
PRODUCT_KEY = ("ItemName", "ItemInfo")

DIM_DATE_SCHEMA = StructType([
    StructField("OrderDate", DateType()), StructField("Day", IntegerType()), StructField("Month", IntegerType()),
    StructField("Year", IntegerType()), StructField("mmmyyyy", StringType()), StructField("yyyymm", StringType()),
])
DIM_CUSTOMER_SCHEMA = StructType([
    StructField("CustomerName", StringType()), StructField("Email", StringType()),
    StructField("First", StringType()), StructField("Last", StringType()), StructField("CustomerID", LongType()),
])
DIM_PRODUCT_SCHEMA = StructType([
    StructField("ItemName", StringType()), StructField("ItemInfo", StringType()), StructField("ItemID", LongType()),
])
FACT_COLUMNS = ("SalesOrderNumber", "SalesOrderLineNumber", "CustomerID", "ItemID", "OrderDate",
                "Quantity", "UnitPrice", "Tax")


# ------------------------------------------------------------------ silver

def with_audit(df: DataFrame, as_of=None, created: str = "CreatedTS", modified: str = "ModifiedTS") -> DataFrame:
    """Audit columns (Q3): load time as created/modified.  ``as_of`` fixes the clock (tests);
    by default it is ``current_timestamp()``, one value for the whole query."""
    now = (F.lit(as_of).cast("timestamp_ntz") if as_of is not None
           else F.current_timestamp().cast("timestamp_ntz"))
    return df.withColumns({created: now, modified: now})


def silver_enrich(df: DataFrame, *, flag_before, as_of=None, name_default: str = "Unknown") -> DataFrame:
    """Clean and enrich a bronze frame: legacy flag, audit times, default names."""
    df = df.withColumn("IsFlagged", before_date("OrderDate", flag_before))
    return with_audit(df, as_of).withColumn("CustomerName", null_or_empty_default("CustomerName", name_default))


def bronze_to_silver(spark: SparkSession, bronze_glob: str, silver: SnapshotTable, *, flag_before,
                     keys: Sequence[str] = LINE_KEY, as_of=None, bad_rows: str = "null", quarantine: SnapshotTable | None = None) -> int:
    """The whole silver job (M17): typed CSV -> lineage + enrichment -> upsert -> new snapshot.

    ``CreatedTS`` keeps its first value on re-runs; duplicate keys in the drop raise
    before anything is written.  With ``bad_rows="quarantine"`` the lines that don't parse are
    kept, with their file, as a snapshot of ``quarantine`` (one a run, an empty one too), written
    after the key check.  Returns the id of the snapshot written.
    """
    if (bad_rows == "quarantine") != (quarantine is not None):
        raise ValueError("bad_rows='quarantine' and a quarantine table belong together")
    bronze = read_csv_typed(spark, bronze_glob, BRONZE_SCHEMA, bad_rows=bad_rows, lineage="FileName")
    bad = None
    if quarantine is not None:
        bronze, bad = bronze
    updates = silver_enrich(bronze, flag_before=flag_before, as_of=as_of)
    # parsed once: the key check and the merge read the written rows, which go when the snapshot is there
    updates = staged(updates.select(*SILVER_SCHEMA.fieldNames()), "silver-updates")
    try:
        with shuffles_deleted(spark):
            assert_unique_keys(updates, keys)
            if silver.snapshots():
                old, new = silver.read(), updates
                tasks = max(sort_tasks(old), sort_tasks(new))
                # both sides are moved and sorted whole: large ones by slices of their keys, each deleting its shuffle files
                slices, tasks = (MERGE_SLICES, -(-tasks // MERGE_SLICES)) if tasks else (1, 0)
                merged = []
                for k in range(slices):
                    sides = (d.where(F.pmod(F.xxhash64(*keys), F.lit(slices)) == k).repartition(tasks, *keys) if tasks else d for d in (old, new))
                    merged.append(merge_upsert(*sides, keys, preserve=("CreatedTS",), check_unique=False))
            else:
                merged = updates
            if bad is not None:
                quarantine.write(bad.select("FileName", F.col(CORRUPT).alias("line")))
            return silver.write(merged)
    finally:
        release(updates)


# ------------------------------------------------------------------ gold

def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def dim_date(sales: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Date dimension, type 0: new dates are added, existing rows never change."""
    dates = sales.select("OrderDate").distinct().filter(F.col("OrderDate").isNotNull()).select(
        "OrderDate",
        F.dayofmonth("OrderDate").alias("Day"),
        F.month("OrderDate").alias("Month"),
        F.year("OrderDate").alias("Year"),
        F.date_format("OrderDate", "MMM-yyyy").alias("mmmyyyy"),
        F.date_format("OrderDate", "yyyyMM").alias("yyyymm"),
    )
    if existing is None:
        return dates
    return merge_insert_only(existing, dates, ["OrderDate"])


def _same(left: DataFrame, right: DataFrame, pairs) -> Column:
    """NULL-safe equality of column pairs: a NULL key is a member like any other."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def _unseen(members: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Members whose key the dimension does not hold yet."""
    seen = existing.select(*(F.col(c).alias(f"__{c}") for c in key))
    return members.join(seen, _same(members, seen, [(c, f"__{c}") for c in key]), "left_anti")


def _with_id(rows: DataFrame, dim: DataFrame, pairs, id_col: str) -> DataFrame:
    """Look up ``id_col`` by NULL-safe key pairs (row column, dimension column)."""
    d = dim.select(*(F.col(b).alias(f"__{b}") for _, b in pairs), id_col)
    return rows.join(d, _same(rows, d, [(a, f"__{b}") for a, b in pairs]), "left").drop(*(f"__{b}" for _, b in pairs))


def dim_customer(sales: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Customer dimension: one key (name, email) for dedup, anti join and ids."""
    spark = sales.sparkSession
    existing = existing if existing is not None else empty(spark, DIM_CUSTOMER_SCHEMA)
    members = sales.select(*CUSTOMER_KEY).distinct()
    new = (_unseen(members, existing, CUSTOMER_KEY)
           .withColumn("First", split_word("CustomerName", 0))
           .withColumn("Last", split_word("CustomerName", 1)))
    new = assign_surrogate_keys(new, list(CUSTOMER_KEY), "CustomerID", start_after=max_key(existing, "CustomerID"))
    return existing.unionByName(new.select(*DIM_CUSTOMER_SCHEMA.fieldNames()))


def product_parts(df: DataFrame, item: str = "Item") -> DataFrame:
    return (df.withColumn("ItemName", split_word(item, 0))
            .withColumn("ItemInfo", word_or_empty(item, 1)))


def dim_product(sales: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Product dimension keyed on (first word, second word or ''); dedup on that key."""
    spark = sales.sparkSession
    existing = existing if existing is not None else empty(spark, DIM_PRODUCT_SCHEMA)
    members = product_parts(sales.select("Item").distinct()).select(*PRODUCT_KEY).distinct()
    new = _unseen(members, existing, PRODUCT_KEY)
    new = assign_surrogate_keys(new, list(PRODUCT_KEY), "ItemID", start_after=max_key(existing, "ItemID"))
    return existing.unionByName(new.select(*DIM_PRODUCT_SCHEMA.fieldNames()))


def build_fact_sales(sales: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Fact rows with both surrogate keys looked up by NULL-safe left joins.
    Spark broadcasts a dimension that is small by its bytes."""
    rows = _with_id(product_parts(sales), dim_cust, [(c, c) for c in CUSTOMER_KEY], "CustomerID")
    return _with_id(rows, dim_prod, [(c, c) for c in PRODUCT_KEY], "ItemID").select(*FACT_COLUMNS)


@dataclass
class Star:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    fact: DataFrame


def build_star(sales: DataFrame, current: Star | None = None, tables: dict[str, SnapshotTable] | None = None) -> Star:
    """The whole gold build (M15): dims first, then the fact against the dims as written.

    Each table is written once, as a new snapshot of ``tables`` (or to the shared
    checkpoint folder), and read back.  The fact merge is insert-only on the sales
    line, so running the build twice on the same silver data gives the same fact (X18).
    """
    spark = sales.sparkSession

    def landed(name: str, df: DataFrame) -> DataFrame:
        if tables is None:
            return reliable_checkpoint(df)
        tables[name].write(df)
        return tables[name].read()

    d = landed("dim_date", dim_date(sales, current.dim_date if current else empty(spark, DIM_DATE_SCHEMA)))
    c = landed("dim_customer", dim_customer(sales, current.dim_customer if current else None))
    p = landed("dim_product", dim_product(sales, current.dim_product if current else None))
    fact = build_fact_sales(sales, c, p)
    if current:
        fact = merge_insert_only(current.fact, fact, list(LINE_KEY))
    return Star(d, c, p, landed("fact", fact))


# ------------------------------------------------------------------ year-scoped warehouse load

CUSTOMER_ROW = StructType([StructField("CustomerID", LongType()), StructField("CustomerName", StringType()),
                           StructField("EmailAddress", StringType())])
ITEM_ROW = StructType([StructField("ItemID", LongType()), StructField("ItemName", StringType())])


def load_year(staging: DataFrame, year: int, dim_cust: DataFrame | None = None,
              dim_item: DataFrame | None = None) -> Star:
    """Year-scoped load (M16): customer and item dims from the year's staging rows
    (DISTINCT + NOT EXISTS), then the year's facts with explicit casts (F9).

    The year's rows are written once and read for both dims and the fact.  Names are not
    used as ids (X19): both dims get surrogate keys.
    """
    spark = staging.sparkSession
    rows = staging.filter(year_range(F.col("OrderDate").cast("date"), year))
    rows = reliable_checkpoint(rows.select(
        "SalesOrderNumber", F.col("SalesOrderLineNumber").cast("int").alias("SalesOrderLineNumber"),
        F.col("OrderDate").cast("date").alias("OrderDate"), "CustomerName", F.col("Email").alias("EmailAddress"),
        F.col("Item").alias("ItemName"), F.col("Quantity").cast("int").alias("Quantity"),
        F.col("Tax").cast("double").alias("TaxAmount"), F.col("UnitPrice").cast("double").alias("UnitPrice")))

    def grown(dim: DataFrame | None, row: StructType) -> DataFrame:
        id_col, *key = row.fieldNames()
        dim = dim if dim is not None else empty(spark, row)
        new = assign_surrogate_keys(_unseen(rows.select(*key).distinct(), dim, key), key, id_col,
                                    start_after=max_key(dim, id_col))
        return reliable_checkpoint(dim.unionByName(new.select(id_col, *key)))

    cust, item = grown(dim_cust, CUSTOMER_ROW), grown(dim_item, ITEM_ROW)
    fact = _with_id(rows, cust, [("CustomerName", "CustomerName"), ("EmailAddress", "EmailAddress")], "CustomerID")
    fact = _with_id(fact, item, [("ItemName", "ItemName")], "ItemID")
    return Star(None, cust, item, fact.select("CustomerID", "ItemID", "SalesOrderNumber", "SalesOrderLineNumber",
                                              "OrderDate", "Quantity", "TaxAmount", "UnitPrice"))


def flag_legacy_orders(orders: DataFrame, before=dt.date(1998, 8, 1)) -> DataFrame:
    """``IsFlagged = OrderDate < cut`` against a DATE literal; NULL dates are not flagged (Q2)."""
    return orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("OrderDate"),
                         before_date(F.col("o_orderdate").cast("date"), before).alias("IsFlagged"))
