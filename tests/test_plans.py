"""Plan-shape checks: the properties the operators rely on at scale, read from explain()."""

import contextlib
import io
import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakekit.operators import keys as K
from lakekit.operators import merge as M
from lakekit.streaming import windows as wn

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    p = plan(entry.queries()["latest_per_key"](spark, SF))
    head = p.split("\n\n")[0]
    agg_lines = [ln for ln in head.splitlines() if "Aggregate" in ln]
    assert len(agg_lines) == 2 and "Exchange" in head          # partial + final around one exchange
    assert "Window" not in head


def test_year_filter_reaches_the_orders_scan(spark):
    p = plan(entry.queries()["sales_by_customer"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in p and "LessThan(o_orderdate,1998-01-01" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p


def test_top1_uses_partial_window_group_limit(spark):
    p = plan(entry.queries()["top_customer_per_category"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2


def test_merge_is_one_join_and_starts_no_job(spark):
    big = spark.range(0, 100000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    upd = spark.range(0, 50).select((F.col("id") * 3000).alias("k"), F.lit(-1).cast("bigint").alias("v"))
    spark.sparkContext.setJobGroup("merge-plan", "no job before execution")
    out = M.merge_upsert(big, upd, ["k"], check_unique=False)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("merge-plan")
    p = plan(out)
    assert p.split("\n\n")[0].count("Join") == 1 and "FullOuter" in p


def test_wide_updates_are_not_broadcast(spark):
    """2000 updates of 200 KB each are few rows but 400 MB."""
    big = spark.range(0, 100000).select(F.col("id").alias("k"), F.lit("").alias("v"))
    upd = spark.range(0, 2000).select((F.col("id") * 30).alias("k"), F.repeat(F.lit("x"), 200_000).alias("v"))
    assert "Broadcast" not in plan(M.merge_upsert(big, upd, ["k"], check_unique=False))


def test_dense_keys_never_use_a_single_partition(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7 % 2000).alias("k"))
    assert "SinglePartition" not in plan(K.assign_surrogate_keys(df, ["k"], "sk"))


def _parts(df, gap, **options):
    return wn._partial_sessions(df, "ts", gap, None, options.pop("keys", []), None)


def test_keyed_sessions_do_not_funnel_a_hot_key(spark):
    rnd = random.Random(3)
    rows = [(0 if i % 3 == 0 else rnd.randrange(1, 50), i * 130) for i in range(3000)]   # key 0 holds a third
    df = spark.createDataFrame(rows, "k int, s long").select(
        "k", F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz").alias("ts"))
    out = wn.sessions(df, "ts", "1min", keys=["k"])
    assert "SinglePartition" not in plan(out)
    assert _parts(df, "1min", keys=["k"]).filter("k = 0").select("__b").distinct().count() > 50
    assert out.filter("k = 0").agg(F.sum("n_events")).first()[0] == 1000


def test_one_outlier_does_not_widen_the_buckets(spark):
    df = spark.range(0, 5000).select(F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).cast("timestamp_ntz").alias("ts"))
    old = spark.range(1).select(F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz").alias("ts"))
    assert _parts(df.union(old), "1min").select("__b").distinct().count() > 80
    assert wn.sessions(df.union(old), "ts", "1min").count() == 2


def test_relative_time_filter_reaches_the_events_scan(spark):
    p = plan(entry.queries()["filter_funnel"](spark, SF))
    scan = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThan(ts," in scan and "EqualTo(event_type,click)" in scan
