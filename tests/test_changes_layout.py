"""Upserts that touch only what changes, views under updates and deletes, clustered layout, quarantine."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from lk_helpers import rows
from pyspark.sql import functions as F

from lakekit.operators import merge as M
from lakekit.operators import scd
from lakekit.plans import medallion as md
from lakekit.sources import layout
from lakekit.sources.buckets import BUCKET, PENDING, BucketTable
from lakekit.sources.snapshots import SnapshotTable
from lakekit.streaming import mview as mv

SCHEMA = "id long, name string, v double"


def table(spark, tmp_dir, n=200, buckets=16):
    t = BucketTable(spark, f"{tmp_dir}/t", ["id"], buckets)
    df = spark.createDataFrame([(i, f"n{i}", float(i)) for i in range(n)] + [(None, "none", 0.0)], SCHEMA)
    t.create(df)
    return t, df


def test_only_touched_buckets_are_rewritten(spark, tmp_dir):
    t, df = table(spark, tmp_dir)
    before = t.files()
    updates = spark.createDataFrame([(3, "new", -1.0), (1000, "added", 5.0)], SCHEMA)
    touched = t.upsert(updates)
    after = t.files()
    assert 1 <= len(touched) <= 2
    assert {b: f for b, f in after.items() if b not in touched} == {b: f for b, f in before.items() if b not in touched}
    assert all(after[b] != before.get(b) for b in touched)
    assert rows(t.read()) == rows(M.merge_upsert(df, updates, ["id"]))
    assert t.upsert(updates.limit(0)) == [] and t.files() == after


def test_other_merges_and_key_types(spark, tmp_dir):
    t, df = table(spark, tmp_dir)
    some = spark.createDataFrame([(4, "x", 9.0), (500, "y", 8.0), (None, "again", 7.0)], "id int, name string, v double")
    t.upsert(some, M.merge_columns, update_set=["v"], insert_cols=["name"], check_unique=False)
    assert rows(t.read()) == rows(M.merge_columns(df, some, ["id"], update_set=["v"], insert_cols=["name"]))
    t.upsert(some, M.merge_insert_only, null_safe=True)
    assert t.read().filter("id is null").count() == 2 and t.read().filter("id = 500").count() == 1


def test_failed_upserts_are_finished_or_dropped(spark, tmp_dir):
    t, df = table(spark, tmp_dir)
    updates = spark.createDataFrame([(3, "new", -1.0)], SCHEMA)
    merged = M.merge_upsert(df, updates, ["id"]).withColumn(BUCKET, t._bucket())
    bucket = merged.filter("id = 3").first()[BUCKET]
    pending = f"{t.root}/{PENDING}"
    merged.filter(F.col(BUCKET) == bucket).write.partitionBy(BUCKET).parquet(pending)
    before = t.files()
    BucketTable(spark, t.root, ["id"], 16)      # complete: the next to open the table replaces the bucket
    assert rows(t.read()) == rows(M.merge_upsert(df, updates, ["id"])) and t.files()[bucket] != before[bucket]
    merged.filter(F.col(BUCKET) == bucket).withColumn("name", F.lit("bad")).write.partitionBy(BUCKET).parquet(pending)
    t._fs.delete(t._Path(f"{pending}/_SUCCESS"), False)
    BucketTable(spark, t.root, ["id"], 16)      # incomplete: dropped
    assert rows(t.read()) == rows(M.merge_upsert(df, updates, ["id"])) and not glob.glob(f"{t.root}/{PENDING}")


def test_untouched_buckets_are_not_read(spark, tmp_dir):
    t, _ = table(spark, tmp_dir)
    plan = t._stored().filter(F.col(BUCKET).isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in plan and "PushedFilters: []" in plan      # the scan lists one folder


def test_the_tables_own_column_is_refused(spark, tmp_dir):
    with pytest.raises(ValueError, match="bucket"):
        BucketTable(spark, f"{tmp_dir}/t", ["id"], 4).create(spark.createDataFrame([(1, 2)], "id long, bucket int"))


def test_inline_key_check_fails_when_run_and_shares_the_joins_exchange(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    u = spark.createDataFrame([(2, "x", 3.0), (5, "y", 4.0)], SCHEMA)
    out = M.merge_upsert(t, u, ["id"], check_unique="inline")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == rows(M.merge_upsert(t, u, ["id"]))
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" in plan      # one a side
    twice = u.unionByName(u.limit(1))
    bad = M.merge_upsert(t, twice, ["id"], check_unique="inline")
    with pytest.raises(Exception, match="duplicate source keys"):
        bad.collect()
    with pytest.raises(Exception, match="duplicate source keys"):
        M.merge_columns(t, twice, ["id"], update_set=["v"], check_unique="inline").collect()
    with pytest.raises(ValueError, match="inline"):
        M.merge_upsert(t, u, ["id"], check_unique="later")


# ---------------------------------------------------------------- views under updates and deletes

def view_rows(view):
    return sorted(((r["k"], r[mv.N], None if r["__sum_v"] is None else float(r["__sum_v"]), r["__cnt_v"]) for r in view.read_partials().collect()), key=str)


def recomputed(spark, data):
    out = {}
    for k, v in data:
        out.setdefault(k, []).append(v)
    known = {k: [x for x in v if x is not None] for k, v in out.items()}
    return sorted(((k, len(v), sum(known[k]) if known[k] else None, len(known[k])) for k, v in out.items()), key=str)


def test_view_follows_updates_and_deletes(spark, tmp_dir):
    df = lambda data: spark.createDataFrame(data, "k string, v double")
    view = mv.MaterializedAggregate(spark, f"{tmp_dir}/v", ["k"], ["v"])
    data = [("a", 1.0), ("a", 2.0), ("b", 4.0), ("c", None), (None, 8.0)]
    view.refresh(df(data), 0)
    view.refresh(None, 1, removed=df([("b", 4.0), ("c", None)]))        # both groups are empty now
    left = [("a", 1.0), ("a", 2.0), (None, 8.0)]
    assert view_rows(view) == recomputed(spark, left)
    view.refresh(df([("a", 5.0), ("d", 3.0)]), 2, removed=df([("a", 1.0), (None, 8.0)]))
    left = [("a", 5.0), ("a", 2.0), ("d", 3.0)]
    assert view_rows(view) == recomputed(spark, left)
    assert not view.refresh(df([("a", 5.0), ("d", 3.0)]), 2, removed=df([("a", 1.0), (None, 8.0)]))     # replay
    assert view_rows(view) == recomputed(spark, left)


def test_random_changes_equal_recomputation(spark, tmp_dir):
    rnd = random.Random(2)
    df = lambda data: spark.createDataFrame(data, "k string, v double")
    view = mv.MaterializedAggregate(spark, f"{tmp_dir}/v", ["k"], ["v"])
    data = [(rnd.choice("abcdef"), float(rnd.randrange(100))) for _ in range(60)]
    view.refresh(df(data), 0)
    for batch in range(1, 5):
        rnd.shuffle(data)
        gone, data = data[:12], data[12:]
        new = [(rnd.choice("abcdef"), float(rnd.randrange(100))) for _ in range(5)]
        view.refresh(df(new), batch, removed=df(gone))
        data += new
        assert view_rows(view) == recomputed(spark, data)


def test_rows_that_the_view_never_held_raise(spark, tmp_dir):
    view = mv.MaterializedAggregate(spark, f"{tmp_dir}/v", ["k"], ["v"])
    view.refresh(spark.createDataFrame([("a", 1.0)], "k string, v double"), 0)
    with pytest.raises(Exception, match="doesn't hold"):
        view.refresh(None, 1, removed=spark.createDataFrame([("a", 1.0), ("a", 1.0)], "k string, v double"))
    assert view_rows(view) == [("a", 1, 1.0, 1)]


# ---------------------------------------------------------------- layout

def touched_share(path, column, low, high):
    """Share of row groups whose statistics can't exclude low <= column <= high."""
    hit = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += s.min <= high and s.max >= low
    return hit / total, total


def test_filters_on_either_column_skip_most_row_groups(spark, tmp_dir):
    df = spark.range(200_000).select((F.xxhash64("id") % 1000).alias("a"), (F.xxhash64("id", F.lit(1)) % 1000).alias("b"), "id")
    layout.write_clustered(df, f"{tmp_dir}/z", ["a", "b"], files=64)
    df.repartitionByRange(64, "a").sortWithinPartitions("a").write.parquet(f"{tmp_dir}/sorted")
    for column in ("a", "b"):
        share, groups = touched_share(f"{tmp_dir}/z", column, 100, 110)
        assert groups >= 64 and share <= 0.25
    assert touched_share(f"{tmp_dir}/sorted", "b", 100, 110)[0] == 1.0      # what one sort column does to the other
    assert rows(spark.read.parquet(f"{tmp_dir}/z").agg(F.count("*"), F.sum("id"))) == rows(df.agg(F.count("*"), F.sum("id")))


def test_morton_order_of_bins(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = df.select("a", "b", layout.interleave([F.col("a"), F.col("b")], 2).alias("m")).collect()
    assert {(r.a, r.b): r.m for r in got} == {(a, b): (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | (b & 1) for a in range(4) for b in range(4)}


def test_layout_of_nulls_ties_and_few_values(spark, tmp_dir):
    df = spark.createDataFrame([(None, 1.0), (1, None), (1, 2.0)] + [(7, 7.0)] * 500, "a long, b double")
    layout.write_clustered(df, f"{tmp_dir}/z", ["a", "b"], files=8)
    got = spark.read.parquet(f"{tmp_dir}/z")
    assert rows(got) == rows(df) and len(glob.glob(f"{tmp_dir}/z/*.parquet")) >= 6      # a value of most rows is split
    layout.write_clustered(df.limit(0), f"{tmp_dir}/e", ["a", "b"], files=2)
    assert spark.read.schema(df.schema).parquet(f"{tmp_dir}/e").count() == 0


# ---------------------------------------------------------------- quarantine, type 0

def test_quarantine_keeps_bad_lines_with_their_file(spark, tmp_dir):
    path = f"{tmp_dir}/2024.csv"
    with open(path, "w") as f:
        f.write(",".join(md.BRONZE_SCHEMA.fieldNames()) + "\n")
        f.write("SO1,1,2024-01-05,Ann Lee,a@x,Bike,2,10.5,1.0\nSO1,2,2024-01-05,Ann Lee,a@x,Bike,many,10.5,1.0\nSO2,1,2024-01-06,,b@x,Bike,1,10.5,1.0\n")
    silver, bad = SnapshotTable(spark, f"{tmp_dir}/silver"), SnapshotTable(spark, f"{tmp_dir}/bad")
    for n in range(2):
        md.bronze_to_silver(spark, path, silver, flag_before=dt.date(2020, 1, 1), as_of=dt.datetime(2024, 2, 1 + n), bad_rows="quarantine", quarantine=bad)
        assert [(r.SalesOrderNumber, r.CustomerName) for r in silver.read().orderBy("SalesOrderNumber").collect()] == [("SO1", "Ann Lee"), ("SO2", "Unknown")]
        line = bad.read().collect()
        assert [r["line"] for r in line] == ["SO1,2,2024-01-05,Ann Lee,a@x,Bike,many,10.5,1.0"] and line[0]["FileName"].endswith("2024.csv")
    assert len(bad.snapshots()) == 2 and all(r.FileName.endswith("2024.csv") for r in silver.read().collect())
    with pytest.raises(ValueError, match="belong together"):
        md.bronze_to_silver(spark, path, silver, flag_before=dt.date(2020, 1, 1), bad_rows="quarantine")


def test_type_0_takes_the_last_row_of_a_new_key(spark):
    dim = spark.createDataFrame([(1, "kept")], "k long, name string")
    incoming = spark.createDataFrame([(1, "changed", 9), (2, "b", 3), (2, "a", 5), (2, "c", 4)], "k long, name string, seq int")
    assert rows(scd.scd0_insert_new(dim, incoming, ["k"], ["seq"])) == [(1, "kept"), (2, "a")]
    assert rows(scd.scd0_insert_new(dim, incoming, ["k"])) == [(1, "kept"), (2, "c")]
