import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lk_helpers import T, rows
from lakekit.sources.snapshots import SnapshotTable, as_of
from lakekit.streaming import mview as mv
from lakekit.streaming import windows as wn

BASE = T(2024, 1, 1, 0, 0, 0)


def _events(spark, pairs, keys=None):
    data = [((keys[i] if keys else 0), BASE + dt.timedelta(seconds=s), float(v)) for i, (s, v) in enumerate(pairs)]
    return spark.createDataFrame(data, "k int, ts timestamp_ntz, v double")


def test_session_gap_fixture(spark):
    df = _events(spark, [(0, 1), (600, 2), (1201, 3)])
    assert [r[1] for r in rows(wn.sessions(df, "ts", "10min", "v").select("session_start", "n_events"), "session_start")] == [2, 1]
    out = rows(wn.session_values(df, "ts", "v", "10min"), "session_start", "position")
    assert [(int((r[0] - BASE).total_seconds()), r[1], r[2]) for r in out] == [(0, 1, 1.0), (0, 2, 2.0), (1201, 1, 3.0)]


def test_tumbling_fixture_from_first_event(spark):
    df = _events(spark, [(0, 1), (25, 2)])
    out = wn.tumbling(df, "ts", "10s", "v", origin="first", fill_empty=True)
    got = [(int((r.window_start - BASE).total_seconds()), r.total_value) for r in out.orderBy("window_start").collect()]
    assert got == [(0, Decimal("1.00")), (10, Decimal("0.00")), (20, Decimal("2.00"))]


def test_reference_bounds_drop_event_on_last_start(spark):
    df = _events(spark, [(0, 1), (20, 2)])       # second event starts the last window
    keep = wn.tumbling(df, "ts", "10s", "v", origin="first")
    ref = wn.tumbling(df, "ts", "10s", "v", origin="first", reference_bounds=True)
    assert keep.agg(F.sum("n_events")).first()[0] == 2 and ref.agg(F.sum("n_events")).first()[0] == 1


def test_every_event_in_one_tumbling_window(spark):
    rnd = random.Random(7)
    df = _events(spark, [(rnd.randrange(0, 100000), rnd.random()) for _ in range(500)])
    assert wn.tumbling(df, "ts", "15min", "v").agg(F.sum("n_events")).first()[0] == 500


def _brute_sessions(times, gap):
    out, cur = [], [times[0]]
    for a, b in zip(times, times[1:]):
        if b - a > gap:
            out.append(cur)
            cur = []
        cur.append(b)
    out.append(cur)
    return [(s[0], len(s)) for s in out]


@pytest.mark.parametrize("bucket,block", [("1min", 3), ("1min", 1024), ("7min", 2), ("20min", 1024), ("1d", 1), (None, 1024)])
def test_sessions_match_brute_force_across_buckets(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(wn, "BLOCK_BUCKETS", block)
    rnd = random.Random(11)
    keys = [rnd.choice([1, 2, None]) for _ in range(400)]
    secs = [rnd.randrange(0, 20000) for _ in range(400)]
    df = _events(spark, [(s, 1) for s in secs], keys)
    got = rows(wn.sessions(df, "ts", "10min", "v", keys=["k"], bucket=bucket).select("k", "session_start", "n_events"))
    exp = []
    for k in (1, 2, None):
        times = sorted(s for s, kk in zip(secs, keys) if kk == k)
        exp += [(k, BASE + dt.timedelta(seconds=s), n) for s, n in _brute_sessions(times, 600)]
    assert got == sorted(exp, key=lambda t: tuple((x is None, str(x)) for x in t))
    values = rows(wn.session_values(df, "ts", "v", "10min", keys=["k"], bucket=bucket))
    want = [(k, start, i + 1, 1.0) for k, start, n in exp for i in range(n)]
    assert values == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_measures_keep_their_places(spark):
    df = _events(spark, [(0, 0.004), (1, 0.004), (2, 3578.2705)])
    assert wn.tumbling(df, "ts", "1h", "v").first().total_value == Decimal("3578.278500")
    from lakekit.operators.quality import scale_violations
    assert scale_violations(df, ["v"]).count() == 0 and scale_violations(df, ["v"], 2).count() == 3


def test_null_keys_are_filled_and_null_times_left_out(spark):
    df = _events(spark, [(0, 1), (7300, 2)], [None, None]).unionByName(spark.sql("SELECT NULL AS k, CAST(NULL AS TIMESTAMP_NTZ) AS ts, 1D AS v"))
    out = rows(wn.tumbling(df.filter("ts IS NOT NULL"), "ts", "1h", "v", keys=["k"], fill_empty=True).select("window_start", "n_events"))
    assert [n for _, n in out] == [1, 0, 1]
    assert wn.tumbling(df, "ts", "1h", "v", origin="first").filter("window_start IS NULL").count() == 0


def test_sliding_contains_each_event_size_over_step_times(spark):
    df = _events(spark, [(3600 * 5 + 10, 1), (3600 * 9 + 5, 1)])
    out = wn.sliding(df, "ts", "2h", "1h", "v")
    assert out.agg(F.sum("n_events")).first()[0] == 4
    first = wn.sliding(df, "ts", "2h", "1h", "v", origin="first")
    assert first.agg(F.sum("n_events")).first()[0] == 3     # no window starts before the first event


def test_snapshots_time_travel_clone_truncate_restore(spark, tmp_dir):
    t = SnapshotTable(spark, f"{tmp_dir}/emp")
    df1 = spark.createDataFrame([(1, "a")], "id int, name string")
    df2 = df1.union(spark.createDataFrame([(12, "b")], "id int, name string"))
    s1 = t.write(df1, at=T(2025, 4, 18))
    s2 = t.write(df2, at=T(2025, 4, 19))
    assert t.read(as_of=T(2025, 4, 18, 12)).count() == 1 and t.read().count() == 2
    clone = t.clone(f"{tmp_dir}/emp_clone", as_of=T(2025, 4, 18, 12))
    assert clone.read().count() == 1
    t.truncate()
    assert t.read().count() == 0 and t.read().columns == ["id", "name"]
    t.restore(s2)
    assert rows(t.read()) == rows(df2) and t.snapshots()[:2] == [s1, s2]
    with pytest.raises(LookupError):
        t.read(as_of=T(2020, 1, 1))
    views = as_of({"emp": t}, T(2025, 4, 18, 12))
    assert views["emp"].count() == 1


def test_uncommitted_snapshot_is_ignored(spark, tmp_dir):
    import os
    t = SnapshotTable(spark, f"{tmp_dir}/t")
    t.write(spark.range(3), at=T(2025, 1, 1))
    os.makedirs(f"{tmp_dir}/t/snapshot_ts=99999999999999999")   # half-written: no _SUCCESS
    assert t.read().count() == 3
    t.write(spark.range(5), at=99999999999999999)                # a replay of that id replaces it
    assert t.read().count() == 5


@pytest.mark.parametrize("cut", [0, 30, 77, 100])
def test_materialized_view_equals_recomputed(spark, tmp_dir, cut):
    rnd = random.Random(cut)
    data = [(rnd.choice("ab"), rnd.choice([1, 2, 3]), round(rnd.random() * 100, 2) if rnd.random() > 0.1 else None)
            for _ in range(100)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, vendor_id string, d int, fare double")
    view = mv.MaterializedAggregate(spark, f"{tmp_dir}/mv{cut}", ["vendor_id", "d"], ["fare"])
    view.refresh(df.filter(F.col("i") < cut), 0)
    view.refresh(df.filter(F.col("i") >= cut), 1)
    assert view.refresh(df.filter(F.col("i") >= cut), 1) is False
    got = rows(view.read_partials())
    exp = rows(view.partials(df))
    assert got == exp
    with pytest.raises(ValueError):         # other data under an id already applied
        view.refresh(df.filter(F.col("i") < 10), 1)
    assert view.refresh(df.filter(F.col("i") < 10), 0, source="second") is True
    assert len(view.table.snapshots()) <= view.keep


def test_file_stream_reads_the_exact_file(spark, tmp_dir):
    import os
    import shutil

    from lakekit.streaming import stream as st
    src = f"{tmp_dir}/src"
    _events(spark, [(i, i) for i in range(3)]).coalesce(1).write.parquet(src)
    part = [f for f in os.listdir(src) if f.endswith(".parquet")][0]
    for name in ("events.parquet", "events.parquet.old", "events.parquet2"):
        shutil.copy(f"{src}/{part}", f"{tmp_dir}/{name}")
    schema = spark.read.parquet(src).schema
    s = st.file_stream(spark, f"{tmp_dir}/events.parquet", schema)
    out = st.run_stream(s, lambda d: d.select("k", "v"), f"{tmp_dir}/sink", f"{tmp_dir}/ck", output_mode="append")
    assert spark.read.parquet(out).count() == 3


def test_dated_names_that_look_like_spark_parts(spark, tmp_dir):
    import os

    from lakekit.sources.files import read_csv_typed, read_dated_files
    os.makedirs(f"{tmp_dir}/in")
    open(f"{tmp_dir}/in/part-2024-01-05.csv", "w").write("a\n1\n")
    spark.range(1).select(F.col("id").alias("a")).write.option("header", True).csv(f"{tmp_dir}/in/2024-02-06.csv")
    got = rows(read_dated_files(spark, f"{tmp_dir}/in", spark.createDataFrame([], "a int").schema).select("a", "file_date"))
    assert got == [(0, dt.date(2024, 2, 6)), (1, dt.date(2024, 1, 5))]
    open(f"{tmp_dir}/breaks.csv", "w").write('a,b\n1,"x\ny"\n')
    assert read_csv_typed(spark, f"{tmp_dir}/breaks.csv", spark.createDataFrame([], "a int, b string").schema, multi_line=True, bad_rows="fail").collect() == [(1, "x\ny")]


def test_last_days_takes_any_span(spark):
    from lakekit.plans.timeseries import last_days
    df = spark.sql("SELECT DATE'2024-01-10' AS pickup_date, 'a' AS vendor_id, 1L AS trips, 1D AS avg_fare, 1D AS total_revenue UNION ALL SELECT DATE'2024-01-01', 'a', 1, 1, 1")
    now = F.lit(T(2024, 1, 10, 12)).cast("timestamp_ntz")
    assert last_days(df, now, "24h").count() == 1 and last_days(df, now, "24d").count() == 2


def test_partitioned_snapshot_prunes_on_read(spark, tmp_dir):
    import contextlib
    import io
    t = SnapshotTable(spark, f"{tmp_dir}/events")
    df = spark.range(0, 300).select(F.col("id"), (F.col("id") % 3).cast("int").alias("day"))
    t.write(df, at=T(2025, 1, 1), partition_by=["day"])
    got = t.read().filter(F.col("day") == 1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "PartitionFilters: [isnotnull(day" in buf.getvalue() and got.count() == 100


def test_continuous_stream_returns_handle(spark, tmp_dir):
    from lakekit.streaming import stream as st
    src = f"{tmp_dir}/src"
    _events(spark, [(i * 60, i) for i in range(120)]).write.parquet(src)
    schema = spark.read.parquet(src).schema
    s = st.file_stream(spark, src, schema, event_time="ts")
    q = st.run_stream(s, lambda d: wn.tumbling(d, "ts", "1h", "v"), f"{tmp_dir}/sink", f"{tmp_dir}/ck",
                      output_mode="complete", available_now=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = SnapshotTable(spark, f"{tmp_dir}/sink").read()
    assert out.agg(F.sum("n_events")).first()[0] == 120 and out.count() == 2


def test_sliding_reference_bounds_fixture(spark):
    df = _events(spark, [(0, 1), (5, 2), (25, 4)])
    out = wn.sliding(df, "ts", "10s", "5s", "v", reference_bounds=True)
    got = [(int((r.window_start - BASE).total_seconds()), r.n_events, r.total_value)
           for r in out.orderBy("window_start").collect()]
    # starts stop at start < 25 - 10; the last event is in no window (the reference's rule)
    assert got == [(0, 2, Decimal("3.00")), (5, 1, Decimal("2.00")), (10, 0, Decimal("0.00"))]


def test_append_rows_query_sends_one_row_through_the_driver(spark, tmp_dir, monkeypatch):
    from lakekit.plans import q_storage

    wide = spark.range(500).selectExpr("cast(id as int) AS r_regionkey", "concat('r', id) AS r_name", "'c' AS r_comment")
    wide.write.parquet(f"{tmp_dir}/region.parquet")
    sent, append = [], q_storage.tb.append_rows
    monkeypatch.setattr(q_storage.tb, "append_rows", lambda s, path, rows, schema: (sent.append(len(rows)), append(s, path, rows, schema)))
    got = q_storage.q_append_rows(spark, tmp_dir)
    assert sent == [1] and sorted(got.collect()) == sorted(wide.collect())
