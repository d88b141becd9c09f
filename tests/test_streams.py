"""Streams: recovery, state of our own, late rows, joins, drops."""

import datetime as dt
import glob
import os
import random

import pytest
from lk_helpers import rows
from pyspark.sql import functions as F

from lakekit.operators import scd
from lakekit.sources.snapshots import SnapshotTable
from lakekit.streaming import drops as dr
from lakekit.streaming import joins as jn
from lakekit.streaming import late as lt
from lakekit.streaming import mview as mv
from lakekit.streaming import stateful as sf
from lakekit.streaming import stream as st
from lakekit.streaming import windows as wn

SCHEMA = "k string, ts timestamp, v double"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def deliver(spark, folder, n, data, schema=SCHEMA):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{n}")


def source(spark, folder, schema=SCHEMA):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def drop_last_commit(checkpoint):
    """As after a crash between the sink's commit and the stream's."""
    commits = sorted(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (commits[-1], f"{checkpoint}/commits/.{os.path.basename(commits[-1])}.crc"):
        if os.path.exists(path):
            os.remove(path)
    return int(os.path.basename(commits[-1]))


def hourly(spark, tmp_dir):
    return st.run_stream(source(spark, f"{tmp_dir}/in"), lambda s: wn.tumbling(s, "ts", "1h", "v"), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                         watermark=("ts", "1 hour"))


def test_stream_goes_on_after_a_replayed_batch(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(m), 1.0) for m in range(0, 200, 7)])
    first = rows(hourly(spark, tmp_dir).read())
    drop_last_commit(f"{tmp_dir}/ckpt")
    assert rows(hourly(spark, tmp_dir).read()) == first
    deliver(spark, f"{tmp_dir}/in", 1, [("a", at(500), 2.0)])
    after = rows(hourly(spark, tmp_dir).read())
    assert len(after) == len(first) + 1 and set(first) < set(after)
    drop_last_commit(f"{tmp_dir}/ckpt")
    assert rows(hourly(spark, tmp_dir).read()) == after


def test_new_checkpoint_over_an_old_sink_raises(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(0), 1.0)])
    hourly(spark, tmp_dir)
    with pytest.raises(ValueError, match="another checkpoint"):
        st.run_stream(source(spark, f"{tmp_dir}/in"), lambda s: wn.tumbling(s, "ts", "1h", "v"), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt2")


def test_the_state_store_setting_is_put_back(spark, tmp_dir):
    before = spark.conf.get(st.STATE_STORE, None)
    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(0), 1.0)])
    st.run_stream(source(spark, f"{tmp_dir}/in"), lambda s: sf.session_values_stream(s, "ts", "v", "5min", ["k"]), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                  output_mode="append", watermark=("ts", "1 minute"), state_store=st.ROCKSDB)
    assert spark.conf.get(st.STATE_STORE, None) == before


# ---------------------------------------------------------------- sessions with their values

def sessions_run(spark, tmp_dir, keys):
    st.run_stream(source(spark, f"{tmp_dir}/in"), lambda s: sf.session_values_stream(s, "ts", "v", "10min", keys), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                  output_mode="append", watermark=("ts", "30 minutes"), state_store=st.ROCKSDB)
    over = spark.read.parquet(f"{tmp_dir}/sink")
    return over, sf.open_session_values(spark, f"{tmp_dir}/ckpt", "10min", keys)


@pytest.mark.parametrize("keys", [["k"], []])
def test_session_values_equal_the_batch_version(spark, tmp_dir, keys):
    """Three deliveries out of order within the watermark, NULL keys, equal times, NULL values."""
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), at(m / 3), rnd.choice([None, 1.5, float(m)])) for m in range(0, 1500, 4) if m % 200 < 140]
    data += [("a", at(50), 7.0), ("a", at(50), 3.0), ("b", None, 1.0)]
    data.sort(key=lambda r: (r[1] or T0) + dt.timedelta(minutes=rnd.randrange(25)))     # 25 minutes late at most
    for n in range(3):
        deliver(spark, f"{tmp_dir}/in", n, data[n * 100: (n + 1) * 100 if n < 2 else None])
        over, left = sessions_run(spark, tmp_dir, keys)
        if n == 0:
            assert over.count() < 100
    want = wn.session_values(spark.createDataFrame(data, SCHEMA), "ts", "v", "10min", keys=keys)
    assert rows(over.unionByName(left)) == rows(want)
    assert over.count() > left.count() > 0


def test_state_goes_with_the_sessions(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(m), 1.0) for m in range(30)] + [("b", at(3), 2.0)])
    sessions_run(spark, tmp_dir, ["k"])
    deliver(spark, f"{tmp_dir}/in", 1, [("c", at(500), 1.0)])
    over, left = sessions_run(spark, tmp_dir, ["k"])
    assert over.groupBy("k").count().count() == 2 and [r["k"] for r in left.collect()] == ["c"]


def test_rows_of_a_closed_session_are_too_late(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(0), 1.0), ("a", at(100), 1.0)])
    sessions_run(spark, tmp_dir, ["k"])
    deliver(spark, f"{tmp_dir}/in", 1, [("a", at(1), 9.0), ("a", at(101), 2.0)])
    over, left = sessions_run(spark, tmp_dir, ["k"])
    assert [r["value"] for r in over.collect()] == [1.0] and sorted(r["value"] for r in left.collect()) == [1.0, 2.0]


# ---------------------------------------------------------------- panes and grids

def brute_sliding(data, size, step, origin):
    """{(key, start in seconds): [values]} with windows by hand; seconds since T0, a multiple of all steps."""
    out, size, step = {}, 60 * size, 60 * step
    for k in {r[0] for r in data}:
        mine = [(int((r[1] - T0).total_seconds()), r[2]) for r in data if r[0] == k and r[1] is not None]
        if not mine:
            continue
        zero = min(m for m, _ in mine) if origin == "first" else 0
        for m, v in mine:
            i = (m - zero) // step
            while zero + i * step + size > m:
                if zero + i * step <= m and (origin == "epoch" or i >= 0):
                    out.setdefault((k, zero + i * step), []).append(v)
                i -= 1
    return out


@pytest.mark.parametrize("origin", ["epoch", "first"])
@pytest.mark.parametrize("size,step", [(60, 1), (90, 60), (50, 20), (30, 30)])
def test_sliding_from_panes(spark, size, step, origin):
    rnd = random.Random(size + step)
    data = [(rnd.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rnd.randrange(0, 36_000)), float(rnd.randrange(9))) for _ in range(150)] + [("a", None, 1.0)]
    got = wn.sliding(spark.createDataFrame(data, SCHEMA), "ts", f"{size}min", f"{step}min", "v", keys=["k"], origin=origin).collect()
    want = brute_sliding(data, size, step, origin)
    assert {(r["k"], int((r["window_start"] - T0).total_seconds())): (r["n_events"], float(r["total_value"])) for r in got} == {k: (len(v), sum(v)) for k, v in want.items()}
    assert len(got) == len(want) and all(r["window_end"] - r["window_start"] == dt.timedelta(minutes=size) for r in got)


def test_no_event_is_multiplied_before_the_first_aggregate(spark):
    df = spark.createDataFrame([("a", at(0), 1.0)], SCHEMA)
    plan = wn.sliding(df, "ts", "1h", "1min", "v", keys=["k"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    generates = [i for i, line in enumerate(lines) if "Generate explode" in line or "Expand" in line]
    aggregates = [i for i, line in enumerate(lines) if "HashAggregate" in line or "ObjectHashAggregate" in line]
    assert len(generates) == 1 and sum(i > generates[0] for i in aggregates) == 2      # the panes' partial and final aggregate lie below


def test_tumbling_from_each_keys_first_event(spark):
    data = [("a", at(7), 1.0), ("a", at(66), 2.0), ("a", at(67), 4.0), ("b", at(30), 8.0), (None, at(5), 1.0), (None, at(70), 1.0)]
    got = wn.tumbling(spark.createDataFrame(data, SCHEMA), "ts", "1h", "v", keys=["k"], origin="first", fill_empty=True)
    assert rows(got.select("k", "window_start", "n_events")) == rows(spark.createDataFrame(
        [("a", at(7), 2), ("a", at(67), 1), ("b", at(30), 1), (None, at(5), 1), (None, at(65), 1)], "k string, window_start timestamp, n_events long"))


def test_complete_windows_of_a_null_key(spark):
    data = [(k, at(m), 1.0) for k in ("a", None) for m in (0, 30, 90, 125)]
    got = wn.sliding(spark.createDataFrame(data, SCHEMA), "ts", "1h", "30min", "v", keys=["k"], complete_only=True)
    assert {r["k"] for r in got.collect()} == {"a", None}


# ---------------------------------------------------------------- late rows

def late_run(spark, tmp_dir, split):
    q = source(spark, f"{tmp_dir}/in").writeStream.foreachBatch(split.apply).option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()


def test_late_rows_are_kept_and_counted(spark, tmp_dir):
    view = mv.MaterializedAggregate(spark, f"{tmp_dir}/view", ["k"], ["v"])
    split = lt.LateSplit(spark, f"{tmp_dir}/split", "ts", "30min", lambda b, i: view.refresh(b.select("k", "v"), i))
    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(0), 1.0), ("a", at(100), 2.0)])
    late_run(spark, tmp_dir, split)
    deliver(spark, f"{tmp_dir}/in", 1, [("a", at(69), 4.0), ("a", at(70), 8.0), ("b", at(90), 16.0), ("b", None, 32.0)])
    late_run(spark, tmp_dir, split)
    late_run(spark, tmp_dir, split)     # nothing new
    deliver(spark, f"{tmp_dir}/in", 2, [("a", at(10), 64.0)])
    late_run(spark, tmp_dir, split)
    assert [tuple(r)[2:] for r in split.counts().orderBy("batch").collect()] == [(2, 0), (2, 2), (0, 1)]
    assert sorted((r["v"], r["batch"]) for r in split.late_rows().collect()) == [(4.0, 1), (32.0, 1), (64.0, 2)]
    assert {r["k"]: float(r["__sum_v"]) for r in view.read_partials().collect()} == {"a": 11.0, "b": 16.0}


@pytest.mark.parametrize("undo", ["progress", "commit"])
def test_a_batch_that_failed_midway_is_split_the_same_way(spark, tmp_dir, undo):
    view = mv.MaterializedAggregate(spark, f"{tmp_dir}/view", ["k"], ["v"])
    split = lt.LateSplit(spark, f"{tmp_dir}/split", "ts", "30min", lambda b, i: view.refresh(b.select("k", "v"), i))
    for n, data in enumerate([[("a", at(100), 1.0)], [("a", at(10), 2.0), ("a", at(200), 4.0)]]):
        deliver(spark, f"{tmp_dir}/in", n, data)
        late_run(spark, tmp_dir, split)
    before = rows(split.counts()), rows(split.late_rows()), rows(view.read_partials())
    last = drop_last_commit(f"{tmp_dir}/ckpt")
    if undo == "progress":      # both sides were written, the counts were not
        split.progress._fs.delete(split.progress._Path(split.progress._path(last)), True)
    late_run(spark, tmp_dir, split)
    assert (rows(split.counts()), rows(split.late_rows()), rows(view.read_partials())) == before


# ---------------------------------------------------------------- joins

LEFT, RIGHT = "id long, start timestamp", "id long, login timestamp, name string"


def joined(spark, tmp_dir):
    q = jn.join_within(source(spark, f"{tmp_dir}/left", LEFT), source(spark, f"{tmp_dir}/right", RIGHT), "id", "start", "login", "1h", "10min")
    run = q.writeStream.format("parquet").option("path", f"{tmp_dir}/sink").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{tmp_dir}/sink"), sum(s["numRowsTotal"] for s in run.recentProgress[-1]["stateOperators"])


def test_streams_join_within_a_range_and_forget(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/left", 0, [(1, at(30)), (1, at(61)), (2, at(5)), (None, at(5)), (3, None)], LEFT)
    deliver(spark, f"{tmp_dir}/right", 0, [(1, at(0), "one"), (2, at(6), "after"), (None, at(0), "none"), (3, at(0), "three")], RIGHT)
    out, _ = joined(spark, tmp_dir)
    assert rows(out.select("id", "start", "name")) == [(1, at(30), "one")]
    deliver(spark, f"{tmp_dir}/left", 1, [(3, at(59))], LEFT)       # its partner came in the batch before
    deliver(spark, f"{tmp_dir}/right", 1, [(2, at(2), "in time")], RIGHT)
    out, held = joined(spark, tmp_dir)
    assert rows(out.select("id", "name")) == [(1, "one"), (2, "in time"), (3, "three")] and held > 0
    deliver(spark, f"{tmp_dir}/left", 2, [(9, at(10_000))], LEFT)
    deliver(spark, f"{tmp_dir}/right", 2, [(8, at(10_000), "far")], RIGHT)
    _, held = joined(spark, tmp_dir)
    assert held == 2       # only the rows that can still find a partner


def test_each_batch_sees_the_newest_dimension(spark, tmp_dir):
    dimension = SnapshotTable(spark, f"{tmp_dir}/dim")
    enrich = lambda: jn.run_with_dimension(source(spark, f"{tmp_dir}/in"), dimension, lambda b, d: b.join(d, "k", "left"), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    for n in range(2):
        dimension.write(spark.createDataFrame([("a", f"v{n}")], "k string, name string"))
        deliver(spark, f"{tmp_dir}/in", n, [("a", at(n), float(n)), ("x", at(n), 0.0)])
        out = enrich()
    want = [("a", "v0", 0), ("a", "v1", 1), ("x", None, 0), ("x", None, 1)]
    assert rows(out.read_all("batch").select("k", "name", "batch")) == want
    drop_last_commit(f"{tmp_dir}/ckpt")
    dimension.write(spark.createDataFrame([("a", "v2")], "k string, name string"))
    assert rows(enrich().read_all("batch").select("k", "name", "batch")) == want


# ---------------------------------------------------------------- drops

def test_rows_delivered_again_add_nothing(spark, tmp_dir):
    def run():
        out = dr.once_within(source(spark, f"{tmp_dir}/in"), "ts", "30min", ["k"])
        q = out.writeStream.format("parquet").option("path", f"{tmp_dir}/sink").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.parquet(f"{tmp_dir}/sink"), q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    deliver(spark, f"{tmp_dir}/in", 0, [("a", at(0), 1.0), ("b", at(1), 1.0), ("a", at(0), 1.0), (None, at(1), 5.0)])
    run()
    deliver(spark, f"{tmp_dir}/in", 1, [("a", at(0), 1.0), ("b", at(2), 2.0), ("c", at(3), 1.0), (None, at(2), 5.0)])
    out, _ = run()
    assert sorted(str(r["k"]) for r in out.collect()) == ["None", "a", "b", "c"]
    deliver(spark, f"{tmp_dir}/in", 2, [("z", at(5000), 1.0)])
    out, held = run()
    assert held == 1 and out.count() == 5       # the others left the state


CUSTOMER = "customer_id long, city string, seq long"


def csv_drop(spark, tmp_dir, day, data):
    path = f"{tmp_dir}/drops/Customer_{day}.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("customer_id,city,seq\n" + "".join(f"{a},{b},{c}\n" for a, b, c in data))


def follow(spark, tmp_dir, kind):
    table = SnapshotTable(spark, f"{tmp_dir}/{kind}")
    if kind == "scd2":
        initial = "customer_id long, city string, start_date date, end_date date, is_current boolean"
        apply = lambda d, s: scd.scd2_replay(d, s, ["customer_id"], ["city"], drop="file_date", effective="file_date", tiebreak=["seq"])
    else:
        initial = "customer_id long, city string, last_updated_date date"
        apply = lambda d, s: scd.scd1_replay(d, s.withColumn("drop", F.col("file_date")), ["customer_id"], ["city"], drop="drop", tiebreak=["seq"])
    if not table.snapshots():
        table.write(spark.createDataFrame([], initial), at=0)
    read = dr.maintain_dimension(dr.dated_drops(spark, f"{tmp_dir}/drops", spark.createDataFrame([], CUSTOMER).schema), table, apply, f"{tmp_dir}/{kind}-ckpt")
    return table, read


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_dimension_follows_new_drops_only(spark, tmp_dir, kind):
    csv_drop(spark, tmp_dir, "2024-01-01", [(1, "Bern", 1), (2, "Rom", 1)])
    table, read = follow(spark, tmp_dir, kind)
    assert read == 2
    csv_drop(spark, tmp_dir, "2024-01-02", [(1, "Genf", 1), (2, "Rom", 1), (3, "Wien", 1)])
    table, read = follow(spark, tmp_dir, kind)
    assert read == 3        # the first drop isn't read again
    D = dt.date
    if kind == "scd1":
        want = [(1, "Genf", D(2024, 1, 2)), (2, "Rom", D(2024, 1, 1)), (3, "Wien", D(2024, 1, 2))]
    else:
        want = [(1, "Bern", D(2024, 1, 1), D(2024, 1, 2), False), (1, "Genf", D(2024, 1, 2), None, True), (2, "Rom", D(2024, 1, 1), None, True),
                (3, "Wien", D(2024, 1, 2), None, True)]
    assert rows(table.read()) == rows(spark.createDataFrame(want, table.read().schema))
    before = table.snapshots()
    drop_last_commit(f"{tmp_dir}/{kind}-ckpt")      # crash between the two commits
    table, _ = follow(spark, tmp_dir, kind)
    assert table.snapshots() == before and rows(table.read()) == rows(spark.createDataFrame(want, table.read().schema))
    table, read = follow(spark, tmp_dir, kind)
    assert read == 0


def test_dimension_needs_an_initial_state_and_its_checkpoint(spark, tmp_dir):
    csv_drop(spark, tmp_dir, "2024-01-01", [(1, "Bern", 1)])
    stream = dr.dated_drops(spark, f"{tmp_dir}/drops", spark.createDataFrame([], CUSTOMER).schema)
    with pytest.raises(ValueError, match="initial state"):
        dr.maintain_dimension(stream, SnapshotTable(spark, f"{tmp_dir}/none"), lambda d, s: d, f"{tmp_dir}/c")
    table, _ = follow(spark, tmp_dir, "scd1")
    with pytest.raises(ValueError, match="another checkpoint"):
        dr.maintain_dimension(stream, table, lambda d, s: d, f"{tmp_dir}/c")
