"""Registered streaming and materialized-view queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.plans import fixtures as fx
from lakekit.plans.q_timeseries import SQL_DAILY
from lakekit.plans.registry import query
from lakekit.session import work_dir
from lakekit.sources.snapshots import SnapshotTable
from lakekit.sources.tables import load
from lakekit.operators import scd
from lakekit.plans import q_dimensions as qd
from lakekit.plans.registry import ORACLES
from lakekit.streaming import drops as dr
from lakekit.streaming import joins as jn
from lakekit.streaming import late as lt
from lakekit.streaming import mview as mv
from lakekit.streaming import stateful as sf
from lakekit.streaming import stream as st
from lakekit.streaming import windows as wn

SQL_DEC_SUM = "CAST(sum(CAST(value AS DECIMAL(24,6))) AS DECIMAL(38,6))"


def _events_stream(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    return st.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema, event_time="ts")


@query("run_stream", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM events GROUP BY 1, 2""")
def q_run_stream(spark, sf_dir):
    """Events as a file stream -> hourly tumbling totals, complete mode, exactly-once sink."""
    sink = st.run_stream(_events_stream(spark, sf_dir),
                         lambda s: wn.tumbling(s, "ts", "1h", "value"),
                         work_dir(spark, "stream-sink"), work_dir(spark, "stream-ckpt"),
                         output_mode="complete", watermark=("ts", "1 hour"))
    return sink.read()


@query("stream_user_sessions", """
WITH o AS (SELECT user_id, ts, value,
                  CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                         OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END
                    AS new_s
           FROM events),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AS sid FROM o),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events,
             CAST(sum(CAST(value AS DECIMAL(24,6))) AS DECIMAL(38,6)) AS total_value
      FROM s GROUP BY user_id, sid)
SELECT * FROM g WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_user_sessions(spark, sf_dir):
    """Per-user sessions on a stream, append mode, watermark 1 hour: a drained stream emits
    exactly the sessions that closed before the final watermark (max event time - 1 hour)."""
    out = st.run_stream(_events_stream(spark, sf_dir),
                        lambda s: st.session_totals(s, "ts", "30min", ["user_id"], "value"),
                        work_dir(spark, "sessions-sink"), work_dir(spark, "sessions-ckpt"),
                        output_mode="append", watermark=("ts", "1 hour"))
    return st.to_ntz(spark.read.parquet(out))


def _with_day(trips):
    return trips.withColumn("pickup_date", F.to_date("pickup_datetime"))


@query("mv_daily_metrics", f"WITH {fx.SQL_TRIPS} {SQL_DAILY}")
def q_mv_daily_metrics(spark, sf_dir):
    """View maintained in two batches (plus a replay of the second, which is skipped);
    it must equal the view recomputed from scratch."""
    trips = _with_day(fx.taxi_trips(spark, sf_dir))
    cut = fx.events_as_of(spark, sf_dir) - F.expr("INTERVAL 15 DAYS")
    view = mv.MaterializedAggregate(spark, work_dir(spark, "mv"), ["vendor_id", "pickup_date"], ["fare_amount"])
    view.refresh(trips.filter(F.col("pickup_datetime") < cut), 0)
    later = trips.filter(F.col("pickup_datetime") >= cut)
    view.refresh(later, 1)
    view.refresh(later, 1)  # replay: no effect
    return mv.daily_metrics_view(view.read_partials())


@query("mv_daily_metrics_changes", f"""WITH {fx.SQL_TRIPS.replace("FROM events", "FROM (SELECT * REPLACE (CASE WHEN event_id % 4 = 1 THEN value + 1 ELSE value END AS value) FROM events WHERE event_id % 5 <> 0)")} {SQL_DAILY}""")
def q_mv_daily_metrics_changes(spark, sf_dir):
    """The view kept current while every fifth trip is deleted and every fourth fare updated; it
    must equal the view recomputed from what is left."""
    trips = _with_day(fx.taxi_trips(spark, sf_dir))
    view = mv.MaterializedAggregate(spark, work_dir(spark, "mv-changes"), ["vendor_id", "pickup_date"], ["fare_amount"])
    view.refresh(trips, 0)
    gone = trips.filter(F.col("trip_id") % 5 == 0)
    view.refresh(None, 1, removed=gone)
    old = trips.filter((F.col("trip_id") % 5 != 0) & (F.col("trip_id") % 4 == 1))
    view.refresh(old.withColumn("fare_amount", F.col("fare_amount") + 1), 2, removed=old)
    return mv.daily_metrics_view(view.read_partials())


@query("mv_daily_metrics_stream", f"WITH {fx.SQL_TRIPS} {SQL_DAILY}")
def q_mv_daily_metrics_stream(spark, sf_dir):
    """The same view kept current by a stream through ``foreachBatch``."""
    view = mv.MaterializedAggregate(spark, work_dir(spark, "mv-stream"), ["vendor_id", "pickup_date"],
                                    ["fare_amount"])
    stream = _with_day(fx.trips_from_events(_events_stream(spark, sf_dir)))
    q = (stream.writeStream.foreachBatch(view.foreach_batch())
         .option("checkpointLocation", work_dir(spark, "mv-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return mv.daily_metrics_view(view.read_partials())


SQL_SESSION_VALUES = """
WITH o AS (SELECT event_id, user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new_s
           FROM events),
s AS (SELECT user_id, ts, value, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o),
v AS (SELECT user_id, min(ts) OVER (PARTITION BY user_id, sid) AS session_start, max(ts) OVER (PARTITION BY user_id, sid) + INTERVAL 30 MINUTE AS session_end,
             row_number() OVER (PARTITION BY user_id, sid ORDER BY ts, value) AS position, value FROM s)
SELECT user_id, session_start, position, value, session_end > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS still_open FROM v"""


@query("stream_session_values", SQL_SESSION_VALUES)
def q_stream_session_values(spark, sf_dir):
    """Ordered values of each user's sessions from a stream; those still open come from its state."""
    sink, ckpt = work_dir(spark, "values-sink"), work_dir(spark, "values-ckpt")
    st.run_stream(_events_stream(spark, sf_dir), lambda s: sf.session_values_stream(s, "ts", "value", "30min", ["user_id"]), sink, ckpt,
                  output_mode="append", watermark=("ts", "1 hour"), state_store=st.ROCKSDB)
    over = spark.read.parquet(sink).withColumn("still_open", F.lit(False))
    left = sf.open_session_values(spark, ckpt, "30min", ["user_id"]).withColumn("still_open", F.lit(True))
    return st.to_ntz(over.unionByName(left))


SQL_DROPS = """
e AS (SELECT *, least(2, date_diff('day', (SELECT min(ts) FROM events), ts) // 10 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS drop FROM events)"""


def _deliveries(spark, sf_dir):
    """Events with the delivery they come in: ten days each, every tenth event one delivery later."""
    e = load(spark, sf_dir, "events")
    first = e.agg(F.min("ts")).first()[0]
    late = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    day = F.date_diff("ts", F.lit(first).cast("timestamp_ntz"))
    return e.withColumn("delivery", F.least(F.lit(2), F.floor(day / 10) + late))


@query("late_events", f"""
WITH {SQL_DROPS},
m AS (SELECT drop, max(max(ts)) OVER (ORDER BY drop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 HOUR AS mark FROM e GROUP BY drop),
r AS (SELECT e.*, coalesce(ts < mark, FALSE) AS late FROM e JOIN m USING (drop))
SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) FILTER (NOT late) AS n_on_time, count(*) FILTER (late) AS n_late,
       CAST(coalesce(sum(CAST(value AS DECIMAL(24,6))) FILTER (NOT late), 0) AS DECIMAL(38,6)) AS total_value
FROM r GROUP BY 1""")
def q_late_events(spark, sf_dir):
    """Three deliveries: daily totals of the rows in time, and how many came behind the watermark."""
    events, folder, root, ckpt = _deliveries(spark, sf_dir), *(work_dir(spark, n) for n in ("deliveries", "late", "late-ckpt"))
    view = mv.MaterializedAggregate(spark, f"{root}/totals", ["day"], ["value"])
    split = lt.LateSplit(spark, root, "ts", "2h", lambda rows, b: view.refresh(rows.select(F.date_trunc("day", "ts").alias("day"), "value"), b))
    for d in range(3):
        events.filter(F.col("delivery") == d).drop("delivery").write.parquet(f"{folder}/{d}")
        stream = spark.readStream.schema(load(spark, sf_dir, "events").schema).option("recursiveFileLookup", True).parquet(folder)
        q = stream.writeStream.foreachBatch(split.apply).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    totals = view.read_partials().select("day", F.col(mv.N).alias("n_on_time"), F.col("__sum_value").alias("total_value"))
    late = split.late_rows().groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("n_late"))
    j = totals.join(late, "day", "full_outer")
    return j.select(F.col("day").cast("timestamp_ntz").alias("day"), *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_on_time", "n_late")),
                    F.coalesce("total_value", F.lit(0)).cast("decimal(38,6)").alias("total_value"))


@query("stream_dimension_join", f"""
WITH {SQL_DROPS}
SELECT event_id, drop AS batch, c_name || '/' || drop AS member FROM e JOIN customer ON c_custkey = user_id""")
def q_stream_dimension_join(spark, sf_dir):
    """Each delivery of events meets the customers as they are when it is read: the dimension is
    written anew before each, and the next batch sees it."""
    events, folder, sink, ckpt = _deliveries(spark, sf_dir), *(work_dir(spark, n) for n in ("deliveries", "enriched", "enriched-ckpt"))
    dimension = SnapshotTable(spark, work_dir(spark, "customers"))
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    for d in range(3):
        dimension.write(customers.select("user_id", F.concat("c_name", F.lit(f"/{d}")).alias("member")))
        events.filter(F.col("delivery") == d).drop("delivery").write.parquet(f"{folder}/{d}")
        stream = spark.readStream.schema(load(spark, sf_dir, "events").schema).option("recursiveFileLookup", True).parquet(folder)
        out = jn.run_with_dimension(stream, dimension, lambda batch, dim: batch.join(dim, "user_id"), sink, ckpt)
    return out.read_all("batch").select("event_id", "batch", "member")


@query("stream_once", "SELECT event_id, ts, value FROM events")
def q_stream_once(spark, sf_dir):
    """Events of which every third is delivered again, in a second file: each comes out once."""
    events, folder = load(spark, sf_dir, "events"), work_dir(spark, "repeated")
    out = None
    sink, ckpt = work_dir(spark, "once-sink"), work_dir(spark, "once-ckpt")
    for d, some in enumerate((events, events.filter(F.col("event_id") % 3 == 0))):
        some.write.parquet(f"{folder}/{d}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))
        out = st.run_append(dr.once_within(stream, "ts", "1h", ["event_id"]).select("event_id", "ts", "value"), sink, ckpt)
    return st.to_ntz(spark.read.parquet(out))


def _dimension_from_drops(spark, sf_dir, dim, staged, apply):
    """Yearly drops written as dated CSV folders, one after another; each run of the stream reads the new one."""
    folder, ckpt = work_dir(spark, "drops"), work_dir(spark, "dim-ckpt")
    table = SnapshotTable(spark, work_dir(spark, "dim"))
    table.write(dim, at=0)
    schema = staged.schema
    staged = staged.withColumn("drop", F.year("last_updated"))
    for year in [r[0] for r in staged.select("drop").distinct().orderBy("drop").collect()]:     # a handful of years
        staged.filter(F.col("drop") == year).drop("drop").write.option("header", True).csv(f"{folder}/Customer_{year}-12-31.csv")
        dr.maintain_dimension(dr.dated_drops(spark, folder, schema), table, apply, ckpt)
    return table.read()


@query("stream_scd1", ORACLES["scd1_replay"])
def q_stream_scd1(spark, sf_dir):
    """SCD1 following a folder of yearly drops; equals replaying them in one pass."""
    pre, staged = qd._scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "email", "address", F.col("last_updated").alias("last_updated_date"))
    return _dimension_from_drops(spark, sf_dir, dim, staged, lambda d, s: scd.scd1_replay(
        d, s.withColumn("drop", F.col("file_date")).drop("file_date").withColumnRenamed("last_updated", "staged_date"), ["customer_id"], ["name", "email", "address"],
        drop="drop", dim_date="last_updated_date", staged_date="staged_date", tiebreak=["seq"]))


@query("stream_scd2", ORACLES["scd2_replay"])
def q_stream_scd2(spark, sf_dir):
    """SCD2 following a folder of yearly drops; equals replaying them in one pass."""
    pre, staged = qd._scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", F.col("last_updated").alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
    return _dimension_from_drops(spark, sf_dir, dim, staged, lambda d, s: scd.scd2_replay(
        d, s, ["customer_id"], ["name", "address"], drop="file_date", effective="last_updated", tiebreak=["seq"]))
