"""Registered time-window queries over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.plans.registry import query
from lakekit.sources.tables import load
from lakekit.streaming import windows as wn

SQL_DEC_SUM = "CAST(sum(CAST(value AS DECIMAL(24,6))) AS DECIMAL(38,6))"


@query("tumbling_sum", f"""
WITH b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, {SQL_DEC_SUM} AS total
           FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(window_start) FROM b), (SELECT max(window_start) FROM b),
                                    INTERVAL 1 HOUR)) AS window_start)
SELECT g.window_start, g.window_start + INTERVAL 1 HOUR AS window_end, COALESCE(b.n, 0) AS n_events,
       CAST(COALESCE(b.total, 0) AS DECIMAL(38,6)) AS total_value
FROM g LEFT JOIN b ON g.window_start = b.window_start""")
def q_tumbling_sum(spark, sf_dir):
    """Hourly totals, epoch-aligned, empty hours emitted with 0."""
    return wn.tumbling(load(spark, sf_dir, "events"), "ts", "1h", "value", fill_empty=True)


@query("tumbling_first", f"""
WITH f AS (SELECT min(ts) AS t0 FROM events),
b AS (SELECT (SELECT t0 FROM f) + to_microseconds(CAST(floor(epoch_us(ts - (SELECT t0 FROM f)) / 86400000000) AS BIGINT)
                                                  * 86400000000) AS window_start, value FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM b GROUP BY window_start""")
def q_tumbling_first(spark, sf_dir):
    """Daily totals on a grid anchored at the first event, as the reference helper does."""
    return wn.tumbling(load(spark, sf_dir, "events"), "ts", "1d", "value", origin="first")


@query("tumbling_by_type", f"""
SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end,
       count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM events GROUP BY 1, 2""")
def q_tumbling_by_type(spark, sf_dir):
    return wn.tumbling(load(spark, sf_dir, "events"), "ts", "6h", "value", keys=["event_type"])


@query("sliding_sum", f"""
WITH e AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hb, value FROM events),
w AS (SELECT hb - to_hours(k) AS window_start, value FROM e, range(0, 2) t(k))
SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM w GROUP BY window_start""")
def q_sliding_sum(spark, sf_dir):
    """Two-hour windows every hour."""
    return wn.sliding(load(spark, sf_dir, "events"), "ts", "2h", "1h", "value")


@query("sliding_first", f"""
WITH f AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM events),
g AS (SELECT unnest(generate_series((SELECT t0 FROM f), (SELECT t1 FROM f), INTERVAL 1 HOUR)) AS window_start),
w AS (SELECT window_start FROM g WHERE window_start < (SELECT t1 FROM f) - INTERVAL 2 HOUR)
SELECT w.window_start, w.window_start + INTERVAL 2 HOUR AS window_end, count(e.ts) AS n_events,
       CAST(COALESCE(sum(CAST(e.value AS DECIMAL(24,6))), 0) AS DECIMAL(38,6)) AS total_value
FROM w LEFT JOIN events e ON e.ts >= w.window_start AND e.ts < w.window_start + INTERVAL 2 HOUR
GROUP BY w.window_start""")
def q_sliding_first(spark, sf_dir):
    """The reference's sliding helper: two-hour windows every hour from the first event,
    stopping before a window reaches the last event; empty windows are emitted with 0."""
    return wn.sliding(load(spark, sf_dir, "events"), "ts", "2h", "1h", "value", reference_bounds=True)


def _sessions_sql(gap_min: int, keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    sel = f"{keys}, " if keys else ""
    return f"""
WITH o AS (SELECT {sel}ts, value,
                  CASE WHEN lag(ts) OVER ({part} ORDER BY ts) IS NULL
                         OR ts - lag(ts) OVER ({part} ORDER BY ts) > INTERVAL {gap_min} MINUTE THEN 1 ELSE 0 END AS new_s
           FROM events),
s AS (SELECT *, sum(new_s) OVER ({part} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o)
SELECT {sel}min(ts) AS session_start, max(ts) + INTERVAL {gap_min} MINUTE AS session_end, count(*) AS n_events,
       {SQL_DEC_SUM} AS total_value
FROM s GROUP BY {sel}sid"""


@query("series_sessions", _sessions_sql(10, ""))
def q_series_sessions(spark, sf_dir):
    """Sessions of the whole event series (no key), gap 10 minutes."""
    return wn.sessions(load(spark, sf_dir, "events"), "ts", "10min", "value")


@query("session_values", """
WITH o AS (SELECT event_id, ts, value, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, event_id) <= INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new_s
           FROM events),
s AS (SELECT ts, value, sum(new_s) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o)
SELECT min(ts) OVER (PARTITION BY sid) AS session_start, row_number() OVER (PARTITION BY sid ORDER BY ts, value) AS position, value
FROM s""")
def q_session_values(spark, sf_dir):
    """The values of each session of the whole series, in time order."""
    return wn.session_values(load(spark, sf_dir, "events"), "ts", "value", "10min")


@query("tumbling_reference", f"""
WITH f AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM events),
g AS (SELECT unnest(generate_series((SELECT t0 FROM f), (SELECT t1 FROM f), INTERVAL 10 MINUTE)) AS window_start)
SELECT g.window_start, g.window_start + INTERVAL 10 MINUTE AS window_end, count(e.ts) AS n_events,
       CAST(COALESCE(sum(CAST(e.value AS DECIMAL(24,6))), 0) AS DECIMAL(38,6)) AS total_value
FROM g LEFT JOIN events e ON e.ts >= g.window_start AND e.ts < g.window_start + INTERVAL 10 MINUTE
WHERE g.window_start < (SELECT t1 FROM f)
GROUP BY g.window_start""")
def q_tumbling_reference(spark, sf_dir):
    """The reference's tumbling helper: windows from the first event on, empty ones with 0,
    as long as they start before the last event."""
    return wn.tumbling(load(spark, sf_dir, "events"), "ts", "10min", "value", origin="first", fill_empty=True,
                       reference_bounds=True)


SQL_HOLED = """(SELECT ts, value, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
                CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type FROM events)"""


def _holed(spark, sf_dir):
    """Events of which every 7th has no user and every 3rd no type."""
    return load(spark, sf_dir, "events").select(
        "ts", "value", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"))


@query("user_sessions_null_key", _sessions_sql(30, "user_id").replace("FROM events", f"FROM {SQL_HOLED}"))
def q_user_sessions_null_key(spark, sf_dir):
    """Events without a user are one series."""
    return wn.sessions(_holed(spark, sf_dir), "ts", "30min", "value", keys=["user_id"])


@query("tumbling_fill_null_key", f"""
WITH b AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, {SQL_DEC_SUM} AS total
           FROM {SQL_HOLED} GROUP BY 1, 2),
k AS (SELECT event_type, min(window_start) AS lo, max(window_start) AS hi FROM b GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS window_start FROM k)
SELECT g.event_type, g.window_start, g.window_start + INTERVAL 1 HOUR AS window_end, COALESCE(b.n, 0) AS n_events,
       CAST(COALESCE(b.total, 0) AS DECIMAL(38,6)) AS total_value
FROM g LEFT JOIN b ON g.window_start = b.window_start AND g.event_type IS NOT DISTINCT FROM b.event_type""")
def q_tumbling_fill_null_key(spark, sf_dir):
    return wn.tumbling(_holed(spark, sf_dir), "ts", "1h", "value", keys=["event_type"], fill_empty=True)


@query("user_sessions", _sessions_sql(30, "user_id"))
def q_user_sessions(spark, sf_dir):
    """Sessions per user, gap 30 minutes."""
    return wn.sessions(load(spark, sf_dir, "events"), "ts", "30min", "value", keys=["user_id"])


@query("sliding_hour_by_minute", f"""
WITH e AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS mb, CAST(value AS DECIMAL(24,6)) AS value FROM events),
w AS (SELECT mb - to_minutes(k) AS window_start, value FROM e, range(0, 60) t(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n_events, CAST(sum(value) AS DECIMAL(38,6)) AS total_value
FROM w GROUP BY window_start""")
def q_sliding_hour_by_minute(spark, sf_dir):
    """Hour windows every minute: each event lies in sixty, and is aggregated once."""
    return wn.sliding(load(spark, sf_dir, "events"), "ts", "1h", "1min", "value")


@query("sliding_uneven", f"""
WITH w AS (SELECT event_type, time_bucket(INTERVAL 60 MINUTE, ts) - to_minutes(60 * CAST(k AS INT)) AS window_start, ts, value FROM events, range(0, 2) t(k))
SELECT event_type, window_start, window_start + INTERVAL 90 MINUTE AS window_end, count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM w WHERE ts < window_start + INTERVAL 90 MINUTE GROUP BY 1, 2""")
def q_sliding_uneven(spark, sf_dir):
    """Windows of 90 minutes every hour, by type: the step does not divide the size."""
    return wn.sliding(load(spark, sf_dir, "events"), "ts", "90min", "60min", "value", keys=["event_type"])


@query("tumbling_first_by_user", f"""
WITH f AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS t0 FROM {SQL_HOLED}),
b AS (SELECT user_id, t0 + to_microseconds(CAST(floor(epoch_us(ts - t0) / 21600000000) AS BIGINT) * 21600000000) AS window_start, value FROM f)
SELECT user_id, window_start, window_start + INTERVAL 6 HOUR AS window_end, count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM b GROUP BY 1, 2""")
def q_tumbling_first_by_user(spark, sf_dir):
    """Six-hour totals of each user, from that user's first event on; events without a user are one series."""
    return wn.tumbling(_holed(spark, sf_dir), "ts", "6h", "value", keys=["user_id"], origin="first")


@query("sliding_first_by_user", f"""
WITH f AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS t0 FROM {SQL_HOLED}),
w AS (SELECT user_id, t0, ts, value, CAST(floor(epoch_us(ts - t0) / 3600000000) AS BIGINT) - k AS k FROM f, range(0, 3) t(k))
SELECT user_id, t0 + to_microseconds(k * 3600000000) AS window_start, t0 + to_microseconds((k + 3) * 3600000000) AS window_end, count(*) AS n_events, {SQL_DEC_SUM} AS total_value
FROM w WHERE k >= 0 GROUP BY user_id, t0, k""")
def q_sliding_first_by_user(spark, sf_dir):
    """Three-hour windows every hour, from each user's first event on."""
    return wn.sliding(_holed(spark, sf_dir), "ts", "3h", "1h", "value", keys=["user_id"], origin="first")
