"""Registered request-log queries: events as requests, users as sessions, customer+nation as connections."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.plans import fixtures as fx
from lakekit.plans import reqlog as rl
from lakekit.plans.registry import query
from lakekit.session import work_dir
from lakekit.sources.tables import load
from lakekit.streaming import stream as st

ASOF = fx.SQL_EVENTS_AS_OF

SQL_LOG = f"""
requests AS (SELECT event_id AS request_id, user_id AS session_id, event_type AS command,
                    event_type || ' ' || props AS query_text, ts AS start_time,
                    CAST(round(value * 1000) AS BIGINT) AS total_elapsed_time,
                    CASE WHEN ts > {ASOF} - INTERVAL 1 DAY THEN 'running' ELSE 'completed' END AS status
             FROM events),
sessions AS (SELECT c.c_custkey AS session_id, c.c_name AS login_name, f.login_time
             FROM customer c JOIN (SELECT user_id, min(ts) AS login_time FROM events GROUP BY user_id) f
               ON c.c_custkey = f.user_id),
connections AS (SELECT n.n_name || '-' || CAST(c.c_custkey AS VARCHAR) AS connection_id, c.c_custkey AS session_id
                FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def requests(spark, sf_dir):
    return _as_requests(load(spark, sf_dir, "events"), fx.events_as_of(spark, sf_dir))


def _as_requests(e, now):
    return e.select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("session_id"),
        F.col("event_type").alias("command"),
        F.concat_ws(" ", "event_type", "props").alias("query_text"),
        F.col("ts").alias("start_time"),
        F.round(F.col("value") * 1000).cast("bigint").alias("total_elapsed_time"),
        F.when(F.col("ts") > now - F.expr("INTERVAL 1 DAY"), "running").otherwise("completed").alias("status"))


def sessions(spark, sf_dir):
    first = load(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("login_time"))
    c = load(spark, sf_dir, "customer")
    return c.join(first, c.c_custkey == first.user_id).select(
        F.col("c_custkey").alias("session_id"), F.col("c_name").alias("login_name"), "login_time")


def connections(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.concat_ws("-", "n_name", F.col("c_custkey").cast("string")).alias("connection_id"),
        F.col("c_custkey").alias("session_id"))


@query("active_requests", f"""WITH {SQL_LOG}
SELECT c.connection_id, s.session_id, s.login_name, s.login_time, r.request_id, r.command, r.start_time,
       r.total_elapsed_time
FROM connections c JOIN sessions s ON c.session_id = s.session_id
JOIN requests r ON r.session_id = s.session_id
WHERE r.status = 'running' ORDER BY r.total_elapsed_time DESC""")
def q_active_requests(spark, sf_dir):
    return rl.active_requests(connections(spark, sf_dir), sessions(spark, sf_dir), requests(spark, sf_dir))


@query("active_requests_stream", f"""WITH {SQL_LOG}
SELECT c.connection_id, s.session_id, s.login_name, s.login_time, r.request_id, r.command, r.start_time, r.total_elapsed_time
FROM connections c JOIN sessions s ON c.session_id = s.session_id JOIN requests r ON r.session_id = s.session_id
WHERE r.status = 'running' AND r.start_time >= s.login_time AND r.start_time <= s.login_time + INTERVAL 29 DAY""")
def q_active_requests_stream(spark, sf_dir):
    """Requests and logins as two streams, joined within 29 days of the login."""
    logins = work_dir(spark, "logins")
    sessions(spark, sf_dir).write.parquet(logins)
    schema = load(spark, sf_dir, "events").schema
    events = st.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema, event_time="ts")
    log = _as_requests(events, fx.events_as_of(spark, sf_dir))
    opened = st.file_stream(spark, logins, spark.read.parquet(logins).schema, event_time="login_time")
    live = rl.active_requests_stream(connections(spark, sf_dir), opened, log, within="29d", delay="1h")
    out = st.run_append(live, work_dir(spark, "active-sink"), work_dir(spark, "active-ckpt"))
    return st.to_ntz(spark.read.parquet(out))


@query("request_history", f"""WITH {SQL_LOG}
SELECT request_id, session_id, command, query_text, start_time, total_elapsed_time, status FROM requests""")
def q_request_history(spark, sf_dir):
    return rl.request_history(requests(spark, sf_dir))


@query("frequent_requests", f"""WITH {SQL_LOG}
SELECT query_text, count(*) AS number_of_runs,
       CAST(sum(total_elapsed_time) AS DOUBLE) / CAST(count(total_elapsed_time) AS DOUBLE) AS avg_elapsed_ms,
       min(total_elapsed_time) AS min_elapsed_ms, max(total_elapsed_time) AS max_elapsed_ms,
       max(start_time) AS last_run_start_time
FROM requests GROUP BY query_text ORDER BY number_of_runs DESC""")
def q_frequent_requests(spark, sf_dir):
    return rl.frequent_requests(requests(spark, sf_dir))


@query("long_running_requests", f"""WITH {SQL_LOG},
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_text ORDER BY start_time DESC, request_id DESC) AS rn
           FROM requests)
SELECT query_text, max(total_elapsed_time) AS max_elapsed_ms,
       CAST(sum(total_elapsed_time) AS DOUBLE) / CAST(count(total_elapsed_time) AS DOUBLE) AS avg_elapsed_ms,
       max(CASE WHEN rn = 1 THEN total_elapsed_time END) AS last_run_elapsed_ms, count(*) AS number_of_runs
FROM ranked GROUP BY query_text ORDER BY max_elapsed_ms DESC""")
def q_long_running_requests(spark, sf_dir):
    return rl.long_running_requests(requests(spark, sf_dir))
