"""Request-log analytics (G1-G4, J9): the monitoring views' query shapes over any log table.

Live server views cannot exist in a library; these run the same joins and
rankings over a request log, a session table and a connection table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.streaming.joins import join_within


def active_requests(connections: DataFrame, sessions: DataFrame, requests: DataFrame,
                    status: str = "running") -> DataFrame:
    """Running requests with their session and connection, longest first (G1).

    The request filter runs before the joins; connections and sessions are keyed by
    session id, so each join is an equi-join on that key.
    """
    running = requests.filter(F.col("status") == status)
    s = sessions.select("session_id", "login_name", "login_time")
    c = connections.select("connection_id", "session_id")
    return (running.join(s, "session_id").join(c, "session_id")
            .select("connection_id", "session_id", "login_name", "login_time", "request_id", "command",
                    "start_time", "total_elapsed_time")
            .orderBy(F.desc("total_elapsed_time"), "request_id"))


def active_requests_stream(connections: DataFrame, sessions: DataFrame, requests: DataFrame, within: str, delay: str,
                           status: str = "running") -> DataFrame:
    """``active_requests`` over live logs: ``requests`` and ``sessions`` are streams, joined when
    a request starts at most ``within`` after its session's login; ``connections`` is a table.

    Inner joins emit a match as soon as both rows are there, so a drained stream has all rows
    of the batch version whose request lies within the range (unordered: a stream has no order).
    """
    running = requests.filter(F.col("status") == status)
    s = sessions.select("session_id", "login_name", "login_time")
    j = join_within(running, s, "session_id", "start_time", "login_time", within, delay)
    return (j.withColumnRenamed("__right_login_time", "login_time").join(connections.select("connection_id", "session_id"), "session_id")
            .select("connection_id", "session_id", "login_name", "login_time", "request_id", "command", "start_time", "total_elapsed_time"))


def request_history(requests: DataFrame) -> DataFrame:
    """Every request with its text, timing and outcome."""
    return requests.select("request_id", "session_id", "command", "query_text", "start_time",
                           "total_elapsed_time", "status")


def _last_run(col: str) -> Column:
    return F.max(F.struct("start_time", "request_id", col))[col]


def frequent_requests(requests: DataFrame) -> DataFrame:
    """Query texts by number of runs (G3): count, average/min/max duration, last start."""
    return (requests.groupBy("query_text")
            .agg(F.count(F.lit(1)).alias("number_of_runs"),
                 (F.sum("total_elapsed_time").cast("double") / F.count("total_elapsed_time").cast("double"))
                 .alias("avg_elapsed_ms"),
                 F.min("total_elapsed_time").alias("min_elapsed_ms"),
                 F.max("total_elapsed_time").alias("max_elapsed_ms"),
                 F.max("start_time").alias("last_run_start_time"))
            .orderBy(F.desc("number_of_runs"), "query_text"))


def long_running_requests(requests: DataFrame) -> DataFrame:
    """Query texts by longest duration (G4): max, average and the latest run's duration."""
    return (requests.groupBy("query_text")
            .agg(F.max("total_elapsed_time").alias("max_elapsed_ms"),
                 (F.sum("total_elapsed_time").cast("double") / F.count("total_elapsed_time").cast("double"))
                 .alias("avg_elapsed_ms"),
                 _last_run("total_elapsed_time").alias("last_run_elapsed_ms"),
                 F.count(F.lit(1)).alias("number_of_runs"))
            .orderBy(F.desc("max_elapsed_ms"), "query_text"))
