"""Registered event-table queries (pipe-style queries, the materialized view query, the stored function)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.plans import timeseries as eh
from lakekit.plans import fixtures as fx
from lakekit.plans.registry import query
from lakekit.sources.tables import load

ASOF = fx.SQL_EVENTS_AS_OF
SQL_AVG = "CAST(SUM(CAST(fare_amount AS DECIMAL(24,6))) AS DOUBLE) / CAST(COUNT(fare_amount) AS DOUBLE)"
SQL_SUM = "CAST(SUM(CAST(fare_amount AS DECIMAL(24,6))) AS DECIMAL(38,6))"
FUNNEL_VENDOR = "click"
MIN_PASSENGERS = 3


def _trips(spark, sf_dir):
    return fx.taxi_trips(spark, sf_dir), fx.events_as_of(spark, sf_dir)


@query("recent_window_filter", f"""WITH {fx.SQL_TRIPS}
SELECT trip_id, vendor_id, pickup_datetime, fare_amount FROM trips
WHERE pickup_datetime > {ASOF} - INTERVAL 30 MINUTE""")
def q_recent_window_filter(spark, sf_dir):
    trips, now = _trips(spark, sf_dir)
    return eh.recent_window_filter(trips, now, "30min")


@query("avg_by_key_recent", f"""WITH {fx.SQL_TRIPS}
SELECT vendor_id, {SQL_AVG} AS avg_fare FROM trips
WHERE pickup_datetime > {ASOF} - INTERVAL 30 MINUTE GROUP BY vendor_id""")
def q_avg_by_key_recent(spark, sf_dir):
    trips, now = _trips(spark, sf_dir)
    return eh.avg_by_key_recent(trips, now, "30min")


@query("filter_funnel", f"""WITH {fx.SQL_TRIPS}
SELECT count(*) AS trip_count FROM trips
WHERE pickup_datetime > {ASOF} - INTERVAL 1 DAY AND vendor_id = '{FUNNEL_VENDOR}' AND fare_amount > 0""")
def q_filter_funnel(spark, sf_dir):
    trips, now = _trips(spark, sf_dir)
    return eh.filter_funnel(trips, now, FUNNEL_VENDOR, "1d")


@query("project_early", f"""WITH {fx.SQL_TRIPS}
SELECT {SQL_AVG} AS avg_fare FROM trips WHERE pickup_datetime > {ASOF} - INTERVAL 1 DAY""")
def q_project_early(spark, sf_dir):
    trips, now = _trips(spark, sf_dir)
    return eh.project_early(trips, now, "1d")


@query("count_by_keys_limit", f"""WITH {fx.SQL_TRIPS}
SELECT trip_id, vendor_id, count(*) AS trip_count FROM trips
WHERE pickup_datetime > {ASOF} - INTERVAL 1 DAY
GROUP BY trip_id, vendor_id ORDER BY trip_id, vendor_id LIMIT 1000""")
def q_count_by_keys_limit(spark, sf_dir):
    trips, now = _trips(spark, sf_dir)
    return eh.count_by_keys_limit(trips, now, 1000, "1d")


@query("events_per_hour", """
SELECT date_trunc('hour', ts) AS bin_start, count(*) AS EventCount FROM events GROUP BY 1""")
def q_events_per_hour(spark, sf_dir):
    return eh.count_per_bin(load(spark, sf_dir, "events"), "ts", "hour", "EventCount")


@query("ingestions_per_hour", """
SELECT date_trunc('hour', date_trunc('day', ts) + INTERVAL 1 DAY) AS bin_start, count(*) AS IngestionCount
FROM events GROUP BY 1""")
def q_ingestions_per_hour(spark, sf_dir):
    """Events arrive in daily drops; the loader stamps each drop with its landing time."""
    e = load(spark, sf_dir, "events")
    landed = eh.with_ingestion_time(e, F.date_trunc("day", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    return eh.count_per_bin(landed, "ingestion_time", "hour", "IngestionCount")


@query("broadcast_dim_join", """
SELECT s.s_suppkey, s.s_name, n.n_name FROM nation n JOIN supplier s ON n.n_nationkey = s.s_nationkey""")
def q_broadcast_dim_join(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return eh.small_first_join(n, s, "s_nationkey").select("s_suppkey", "s_name", "n_name")


SQL_DAILY = f"""
SELECT vendor_id, CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trips,
       {SQL_AVG} AS avg_fare, {SQL_SUM} AS total_revenue
FROM trips GROUP BY vendor_id, CAST(pickup_datetime AS DATE)"""


@query("daily_metrics", f"WITH {fx.SQL_TRIPS} {SQL_DAILY}")
def q_daily_metrics(spark, sf_dir):
    return eh.daily_metrics(fx.taxi_trips(spark, sf_dir))


@query("daily_metrics_last_7d", f"""WITH {fx.SQL_TRIPS}, mv AS ({SQL_DAILY})
SELECT pickup_date, vendor_id, trips, avg_fare, total_revenue FROM mv
WHERE CAST(pickup_date AS TIMESTAMP) >= {ASOF} - INTERVAL 7 DAY
ORDER BY pickup_date DESC, total_revenue DESC""")
def q_daily_metrics_last_7d(spark, sf_dir):
    trips, now = _trips(spark, sf_dir)
    return eh.last_days(eh.daily_metrics(trips), now, "7d")


@query("trips_min_passengers_top10", f"""WITH {fx.SQL_TRIPS}
SELECT trip_id, pickup_datetime FROM trips WHERE passenger_count >= {MIN_PASSENGERS}
ORDER BY pickup_datetime, trip_id LIMIT 10""")
def q_trips_min_passengers_top10(spark, sf_dir):
    trips = fx.taxi_trips(spark, sf_dir)
    return eh.take_ordered(eh.trips_by_min_passenger_count(trips, MIN_PASSENGERS), 10, "pickup_datetime", "trip_id")
