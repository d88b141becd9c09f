"""Time-series reporting over an event table (pipe-style queries: P1, P4-P6, P15, A1-A3, A5-A7,
F7, F8, J8, O2, O3, V4, V5).

Each pipe ``T | where | project | summarize | sort`` is a chain of DataFrame
calls; the time filter is a plain comparison so Parquet statistics skip row groups
and the projection prunes the scan.  "now" is always an explicit ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalar import ago, exact_avg, exact_sum, interval


def recent_window_filter(trips: DataFrame, as_of: Column, span: str = "30min") -> DataFrame:
    """``where pickup_datetime > ago(span) | project ...``."""
    return (trips.filter(ago("pickup_datetime", span, as_of))
            .select("trip_id", "vendor_id", "pickup_datetime", "fare_amount"))


def avg_by_key_recent(trips: DataFrame, as_of: Column, span: str = "30min") -> DataFrame:
    """``where > ago(span) | project | summarize avg_fare = avg(fare_amount) by vendor_id`` (A3)."""
    return (recent_window_filter(trips, as_of, span)
            .groupBy("vendor_id").agg(exact_avg("fare_amount").alias("avg_fare")))


def filter_funnel(trips: DataFrame, as_of: Column, vendor: str, span: str = "1d") -> DataFrame:
    """Chained filters (time, vendor, value) then ``summarize trip_count = count()``.

    The order filters are written in does not matter: Catalyst evaluates the
    conjunction in one codegen stage and pushes each comparison to the scan.
    """
    return (trips.filter(ago("pickup_datetime", span, as_of))
            .filter(F.col("vendor_id") == vendor)
            .filter(F.col("fare_amount") > 0)
            .agg(F.count(F.lit(1)).alias("trip_count")))


def project_early(trips: DataFrame, as_of: Column, span: str = "1d") -> DataFrame:
    """``project trip_id, pickup_datetime, fare_amount | where > ago(span) | summarize avg``."""
    return (trips.select("trip_id", "pickup_datetime", "fare_amount")
            .filter(ago("pickup_datetime", span, as_of))
            .agg(exact_avg("fare_amount").alias("avg_fare")))


def count_by_keys_limit(trips: DataFrame, as_of: Column, n: int = 1000, span: str = "1d") -> DataFrame:
    """``summarize trip_count = count() by trip_id, vendor_id | limit n`` (A2, O3).

    The limit is the feature (an exploration sample); an order makes it repeatable.
    """
    return (trips.filter(ago("pickup_datetime", span, as_of))
            .groupBy("trip_id", "vendor_id").agg(F.count(F.lit(1)).alias("trip_count"))
            .orderBy("trip_id", "vendor_id").limit(n))


def count_per_bin(df: DataFrame, ts: str, width: str = "hour", name: str = "IngestionCount") -> DataFrame:
    """``summarize count() by bin(ts, 1h)`` (A6, F7).  The bin keeps the input's timestamp type
    (``date_trunc`` would turn a zone-free time into a zoned one)."""
    return (df.groupBy(F.date_trunc(width, F.col(ts)).cast(df.schema[ts].dataType).alias("bin_start"))
            .agg(F.count(F.lit(1)).alias(name)))


def with_ingestion_time(df: DataFrame, when: Column | str, name: str = "ingestion_time") -> DataFrame:
    """Stamp rows with the time the loader took them in (``ingestion_time()``, A7)."""
    return df.withColumn(name, F.col(when) if isinstance(when, str) else when)


def daily_metrics(trips: DataFrame) -> DataFrame:
    """``summarize trips = count(), avg_fare = avg(fare), total_revenue = sum(fare)
    by vendor_id, pickup_date`` (A5).  The day stays a DATE (X16)."""
    return (trips.groupBy("vendor_id", F.to_date("pickup_datetime").alias("pickup_date"))
            .agg(F.count(F.lit(1)).alias("trips"),
                 exact_avg("fare_amount").alias("avg_fare"),
                 exact_sum("fare_amount").alias("total_revenue")))


def last_days(view: DataFrame, as_of: Column, span: str = "7d") -> DataFrame:
    """``where pickup_date >= ago(7d) | project ... | sort by pickup_date desc, total_revenue desc`` (V4, O2)."""
    return (view.filter(F.col("pickup_date").cast("timestamp_ntz") >= (as_of - interval(span)))
            .select("pickup_date", "vendor_id", "trips", "avg_fare", "total_revenue")
            .orderBy(F.desc("pickup_date"), F.desc("total_revenue"), "vendor_id"))


def trips_by_min_passenger_count(trips: DataFrame, num_passengers: int) -> DataFrame:
    """Stored function ``trips_by_min_passenger_count(n)`` used as a table (V5)."""
    return (trips.filter(F.col("passenger_count") >= F.lit(num_passengers))
            .select("trip_id", "pickup_datetime"))


def take_ordered(df: DataFrame, n: int, *order) -> DataFrame:
    """``take n`` made repeatable: top-n by an order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def small_first_join(small: DataFrame, big: DataFrame, on) -> DataFrame:
    """``Small | join kind=inner Big on k`` (J8).  In Spark the written order does not
    matter: the side that is small by its measured bytes is broadcast."""
    return small.join(big, on, "inner")
