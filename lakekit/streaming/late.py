"""Late rows counted instead of lost.

A watermarked aggregate drops rows that come behind its watermark, and only a metric says how
many.  Here each micro-batch is split in two: rows in time go on to a replay-safe fold, rows
behind the watermark are kept in a table of their own.  The watermark follows Spark's rule (the
newest event time of all earlier batches less the delay; it never goes back) and is committed
with the counts after both sides, so a batch that failed midway is split the same way again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.scalar import seconds_of
from lakekit.sources.snapshots import SnapshotTable
from lakekit.streaming.stream import replayed

US = 1_000_000
PROGRESS = "batch bigint, newest_us bigint, on_time bigint, late bigint"


class LateSplit:
    """Splits batches at the watermark of ``ts``; ``fold(rows, batch_id)`` takes the rows in
    time and must skip a batch it has seen (as ``MaterializedAggregate.refresh`` does).

    A row is late when its time is before the watermark, or missing.  Tables under ``root``:
    ``late`` (a folder a batch) and ``progress`` (a row a batch, read for the watermark).
    """

    def __init__(self, spark: SparkSession, root: str, ts: str, delay: str, fold: Callable[[DataFrame, int], object], keep: int = 3):
        self.spark, self.ts, self.delay_us, self.fold, self.keep = spark, ts, seconds_of(delay) * US, fold, keep
        self.late = SnapshotTable(spark, f"{root.rstrip('/')}/late")
        self.progress = SnapshotTable(spark, f"{root.rstrip('/')}/progress")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` callback."""
        if replayed(self.progress, batch, batch_id, batch_id):
            return
        known = self.progress.read() if self.progress.snapshots() else self.spark.createDataFrame([], PROGRESS)
        newest = known.agg(F.max("newest_us")).first()[0]
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        mark = F.lit(None if newest is None else newest - self.delay_us).cast("bigint")
        is_late = F.coalesce(us < mark, us.isNull())
        batch = batch.persist()     # split, folded and counted from one read of the source
        try:
            if batch_id not in self.late.snapshots():
                self.late.write(batch.filter(is_late), at=batch_id)
            self.fold(batch.filter(~is_late), batch_id)
            seen = batch.agg(F.max(us).alias("newest_us"), F.count_if(~is_late).alias("on_time"), F.count_if(is_late).alias("late"))
            row = seen.select(F.lit(batch_id).cast("bigint").alias("batch"), F.greatest("newest_us", F.lit(newest).cast("bigint")).alias("newest_us"), "on_time", "late")
            self.progress.write(known.unionByName(row).coalesce(1), at=batch_id)     # one small row a batch
            self.progress.expire(self.keep)
        finally:
            batch.unpersist()

    def late_rows(self) -> DataFrame:
        """All late rows so far, with the batch they came in."""
        return self.late.read_all("batch")

    def counts(self) -> DataFrame:
        """batch, newest_us, on_time, late of every batch."""
        return self.progress.read()
