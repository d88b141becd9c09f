"""Joins on streams: two streams within a time range (J9, G1), a stream with the newest version
of a dimension (J3, J8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalar import seconds_of
from lakekit.sources.snapshots import SnapshotTable
from lakekit.streaming.stream import replayed, require_own_checkpoint, started


def join_within(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, delay: str) -> DataFrame:
    """Inner join of two streams on ``key`` where the left row's time is at most ``within`` after
    the right row's.

    Both sides carry a watermark of ``delay``, and the range bounds how long a row can still find
    a partner, so Spark drops it from the state once the watermark is beyond.  The right side's
    key and time are renamed ``__right_<name>``; its other names must differ from the left's.
    Rows without a key or a time join with nothing.
    """
    right_key, right_at = f"__right_{key}", f"__right_{right_ts}"
    left = left.withWatermark(left_ts, f"{seconds_of(delay)} seconds")
    right = right.withColumnsRenamed({key: right_key, right_ts: right_at}).withWatermark(right_at, f"{seconds_of(delay)} seconds")
    near = (F.col(left_ts) >= F.col(right_at)) & (F.col(left_ts) <= F.col(right_at) + F.expr(f"INTERVAL {seconds_of(within)} SECONDS"))
    return left.join(right, (F.col(key) == F.col(right_key)) & near)


def run_with_dimension(stream: DataFrame, dimension: SnapshotTable, join: Callable[[DataFrame, DataFrame], DataFrame],
                       sink_root: str, checkpoint: str) -> SnapshotTable:
    """Join each micro-batch with the newest committed version of ``dimension`` at that time
    (a plain stream-static join keeps the files it was planned with) until the input is drained.

    Each batch is one snapshot of the sink, committed once: a replayed batch keeps the rows of
    its first commit, whatever the dimension is by then.  ``read_all`` gives all batches.
    """
    sink = SnapshotTable(stream.sparkSession, sink_root)
    require_own_checkpoint(sink, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not replayed(sink, batch, batch_id, batch_id):
            sink.write(join(batch, dimension.read()), at=batch_id)

    query = started(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True))
    query.awaitTermination()
    return sink
