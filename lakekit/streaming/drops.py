"""Dated file drops as a stream: each file is read once (S4), repeated rows are dropped
and dimensions follow the drops (M7, M9, V11)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakekit.functions.scalar import seconds_of
from lakekit.sources.files import with_drop_date
from lakekit.sources.snapshots import SnapshotTable
from lakekit.streaming.stream import replayed, require_own_checkpoint, started


def dated_drops(spark: SparkSession, folder: str, schema: StructType, *, header: bool = True, sep: str = ",",
                files_per_batch: int | None = None, **naming) -> DataFrame:
    """The folder's drops as a stream, with the columns of ``files.read_dated_files``.

    The stream's checkpoint remembers the files it has read, so a later run reads only new
    ones; they are taken in the order in which they came.
    """
    reader = spark.readStream.option("header", header).option("sep", sep).option("recursiveFileLookup", True).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_drop_date(reader.csv(folder), **naming)


def once_within(stream: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Rows of keys not seen within ``delay`` of event time: what is delivered again adds
    nothing, and a key leaves the state when the watermark is past its time plus ``delay``.
    A repeat that comes later than that is behind the watermark, so it is dropped as late."""
    return stream.withWatermark(ts, f"{seconds_of(delay)} seconds").dropDuplicatesWithinWatermark(list(keys))


def maintain_dimension(stream: DataFrame, table: SnapshotTable, apply: Callable[[DataFrame, DataFrame], DataFrame],
                       checkpoint: str, keep: int = 3) -> int:
    """Fold each micro-batch into the dimension until the input is drained; returns the rows read.

    ``table`` starts with its initial state as snapshot 0; batch b is committed as snapshot
    b + 1 of ``apply(dimension, batch)`` (``scd1_replay``, ``scd2_replay``, a merge).  A batch
    that is replayed because the stream failed between the two commits finds its snapshot and
    changes nothing.
    """
    if not table.snapshots():
        raise ValueError(f"{table.root} has no initial state: write one as snapshot 0")

    def fold(batch: DataFrame, batch_id: int) -> None:
        if not replayed(table, batch, batch_id, batch_id + 1):
            table.write(apply(table.read(), batch), at=batch_id + 1)
            table.expire(keep)

    require_own_checkpoint(table, checkpoint, first=1)
    query = started(stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True))
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)

