"""Source -> transform -> sink as one Structured Streaming query.

Event times in the driver data are ``timestamp_ntz``; a watermark needs
``timestamp``, so the stream casts them (session time zone UTC) and the sink casts
them back.  Complete-mode results go through ``foreachBatch`` into a snapshot table
whose snapshot id is the batch id: a batch replayed after a failure finds its
snapshot already committed and writes nothing (its rows are still read once, so that the
state store commits too), so the sink is exactly-once and the stream goes on.
Append-mode results use the Parquet file sink, whose commit log gives the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.sources.snapshots import SnapshotTable


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def file_stream(spark: SparkSession, path: str, schema: StructType, *, event_time: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over a folder (or a single file) with a fixed schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if not _is_dir(spark, path):
        # a stream needs a pattern: the last character as a class of one matches this file only
        parent, name = path.rstrip("/").rsplit("/", 1)
        reader = reader.option("basePath", parent)
        path = f"{parent}/{re.sub(r'([][*?{}])', r'[\1]', name[:-1])}[{name[-1]}]"
    df = reader.parquet(path)
    if event_time:
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every zoned timestamp column (top level or window struct fields) to timestamp_ntz."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "timestamp":
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def started(writer, state_store: str | None = None):
    """Start a stream; ``state_store`` is its state store's provider (a stream keeps the one it
    was first started with in its checkpoint)."""
    spark = writer._spark
    before = spark.conf.get(STATE_STORE, None)
    if state_store:
        spark.conf.set(STATE_STORE, state_store)
    try:
        return writer.start()
    finally:
        if state_store:
            spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def require_own_checkpoint(sink: SnapshotTable, checkpoint: str, first: int = 0) -> None:
    """Raise when ``sink`` has results of batches (ids from ``first`` on) and ``checkpoint`` is new."""
    if any(sid >= first for sid in sink.snapshots()) and not _is_dir(sink.spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{sink.root} holds results of a stream with another checkpoint than {checkpoint}: give this one a sink of its own")


def replayed(sink: SnapshotTable, batch: DataFrame, batch_id: int, snapshot: int) -> bool:
    """Whether ``batch`` was committed before, as ``snapshot``: the stream failed between the
    sink's commit and its own.  Its rows are read to the end all the same, else the operators'
    state would not be committed and every restart would fail there."""
    done = sink.snapshots()
    if not done or snapshot > done[-1]:
        return False
    if snapshot < done[-1]:
        raise ValueError(f"batch {batch_id} is older than the newest in {sink.root}: the checkpoint was rolled back")
    batch.write.format("noop").mode("overwrite").save()
    return True


def run_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_root: str, checkpoint: str,
               *, output_mode: str = "complete", watermark: tuple[str, str] | None = None,
               available_now: bool = True, keep: int = 3, state_store: str | None = None) -> SnapshotTable | str:
    """Run ``transform`` over ``stream`` until the input is drained (``availableNow``).

    Complete mode returns the snapshot table holding the latest full result; append
    mode returns the Parquet folder of emitted rows.  Append mode emits a window or session
    once the watermark has passed its end: those still open when the input is drained stay in
    the checkpoint and come with later input.  Complete mode keeps the newest ``keep`` results.  With ``available_now=False`` the
    query keeps running on a 10-second trigger and its ``StreamingQuery`` handle is
    returned instead (the caller stops it).  A sink that holds another stream's results raises:
    its snapshot ids say nothing about a new checkpoint's batches.
    """
    spark = stream.sparkSession
    if watermark:
        stream = stream.withWatermark(*watermark)
    sink = SnapshotTable(spark, sink_root) if output_mode == "complete" else None
    if sink is not None:
        require_own_checkpoint(sink, checkpoint)
    out = transform(stream)
    writer = out.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    if output_mode == "complete":
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            if replayed(sink, batch, batch_id, batch_id):
                return
            sink.write(to_ntz(batch), at=batch_id)
            sink.expire(keep)

        q = started(writer.foreachBatch(write_batch), state_store)
        if not available_now:
            return q
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        return sink
    if output_mode == "append":
        q = started(writer.format("parquet").option("path", sink_root), state_store)
        if not available_now:
            return q
        q.awaitTermination()
        return sink_root
    raise ValueError("output_mode must be 'complete' or 'append'")


def run_append(out: DataFrame, sink_root: str, checkpoint: str, state_store: str | None = None) -> str:
    """Append the rows of a prepared stream (it has its own watermarks) until the input is drained."""
    return run_stream(out, lambda s: s, sink_root, checkpoint, output_mode="append", state_store=state_store)


def session_totals(stream: DataFrame, ts: str, gap: str, keys, value: str | None = None) -> DataFrame:
    """Per-key session windows on a stream (T3, T4): Spark keeps open sessions in the state
    store and, in append mode, emits a session once the watermark passes its end."""
    from lakekit.functions.scalar import MONEY, MONEY_SUM, seconds_of

    aggs = [F.count(F.lit(1)).alias("n_events")]
    if value:
        aggs.append(F.sum(F.col(value).cast(MONEY)).cast(MONEY_SUM).alias("total_value"))
    g = stream.groupBy(*keys, F.session_window(ts, f"{seconds_of(gap)} seconds").alias("__sw")).agg(*aggs)
    return g.select(*keys, F.col("__sw.start").alias("session_start"), F.col("__sw.end").alias("session_end"),
                    *[a for a in ("n_events", "total_value") if a in g.columns])
