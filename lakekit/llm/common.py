"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.session import prepare, work_dir

# Rows per Arrow batch handed to a Python worker: long texts make large batches.
ARROW_ROWS = 500
# Rows to each task that writes a table whose number of rows is known, on average.
WRITE_ROWS = 100_000
# Delete a query's shuffle files when it ends (left alone they stay until the driver collects garbage).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ready(spark: SparkSession) -> SparkSession:
    """Prepare the session: shared checkpoint folder, UTC, small Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """Queries that begin in here delete their shuffle files when they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def few(df: DataFrame, rows: int, least: int = 1) -> DataFrame:
    """``df`` in no more tasks than its rows (so many at most, roughly) or the cores need, for a write: of a small
    table each shuffle partition would else become a file, and on a local disk Hadoop starts processes for each."""
    return df.coalesce(max(math.ceil(rows / WRITE_ROWS), df.sparkSession.sparkContext.defaultParallelism, least))


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut and
    the rows are computed once, so a lost executor cannot change them.  Nothing reads the
    shuffles of the write again, so their files go with it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    with shuffles_deleted(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_path = path
    return table


def staged_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``staged``, in buckets of ``key``: a join on it moves the other side only.  Spark knows buckets
    from its catalog, so the table has an entry there until it is released.  ``df`` should come dealt
    out by ``repartition(buckets, key)``, or each task writes a file for each bucket."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    entry = path.rsplit("/", 1)[1].replace("-", "_")
    spark.createDataFrame([], df.schema).write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(entry)
    with shuffles_deleted(spark):
        df.write.insertInto(entry)
    table = spark.table(entry)
    table._staged_path, table._staged_entry = path, entry
    return table


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again (what was made from them is written)."""
    for t in tables:
        if hasattr(t, "_staged_entry"):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {t._staged_entry}")
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._staged_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (a NULL id gives NULL)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


_HELD: list[Callable] = []


def held(fn: Callable) -> Callable:
    """Keep what ``fn`` builds (tokenizers, memos) in the Python worker, for one argument."""
    kept = functools.lru_cache(maxsize=1)(fn)
    _HELD.append(kept)
    return kept


def focus(*keep: Callable) -> None:
    """Drop what other operators hold in this worker: Spark uses a worker for stage after
    stage, and an executor's memory would fill with what earlier ones built."""
    if [fn.cache_clear() for fn in _HELD if fn not in keep and fn.cache_info().currsize]:
        trim()


def trim() -> None:
    """Give freed memory back to the system: an idle worker keeps it otherwise."""
    gc.collect()        # a memo and the tokenizer whose method it calls refer to each other
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


class WordCache(dict):
    """Bounded memo of ``fn(word)``: two generations, so frequent words stay.

    A lookup that misses the young generation takes the value from the old one or computes
    it; when the young generation is full it becomes the old one.
    """

    def __init__(self, fn: Callable, limit: int):
        super().__init__()
        self.fn, self.limit, self.old = fn, limit, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.fn(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        # very long words would hold memory and hardly come again
        if len(word) <= 200:
            self[word] = value
        return value


_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[^\\S\x1c-\x1f]+")


def chunks(text: str) -> list[str]:
    """Runs of characters that aren't white space, as the tokenizers' ``\\s`` has it
    (Python's ``split`` also cuts at U+001C to U+001F, which are ordinary there)."""
    if _SEPARATORS.search(text):
        return [c for c in _BLANKS.split(text) if c]
    return text.split()
