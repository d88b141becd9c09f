"""A table laid out by key buckets, whose upserts rewrite only the buckets they touch (M1, M3).

``<root>/bucket=<n>/`` holds the rows whose key hashes to n.  An upsert reads and joins the
buckets that its rows fall into, writes the result into ``<root>/_pending`` first, then replaces
these folders by dynamic partition overwrite; files of other buckets stay as they are.  The
pending copy is complete once its marker is there, so an upsert that fails while replacing is
finished by the next one that opens the table, and one that fails before leaves no trace.  There is
no log and one writer per table; readers of a touched bucket wait for the replacement.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators.merge import merge_upsert

BUCKET = "bucket"
PENDING = "_pending"


class BucketTable:
    """``keys`` and ``buckets`` are fixed for the table's life; choose so many buckets that one
    is a few tasks' work (about a gigabyte).  The schema must not have a column ``bucket``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._finish()

    def _bucket(self) -> Column:
        """Hash of the keys' text, so that an int and a bigint key fall into the same bucket."""
        text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in self.keys]
        return F.pmod(F.xxhash64(*text), F.lit(self.buckets)).cast("int")

    def create(self, df: DataFrame) -> None:
        """Write the first state."""
        if BUCKET in df.columns:
            raise ValueError(f"the column {BUCKET!r} is the table's own")
        df.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(self.root)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def upsert(self, updates: DataFrame, merge: Callable[..., DataFrame] = merge_upsert, **options) -> list[int]:
        """``merge(target, updates, keys, **options)`` on the buckets that ``updates`` touch; returns
        them.  ``merge`` must not delete rows (``merge_upsert``, ``merge_columns``, ``merge_insert_only``)."""
        dealt = updates.withColumn(BUCKET, self._bucket())
        touched = sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())      # at most one row a bucket
        if not touched:
            return []
        stored = self._stored()
        target = stored.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)     # only these folders are listed and read
        merged = merge(target, updates, self.keys, **options).withColumn(BUCKET, self._bucket())
        merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{PENDING}")
        self._finish()
        return touched

    def _finish(self) -> None:
        """Replace the buckets that a complete pending copy holds; an incomplete one is dropped."""
        pending = self._Path(f"{self.root}/{PENDING}")
        if not self._fs.exists(pending):
            return
        if self._fs.exists(self._Path(f"{self.root}/{PENDING}/_SUCCESS")):
            (self.spark.read.parquet(f"{self.root}/{PENDING}").repartition(BUCKET).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.root))
        self._fs.delete(pending, True)

    def files(self) -> dict[int, set[str]]:
        """Names of each bucket's files (one listing on the driver)."""
        out: dict[int, set[str]] = {}
        for status in self._fs.globStatus(self._Path(f"{self.root}/{BUCKET}=*/*.parquet")) or []:
            path = status.getPath()
            out.setdefault(int(path.getParent().getName().split("=")[1]), set()).add(path.getName())
        return out
