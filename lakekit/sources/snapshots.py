"""Point-in-time table versions without a table format.

A table is a folder of immutable snapshots ``<root>/snapshot_ts=<epoch micros>/``;
a snapshot counts once its ``_SUCCESS`` marker exists (Spark writes it last), so a
half-written snapshot is never read.  Reads at a time pick the newest committed
snapshot not after it.  Single writer per table.  When a table format such as
Delta is available, callers may use it instead; nothing here depends on one.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PREFIX = "snapshot_ts="
MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"     # whether a write ends with _SUCCESS


def _micros(ts) -> int:
    if isinstance(ts, int):
        return ts
    if isinstance(ts, str):
        ts = dt.datetime.fromisoformat(ts)
    if isinstance(ts, dt.datetime):
        if ts.tzinfo is None:
            ts = ts.replace(tzinfo=dt.timezone.utc)
        return int(ts.timestamp() * 1_000_000)
    raise TypeError(f"cannot read {ts!r} as a time")


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- listing -----------------------------------------------------------------------------
    def snapshots(self) -> list[int]:
        """Committed snapshot ids (epoch microseconds), oldest first."""
        found = self._fs.globStatus(self._Path(f"{self.root}/{PREFIX}*/_SUCCESS")) or []
        return sorted(int(st.getPath().getParent().getName()[len(PREFIX):]) for st in found)

    def _path(self, sid: int) -> str:
        return f"{self.root}/{PREFIX}{sid}"

    # -- writing -----------------------------------------------------------------------------
    def write(self, df: DataFrame | Sequence[DataFrame], at=None, partition_by: tuple[str, ...] | list[str] = ()) -> int:
        """Write ``df`` as a new snapshot; returns its id.  Ids only grow.

        Several frames are parts of one snapshot, written one after the other; it counts when
        the last one is there.

        ``partition_by`` lays the snapshot out in folders by those columns, so reads
        that filter on them prune whole folders (partition pruning).
        """
        existing = self.snapshots()
        sid = _micros(at) if at is not None else int(time.time() * 1_000_000)
        if existing and sid <= existing[-1]:
            if at is not None:
                raise ValueError("snapshot time must be after the newest snapshot")
            sid = existing[-1] + 1
        # the id is not committed: a folder left by a writer that died midway (no
        # _SUCCESS) is replaced, so a replayed batch can always write its snapshot
        parts = [df] if isinstance(df, DataFrame) else [*df]
        for n, part in enumerate(parts, 1):
            writer = part.write.mode("overwrite" if n == 1 else "append").option(MARK, str(n == len(parts)).lower())
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(self._path(sid))
        return sid

    def truncate(self, at=None) -> int:
        """``TRUNCATE TABLE``: a new, empty snapshot with the same schema."""
        schema = self.read().schema
        return self.write(self.spark.createDataFrame([], schema), at)

    def expire(self, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` snapshots; returns the ids deleted.  Frames read
        from them stop working, so keep more than the longest-running reader needs."""
        if keep < 1:
            raise ValueError("at least one snapshot must be kept")
        old = self.snapshots()[:-keep]
        for sid in old:
            self._fs.delete(self._Path(self._path(sid)), True)
        return old

    def drop(self) -> None:
        """``DROP TABLE``: the folder and all snapshots."""
        self._fs.delete(self._Path(self.root), True)

    def restore(self, snapshot: int, at=None) -> int:
        """Make an older snapshot the newest again (copy; history is kept)."""
        return self.write(self.read_snapshot(snapshot), at)

    def clone(self, target_root: str, as_of=None, at=None) -> "SnapshotTable":
        """``CREATE TABLE b AS CLONE OF a [AT ts]``: the chosen snapshot copied as b's first."""
        clone = SnapshotTable(self.spark, target_root)
        if clone.snapshots():
            raise ValueError(f"{target_root} already exists")
        clone.write(self.read(as_of), at)
        return clone

    # -- reading -----------------------------------------------------------------------------
    def snapshot_at(self, as_of=None) -> int:
        snaps = self.snapshots()
        if not snaps:
            raise FileNotFoundError(f"no committed snapshot in {self.root}")
        if as_of is None:
            return snaps[-1]
        t = _micros(as_of)
        older = [s for s in snaps if s <= t]
        if not older:
            raise LookupError(f"{self.root} has no snapshot at or before {as_of}")
        return older[-1]

    def read_snapshot(self, sid: int, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self._path(sid))

    def read_all(self, name: str) -> DataFrame:
        """The rows of all committed snapshots, for a table whose snapshots add up (a batch
        each); ``name`` is the column that holds the snapshot's id."""
        done = self.snapshots()
        if not done:
            raise FileNotFoundError(f"no committed snapshot in {self.root}")
        column = PREFIX.rstrip("=")
        found = self.spark.read.option("basePath", self.root).parquet(*map(self._path, done))
        return found.withColumn(name, found[column].cast("bigint")).drop(column)

    def read(self, as_of=None) -> DataFrame:
        """The table as of a time (``FOR TIMESTAMP AS OF``), or the newest version."""
        return self.read_snapshot(self.snapshot_at(as_of))


def as_of(tables: dict[str, SnapshotTable], ts) -> dict[str, DataFrame]:
    """Bind every input of a view at one time: a view is a function of DataFrames, so
    ``view(**as_of(tables, ts))`` is the view as it was at ``ts``."""
    return {name: t.read(ts) for name, t in tables.items()}
