"""Incrementally maintained aggregate views (V3).

The view stores partial aggregates — row count, and for every measure an exact
decimal sum and a non-NULL count — never an average.  New data is aggregated on
its own, then merged by adding partials per key (union + re-aggregate: one shuffle
of two pre-aggregated sets), and written as a new snapshot.  Each row of it carries, for
every source, the last batch applied and a digest of that batch's partials: the same
batch of the same source is a replay and skipped, so a ``foreachBatch`` replay after a
failure cannot count data twice; other data under an id already applied raises.
Averages are derived on read as sum / count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.scalar import MONEY, MONEY_SUM
from lakekit.session import reliable_checkpoint
from lakekit.sources.snapshots import SnapshotTable

N = "__rows"
APPLIED = "__applied"       # map: source -> struct(batch, digest)


class MaterializedAggregate:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], measures: Sequence[str], keep: int = 3):
        self.spark = spark
        self.table = SnapshotTable(spark, root)
        self.keys = list(keys)
        self.measures = list(measures)
        self.keep = keep

    def partials(self, rows: DataFrame) -> DataFrame:
        """Aggregate new rows into partials (map-side combined before the shuffle)."""
        aggs = [F.count(F.lit(1)).cast("bigint").alias(N)]
        for m in self.measures:
            aggs += [F.sum(F.col(m).cast(MONEY)).cast(MONEY_SUM).alias(f"__sum_{m}"),
                     F.count(F.col(m)).cast("bigint").alias(f"__cnt_{m}")]
        return rows.groupBy(*self.keys).agg(*aggs)

    def applied(self) -> dict[str, tuple[int, int]]:
        """Last batch id and digest applied from each source."""
        row = self.table.read().select(APPLIED).first() if self.table.snapshots() else None
        return {k: (v["batch"], v["digest"]) for k, v in (row[0] if row else {}).items()}

    def signed(self, rows: DataFrame | None, removed: DataFrame) -> DataFrame:
        """Partials of ``rows`` less those of ``removed``: one row per key, counts may be negative."""
        less = self.partials(removed)
        parts = [c for c in less.columns if c not in self.keys]
        less = less.select(*self.keys, *((-F.col(c)).alias(c) for c in parts))
        return self._summed(less if rows is None else self.partials(rows).unionByName(less))

    def _summed(self, partials: DataFrame) -> DataFrame:
        parts = [c for c in partials.columns if c not in self.keys]
        return partials.groupBy(*self.keys).agg(*[F.sum(c).cast(MONEY_SUM if c.startswith("__sum_") else "bigint").alias(c) for c in parts])

    def refresh(self, rows: DataFrame | None, batch_id: int, source: str = "default", removed: DataFrame | None = None) -> bool:
        """Fold ``rows`` into the view as batch ``batch_id`` of ``source``; False for a replay.

        ``removed`` are rows that the view counted and that are gone: those a DELETE took, or the
        old versions of those an UPDATE changed (their new versions are in ``rows``).  Sums
        and counts are kept with signs, and a group whose count comes to 0 goes; one that comes
        below 0 was never counted, and raises.

        An id not above the source's last one is a replay only if it is that last batch with
        the same data; anything else raises, since it would be lost or counted twice.
        """
        done = self.applied()
        new, seen = self.partials(rows) if removed is None else self.signed(rows, removed), Observation()
        # the digest comes out of the same job that writes the partials
        new = reliable_checkpoint(new.observe(seen, F.coalesce(F.bit_xor(F.xxhash64(*new.columns)), F.lit(0)).alias("d")))
        digest = seen.get["d"]
        if source in done and batch_id <= done[source][0]:
            if (batch_id, digest) == done[source]:
                return False
            raise ValueError(f"batch {batch_id} of {source!r} is not a replay of the last applied, {done[source][0]}")
        merged = new
        if self.table.snapshots():
            merged = self._summed(self.table.read().drop(APPLIED).unionByName(new))
        if removed is not None:
            below = F.raise_error(F.lit("rows were removed that the view doesn't hold")).cast("boolean")
            merged = merged.filter(F.when(F.col(N) < 0, below).otherwise(F.col(N) > 0))
        state = {**done, source: (batch_id, digest)}
        entries = [x for k, (b, d) in sorted(state.items())
                   for x in (F.lit(k), F.struct(F.lit(b).cast("bigint").alias("batch"), F.lit(d).cast("bigint").alias("digest")))]
        self.table.write(merged.withColumn(APPLIED, F.create_map(*entries)))
        self.table.expire(self.keep)
        return True

    def read_partials(self) -> DataFrame:
        return self.table.read().drop(APPLIED)

    def foreach_batch(self, transform=None, source: str = "default"):
        """A ``foreachBatch`` callback keeping the view current as a stream runs.  Each stream
        checkpoint needs a ``source`` of its own: batch ids start anew with it."""
        def apply(batch: DataFrame, batch_id: int) -> None:
            self.refresh(transform(batch) if transform else batch, batch_id, source)
        return apply


def daily_metrics_view(partials: DataFrame) -> DataFrame:
    """``trips = count(), avg_fare = avg(fare_amount), total_revenue = sum(fare_amount)`` from partials."""
    return partials.select(
        "vendor_id", "pickup_date",
        F.col(N).alias("trips"),
        (F.col("__sum_fare_amount").cast("double") / F.col("__cnt_fare_amount").cast("double")).alias("avg_fare"),
        F.col("__sum_fare_amount").cast(MONEY_SUM).alias("total_revenue"))
