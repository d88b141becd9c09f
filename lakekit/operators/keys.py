"""Dense surrogate keys and key helpers.

``monotonically_increasing_id()`` is unique but leaves gaps of 2^33 between
partitions.  We keep its per-partition counter and close the gaps: range-partition
the rows on the key, write them once to the shared checkpoint folder (so a lost
executor cannot re-sample other range bounds), count rows per partition (one small
row per partition to the driver) and add each partition's running offset.  No step
puts all rows in one task, and the numbering equals ``row_number() OVER (ORDER BY key)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lakekit.session import reliable_checkpoint

PID = "__pid"


def max_key(df: DataFrame, key: str) -> Column:
    """``coalesce(max(key), 0)`` as a lazy scalar subquery (no driver round trip)."""
    return df.select(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()


def assign_surrogate_keys(df: DataFrame, order_cols: Sequence[str], key_name: str,
                          start_after: int | Column = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` = start_after + dense 1-based rank of each row in ``order_cols`` order.

    ``order_cols`` must order the rows totally (ties would be numbered arbitrarily).
    Without ``num_partitions`` the range exchange is sized by AQE (adjacent ranges are
    coalesced, which keeps the order).  The per-partition offsets (one row per
    partition) reach the rows through a broadcast join on the partition id, which
    keeps each partition's rows where and in the order they are.
    """
    spark = df.sparkSession
    start = start_after if isinstance(start_after, Column) else F.lit(int(start_after))
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ranged = ranged.sortWithinPartitions(*order_cols).withColumn(PID, F.spark_partition_id())
    ranged = reliable_checkpoint(ranged)
    counts = {r[PID]: r["n"] for r in ranged.groupBy(PID).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, run = [], 0
    for p in range(ranged.rdd.getNumPartitions()):
        offsets.append((p, run))
        run += counts.get(p, 0)
    table = spark.createDataFrame(offsets or [(0, 0)], f"{PID} int, __off long")
    row_in_part = F.monotonically_increasing_id() - F.shiftleft(F.col(PID).cast("bigint"), 33)
    numbered = ranged.withColumn("__row", row_in_part).join(F.broadcast(table), PID)
    return (numbered.withColumn(key_name, (start.cast("bigint") + F.col("__off") + F.col("__row") + 1).cast("bigint"))
            .drop(PID, "__off", "__row"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Latest row per key: ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_cols DESC) = 1``.

    Written as ``max(struct(order..., rest...))`` per key, so each map task keeps one
    row per key before the shuffle (partial aggregation): a key holding a third of
    all rows is reduced on every executor instead of landing whole in one task.
    ``order_cols`` should include a tie-break that makes the choice unique.  Structs of
    variable width are aggregated by sorting, so each map task sorts its rows by key.
    A MAP column cannot be compared; it is carried as sorted entries and rebuilt.
    """
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType) and f.name not in keys]
    if maps:
        as_entries = df.withColumns({c: F.array_sort(F.map_entries(c)) for c in maps})
        return latest_per_key(as_entries, keys, order_cols).withColumns({c: F.map_from_entries(c) for c in maps})
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c) for c in rest]).alias("__best")
    agg = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    cols = []
    for c in df.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in order_cols:
            cols.append(F.col(f"__best.o{list(order_cols).index(c)}").alias(c))
        else:
            cols.append(F.col(f"__best.{c}").alias(c))
    return agg.select(*cols)


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """``dropDuplicates(keys)`` with a defined survivor: the latest by ``order_cols``
    (all other columns, as a last resort, so the result is repeatable)."""
    order = list(order_cols) if order_cols else [c for c in df.columns if c not in keys]
    if not order:
        return df.select(*keys).distinct()
    return latest_per_key(df, keys, order)
