"""Clustered layout: files in Morton order of several columns.

Sorted by one column, a table's row groups have narrow ranges of that column only.  Here each
column is cut into quantile bins, the bins' bits are interleaved, and rows are range-partitioned
and sorted by the result, so row groups have narrow ranges of every column, and a filter
on any of them lets the Parquet scan skip most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MORTON = "__morton"


def quantile_bin(value: Column, bounds: list) -> Column:
    """How many ``bounds`` (ascending) the value reaches, by a tree of comparisons; NULL is in bin 0."""
    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= F.lit(bounds[mid]), pick(mid + 1, hi)).otherwise(pick(lo, mid))

    return pick(0, len(bounds))


def interleave(bins: Sequence[Column], bits: int) -> Column:
    """The bins' bits in turn, the first column's highest in front."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for at, b in enumerate(reversed(bins)):
            one = F.shiftright(b, bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(bins) + at))
    return out


def with_morton(df: DataFrame, columns: Sequence[str], bits: int = 5) -> DataFrame:
    """``df`` with ``__morton``: its place on the curve over 2^bits quantile bins of each column
    (numbers, dates and times).  One aggregate finds the bounds, at most 2^bits - 1 a column."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*(F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns))).first()
    bins = [quantile_bin(F.col(c), sorted(set(found[i] or []))) for i, c in enumerate(columns)]
    return df.withColumn(MORTON, interleave(bins, bits))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 5, group_bytes: int | None = None) -> None:
    """Write ``df`` as ``files`` Parquet files in Morton order of ``columns``; ``group_bytes`` sets
    the size of their row groups.  Rows that share a place on the curve stay together unless
    they are more than a file: a tie of their own splits them."""
    rows = with_morton(df, columns, bits).withColumn("__tie", F.monotonically_increasing_id())
    order = [MORTON, "__tie"]
    writer = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(*order).write
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)
