"""Data-quality checks for constraints the warehouse declares but does not enforce (Q4, Q5, Q7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalar import MONEY_SCALE


def scale_violations(df: DataFrame, measures: Sequence[str], scale: int = MONEY_SCALE) -> DataFrame:
    """Rows with a measure that a sum with ``scale`` decimal places would round."""
    cond = F.lit(False)
    for c in measures:
        kept = F.col(c).try_cast(f"decimal(38,{scale})")
        cond = cond | (F.col(c).isNotNull() & ~F.coalesce(kept.cast("double") == F.col(c).cast("double"), F.lit(False)))
    return df.filter(cond)


def null_violations(df: DataFrame, not_null: Sequence[str]) -> DataFrame:
    """Rows breaking a NOT NULL declaration on any of ``not_null``."""
    cond = None
    for c in not_null:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def assert_not_null(df: DataFrame, not_null: Sequence[str]) -> None:
    """Raise when a NOT NULL column holds a NULL (stops at the first one)."""
    if null_violations(df, not_null).limit(1).count():
        raise ValueError(f"NULL found in NOT NULL columns {list(not_null)}")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its NULL count (single aggregate pass)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.select(F.expr(f"stack({len(columns)}, {stack}) AS (column_name, null_count)"))


def orphan_facts(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (NULL keys included): the
    foreign-key check of an unenforced constraint, as a ``left_anti`` join."""
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("__dk")).distinct()
    return fact.join(keys, fact[fact_key] == keys["__dk"], "left_anti")
