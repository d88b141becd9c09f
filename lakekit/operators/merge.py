"""Upserts without a table format.

Every operator is a pure function ``(target, updates) -> new target``; writing the
result as a new snapshot is the caller's (or :mod:`lakekit.sources.snapshots`') job.
Each merge is one join on the keys; Spark picks the join by the bytes it measures.
Presence flags (not ``IS NULL`` tests) tell matched rows apart, so NULL payloads survive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

T_FLAG = "__in_target"
U_FLAG = "__in_updates"
ONE = "__one"


def _u(c: str) -> str:
    return f"__u__{c}"


def _key_cond(t: DataFrame, u: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = t[k].eqNullSafe(u[_u(k)]) if null_safe else (t[k] == u[_u(k)])
        cond = c if cond is None else cond & c
    return cond


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (unenforced primary key check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats.  One aggregate job; stops at the first duplicate found."""
    if duplicate_keys(df, keys).limit(1).count():
        raise ValueError(f"duplicate source keys on {list(keys)}")


def unique_or_fail(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing when it runs if a key repeats.  The count is a window over the keys, so a
    join on them uses its partitioning and order, and ``df`` is computed once."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    fail = F.raise_error(F.lit(f"duplicate source keys on {list(keys)}")).cast("boolean")
    return df.withColumn(ONE, F.when(n > 1, fail).otherwise(True)).filter(F.col(ONE)).drop(ONE)


def _checked(updates: DataFrame, keys: Sequence[str], check: bool | str) -> DataFrame:
    if check not in (True, False, "inline"):
        raise ValueError("check_unique must be True, False or 'inline'")
    if check == "inline":
        return unique_or_fail(updates, keys)
    if check:
        assert_unique_keys(updates, keys)
    return updates


def _joined(target: DataFrame, updates: DataFrame, keys: Sequence[str], null_safe: bool,
            how: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = target.withColumn(T_FLAG, F.lit(True))
    u = updates.select(*[F.col(c).alias(_u(c)) for c in updates.columns]).withColumn(U_FLAG, F.lit(True))
    return t.join(u, _key_cond(t, u, keys, null_safe), how), t, u


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], *, null_safe: bool = False,
                 preserve: Sequence[str] = (), check_unique: bool | str = True) -> DataFrame:
    """MERGE: matched -> update all columns, not matched -> insert all (M1).

    ``preserve`` columns keep the target's value on update (e.g. ``CreatedTS``).
    Duplicate source keys would update one target row twice, so they raise: at once, which
    runs the updates' plan once more, or with ``check_unique="inline"`` when the result is computed.
    """
    updates = _checked(updates, keys, check_unique)
    j = _joined(target, updates, keys, null_safe, "full_outer")[0]
    in_u = F.col(U_FLAG).isNotNull()
    in_t = F.col(T_FLAG).isNotNull()
    out = []
    for c in target.columns:
        if c not in updates.columns:
            out.append(F.when(in_t, F.col(c)).alias(c))
        elif c in preserve:
            out.append(F.when(in_t, F.col(c)).otherwise(F.col(_u(c))).alias(c))
        else:
            out.append(F.when(in_u, F.col(_u(c))).otherwise(F.col(c)).alias(c))
    return j.select(*out)


def merge_insert_only(target: DataFrame, updates: DataFrame, keys: Sequence[str], *,
                      null_safe: bool = False) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED INSERT: append rows whose key is new (M2, idempotent).

    Only the target's key columns are joined; its rows pass through as they are.
    """
    tk = target.select(*[F.col(k).alias(_u(k) + "t") for k in keys])
    cond = None
    for k in keys:
        c = updates[k].eqNullSafe(tk[_u(k) + "t"]) if null_safe else (updates[k] == tk[_u(k) + "t"])
        cond = c if cond is None else cond & c
    new = updates.join(tk, cond, "left_anti")
    return target.unionByName(new.select(*target.columns))


def merge_columns(target: DataFrame, updates: DataFrame, keys: Sequence[str], *,
                  update_set: Mapping[str, str] | Sequence[str] = (), insert_cols: Sequence[str] = (),
                  null_safe: bool = False, check_unique: bool | str = True) -> DataFrame:
    """MERGE with explicit column lists (M3).

    Matched rows take ``update_set`` columns from the updates (others kept); new keys
    insert ``insert_cols`` (plus the keys) and NULL elsewhere.  ``check_unique`` as in ``merge_upsert``.
    """
    updates = _checked(updates, keys, check_unique if update_set else False)
    if not isinstance(update_set, Mapping):
        update_set = {c: c for c in update_set}
    insert = set(insert_cols) | set(keys)
    j = _joined(target, updates, keys, null_safe, "full_outer")[0]
    in_u = F.col(U_FLAG).isNotNull()
    in_t = F.col(T_FLAG).isNotNull()
    out = []
    for c in target.columns:
        matched = F.col(_u(update_set[c])) if c in update_set else F.col(c)
        inserted = F.col(_u(c)) if c in insert else F.lit(None).cast(target.schema[c].dataType)
        out.append(F.when(in_t & in_u, matched).when(in_t, F.col(c)).otherwise(inserted).alias(c))
    return j.select(*out)


def update_where(df: DataFrame, predicate: Column | str, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE t SET c = e WHERE p`` (M5/M8).  All new values read the old row, as in SQL."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    p = F.coalesce(p, F.lit(False))
    return df.withColumns({c: F.when(p, e).otherwise(F.col(c)).cast(df.schema[c].dataType)
                           for c, e in assignments.items()})
