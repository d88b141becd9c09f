"""Slowly changing dimensions, types 0-3 (M6-M12), as single-pass DataFrame jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalar import any_changed
from lakekit.operators.keys import assign_surrogate_keys, dedup_by_key, latest_per_key, max_key
from lakekit.operators.merge import merge_insert_only
from lakekit.session import reliable_checkpoint

S = "__s__"  # prefix of the staged side after the join
IN_S = "__in_staged"
IN_D = "__in_dim"
PARSED = "__parsed"


def _staged(latest: DataFrame) -> DataFrame:
    return latest.select(*[F.col(c).alias(S + c) for c in latest.columns]).withColumn(IN_S, F.lit(True))


def _join(dim: DataFrame, latest: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Join dimension rows with the latest staged row per key (``inner``, ``left`` or ``full_outer``):
    one join, chosen by Spark from the bytes it measures."""
    d, s = dim.withColumn(IN_D, F.lit(True)), _staged(latest)
    cond = None
    for k in key:
        c = d[k] == s[S + k]
        cond = c if cond is None else cond & c
    return d.join(s, cond, how)


def scd0_insert_new(dim: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Type 0: rows never change; only unseen keys are added (e.g. the date dimension).

    Of several incoming rows of a new key the last by ``order`` is taken (by default by all
    other columns), so the result can be repeated.
    """
    one = dedup_by_key(incoming.select(*dim.columns, *(c for c in order or () if c not in dim.columns)), key, order)
    return merge_insert_only(dim, one.select(*dim.columns), key)


def changed_members(dim: DataFrame, latest: DataFrame, key: Sequence[str], attrs: Sequence[str],
                    strict_sql: bool = False) -> DataFrame:
    """Rows whose key matches and any attribute differs (NULL-safe unless ``strict_sql``).

    Output: key, then ``old_<a>`` and ``new_<a>`` for every attribute.
    """
    j = _join(dim, latest, key, "inner")
    cond = any_changed([(F.col(a), F.col(S + a)) for a in attrs], strict_sql)
    cols = [F.col(k) for k in key]
    for a in attrs:
        cols += [F.col(a).alias(f"old_{a}"), F.col(S + a).alias(f"new_{a}")]
    return j.filter(cond).select(*cols)


def scd1_apply(dim: DataFrame, staging: DataFrame, key: Sequence[str], attrs: Sequence[str], *,
               dim_date: str = "last_updated_date", staged_date: str = "file_date",
               tiebreak: Sequence[str] = (), strict_sql: bool = False) -> DataFrame:
    """Type 1 (M7): overwrite attributes when the staged row is newer AND a value changed;
    insert unseen keys.  Staging is reduced to its latest row per key first (X13).

    Dates are compared after ``try_cast`` to DATE.  A staged row whose date does not parse
    counts only when its key has no other: it updates nothing (the SQL rule), and an
    unseen key is inserted with it, its date NULL unless the dimension keeps dates as
    text.  Unchanged rows keep their old date.
    """
    dated = staging.select(*key, *attrs, staged_date, *tiebreak)
    # NULL is smallest, so a row whose date does not parse loses against any that has one
    latest = latest_per_key(dated.withColumn(PARSED, F.col(staged_date).try_cast("date")), key,
                            [PARSED, staged_date, *tiebreak])
    j = _join(dim, latest, key, "full_outer")
    in_d, in_s = F.col(IN_D).isNotNull(), F.col(IN_S).isNotNull()
    newer = F.coalesce(F.col(S + PARSED) > F.col(dim_date).try_cast("date"), F.lit(False))
    changed = any_changed([(F.col(a), F.col(S + a)) for a in attrs], strict_sql)
    update = in_d & in_s & newer & changed
    out = []
    for c in dim.columns:
        if c in key:
            out.append(F.when(in_d, F.col(c)).otherwise(F.col(S + c)).alias(c))
        elif c in attrs:
            out.append(F.when(update | ~in_d, F.col(S + c)).otherwise(F.col(c)).alias(c))
        elif c == dim_date:
            out.append(F.when(update | ~in_d, F.col(S + staged_date).try_cast(dim.schema[c].dataType))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(in_d, F.col(c)).alias(c))
    return j.select(*out)


def scd2_apply(dim: DataFrame, staging: DataFrame, key: Sequence[str], attrs: Sequence[str], *,
               effective: str = "last_updated", start: str = "start_date", end: str = "end_date",
               current: str = "is_current", open_end=None, tiebreak: Sequence[str] = (),
               guard_newer: bool = True, strict_sql: bool = False,
               surrogate: str | None = None) -> DataFrame:
    """Type 2 (M9/M10): close changed current rows and add a new open version; add new keys.

    One pass: history rows pass through; current rows are full-outer-joined with the
    latest staged row per key and each joined row emits 1 or 2 output rows
    (kept, or closed + new) through ``explode``.  ``open_end`` is the end value of an
    open row (NULL, or a sentinel such as 2999-12-31).  ``guard_newer`` ignores staged
    rows not newer than the open row's start (re-loading an old file closes nothing).
    With ``surrogate`` the new rows get dense keys after the current maximum.
    """
    latest = latest_per_key(staging.select(*key, *attrs, effective, *tiebreak), key,
                            [effective, *tiebreak])
    is_cur = F.coalesce(F.col(current).cast("boolean"), F.lit(False))
    history = dim.filter(~is_cur)
    cur = dim.filter(is_cur)
    j = _join(cur, latest, key, "full_outer")
    in_d, in_s = F.col(IN_D).isNotNull(), F.col(IN_S).isNotNull()
    eff = F.col(S + effective).cast(dim.schema[start].dataType)
    changed = any_changed([(F.col(a), F.col(S + a)) for a in attrs], strict_sql)
    if guard_newer:
        changed = changed & F.coalesce(eff > F.col(start), F.lit(False))
    close = in_d & in_s & changed
    add = (in_s & ~in_d) | close
    cur_type = dim.schema[current].dataType
    end_type = dim.schema[end].dataType
    open_end_col = F.lit(open_end).cast(end_type)

    def row(kind: str) -> Column:
        fields = []
        for c in dim.columns:
            if c == surrogate:
                v = F.col(c) if kind != "new" else F.lit(None).cast(dim.schema[c].dataType)
            elif c in key:
                v = F.when(in_d, F.col(c)).otherwise(F.col(S + c)) if kind == "new" else F.col(c)
            elif c in attrs:
                v = F.col(S + c) if kind == "new" else F.col(c)
            elif c == start:
                v = eff if kind == "new" else F.col(c)
            elif c == end:
                v = {"keep": F.col(c), "closed": eff.cast(end_type), "new": open_end_col}[kind]
            elif c == current:
                v = F.lit(kind != "closed").cast(cur_type) if kind != "keep" else F.col(c)
            else:
                v = F.col(c) if kind != "new" else F.lit(None).cast(dim.schema[c].dataType)
            fields.append(v.alias(c))
        fields.append(F.lit(kind == "new").alias("__new"))
        return F.struct(*fields)

    versions = F.array(
        F.when(in_d & ~close, row("keep")),
        F.when(close, row("closed")),
        F.when(add, row("new")),
    )
    emitted = (j.select(F.explode(F.filter(versions, lambda x: x.isNotNull())).alias("r"))
               .select("r.*"))
    if surrogate is None:
        return history.unionByName(emitted.drop("__new"))
    emitted = reliable_checkpoint(emitted)     # read for the old rows and for numbering the new ones
    old = emitted.filter(~F.col("__new")).drop("__new")
    new = assign_surrogate_keys(emitted.filter(F.col("__new")).drop("__new", surrogate),
                                [*key], "__sk", start_after=max_key(dim, surrogate))
    new = new.withColumn(surrogate, F.col("__sk").cast(dim.schema[surrogate].dataType)).drop("__sk")
    return history.unionByName(old).unionByName(new.select(*dim.columns))


def scd3_apply(dim: DataFrame, changes: DataFrame, key: Sequence[str], attr: str, *,
               previous: str, valid_from: str, effective: str, tiebreak: Sequence[str] = (),
               insert_new: bool = False, strict_sql: bool = False) -> DataFrame:
    """Type 3 (M11): on change, shift the current value to ``previous`` and set ``valid_from``.

    Keys only in ``changes`` are ignored (an UPDATE) unless ``insert_new``.
    """
    latest = latest_per_key(changes.select(*key, attr, effective, *tiebreak), key, [effective, *tiebreak])
    j = _join(dim, latest, key, "full_outer" if insert_new else "left")
    in_d, in_s = F.col(IN_D).isNotNull(), F.col(IN_S).isNotNull()
    changed = in_d & in_s & any_changed([(F.col(attr), F.col(S + attr))], strict_sql)
    new = in_s & ~in_d
    out = []
    for c in dim.columns:
        if c in key:
            v = F.when(in_d, F.col(c)).otherwise(F.col(S + c))
        elif c == attr:
            v = F.when(changed | new, F.col(S + attr)).otherwise(F.col(c))
        elif c == previous:
            v = F.when(changed, F.col(attr).cast(dim.schema[c].dataType)).when(new, F.lit(None)).otherwise(F.col(c))
        elif c == valid_from:
            v = F.when(changed | new, F.col(S + effective).cast(dim.schema[c].dataType)).otherwise(F.col(c))
        else:
            v = F.when(in_d, F.col(c))
        out.append(v.cast(dim.schema[c].dataType).alias(c))
    return j.select(*out)


# ---------------------------------------------------------------- replay of several drops

def state_changes(current: DataFrame, staging: DataFrame, key: Sequence[str], attrs: Sequence[str], *,
                  effective: str, drop: str, cur_start: str | None, tiebreak: Sequence[str] = (),
                  guard_newer: bool = True, strict_sql: bool = False) -> DataFrame:
    """The staged rows that change a key's state when drops are applied one after another.

    Each drop is first reduced to its latest row per key (as each per-file load does), by
    partial aggregation, so a key costs at most one row per drop however hot it is.  Per key,
    the drops' rows are folded in the order of the drops: a row changes the state when the
    key is new, or when it differs from the running state and (``guard_newer``) is newer
    than the date the running state got last.  Drops whose date is NULL or older change nothing.

    Output: key, ``__changes`` (array of structs of ``effective`` and the attributes, in the
    order applied), ``__known`` (the key was in ``current``).
    """
    dated = staging.withColumn(PARSED, F.col(effective).try_cast("date"))
    latest = latest_per_key(dated.select(*key, *attrs, effective, PARSED, drop, *tiebreak), [*key, drop],
                            [PARSED, effective, *tiebreak])
    state = lambda at, values: F.struct(at.alias("at"), *(v.alias(f"a{i}") for i, v in enumerate(values)))
    rows = latest.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(
        F.col(drop).alias("drop"), F.col(PARSED).alias("at"), F.col(effective).alias("raw"), *(F.col(c).alias(f"a{i}") for i, c in enumerate(attrs))))).alias("__rows"))
    start = F.col(cur_start).try_cast("date") if cur_start else F.lit(None).cast("date")
    cur = current.select(*key, state(start, [F.col(c) for c in attrs]).alias("__state"))
    j = rows.join(cur, list(key), "left").withColumn("__known", F.col("__state").isNotNull())
    kind = j.schema["__rows"].dataType.simpleString()
    first = F.struct(F.col("__state").alias("now"), F.array().cast(kind).alias("out"))

    def step(acc: Column, row: Column) -> Column:
        now = acc["now"]
        differs = any_changed([(row[f"a{i}"], now[f"a{i}"]) for i in range(len(attrs))], strict_sql)
        if guard_newer:
            differs = differs & F.coalesce(row["at"] > now["at"], F.lit(False))
        change = now.isNull() | differs
        return F.struct(F.when(change, state(row["at"], [row[f"a{i}"] for i in range(len(attrs))])).otherwise(now).alias("now"),
                        F.when(change, F.concat(acc["out"], F.array(row))).otherwise(acc["out"]).alias("out"))

    changes = F.aggregate("__rows", first, step, lambda acc: acc["out"])
    return j.select(*key, "__known", changes.alias("__changes")).filter(F.size("__changes") > 0)


def scd2_replay(dim: DataFrame, staging: DataFrame, key: Sequence[str], attrs: Sequence[str], *,
                drop: str, effective: str = "last_updated", start: str = "start_date", end: str = "end_date",
                current: str = "is_current", open_end=None, tiebreak: Sequence[str] = (),
                guard_newer: bool = True, strict_sql: bool = False) -> DataFrame:
    """SCD type 2 over several dated drops at once, equal to loading them one by one in the
    order of ``drop``: every change becomes a version; each ends where the next one starts."""
    is_cur = F.coalesce(F.col(current).cast("boolean"), F.lit(False))
    history, cur = dim.filter(~is_cur), dim.filter(is_cur)
    chg = state_changes(cur, staging, key, attrs, effective=effective, drop=drop, cur_start=start,
                        tiebreak=tiebreak, guard_newer=guard_newer, strict_sql=strict_sql)
    chg = reliable_checkpoint(chg)      # read for the versions and for closing the open rows
    start_t, end_t, cur_t = dim.schema[start].dataType, dim.schema[end].dataType, dim.schema[current].dataType
    each = chg.select(*key, "__changes", F.posexplode("__changes").alias("__i", "__v"))
    nxt = F.get("__changes", F.col("__i") + 1)["raw"]
    versions = each.select(*key, *(F.col(f"__v.a{i}").alias(c) for i, c in enumerate(attrs)),
                           F.col("__v.raw").cast(start_t).alias(start),
                           F.coalesce(nxt.cast(end_t), F.lit(open_end).cast(end_t)).alias(end),
                           nxt.isNull().cast(cur_t).alias(current))
    first = chg.filter("__known").select(*key, F.col("__changes")[0]["raw"].alias("__first"))
    closed = cur.join(first, list(key), "left") \
        .withColumn(end, F.when(F.col("__first").isNull(), F.col(end)).otherwise(F.col("__first").cast(end_t))) \
        .withColumn(current, F.when(F.col("__first").isNull(), F.col(current)).otherwise(F.lit(False).cast(cur_t)))
    for c in (c for c in dim.columns if c not in (*key, *attrs, start, end, current)):
        versions = versions.withColumn(c, F.lit(None).cast(dim.schema[c].dataType))
    return history.unionByName(closed.select(*dim.columns)).unionByName(versions.select(*dim.columns))


def scd1_replay(dim: DataFrame, staging: DataFrame, key: Sequence[str], attrs: Sequence[str], *,
                drop: str, dim_date: str = "last_updated_date", staged_date: str = "file_date",
                tiebreak: Sequence[str] = (), strict_sql: bool = False) -> DataFrame:
    """SCD type 1 over several dated drops at once, equal to loading them one by one in the
    order of ``drop``: the last change wins and sets the date; drops that change nothing leave it."""
    chg = state_changes(dim, staging, key, attrs, effective=staged_date, drop=drop, cur_start=dim_date,
                        tiebreak=tiebreak, strict_sql=strict_sql)
    last = chg.select(*key, F.element_at("__changes", -1).alias("__v"))
    last = last.select(*key, *(F.col(f"__v.a{i}").alias(c) for i, c in enumerate(attrs)), F.col("__v.raw").alias(staged_date))
    j = _join(dim, last, key, "full_outer")
    in_d, in_s = F.col(IN_D).isNotNull(), F.col(IN_S).isNotNull()
    out = []
    for c in dim.columns:
        if c in key:
            v = F.when(in_d, F.col(c)).otherwise(F.col(S + c))
        elif c in attrs:
            v = F.when(in_s, F.col(S + c)).otherwise(F.col(c))
        elif c == dim_date:
            v = F.when(in_s, F.col(S + staged_date).try_cast(dim.schema[c].dataType)).otherwise(F.col(c))
        else:
            v = F.when(in_d, F.col(c))
        out.append(v.cast(dim.schema[c].dataType).alias(c))
    return j.select(*out)
