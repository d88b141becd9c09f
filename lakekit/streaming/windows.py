"""Tumbling, sliding and session windows (T1-T4), batch and streaming.

The reference computes these with Python loops over a dict in one process.  Here
they are shuffled window aggregations:

* tumbling uses ``F.window`` (epoch-aligned, also valid on a stream) or, for
  ``origin="first"`` (batch only), the same grid anchored at each key's first event;
* sliding aggregates events once into panes of gcd(size, step) and puts windows together
  from panes, so no event is multiplied before the shuffle;
* sessions are built in levels so no key — not even the single series with no key at
  all — is processed whole by one task: ``session_window`` runs per (key, time bucket),
  what it finds is stitched within blocks of buckets, and only the first and last
  session of each block meet in a window over the whole series.

Sums are decimals with ``MONEY_SCALE`` places; every event lands in exactly one tumbling window
(the reference drops events on the last boundary, X17 — ``reference_bounds`` keeps
its rule for comparison).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.scalar import MONEY, MONEY_SUM, seconds_of
from lakekit.session import reliable_checkpoint

US = 1_000_000


def _us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _ts(us: Column, like_ntz: bool) -> Column:
    t = F.timestamp_micros(us)
    return t.cast("timestamp_ntz") if like_ntz else t


def _is_ntz(df: DataFrame, ts: str) -> bool:
    return df.schema[ts].dataType.typeName() == "timestamp_ntz"


def _measures(value: str | None, with_sum: bool = True) -> list[Column]:
    out = [F.count(F.lit(1)).alias("n_events")]
    if value is not None and with_sum:
        out.append(F.sum(F.col(value).cast(MONEY)).cast(MONEY_SUM).alias("total_value"))
    return out


def _anchored(df: DataFrame, ts: str, keys: Sequence[str], origin: str) -> DataFrame:
    """Rows that have a time, with ``__origin``: where their series' grid starts, in
    microseconds: the epoch, or the first event of the key (NULL keys are one series); batch only."""
    df = df.filter(F.col(ts).isNotNull())
    if origin == "epoch":
        return df.withColumn("__origin", F.lit(0).cast("bigint"))
    if origin != "first":
        raise ValueError("origin must be 'epoch' or 'first'")
    if not keys:
        return df.withColumn("__origin", df.select(F.min(_us(F.col(ts)))).scalar())
    first = df.groupBy(*keys).agg(F.min(_us(F.col(ts))).alias("__origin"))
    return _with_series(df, first, keys)


def _with_series(df: DataFrame, series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the other columns of ``series``, one row per key (NULL keys meet)."""
    own = {k: f"__s_{k}" for k in keys}
    cond = F.lit(True)
    for k, mine in own.items():
        cond = cond & F.col(k).eqNullSafe(F.col(mine))
    return df.join(series.withColumnsRenamed(own), cond).drop(*own.values())


def tumbling(df: DataFrame, ts: str, size: str, value: str | None = None, keys: Sequence[str] = (),
             origin: str = "epoch", fill_empty: bool = False, reference_bounds: bool = False) -> DataFrame:
    """Non-overlapping windows ``[start, start + size)``; output keys, window_start,
    window_end, n_events (and total_value).  ``origin="first"`` starts each key's grid at its
    first event (batch only).  ``fill_empty`` emits windows without
    events (count 0, total 0) between each series' first and last window.  Rows without a
    time are in no window."""
    ntz = _is_ntz(df, ts)
    size_us = seconds_of(size) * US
    if origin == "epoch":
        grouped = df.groupBy(*keys, F.window(ts, f"{seconds_of(size)} seconds").alias("__w")).agg(*_measures(value))
        out = grouped.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                             *[c for c in grouped.columns if c in ("n_events", "total_value")])
    else:
        rows = _anchored(df, ts, keys, origin)
        start = F.col("__origin") + F.floor((_us(F.col(ts)) - F.col("__origin")) / F.lit(size_us)) * F.lit(size_us)
        grouped = rows.groupBy(*keys, start.alias("__s")).agg(*_measures(value))
        out = grouped.select(*keys, _ts(F.col("__s"), ntz).alias("window_start"),
                             _ts(F.col("__s") + F.lit(size_us), ntz).alias("window_end"),
                             *[c for c in grouped.columns if c in ("n_events", "total_value")])
    if fill_empty:
        out = _fill(out, keys, size_us, value is not None, ntz)
    if reference_bounds:
        # the reference loop stops at start < max(ts): a window starting at the last
        # event time is dropped
        last = df.select(F.max(F.col(ts))).scalar()
        out = out.filter(F.col("window_start") < last)
    return out


GRID_BLOCK = 1000


def _grid(span: DataFrame, keys: Sequence[str], step_us: int) -> DataFrame:
    """keys, __s: every ``step_us`` from ``__lo`` to ``__hi`` of each row of ``span``.

    Blocks of steps are dealt over the shuffle partitions first, so a long span is many
    tasks with short arrays instead of one array.
    """
    parts = int(span.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = F.lit(GRID_BLOCK * step_us)
    blocks = span.select(*keys, "__hi", F.explode(F.sequence("__lo", "__hi", width)).alias("__from"))
    blocks = blocks.repartition(parts, *keys, "__from")
    upto = F.least(F.col("__hi"), F.col("__from") + width - F.lit(step_us))
    return blocks.select(*keys, F.explode(F.sequence(F.col("__from"), upto, F.lit(step_us))).alias("__s"))


def _on_grid(grid: DataFrame, agg: DataFrame, keys: Sequence[str], size_us: int, has_sum: bool, ntz: bool) -> DataFrame:
    """The grid's windows with their aggregates, 0 where there are none (keys NULL-safe)."""
    own = {c: f"__g_{c}" for c in [*keys, "window_start"]}
    g = grid.select(*[F.col(c).alias(own[c]) for c in keys], _ts(F.col("__s"), ntz).alias(own["window_start"]),
                    _ts(F.col("__s") + F.lit(size_us), ntz).alias("__g_end"))
    cond = F.lit(True)
    for c, mine in own.items():
        cond = cond & g[mine].eqNullSafe(agg[c])
    filled = g.join(agg, cond, "left")
    cols = [*[F.col(mine).alias(c) for c, mine in own.items()], F.col("__g_end").alias("window_end"),
            F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events")]
    if has_sum:
        cols.append(F.coalesce("total_value", F.lit(0).cast(MONEY_SUM)).cast(MONEY_SUM).alias("total_value"))
    return filled.select(*cols)


def _fill(agg: DataFrame, keys: Sequence[str], step_us: int, has_sum: bool, ntz: bool,
          size_us: int | None = None) -> DataFrame:
    """Windows without events: per series, the grid from its first to its last window
    (rows grow with the time span, not with the data)."""
    span = agg.groupBy(*keys).agg(F.min(_us(F.col("window_start"))).alias("__lo"),
                                  F.max(_us(F.col("window_start"))).alias("__hi")).filter(F.col("__lo").isNotNull())
    return _on_grid(_grid(span, keys, step_us), agg, keys, size_us or step_us, has_sum, ntz)


def sliding(df: DataFrame, ts: str, size: str, step: str, value: str | None = None, keys: Sequence[str] = (),
            origin: str = "epoch", complete_only: bool = False, fill_empty: bool = False,
            reference_bounds: bool = False) -> DataFrame:
    """Overlapping windows of ``size`` every ``step``; each event is counted in every window
    containing it.  ``origin="first"`` starts each key's windows at its first event.  A table is
    aggregated into panes first; a stream, which can hold one aggregate, by ``F.window``.  ``complete_only`` keeps windows lying within [first event, last event].

    ``fill_empty`` also emits windows without events (count 0, total 0) on the grid from
    the first to the last window.  ``reference_bounds`` keeps the reference loop's rule:
    windows start at the first event and stop before ``start + size`` reaches the last
    event (single series, ``origin="first"``)."""
    if reference_bounds:
        return _sliding_reference(df, ts, size, step, value)
    ntz = _is_ntz(df, ts)
    size_s, step_s = seconds_of(size), seconds_of(step)
    if df.isStreaming:
        if origin != "epoch":
            raise ValueError("a stream's windows are aligned to the epoch")
        w = F.window(ts, f"{size_s} seconds", f"{step_s} seconds")
        grouped = df.groupBy(*keys, w.alias("__w")).agg(*_measures(value))
        out = grouped.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                             *[c for c in grouped.columns if c in ("n_events", "total_value")])
    else:
        out = _from_panes(_anchored(df, ts, keys, origin), ts, size_s, step_s, value, keys, ntz, from_origin=origin == "first")
    if fill_empty:
        out = _fill(out, keys, step_s * US, value is not None, ntz, size_us=size_s * US)
    if complete_only:
        bounds = df.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
        out = _within(out, bounds, keys)
    return out


def _from_panes(rows: DataFrame, ts: str, size_s: int, step_s: int, value: str | None, keys: Sequence[str], ntz: bool, from_origin: bool) -> DataFrame:
    """Sliding windows put together from panes as wide as size and step allow: an event is
    counted once, in its pane; only panes are repeated for the windows they lie in."""
    pane_s = math.gcd(size_s, step_s)
    pane_us, in_step, in_size = pane_s * US, step_s // pane_s, size_s // pane_s
    pane = F.floor((_us(F.col(ts)) - F.col("__origin")) / F.lit(pane_us))
    panes = rows.groupBy(*keys, "__origin", pane.alias("__pane")).agg(*_measures(value))
    low, high = F.ceil((F.col("__pane") - F.lit(in_size - 1)) / F.lit(in_step)), F.floor(F.col("__pane") / F.lit(in_step))
    if from_origin:
        low = F.greatest(low, F.lit(0).cast("bigint"))     # no window starts before the first event
    spread = panes.withColumns({"__low": low, "__high": high}).filter("__low <= __high")     # steps wider than the size leave gaps
    spread = spread.withColumn("__k", F.explode(F.sequence("__low", "__high")))
    sums = [F.sum("n_events").alias("n_events")] + ([F.sum("total_value").cast(MONEY_SUM).alias("total_value")] if value else [])
    grouped = spread.groupBy(*keys, "__origin", "__k").agg(*sums)
    start = F.col("__origin") + F.col("__k") * F.lit(step_s * US)
    return grouped.select(*keys, _ts(start, ntz).alias("window_start"), _ts(start + F.lit(size_s * US), ntz).alias("window_end"),
                          "n_events", *(["total_value"] if value else []))


def _sliding_reference(df: DataFrame, ts: str, size: str, step: str, value: str | None) -> DataFrame:
    """The reference's sliding loop, distributed: grid ``first + k*step`` while
    ``start < last - size``; every grid window is emitted, empty ones with 0."""
    ntz = _is_ntz(df, ts)
    size_us, step_us = seconds_of(size) * US, seconds_of(step) * US
    counted = sliding(df, ts, size, step, value, origin="first")
    # the last start is the largest step below last - size
    lo, top = F.min(_us(F.col(ts))), F.max(_us(F.col(ts))) - F.lit(size_us)
    span = df.agg(lo.alias("__lo"), top.alias("__top")).filter(F.col("__lo") < F.col("__top"))
    span = span.select("__lo", (F.col("__lo") + F.floor((F.col("__top") - 1 - F.col("__lo")) / F.lit(step_us)) * F.lit(step_us)).alias("__hi"))
    return _on_grid(_grid(span, [], step_us), counted, [], size_us, value is not None, ntz)


def _within(out: DataFrame, bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        j = _with_series(out, bounds, keys)
    else:
        lo = bounds.select("__lo").scalar()
        hi = bounds.select("__hi").scalar()
        j = out.withColumn("__lo", lo).withColumn("__hi", hi)
    return j.filter((F.col("window_start") >= F.col("__lo")) & (F.col("window_end") <= F.col("__hi"))) \
        .drop("__lo", "__hi")


BUCKET_GAPS = 60        # width of a level-1 bucket, in gaps
BLOCK_BUCKETS = 1024    # buckets stitched together in one level-2 group


def _partial_sessions(df: DataFrame, ts: str, gap: str, value: str | None, keys: Sequence[str], bucket: str | None) -> DataFrame:
    """Level 1: sessions inside each (key, bucket): keys, __b, p_start, p_last, p_n (p_sum).

    The bucket's width is fixed (``BUCKET_GAPS`` gaps, or as given), whatever times occur,
    so a hot key is spread over many tasks.  Written once: all later levels read it.
    """
    width = F.lit((seconds_of(bucket) if bucket else BUCKET_GAPS * seconds_of(gap)) * US)
    cols = [*keys, F.col(ts).alias("__ts")] + ([F.col(value).alias("__v")] if value else [])
    ev = df.select(*cols).filter(F.col("__ts").isNotNull()).withColumn("__b", F.floor(_us(F.col("__ts")) / width))
    aggs = [F.min("__ts").alias("p_start"), F.max("__ts").alias("p_last"), F.count(F.lit(1)).alias("p_n")]
    if value:
        aggs.append(F.sum(F.col("__v").cast(MONEY)).cast(MONEY_SUM).alias("p_sum"))
    part = ev.groupBy(*keys, "__b", F.session_window("__ts", f"{seconds_of(gap)} seconds").alias("__sw")).agg(*aggs)
    return reliable_checkpoint(part.drop("__sw"))


def _stitched(parts: DataFrame, group: Sequence[str], gap_us: int, name: str) -> DataFrame:
    """``parts`` with ``name``: the start of the session each belongs to within its group."""
    w = Window.partitionBy(*group).orderBy("p_start") if group else Window.orderBy("p_start")
    apart = F.coalesce(_us(F.col("p_start")) - _us(F.lag("p_last").over(w)) > F.lit(gap_us), F.lit(True))
    starts = parts.withColumn("__new", F.when(apart, F.col("p_start")))
    return starts.withColumn(name, F.max("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def _merge_parts(parts: DataFrame, by: Sequence[str], value: bool) -> DataFrame:
    aggs = [F.min("p_start").alias("p_start"), F.max("p_last").alias("p_last"), F.sum("p_n").alias("p_n")]
    if value:
        aggs.append(F.sum("p_sum").cast(MONEY_SUM).alias("p_sum"))
    return parts.groupBy(*by).agg(*aggs)


def _blocks(part: DataFrame, keys: Sequence[str], gap_us: int, value: bool) -> tuple[DataFrame, DataFrame]:
    """Level 2: partial sessions with their block and the session's start in it (``__sid``),
    and one row per session of a block, ``__edge`` marking those that may go on beyond it."""
    tagged = _stitched(part.withColumn("__blk", F.floor(F.col("__b") / F.lit(BLOCK_BUCKETS))), [*keys, "__blk"], gap_us, "__sid")
    merged = _merge_parts(tagged, [*keys, "__blk", "__sid"], value)
    w = Window.partitionBy(*keys, "__blk")
    edge = (F.col("p_start") == F.min("p_start").over(w)) | (F.col("p_start") == F.max("p_start").over(w))
    return tagged, merged.withColumn("__edge", edge)


def sessions(df: DataFrame, ts: str, gap: str, value: str | None = None, keys: Sequence[str] = (),
             bucket: str | None = None) -> DataFrame:
    """Sessions: a new session starts when the time since the previous event of the same
    key is strictly greater than ``gap`` (events exactly ``gap`` apart stay together).

    Output: keys, session_start, session_end (= last event + gap), n_events, total_value.
    Rows with a NULL key are one series; rows without a time are in no session.

    Level 2 groups hold at most ``BLOCK_BUCKETS`` buckets of at most ``BUCKET_GAPS``
    sessions; level 3 holds two rows per block of a series.  ``bucket`` sets the width of
    level-1 buckets (a timespan); it may be narrower than the gap.
    """
    ntz = _is_ntz(df, ts)
    gap_us = seconds_of(gap) * US
    part = _partial_sessions(df, ts, gap, value, keys, bucket)
    _, merged = _blocks(part, keys, gap_us, value is not None)
    inner = merged.filter(~F.col("__edge")).drop("__edge", "__blk", "__sid")
    ends = _stitched(merged.filter("__edge").drop("__edge", "__sid"), keys, gap_us, "__sid")
    done = inner.unionByName(_merge_parts(ends, [*keys, "__sid"], value is not None).drop("__sid"))
    end = _ts(_us(F.col("p_last")) + F.lit(gap_us), ntz)
    out = [*keys, F.col("p_start").alias("session_start"), end.alias("session_end"), F.col("p_n").cast("bigint").alias("n_events")]
    return done.select(*out, *([F.col("p_sum").alias("total_value")] if value else []))


def session_values(df: DataFrame, ts: str, value: str, gap: str, keys: Sequence[str] = (), bucket: str | None = None) -> DataFrame:
    """The values of each session in time order, as rows: keys, session_start, position
    (from 1), value.  Events of the same time are ordered by value.

    A session of any length stays rows: positions are counted within its partial sessions
    and offset by those before, so no session is gathered in one array or task.
    """
    gap_us = seconds_of(gap) * US
    part = _partial_sessions(df, ts, gap, None, keys, bucket)
    tagged, merged = _blocks(part, keys, gap_us, False)
    ends = _stitched(merged.filter("__edge").select(*keys, "__blk", F.col("__sid").alias("__of"), "p_start", "p_last"), keys, gap_us, "__start")
    ends = ends.select(*[F.col(k).alias(f"__e_{k}") for k in keys], F.col("__blk").alias("__e_blk"), F.col("__of").alias("__e_sid"), "__start")
    cond = (F.col("__blk") == F.col("__e_blk")) & (F.col("__sid") == F.col("__e_sid"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__e_{k}"))
    known = tagged.join(ends, cond, "left").withColumn("session_start", F.coalesce("__start", "__sid"))
    before = Window.partitionBy(*keys, "session_start").orderBy("p_start").rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("__off", F.coalesce(F.sum("p_n").over(before), F.lit(0)))
    known = known.select(*[F.col(k).alias(f"__p_{k}") for k in keys], F.col("__b").alias("__p_b"), "p_start", "p_last", "session_start", "__off")
    width = F.lit((seconds_of(bucket) if bucket else BUCKET_GAPS * seconds_of(gap)) * US)
    ev = df.select(*keys, F.col(ts).alias("__ts"), F.col(value).alias("value")).filter(F.col("__ts").isNotNull())
    ev = ev.withColumn("__b", F.floor(_us(F.col("__ts")) / width))
    cond = (F.col("__b") == F.col("__p_b")) & F.col("__ts").between(F.col("p_start"), F.col("p_last"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__p_{k}"))
    within = Window.partitionBy(*keys, "__b", "p_start").orderBy("__ts", "value")
    return (ev.join(known, cond).withColumn("position", (F.col("__off") + F.row_number().over(within)).cast("bigint"))
            .select(*keys, "session_start", "position", "value"))
