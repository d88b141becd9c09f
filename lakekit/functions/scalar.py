"""Column-level helpers.  All are built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale of measures: doubles are summed as decimals with six places, so a sum does not depend
# on the order of rows.  ``quality.scale_violations`` lists values that have more places.
MONEY_SCALE = 6
MONEY = f"decimal(24,{MONEY_SCALE})"
MONEY_SUM = f"decimal(38,{MONEY_SCALE})"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_word(c, n: int, sep: str = " ") -> Column:
    """n-th (0-based) word of ``c``; NULL when there are fewer words (no ANSI error)."""
    return F.get(F.split(col_(c), sep), n)


def word_or_empty(c, n: int, sep: str = " ") -> Column:
    """n-th word, or '' when it is missing or empty."""
    w = split_word(c, n, sep)
    return F.when(w.isNull() | (w == ""), F.lit("")).otherwise(w)


def null_or_empty_default(c, default: str = "Unknown") -> Column:
    """Replace NULL or empty text by ``default``."""
    c = col_(c)
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def year_boundaries(start, end) -> Column:
    """Number of calendar-year boundaries crossed from ``start`` to ``end``.

    This is the warehouse ``DATEDIFF(year, a, b)`` rule: 2018-12-31 -> 2019-01-01 is 1.
    """
    return F.year(col_(end)) - F.year(col_(start))


def _as_date(v):
    if isinstance(v, str):
        return _dt.date.fromisoformat(v)
    return v


def year_range(c, year: int) -> Column:
    """``YEAR(c) = year`` written as a half-open range so Parquet statistics apply."""
    lo = _dt.date(year, 1, 1)
    hi = _dt.date(year + 1, 1, 1)
    c = col_(c)
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def before_date(c, day) -> Column:
    """Compare against a DATE literal (not a string), NULL -> False."""
    return F.coalesce(col_(c) < F.lit(_as_date(day)), F.lit(False))


def money(c) -> Column:
    return col_(c).cast(MONEY)


def exact_sum(c) -> Column:
    """Sum of a money column as an exact decimal (independent of partition order)."""
    return F.sum(money(c)).cast(MONEY_SUM)


def exact_avg(c) -> Column:
    """Average as double computed from an exact decimal sum and a count.

    Both Spark and SQL engines give identical bits for double(sum)/double(count),
    while a double running sum depends on the order rows arrive in.
    """
    return F.sum(money(c)).cast("double") / F.count(col_(c)).cast("double")


def interval(spec: str) -> Column:
    """Interval literal from a timespan literal: '30min', '1h', '1d', '7d', '10s'."""
    units = {"s": "seconds", "sec": "seconds", "min": "minutes", "m": "minutes", "h": "hours", "d": "days"}
    spec = spec.strip()
    num = "".join(ch for ch in spec if ch.isdigit())
    unit = spec[len(num):]
    return F.expr(f"INTERVAL {int(num)} {units[unit].upper()}")


def seconds_of(spec: str) -> int:
    mult = {"s": 1, "sec": 1, "min": 60, "m": 60, "h": 3600, "d": 86400}
    spec = spec.strip()
    num = "".join(ch for ch in spec if ch.isdigit())
    return int(num) * mult[spec[len(num):]]


def ago(c, spec: str, as_of) -> Column:
    """``c > ago(spec)`` with an explicit clock ``as_of`` (a Column or literal)."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return col_(c) > (as_of - interval(spec))


def distinct_from(a, b) -> Column:
    """NULL-safe inequality: ``NOT (a <=> b)``."""
    return ~col_(a).eqNullSafe(col_(b))


def any_changed(left_prefix_cols: list[tuple[Column, Column]], strict_sql: bool = False) -> Column:
    """True when any pair differs.  ``strict_sql`` keeps the SQL ``<>`` rule (NULL never differs)."""
    conds = []
    for a, b in left_prefix_cols:
        conds.append(F.coalesce(a != b, F.lit(False)) if strict_sql else distinct_from(a, b))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
