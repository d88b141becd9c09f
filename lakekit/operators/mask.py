"""Masked extracts for a named principal (K1-K9).

These operators prepare *safe extracts*: a user of the Spark session can still read
the underlying files, so they are not an access boundary.  Every mask is a
built-in column expression applied in the last projection; NULL stays NULL.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the mask functions.
DEFAULT_TEXT = "xxxx"
EMAIL_TAIL = "XXX@XXX.com"
DEFAULT_DATE = dt.date(1900, 1, 1)
DEFAULT_TIMESTAMP = dt.datetime(1900, 1, 1)


@dataclass(frozen=True)
class Mask:
    kind: str                 # "default" | "email" | "partial" | "random"
    prefix: int = 0
    padding: str = ""
    suffix: int = 0
    low: int = 0
    high: int = 0
    length: int | None = None  # declared text length (VARCHAR(n)) for the default mask


def default() -> Mask:
    return Mask("default")


def email() -> Mask:
    return Mask("email")


def partial(prefix: int, padding: str, suffix: int) -> Mask:
    return Mask("partial", prefix=prefix, padding=padding, suffix=suffix)


def random(low: int, high: int) -> Mask:
    return Mask("random", low=low, high=high)


def mask_default(c: Column, dtype: T.DataType, length: int | None = None) -> Column:
    """Default mask by type: text 'xxxx' (fewer x for a shorter declared length), numbers 0,
    dates 1900-01-01, binary one zero byte, booleans false."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        n = len(DEFAULT_TEXT) if length is None else min(len(DEFAULT_TEXT), length)
        v = F.lit(DEFAULT_TEXT[:n])
    elif isinstance(dtype, T.NumericType):
        v = F.lit(0).cast(dtype)
    elif isinstance(dtype, T.DateType):
        v = F.lit(DEFAULT_DATE)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        v = F.lit(DEFAULT_TIMESTAMP).cast(dtype)
    elif isinstance(dtype, T.BinaryType):
        v = F.unhex(F.lit("00"))
    elif isinstance(dtype, T.BooleanType):
        v = F.lit(False)
    else:
        raise TypeError(f"no default mask for {dtype}")
    return F.when(c.isNotNull(), v.cast(dtype))


def mask_email(c: Column) -> Column:
    """First character, then ``XXX@XXX.com`` — also for text that is not an email."""
    return F.when(c.isNotNull(), F.concat(F.left(c, F.lit(1)), F.lit(EMAIL_TAIL)))


def mask_partial(c: Column, prefix: int, padding: str, suffix: int) -> Column:
    """Keep ``prefix`` leading and ``suffix`` trailing characters around ``padding``.

    Text not longer than prefix + suffix shows the padding only, so a short value is
    never exposed whole.
    """
    shown = F.concat(F.left(c, F.lit(prefix)), F.lit(padding), F.right(c, F.lit(suffix)))
    return F.when(c.isNull(), F.lit(None)).when(F.length(c) > prefix + suffix, shown).otherwise(F.lit(padding))


def mask_random(c: Column, low: int, high: int, row_key: Column, salt: str) -> Column:
    """A number in ``[low, high]`` keyed by a row key and a secret salt (repeatable per row,
    never derived from the masked value)."""
    span = high - low + 1
    v = F.lit(low) + F.pmod(F.xxhash64(row_key, F.lit(salt)), F.lit(span))
    return F.when(c.isNotNull(), v)


def resolve_column(df: DataFrame, name: str) -> str:
    """The frame's column that ``name`` means (backticks stripped, the session's case rule);
    raises when there is none or more than one."""
    if name.startswith("`") and name.endswith("`") and len(name) > 2:
        name = name[1:-1].replace("``", "`")
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    found = [c for c in df.columns if c == name or (not exact and c.lower() == name.lower())]
    if len(found) != 1:
        raise ValueError(f"{name!r} is {'no' if not found else 'more than one'} column of {df.columns}")
    return found[0]


@dataclass
class MaskPolicy:
    """Masks per column plus the principals allowed to see raw values (UNMASK)."""
    masks: dict[str, Mask] = field(default_factory=dict)
    unmasked: set[str] = field(default_factory=set)
    row_key: str | None = None
    salt: str = "lakekit"

    def add(self, column: str, mask: Mask) -> "MaskPolicy":        # ALTER COLUMN ADD MASKED
        self.masks[column] = mask
        return self

    def drop(self, column: str) -> "MaskPolicy":                   # ALTER COLUMN DROP MASKED
        self.masks.pop(column, None)
        return self

    def grant_unmask(self, principal: str) -> "MaskPolicy":
        self.unmasked.add(principal)
        return self

    def revoke_unmask(self, principal: str) -> "MaskPolicy":
        self.unmasked.discard(principal)
        return self

    def resolved(self, df: DataFrame) -> dict[str, Mask]:
        """Masks by the frame's own column names.  A mask on a column that the frame does not
        have raises: a misspelt policy must not leave a column open."""
        return {resolve_column(df, name): mask for name, mask in self.masks.items()}

    def column(self, df: DataFrame, name: str) -> Column:
        name = resolve_column(df, name)
        m = self.resolved(df)[name]
        c = df[f"`{name}`"]
        dtype = df.schema[name].dataType
        if m.kind == "default":
            out = mask_default(c, dtype, m.length)
        elif m.kind == "email":
            out = mask_email(c)
        elif m.kind == "partial":
            out = mask_partial(c, m.prefix, m.padding, m.suffix)
        elif m.kind == "random":
            if not self.row_key:
                raise ValueError("a random mask needs MaskPolicy.row_key")
            out = mask_random(c, m.low, m.high, df[f"`{resolve_column(df, self.row_key)}`"], self.salt)
        else:
            raise ValueError(f"unknown mask {m.kind}")
        return out.cast(dtype).alias(name)


def apply_masks(df: DataFrame, policy: MaskPolicy, principal: str) -> DataFrame:
    """The final projection: masked columns for everyone without UNMASK (K8)."""
    if principal in policy.unmasked:
        return df
    masked = policy.resolved(df)
    return df.select(*[policy.column(df, c) if c in masked else df[f"`{c}`"] for c in df.columns])


def masked_query(df: DataFrame, policy: MaskPolicy, principal: str, predicate: Column | None = None,
                 strict: bool = False) -> DataFrame:
    """Filter then mask (K9).  By default predicates see raw values, as in the warehouse —
    which lets a caller probe masked values by filtering; ``strict=True`` masks first so
    predicates only see what the principal sees."""
    if strict:
        out = apply_masks(df, policy, principal)
        return out.filter(predicate) if predicate is not None else out
    out = df.filter(predicate) if predicate is not None else df
    return apply_masks(out, policy, principal)
