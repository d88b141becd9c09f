"""Object, row and column filters for a named principal.

Like the masks, these build safe extracts; they are not an access boundary.
Order of application: table check -> row filter -> column check -> mask.
A denied principal gets an error; a principal without a mapping row gets no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.mask import MaskPolicy, apply_masks, resolve_column


class AccessDenied(PermissionError):
    pass


@dataclass
class AccessPolicy:
    table_grants: dict[str, set[str]] = field(default_factory=dict)    # table -> principals
    table_denies: dict[str, set[str]] = field(default_factory=dict)
    column_grants: dict[tuple[str, str], set[str]] = field(default_factory=dict)  # (table, principal) -> cols
    column_denies: dict[tuple[str, str], set[str]] = field(default_factory=dict)

    def grant_table(self, table: str, principal: str) -> "AccessPolicy":
        self.table_grants.setdefault(table, set()).add(principal)
        return self

    def deny_table(self, table: str, principal: str) -> "AccessPolicy":
        self.table_denies.setdefault(table, set()).add(principal)
        return self

    def grant_columns(self, table: str, principal: str, columns: Sequence[str]) -> "AccessPolicy":
        self.column_grants.setdefault((table, principal), set()).update(columns)
        return self.grant_table(table, principal)

    def deny_columns(self, table: str, principal: str, columns: Sequence[str]) -> "AccessPolicy":
        self.column_denies.setdefault((table, principal), set()).update(columns)
        return self

    def check_table(self, table: str, principal: str) -> None:
        if principal in self.table_denies.get(table, set()):
            raise AccessDenied(f"SELECT permission denied on {table} for {principal}")
        if principal not in self.table_grants.get(table, set()):
            raise AccessDenied(f"{principal} has no SELECT grant on {table}")


def ols_load(policy: AccessPolicy, principal: str, table: str, loader) -> DataFrame:
    """Table check before the read (K14): ``loader()`` runs only when the read is allowed."""
    policy.check_table(table, principal)
    return loader()


def rls_filter_owner(df: DataFrame, owner_col: str, principal: str) -> DataFrame:
    """Rows whose owner column equals the principal."""
    return df.filter(F.col(owner_col) == F.lit(principal))


def rls_filter_mapping(df: DataFrame, col: str, mapping: DataFrame, principal: str, *,
                       user_col: str = "user_email", value_col: str = "region") -> DataFrame:
    """``@value IN (SELECT value FROM mapping WHERE user = principal)`` as a semi join.

    Only the principal's mapping rows are kept; Spark broadcasts them when they are small.
    """
    allowed = (mapping.filter(F.col(user_col) == F.lit(principal))
               .select(F.col(value_col).alias("__allowed")).distinct())
    return df.join(allowed, df[col] == allowed["__allowed"], "left_semi")


def cls_select(df: DataFrame, policy: AccessPolicy, table: str, principal: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Column check (K12, K13): asking for a denied or ungranted column raises, like a
    ``SELECT *`` over a denied column; asking only for allowed columns succeeds.

    Names are resolved against the frame with the session's case rule before they are
    compared; ``*``, expressions and nested paths are refused.  ``columns=None`` asks for all."""
    try:
        wanted = [resolve_column(df, c) for c in (columns if columns is not None else df.columns)]
    except (ValueError, AttributeError) as e:
        raise AccessDenied(f"only plain column names of {table} can be selected: {e}") from e
    fold = (lambda c: c) if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    names = lambda cols: {fold(c.strip("`")) for c in cols}
    granted = policy.column_grants.get((table, principal))
    deny = names(policy.column_denies.get((table, principal), set()))
    bad = [c for c in wanted if fold(c) in deny or (granted is not None and fold(c) not in names(granted))]
    if bad:
        raise AccessDenied(f"SELECT permission denied on column(s) {bad} of {table} for {principal}")
    return df.select(*(df[f"`{c}`"] for c in wanted))


def secure_read(df: DataFrame, principal: str, table: str, *, access: AccessPolicy,
                row_filter=None, columns: Sequence[str] | None = None,
                masks: MaskPolicy | None = None) -> DataFrame:
    """Table check -> row filter -> column check -> mask, in that order."""
    access.check_table(table, principal)
    out = row_filter(df) if row_filter is not None else df
    out = cls_select(out, access, table, principal, columns)
    return apply_masks(out, masks, principal) if masks is not None else out
