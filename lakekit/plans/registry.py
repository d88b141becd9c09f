"""Registry of named queries: key -> (spark, sf_dir) -> DataFrame, plus the oracle SQL text."""

from __future__ import annotations

import functools
from collections.abc import Callable

from lakekit.session import prepare

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is its DuckDB oracle (optional).

    The registered callable first prepares the session it is given (shared checkpoint
    folder, UTC session time zone) so it runs the same on any caller's session.
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their registrations run."""
    import importlib

    for mod in ("q_warehouse", "q_dimensions", "q_medallion", "q_timeseries", "q_views", "q_security", "q_reqlog", "q_storage", "q_windows", "q_streaming"):
        importlib.import_module(f"lakekit.plans.{mod}")
