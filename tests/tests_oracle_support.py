"""Shared DuckDB comparison used by the oracle tests: values and column types."""

import __spark_entry__ as entry
from oracle_check import compare, duck

_CONS = {}
_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                  "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
                  "float": "FLOAT"}


def _spark_type(t: str) -> str:
    return t.upper().replace(" ", "") if t.startswith("decimal") else _SPARK_TO_DUCK.get(t, t)


def _duck_type(t: str) -> str:
    return t.replace(" ", "") if t.startswith("DECIMAL") else t


def compare_query(spark, sf_dir, key):
    if sf_dir not in _CONS:
        _CONS[sf_dir] = duck(sf_dir)
    con = _CONS[sf_dir]
    df = entry.queries()[key](spark, sf_dir)
    rows, cols = df.collect(), df.columns
    sql = entry.oracle_sql().get(key)
    if sql is None:
        return None
    types = {r[0]: _duck_type(r[1]) for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    wrong = [(c, _spark_type(t), types.get(c)) for c, t in df.dtypes if _spark_type(t) != types.get(c)]
    if wrong:
        return f"column types differ: {wrong}"
    cur = con.execute(sql)
    return compare(rows, cols, cur.fetchall(), [d[0] for d in cur.description])
