"""Run registered queries against their DuckDB oracle and compare the rows.

Usage: python -m tests.oracle_check [--exact] [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False  # set by --exact: compare doubles bit for bit


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {spark_cols} vs {duck_cols}"
    order = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    dorder = sorted(range(len(duck_cols)), key=lambda i: duck_cols[i])
    a = sorted((tuple(_norm(r[i]) for i in order) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in dorder) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first diff: spark={x} duck={y}"
    return None


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from lakekit.session import build_session

    global EXACT
    EXACT = "--exact" in argv
    argv = [a for a in argv if a != "--exact"]
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [k for k in argv if not k.startswith("/")]
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            rows = df.collect()
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if k not in sqls:
            print(f"ROWS {k}: {len(rows)} rows (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            cur = con.execute(sqls[k])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = compare(rows, cols, drows, dcols)
        if msg:
            bad += 1
            print(f"FAIL {k}: {msg}")
        else:
            print(f"OK   {k}: {len(rows)} rows {t1 - t0:.1f}s")
    print(f"{bad} failing")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
