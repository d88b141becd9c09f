"""Large tables are dealt out by their number of rows before a join or window sorts them."""
import contextlib
import datetime as dt
import io
import os

import pytest

from lakekit import session
from lakekit.plans import fixtures as fx
from lakekit.plans import medallion as md
from lakekit.plans import q_medallion as qm

SMOKE = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_sales_lines_are_dealt_by_their_number(spark, monkeypatch):
    want = rows_of(fx.sales(spark, SMOKE))
    monkeypatch.setattr(session, "SORT_ROWS", 250)
    monkeypatch.setattr(fx, "DIMENSION_ROWS", 10)
    tasks = -(-len(want) // 250)
    few = fx.sales(spark, SMOKE)
    plan = plan_of(few)
    for key in ("l_orderkey", "o_orderkey", "o_custkey", "c_custkey", "l_partkey", "p_partkey"):
        assert any(key in line and f", {tasks}), REPARTITION_BY_NUM" in line for line in plan.splitlines()), key
    assert rows_of(few) == want


def test_few_lines_are_left_to_spark(spark):
    assert "REPARTITION_BY_NUM" not in plan_of(fx.sales(spark, SMOKE))


def test_silver_merge_is_dealt_by_its_rows(spark, monkeypatch):
    want = rows_of(qm.q_bronze_to_silver(spark, SMOKE))
    monkeypatch.setattr(session, "SORT_ROWS", 250)
    silver = qm.q_bronze_to_silver(spark, SMOKE)
    assert len(silver.inputFiles()) > spark.sparkContext.defaultParallelism
    assert rows_of(silver) == want


def test_parts_of_the_orders_are_all_sales_lines(spark):
    parts = [rows_of(fx.sales(spark, SMOKE, (k, 3))) for k in range(3)]
    assert all(parts) and sorted(sum(parts, [])) == rows_of(fx.sales(spark, SMOKE))


def test_silver_job_leaves_only_its_snapshots(spark, monkeypatch):
    """Large drops come as compressed files, large merges in slices; shuffle files and the parsed rows go when they were read."""
    from lakekit.sources.snapshots import SnapshotTable

    want = rows_of(qm.q_bronze_to_silver(spark, SMOKE))
    monkeypatch.setattr(session, "SORT_ROWS", 250)
    monkeypatch.setattr(qm, "_INPUTS", {})
    writes = []

    def write(self, df, *options, of=SnapshotTable.write):
        writes.append((1 if hasattr(df, "columns") else len(df), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")))
        return of(self, df, *options)

    monkeypatch.setattr(SnapshotTable, "write", write)
    top = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    kept = lambda: {os.path.join(d, x) for d, names, _ in os.walk(top) for x in names if x.startswith(("rdd-", "silver-updates"))}
    before = kept()
    silver = qm.q_bronze_to_silver(spark, SMOKE)
    assert writes == [(1, "true"), (md.MERGE_SLICES, "true")]
    assert kept() <= before
    drop = qm._INPUTS[(spark.sparkContext.applicationId, SMOKE, "bronze")]
    assert all(f.endswith(".csv.gz") for f in spark.read.csv(f"{drop}/drop=*").inputFiles())
    assert rows_of(silver) == want


def test_a_large_merge_keeps_lines_without_a_key(spark, monkeypatch, tmp_path):
    """Slices are dealt by the keys: lines without one, old and new, are in one of them."""
    from lakekit.sources.snapshots import SnapshotTable

    head = "SalesOrderNumber,SalesOrderLineNumber,OrderDate,CustomerName,Email,Item,Quantity,UnitPrice,Tax\n"
    drop = lambda name, rows: (tmp_path / name).write_text(head + "".join(f"{k},{n},2024-01-0{day},x,y,z,1,2,3\n" for k, n, day in rows))
    drop("a.csv", [(f"SO{k}", 1, 1) for k in range(30)] + [("", 1, 1)])
    drop("b.csv", [(f"SO{k}", 1, 2) for k in range(20, 50)] + [("SO7", "", 2)])
    monkeypatch.setattr(session, "SORT_ROWS", 1)
    silver = SnapshotTable(spark, str(tmp_path / "silver"))
    for name in ("a.csv", "b.csv"):
        md.bronze_to_silver(spark, str(tmp_path / name), silver, flag_before=dt.date(2020, 1, 1), as_of=dt.datetime(2024, 2, 1 + (name == "b.csv")))
    got = sorted((r.SalesOrderNumber or "", r.SalesOrderLineNumber or 0, r.OrderDate.day, r.CreatedTS.day, r.ModifiedTS.day) for r in silver.read().collect())
    assert got == sorted([(f"SO{k}", 1, 1 + (k >= 20), 1 + (k >= 30), 1 + (k >= 20)) for k in range(50)] + [("", 1, 1, 1, 1), ("SO7", 0, 2, 2, 2)])


def test_parts_of_a_snapshot_count_when_all_are_there(spark, tmp_path):
    from pyspark.sql import functions as F

    from lakekit.sources.snapshots import SnapshotTable

    t = SnapshotTable(spark, str(tmp_path / "t"))
    first, second = spark.range(3), spark.range(3, 5)
    with pytest.raises(Exception, match="broken"):
        t.write([first, second.withColumn("id", F.raise_error(F.lit("broken")).cast("long"))])
    assert t.snapshots() == []
    t.write([first, second])
    assert len(t.snapshots()) == 1 and sorted(r.id for r in t.read().collect()) == [0, 1, 2, 3, 4]
