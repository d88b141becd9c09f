"""Driver contract and the DuckDB oracle for every registered query on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests_oracle_support import compare_query

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Category", "CustomerName", "TotalSales"]
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 80


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_oracle(spark, key):
    msg = compare_query(spark, SF, key)
    assert msg is None, msg
