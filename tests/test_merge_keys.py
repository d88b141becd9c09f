from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lk_helpers import rows
from lakekit.operators import keys as K
from lakekit.operators import merge as M

SCHEMA = "id int, name string, price decimal(10,2), created string"


def test_upsert_updates_inserts_and_keeps_null_payload(spark):
    t = spark.createDataFrame([(1, "a", Decimal("1.00"), "t0"), (2, "b", Decimal("2.00"), "t0")], SCHEMA)
    u = spark.createDataFrame([(2, None, Decimal("3.00"), "t1"), (3, "c", None, "t1")], SCHEMA)
    out = M.merge_upsert(t, u, ["id"], preserve=("created",))
    assert rows(out, "id") == [(1, "a", Decimal("1.00"), "t0"), (2, None, Decimal("3.00"), "t0"),
                               (3, "c", None, "t1")]


def test_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "a", Decimal("1.00"), "t0")], SCHEMA)
    u = spark.createDataFrame([(1, "x", Decimal("9.00"), "t1"), (5, "e", Decimal("5.00"), "t1")], SCHEMA)
    once = M.merge_upsert(t, u, ["id"])
    twice = M.merge_upsert(once, u, ["id"])
    assert rows(once) == rows(twice)


def test_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a", Decimal("1.00"), "t0")], SCHEMA)
    u = spark.createDataFrame([(1, "x", None, "t1"), (1, "y", None, "t1")], SCHEMA)
    with pytest.raises(ValueError):
        M.merge_upsert(t, u, ["id"])


def test_null_keys_match_only_when_null_safe(spark):
    t = spark.createDataFrame([(None, "a", None, "t0"), (1, "x", None, "t0")], SCHEMA)
    u = spark.createDataFrame([(None, "b", None, "t1")], SCHEMA)
    assert M.merge_insert_only(t, u, ["id"]).count() == 3   # SQL rule: NULL never matches
    assert M.merge_insert_only(t, u, ["id"], null_safe=True).count() == 2
    assert rows(M.merge_upsert(t, u, ["id"], null_safe=True)) == \
        [(1, "x", None, "t0"), (None, "b", None, "t1")]
    assert M.merge_upsert(t, u, ["id"]).count() == 3


def test_insert_only_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", None, "t0")], SCHEMA)
    u = spark.createDataFrame([(1, "zzz", None, "t1"), (2, "b", None, "t1")], SCHEMA)
    once = M.merge_insert_only(t, u, ["id"])
    assert rows(once, "id") == [(1, "a", None, "t0"), (2, "b", None, "t1")]
    assert rows(M.merge_insert_only(once, u, ["id"])) == rows(once)


def test_merge_columns(spark):
    t = spark.createDataFrame([(1, "a", Decimal("1.00"), "t0")], SCHEMA)
    u = spark.createDataFrame([(1, "x", Decimal("9.00"), "t1"), (2, "b", Decimal("2.00"), "t1")], SCHEMA)
    out = M.merge_columns(t, u, ["id"], update_set=["price"], insert_cols=["name"])
    assert rows(out, "id") == [(1, "a", Decimal("9.00"), "t0"), (2, "b", None, None)]


def test_update_where_reads_old_values(spark):
    df = spark.createDataFrame([(1, 10, 20), (2, 30, 40)], "id int, a int, b int")
    out = M.update_where(df, F.col("id") == 1, {"a": F.col("b"), "b": F.col("a")})
    assert rows(out, "id") == [(1, 20, 10), (2, 30, 40)]


def test_scd1_direct_overwrite_fixture(spark):
    dim = spark.createDataFrame([(1, "Laptop", Decimal("1200.00")), (2, "Headphones", Decimal("150.00"))],
                                "product_id int, product_name string, price decimal(10,2)")
    out = M.update_where(dim, "product_id = 1", {"price": F.lit(Decimal("1300.00"))})
    assert rows(out, "product_id") == [(1, "Laptop", Decimal("1300.00")), (2, "Headphones", Decimal("150.00"))]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_keys_equal_row_number(spark, parts):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v")).distinct()
    out = K.assign_surrogate_keys(df, ["k"], "sk", start_after=100, num_partitions=parts)
    got = rows(out.select("k", "sk"), "k")
    w = Window.orderBy("k")
    exp = rows(df.select("k", (F.row_number().over(w) + 100).cast("bigint").alias("sk")), "k")
    assert got == exp
    assert [r[1] for r in got] == list(range(101, 101 + len(got)))


def test_dense_keys_empty_and_max_key(spark):
    empty = spark.createDataFrame([], "k string")
    assert K.assign_surrogate_keys(empty, ["k"], "sk").count() == 0
    assert spark.range(1).select(K.max_key(spark.createDataFrame([], "id long"), "id")).first()[0] == 0


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 1, "a"), (1, "2024-01-02", 2, "b"), (1, "2024-01-02", 3, "c"),
                                (2, "2024-01-01", 4, "d")], "k int, d string, seq int, v string")
    out = K.latest_per_key(df, ["k"], ["d", "seq"])
    assert rows(out, "k") == [(1, "2024-01-02", 3, "c"), (2, "2024-01-01", 4, "d")]


def test_duplicate_keys_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(M.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


@pytest.mark.parametrize("seed", [7, 8])
@pytest.mark.parametrize("null_safe", [False, True])
def test_merges_on_random_inputs(spark, seed, null_safe):
    import random
    rnd = random.Random(seed)

    def frame(n, tag):
        keys = rnd.sample(range(60), n)
        data = [(None if rnd.random() < 0.1 else k, rnd.choice(["p", "q", None]), None, tag) for k in keys]
        # at most one NULL key per side keeps the update keys unique
        seen_null, out = False, []
        for r in data:
            if r[0] is None:
                if seen_null:
                    continue
                seen_null = True
            out.append(r)
        return spark.createDataFrame(out, SCHEMA)

    t, u = frame(40, "t"), frame(25, "u")
    old, new = ({r[0]: r for r in rows(d)} for d in (t, u))

    def hit(k):
        return k in old and (null_safe or k is not None)

    up = sorted([(k, new[k][1] if k in new and hit(k) else r[1], None, "t") for k, r in old.items()]
                + [r for k, r in new.items() if not hit(k)], key=str)
    ins = sorted([*old.values(), *(r for k, r in new.items() if not hit(k))], key=str)
    assert sorted(rows(M.merge_upsert(t, u, ["id"], null_safe=null_safe, preserve=("created",))), key=str) == up
    assert sorted(rows(M.merge_insert_only(t, u, ["id"], null_safe=null_safe)), key=str) == ins
    col = M.merge_columns(t, u, ["id"], update_set=["name"], insert_cols=["created"], null_safe=null_safe)
    assert col.count() == len(up)
    once = rows(M.merge_upsert(t, u, ["id"], null_safe=True))
    assert rows(M.merge_upsert(spark.createDataFrame(once, SCHEMA), u, ["id"], null_safe=True)) == once


def test_numbering_equals_row_number(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("v").alias("v"))
    start = K.max_key(spark.range(0, 41).withColumnRenamed("id", "sk"), "sk")      # lazy scalar: 40
    got = rows(K.assign_surrogate_keys(df, ["k"], "sk", start_after=start).select("k", "sk"), "k")
    assert got == [(k, 41 + i) for i, k in enumerate(sorted(i * 7919 % 5000 for i in range(3000)))]


def test_latest_per_key_carries_maps(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS o, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2, 'c', 3) UNION ALL SELECT 2, 1, NULL")
    assert {r.k: r.m for r in K.latest_per_key(df, ["k"], ["o"]).collect()} == {1: {"b": 2, "c": 3}, 2: None}
