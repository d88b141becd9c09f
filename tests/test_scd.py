from decimal import Decimal

from pyspark.sql import functions as F

from lk_helpers import D, rows
from lakekit.operators import scd

OPEN = D(2999, 12, 31)
DIM2 = "surrogate_key int, product_id int, product_name string, price decimal(10,2), " \
       "record_start_date date, record_end_date date, is_current int"


def test_scd2_sentinel_fixture(spark):
    dim = spark.createDataFrame([(101, 1, "Laptop", Decimal("1200.00"), D(2025, 1, 1), OPEN, 1),
                                 (102, 2, "Headphones", Decimal("150.00"), D(2025, 1, 1), OPEN, 1)], DIM2)
    stg = spark.createDataFrame([(1, "Laptop", Decimal("1300.00"), D(2025, 6, 1))],
                                "product_id int, product_name string, price decimal(10,2), eff date")
    out = scd.scd2_apply(dim, stg, ["product_id"], ["product_name", "price"], effective="eff",
                         start="record_start_date", end="record_end_date", open_end=OPEN,
                         surrogate="surrogate_key")
    assert rows(out, "surrogate_key") == [
        (101, 1, "Laptop", Decimal("1200.00"), D(2025, 1, 1), D(2025, 6, 1), 0),
        (102, 2, "Headphones", Decimal("150.00"), D(2025, 1, 1), OPEN, 1),
        (103, 1, "Laptop", Decimal("1300.00"), D(2025, 6, 1), OPEN, 1),
    ]


DIM2N = "customer_id int, name string, address string, start_date date, end_date date, is_current boolean"
STG2 = "customer_id int, name string, address string, last_updated date, seq int"


def _dim2(spark):
    return spark.createDataFrame([
        (1, "Ann", "old", D(2020, 1, 1), D(2021, 1, 1), False),     # history
        (1, "Ann", "a1", D(2021, 1, 1), None, True),
        (2, "Bob", None, D(2021, 1, 1), None, True),
        (3, "Cy", "c1", D(2021, 1, 1), None, True),
    ], DIM2N)


def test_scd2_history_close_insert_and_null_safe(spark):
    stg = spark.createDataFrame([
        (1, "Ann", "a2", D(2022, 1, 1), 1), (1, "Ann", "a3", D(2022, 2, 1), 2),   # latest wins
        (2, "Bob", "b1", D(2022, 1, 1), 3),                                        # NULL -> value is a change
        (3, "Cy", "c1", D(2022, 1, 1), 4),                                         # unchanged
        (4, "Di", "d1", D(2022, 1, 1), 5),                                         # new key
    ], STG2)
    out = scd.scd2_apply(_dim2(spark), stg, ["customer_id"], ["name", "address"], tiebreak=["seq"])
    assert rows(out, "customer_id", "start_date") == [
        (1, "Ann", "old", D(2020, 1, 1), D(2021, 1, 1), False),
        (1, "Ann", "a1", D(2021, 1, 1), D(2022, 2, 1), False),
        (1, "Ann", "a3", D(2022, 2, 1), None, True),
        (2, "Bob", None, D(2021, 1, 1), D(2022, 1, 1), False),
        (2, "Bob", "b1", D(2022, 1, 1), None, True),
        (3, "Cy", "c1", D(2021, 1, 1), None, True),
        (4, "Di", "d1", D(2022, 1, 1), None, True),
    ]
    cur = out.filter("is_current").groupBy("customer_id").count()
    assert cur.filter("count > 1").count() == 0


def test_scd2_strict_sql_misses_null_change_and_guard(spark):
    stg = spark.createDataFrame([(2, "Bob", "b1", D(2022, 1, 1), 1),
                                 (3, "Cy", "c9", D(2020, 6, 1), 2)], STG2)   # older than the open row
    strict = scd.scd2_apply(_dim2(spark), stg, ["customer_id"], ["name", "address"], strict_sql=True)
    assert strict.filter("customer_id = 2").count() == 1
    guarded = scd.scd2_apply(_dim2(spark), stg, ["customer_id"], ["name", "address"])
    assert guarded.filter("customer_id = 3").count() == 1
    unguarded = scd.scd2_apply(_dim2(spark), stg, ["customer_id"], ["name", "address"], guard_newer=False)
    assert unguarded.filter("customer_id = 3").count() == 2


def test_scd2_intervals_do_not_overlap(spark):
    stg = spark.createDataFrame([(i % 3 + 1, "n", f"x{i}", D(2022, 1, 1 + i), i) for i in range(5)], STG2)
    d1 = scd.scd2_apply(_dim2(spark), stg.filter("seq < 3"), ["customer_id"], ["name", "address"], tiebreak=["seq"])
    d2 = scd.scd2_apply(d1, stg.filter("seq >= 3"), ["customer_id"], ["name", "address"], tiebreak=["seq"])
    rs = rows(d2, "customer_id", "start_date")
    by_key = {}
    for r in rs:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        for a, b in zip(versions, versions[1:]):
            assert a[4] == b[3]          # end of one version is the start of the next
        assert versions[-1][5] is True and all(v[5] is False for v in versions[:-1])


def test_scd3_fixture(spark):
    dim = spark.createDataFrame([(1, "Laptop", Decimal("1200.00"), None, D(2025, 1, 1)),
                                 (2, "Headphones", Decimal("150.00"), None, D(2025, 1, 1))],
                                "product_id int, product_name string, current_price decimal(10,2), "
                                "previous_price decimal(10,2), current_valid_from date")
    chg = spark.createDataFrame([(1, Decimal("1300.00"), D(2025, 6, 1))],
                                "product_id int, current_price decimal(10,2), eff date")
    out = scd.scd3_apply(dim, chg, ["product_id"], "current_price", previous="previous_price",
                         valid_from="current_valid_from", effective="eff")
    assert rows(out, "product_id") == [(1, "Laptop", Decimal("1300.00"), Decimal("1200.00"), D(2025, 6, 1)),
                                       (2, "Headphones", Decimal("150.00"), None, D(2025, 1, 1))]


DIM1 = "customer_id int, name string, email string, address string, last_updated_date date"
STG1 = "customer_id int, name string, email string, address string, file_date string"


def test_scd1_newer_and_changed_only(spark):
    dim = spark.createDataFrame([(1, "Ann", "a@x", "addr1", D(2026, 3, 1)),
                                 (2, "Bob", "b@x", "addr1", D(2026, 3, 1)),
                                 (3, "Cy", "c@x", "addr1", D(2026, 3, 1))], DIM1)
    stg = spark.createDataFrame([
        (1, "Ann", "a@x", "addr3", "2026-03-10"), (1, "Ann", "a@x", "addr2", "2026-03-17"),  # newest wins
        (2, "Bob", "b@x", "addr9", "2026-02-01"),                                            # older file
        (3, "Cy", "c@x", "addr1", "2026-03-17"),                                             # unchanged
        (4, "Di", "d@x", "addr4", "2026-03-17"),                                             # new
    ], STG1)
    out = scd.scd1_apply(dim, stg, ["customer_id"], ["name", "email", "address"])
    assert rows(out, "customer_id") == [
        (1, "Ann", "a@x", "addr2", D(2026, 3, 17)),
        (2, "Bob", "b@x", "addr1", D(2026, 3, 1)),
        (3, "Cy", "c@x", "addr1", D(2026, 3, 1)),
        (4, "Di", "d@x", "addr4", D(2026, 3, 17)),
    ]


def test_scd1_bad_date_is_not_applied(spark):
    dim = spark.createDataFrame([(1, "Ann", "a@x", "addr1", D(2026, 3, 1))], DIM1)
    stg = spark.createDataFrame([(1, "Ann", "a@x", "addr2", "not-a-date")], STG1)
    out = scd.scd1_apply(dim, stg, ["customer_id"], ["name", "email", "address"])
    assert rows(out) == [(1, "Ann", "a@x", "addr1", D(2026, 3, 1))]


def test_scd0_inserts_new_dates_only(spark):
    dim = spark.createDataFrame([(D(2024, 1, 1), "kept")], "d date, tag string")
    inc = spark.createDataFrame([(D(2024, 1, 1), "changed"), (D(2024, 1, 2), "new"), (D(2024, 1, 2), "new")],
                                "d date, tag string")
    assert rows(scd.scd0_insert_new(dim, inc, ["d"]), "d") == [(D(2024, 1, 1), "kept"), (D(2024, 1, 2), "new")]


def test_changed_members(spark):
    dim = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, n string, addr string")
    lat = spark.createDataFrame([(1, "a", "y"), (2, "b", "x"), (3, "c", "z")], "k int, n string, addr string")
    out = scd.changed_members(dim, lat, ["k"], ["n", "addr"])
    assert rows(out) == [(1, "a", "a", None, "y")]
    assert scd.changed_members(dim, lat, ["k"], ["n", "addr"], strict_sql=True).count() == 0
    assert F  # keep import used


def _drops(spark, seed):
    import random
    rnd = random.Random(seed)
    rows = []
    for d in range(5):
        for k in range(1, 6):
            for _ in range(rnd.choice([0, 1, 2])):
                rows.append((k, rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), D(2022, 1, rnd.randrange(1, 9)),
                             rnd.randrange(1000), f"drop{d}"))
    return spark.createDataFrame(rows, "customer_id int, name string, address string, last_updated date, "
                                       "seq int, drop string")


def _dim_for_replay(spark):
    return spark.createDataFrame([
        (1, "a", "x", D(2020, 1, 1), D(2021, 1, 1), False),
        (1, "a", "y", D(2021, 1, 1), None, True),
        (2, None, "x", D(2021, 1, 1), None, True),
        (3, "b", "x", D(2022, 1, 3), None, True),      # newer than the first drops: guard applies
    ], DIM2N)


import pytest  # noqa: E402


@pytest.mark.parametrize("seed", [1, 2, 3, 7, 8])
def test_scd2_replay_equals_loading_drops_one_by_one(spark, seed):
    drops = _drops(spark, seed)
    seq_dim = _dim_for_replay(spark)
    for d in range(5):
        one = drops.filter(F.col("drop") == f"drop{d}").drop("drop")
        seq_dim = scd.scd2_apply(seq_dim, one, ["customer_id"], ["name", "address"], tiebreak=["seq"])
        seq_dim = spark.createDataFrame(seq_dim.collect(), seq_dim.schema)
    replay = scd.scd2_replay(_dim_for_replay(spark), drops, ["customer_id"], ["name", "address"], drop="drop",
                             tiebreak=["seq"])
    assert rows(replay) == rows(seq_dim)


@pytest.mark.parametrize("seed", [4, 5])
def test_scd1_replay_equals_loading_drops_one_by_one(spark, seed):
    drops = _drops(spark, seed).withColumn("email", F.lit("e")).withColumnRenamed("last_updated", "file_date")
    dim = spark.createDataFrame([(1, "a", "e", "x", D(2021, 1, 1)), (2, None, "e", "x", D(2022, 1, 3))], DIM1)
    seq_dim = dim
    for d in range(5):
        one = drops.filter(F.col("drop") == f"drop{d}").drop("drop")
        seq_dim = scd.scd1_apply(seq_dim, one, ["customer_id"], ["name", "email", "address"], tiebreak=["seq"])
        seq_dim = spark.createDataFrame(seq_dim.collect(), seq_dim.schema)
    replay = scd.scd1_replay(dim, drops, ["customer_id"], ["name", "email", "address"], drop="drop",
                             tiebreak=["seq"])
    assert rows(replay) == rows(seq_dim)


def test_text_dates_lose_against_dates_that_parse(spark):
    dim = spark.createDataFrame([(1, "a", "e", "x", D(2021, 1, 1))], DIM1)
    stg = spark.createDataFrame([(1, "a", "e", "new", "2024-02-01", 1), (1, "a", "e", "bad", "n/a", 2), (2, "b", "e", "y", "soon", 1)],
                                "customer_id int, name string, email string, address string, file_date string, seq int")
    out = scd.scd1_apply(dim, stg, ["customer_id"], ["name", "email", "address"], tiebreak=["seq"])
    assert rows(out) == [(1, "a", "e", "new", D(2024, 2, 1)), (2, "b", "e", "y", None)]


def test_a_late_drop_with_an_older_date_changes_nothing(spark):
    dim = _dim_for_replay(spark).limit(0)
    drops = spark.createDataFrame([(7, "A", "x", D(2024, 3, 1), 1, "drop0"), (7, "B", "x", D(2024, 2, 1), 1, "drop1")],
                                  "customer_id int, name string, address string, last_updated date, seq int, drop string")
    out = scd.scd2_replay(dim, drops, ["customer_id"], ["name", "address"], drop="drop", tiebreak=["seq"])
    assert rows(out) == [(7, "A", "x", D(2024, 3, 1), None, True)]
