"""Registered upsert, key and slowly-changing-dimension queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakekit.operators import keys as K
from lakekit.operators import merge as M
from lakekit.operators import scd
from lakekit.plans import fixtures as fx
from lakekit.plans.registry import ORACLES, query
from lakekit.session import work_dir
from lakekit.sources.buckets import BucketTable
from lakekit.sources.tables import load

# Fixed values of the merge demo: target = orders before 1999, updates = orders from 1998.
TARGET_BEFORE = dt.datetime(1999, 1, 1)
UPDATES_FROM = dt.datetime(1998, 1, 1)
OPEN_END = dt.date(2999, 12, 31)


def _merge_inputs(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit(TARGET_BEFORE).cast("timestamp_ntz"))
    updates = (o.filter(F.col("o_orderdate") >= F.lit(UPDATES_FROM).cast("timestamp_ntz"))
               .withColumn("o_orderstatus", F.lit("U"))
               .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
               .withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW",
                                                     F.col("o_orderpriority"))))
    return target, updates


SQL_MERGE_INPUTS = """
t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
u AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""

ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("merge_upsert", "WITH " + SQL_MERGE_INPUTS + """
SELECT COALESCE(u.o_orderkey, t.o_orderkey) AS o_orderkey,
""" + ",\n".join(f"CASE WHEN u.o_orderkey IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}"
                 for c in ORDER_COLS[1:]) + """
FROM t FULL OUTER JOIN u ON t.o_orderkey = u.o_orderkey""")
def q_merge_upsert(spark, sf_dir):
    target, updates = _merge_inputs(spark, sf_dir)
    return M.merge_upsert(target, updates, ["o_orderkey"])


@query("merge_upsert_inline", ORACLES["merge_upsert"])
def q_merge_upsert_inline(spark, sf_dir):
    """The same upsert with its key check inside the join: the updates are computed once."""
    target, updates = _merge_inputs(spark, sf_dir)
    return M.merge_upsert(target, updates, ["o_orderkey"], check_unique="inline")


@query("merge_insert_only", "WITH " + SQL_MERGE_INPUTS + """
SELECT * FROM t UNION ALL
SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = u.o_orderkey)""")
def q_merge_insert_only(spark, sf_dir):
    target, updates = _merge_inputs(spark, sf_dir)
    return M.merge_insert_only(target, updates, ["o_orderkey"])


@query("merge_columns", "WITH " + SQL_MERGE_INPUTS + """
SELECT COALESCE(t.o_orderkey, u.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE u.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NOT NULL AND u.o_orderkey IS NOT NULL THEN u.o_orderstatus
            WHEN t.o_orderkey IS NOT NULL THEN t.o_orderstatus END AS o_orderstatus,
       CASE WHEN t.o_orderkey IS NOT NULL AND u.o_orderkey IS NOT NULL THEN u.o_totalprice
            WHEN t.o_orderkey IS NOT NULL THEN t.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderdate ELSE u.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN u ON t.o_orderkey = u.o_orderkey""")
def q_merge_columns(spark, sf_dir):
    target, updates = _merge_inputs(spark, sf_dir)
    return M.merge_columns(target, updates, ["o_orderkey"], update_set=["o_orderstatus", "o_totalprice"],
                           insert_cols=["o_custkey", "o_orderdate"])


@query("update_where", """
SELECT p_partkey, p_name, p_brand,
       CASE WHEN p_size > 40 THEN 'PREMIUM' ELSE p_type END AS p_type, p_size,
       CASE WHEN p_size > 40 THEN p_retailprice + 100.0 ELSE p_retailprice END AS p_retailprice
FROM part""")
def q_update_where(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return M.update_where(p, F.col("p_size") > 40, {"p_type": F.lit("PREMIUM"),
                                                    "p_retailprice": F.col("p_retailprice") + F.lit(100.0)})


@query("assert_unique_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_assert_unique_keys(spark, sf_dir):
    return M.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- keys

@query("max_key", "SELECT CAST(COALESCE(MAX(c_custkey), 0) AS BIGINT) AS max_key FROM customer")
def q_max_key(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select(F.coalesce(F.max("c_custkey"), F.lit(0)).cast("bigint").alias("max_key"))


@query("assign_surrogate_keys", """
SELECT p_name AS ItemName, CAST(row_number() OVER (ORDER BY p_name) AS BIGINT) AS ItemID
FROM (SELECT DISTINCT p_name FROM part)""")
def q_assign_surrogate_keys(spark, sf_dir):
    names = load(spark, sf_dir, "part").select(F.col("p_name").alias("ItemName")).distinct()
    return K.assign_surrogate_keys(names, ["ItemName"], "ItemID")


@query("latest_per_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def q_latest_per_key(spark, sf_dir):
    return K.latest_per_key(load(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("dedup_by_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def q_dedup_by_key(spark, sf_dir):
    return K.dedup_by_key(load(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], ["o_orderkey"])


@query("new_dimension_members", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= TIMESTAMP '1998-01-01')
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate < TIMESTAMP '1998-01-01')""")
def q_new_dimension_members(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    cut = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    later = o.filter(F.col("o_orderdate") >= cut).select("c_custkey")
    earlier = o.filter(F.col("o_orderdate") < cut).select("c_custkey")
    return c.join(later, "c_custkey", "left_semi").join(earlier, "c_custkey", "left_anti")


# ---------------------------------------------------------------- slowly changing dimensions

def _scd_inputs(spark, sf_dir):
    st = fx.customer_staging(spark, sf_dir)
    cut = F.lit(fx.SCD_CUT)
    pre = K.latest_per_key(st.filter(F.col("last_updated") < cut), ["customer_id"], ["last_updated", "seq"])
    staged = st.filter(F.col("last_updated") >= cut)
    return pre, staged


SQL_SCD_INPUTS = fx.SQL_STAGING + """,
pre AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, seq DESC) AS rn
        FROM staging WHERE last_updated < DATE '1998-01-01') WHERE rn = 1),
lat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, seq DESC) AS rn
        FROM staging WHERE last_updated >= DATE '1998-01-01') WHERE rn = 1)"""


@query("scd1_apply", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT customer_id, name, email, address, last_updated AS last_updated_date FROM pre),
j AS (SELECT d.*, l.name AS n_name, l.email AS n_email, l.address AS n_address, l.last_updated AS n_date,
             (l.customer_id IS NOT NULL AND l.last_updated > d.last_updated_date
              AND (d.name IS DISTINCT FROM l.name OR d.email IS DISTINCT FROM l.email
                   OR d.address IS DISTINCT FROM l.address)) AS upd
      FROM dim d LEFT JOIN lat l ON d.customer_id = l.customer_id)
SELECT customer_id,
       CASE WHEN upd THEN n_name ELSE name END AS name,
       CASE WHEN upd THEN n_email ELSE email END AS email,
       CASE WHEN upd THEN n_address ELSE address END AS address,
       CASE WHEN upd THEN n_date ELSE last_updated_date END AS last_updated_date
FROM j
UNION ALL
SELECT customer_id, name, email, address, last_updated FROM lat
WHERE customer_id NOT IN (SELECT customer_id FROM dim)""")
def q_scd1_apply(spark, sf_dir):
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "email", "address", F.col("last_updated").alias("last_updated_date"))
    stg = staged.withColumnRenamed("last_updated", "file_date")
    return scd.scd1_apply(dim, stg, ["customer_id"], ["name", "email", "address"],
                          dim_date="last_updated_date", staged_date="file_date", tiebreak=["seq"])


SQL_SCD2_CHANGES = """,
chg AS (SELECT d.*, l.name AS n_name, l.address AS n_address, l.last_updated AS eff
        FROM dim d JOIN lat l ON d.customer_id = l.customer_id
        WHERE (d.name IS DISTINCT FROM l.name OR d.address IS DISTINCT FROM l.address)
          AND l.last_updated > d.start_date)"""


@query("scd2_apply", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT customer_id, name, address, last_updated AS start_date, CAST(NULL AS DATE) AS end_date,
               TRUE AS is_current FROM pre)""" + SQL_SCD2_CHANGES + """
SELECT customer_id, name, address, start_date, end_date, is_current FROM dim
WHERE customer_id NOT IN (SELECT customer_id FROM chg)
UNION ALL SELECT customer_id, name, address, start_date, eff, FALSE FROM chg
UNION ALL SELECT customer_id, n_name, n_address, eff, CAST(NULL AS DATE), TRUE FROM chg
UNION ALL SELECT customer_id, name, address, last_updated, CAST(NULL AS DATE), TRUE FROM lat
WHERE customer_id NOT IN (SELECT customer_id FROM dim)""")
def q_scd2_apply(spark, sf_dir):
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", F.col("last_updated").alias("start_date"),
                     F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
    return scd.scd2_apply(dim, staged, ["customer_id"], ["name", "address"], effective="last_updated",
                          tiebreak=["seq"])


@query("scd2_apply_sentinel", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS surrogate_key, customer_id, name, address,
               last_updated AS start_date, DATE '2999-12-31' AS end_date, TRUE AS is_current FROM pre)"""
       + SQL_SCD2_CHANGES + """,
fresh AS (SELECT customer_id, n_name AS name, n_address AS address, eff AS start_date FROM chg
          UNION ALL
          SELECT customer_id, name, address, last_updated FROM lat
          WHERE customer_id NOT IN (SELECT customer_id FROM dim))
SELECT surrogate_key, customer_id, name, address, start_date, end_date, is_current FROM dim
WHERE customer_id NOT IN (SELECT customer_id FROM chg)
UNION ALL SELECT surrogate_key, customer_id, name, address, start_date, eff, FALSE FROM chg
UNION ALL SELECT CAST((SELECT max(surrogate_key) FROM dim) + row_number() OVER (ORDER BY customer_id) AS BIGINT),
                 customer_id, name, address, start_date, DATE '2999-12-31', TRUE FROM fresh""")
def q_scd2_apply_sentinel(spark, sf_dir):
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", F.col("last_updated").alias("start_date"),
                     F.lit(OPEN_END).alias("end_date"), F.lit(True).alias("is_current"))
    dim = K.assign_surrogate_keys(dim, ["customer_id"], "surrogate_key")
    dim = dim.select("surrogate_key", "customer_id", "name", "address", "start_date", "end_date", "is_current")
    return scd.scd2_apply(dim, staged, ["customer_id"], ["name", "address"], effective="last_updated",
                          tiebreak=["seq"], open_end=OPEN_END, surrogate="surrogate_key")


@query("scd3_apply", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT customer_id, name, address AS current_address, CAST(NULL AS VARCHAR) AS previous_address,
               last_updated AS current_valid_from FROM pre)
SELECT d.customer_id, d.name,
       CASE WHEN l.customer_id IS NOT NULL AND d.current_address IS DISTINCT FROM l.address
            THEN l.address ELSE d.current_address END AS current_address,
       CASE WHEN l.customer_id IS NOT NULL AND d.current_address IS DISTINCT FROM l.address
            THEN d.current_address ELSE d.previous_address END AS previous_address,
       CASE WHEN l.customer_id IS NOT NULL AND d.current_address IS DISTINCT FROM l.address
            THEN l.last_updated ELSE d.current_valid_from END AS current_valid_from
FROM dim d LEFT JOIN lat l ON d.customer_id = l.customer_id""")
def q_scd3_apply(spark, sf_dir):
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", F.col("address").alias("current_address"),
                     F.lit(None).cast("string").alias("previous_address"),
                     F.col("last_updated").alias("current_valid_from"))
    changes = staged.select("customer_id", "address", "last_updated", "seq").withColumnRenamed(
        "address", "current_address")
    return scd.scd3_apply(dim, changes, ["customer_id"], "current_address", previous="previous_address",
                          valid_from="current_valid_from", effective="last_updated", tiebreak=["seq"])


@query("changed_members", "WITH " + SQL_SCD_INPUTS + """
SELECT d.customer_id, d.name AS old_name, l.name AS new_name, d.email AS old_email, l.email AS new_email,
       d.address AS old_address, l.address AS new_address
FROM pre d JOIN lat l ON d.customer_id = l.customer_id
WHERE d.name IS DISTINCT FROM l.name OR d.email IS DISTINCT FROM l.email OR d.address IS DISTINCT FROM l.address""")
def q_changed_members(spark, sf_dir):
    pre, staged = _scd_inputs(spark, sf_dir)
    latest = K.latest_per_key(staged, ["customer_id"], ["last_updated", "seq"])
    dim = pre.select("customer_id", "name", "email", "address")
    return scd.changed_members(dim, latest.select("customer_id", "name", "email", "address"),
                               ["customer_id"], ["name", "email", "address"])


# ---------------------------------------------------------------- several dated drops at once

SQL_REPLAY = """,
st AS (SELECT *, CAST(year(last_updated) AS INTEGER) AS drp FROM staging WHERE last_updated >= DATE '1998-01-01'),
perdrop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, drp
                                                        ORDER BY last_updated DESC, seq DESC) AS rn2 FROM st)
            WHERE rn2 = 1),
j AS (SELECT p.customer_id, p.name, p.email, p.address, p.last_updated, p.seq,
             d.name AS c_name, d.email AS c_email, d.address AS c_address, d.c_start,
             d.customer_id IS NOT NULL AS has_cur
      FROM perdrop p LEFT JOIN dim d ON p.customer_id = d.customer_id
      WHERE d.c_start IS NULL OR p.last_updated > d.c_start),
o AS (SELECT *, row_number() OVER w AS pos, lag(name) OVER w AS p_name, lag(email) OVER w AS p_email,
             lag(address) OVER w AS p_address
      FROM j WINDOW w AS (PARTITION BY customer_id ORDER BY last_updated, seq)),
chg AS (SELECT customer_id, name, email, address, last_updated FROM o
        WHERE CASE WHEN pos = 1 AND NOT has_cur THEN TRUE
                   WHEN pos = 1 THEN {cmp_cur}
                   ELSE {cmp_prev} END)"""


def _replay_inputs(spark, sf_dir):
    pre, staged = _scd_inputs(spark, sf_dir)
    return pre, staged.withColumn("drop", F.year("last_updated"))


@query("scd2_replay", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT customer_id, name, NULL AS email, address, last_updated AS c_start FROM pre)"""
       + SQL_REPLAY.format(cmp_cur="(name IS DISTINCT FROM c_name OR address IS DISTINCT FROM c_address)",
                           cmp_prev="(name IS DISTINCT FROM p_name OR address IS DISTINCT FROM p_address)") + """,
fc AS (SELECT customer_id, min(last_updated) AS first_change FROM chg GROUP BY customer_id)
SELECT d.customer_id, d.name, d.address, d.c_start AS start_date, fc.first_change AS end_date,
       fc.first_change IS NULL AS is_current
FROM dim d LEFT JOIN fc ON d.customer_id = fc.customer_id
UNION ALL
SELECT customer_id, name, address, last_updated AS start_date,
       lead(last_updated) OVER (PARTITION BY customer_id ORDER BY last_updated) AS end_date,
       lead(last_updated) OVER (PARTITION BY customer_id ORDER BY last_updated) IS NULL AS is_current
FROM chg""")
def q_scd2_replay(spark, sf_dir):
    """SCD2 over one drop per year (1998 on) in one pass; equals loading the drops in turn."""
    pre, staged = _replay_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", F.col("last_updated").alias("start_date"),
                     F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
    return scd.scd2_replay(dim, staged, ["customer_id"], ["name", "address"], drop="drop",
                           effective="last_updated", tiebreak=["seq"])


@query("scd1_replay", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT customer_id, name, email, address, last_updated AS c_start FROM pre)"""
       + SQL_REPLAY.format(cmp_cur="(name IS DISTINCT FROM c_name OR email IS DISTINCT FROM c_email "
                                   "OR address IS DISTINCT FROM c_address)",
                           cmp_prev="(name IS DISTINCT FROM p_name OR email IS DISTINCT FROM p_email "
                                    "OR address IS DISTINCT FROM p_address)") + """,
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC) AS r
                        FROM chg) WHERE r = 1)
SELECT COALESCE(d.customer_id, l.customer_id) AS customer_id,
       CASE WHEN l.customer_id IS NOT NULL THEN l.name ELSE d.name END AS name,
       CASE WHEN l.customer_id IS NOT NULL THEN l.email ELSE d.email END AS email,
       CASE WHEN l.customer_id IS NOT NULL THEN l.address ELSE d.address END AS address,
       CASE WHEN l.customer_id IS NOT NULL THEN l.last_updated ELSE d.c_start END AS last_updated_date
FROM dim d FULL OUTER JOIN last l ON d.customer_id = l.customer_id""")
def q_scd1_replay(spark, sf_dir):
    """SCD1 over one drop per year (1998 on) in one pass; equals loading the drops in turn."""
    pre, staged = _replay_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "email", "address", F.col("last_updated").alias("last_updated_date"))
    stg = staged.withColumnRenamed("last_updated", "file_date")
    return scd.scd1_replay(dim, stg, ["customer_id"], ["name", "email", "address"], drop="drop",
                           dim_date="last_updated_date", staged_date="file_date", tiebreak=["seq"])


@query("scd0_insert_new", "WITH " + SQL_SCD_INPUTS + """
SELECT customer_id, name, address, last_updated FROM pre
UNION ALL
SELECT customer_id, name, address, last_updated FROM lat WHERE customer_id NOT IN (SELECT customer_id FROM pre)""")
def q_scd0_insert_new(spark, sf_dir):
    """Type 0: known customers keep their first state, of a new one the latest staged row is added."""
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", "last_updated")
    return scd.scd0_insert_new(dim, staged, ["customer_id"], ["last_updated", "seq"])


@query("merge_bucketed", ORACLES["merge_upsert"])
def q_merge_bucketed(spark, sf_dir):
    """The upsert into a table of 64 key buckets: only those that the updates fall into are rewritten."""
    target, updates = _merge_inputs(spark, sf_dir)
    table = BucketTable(spark, work_dir(spark, "bucketed"), ["o_orderkey"], 64)
    table.create(target)
    table.upsert(updates)
    return table.read()


@query("scd3_apply_insert", "WITH " + SQL_SCD_INPUTS + """,
dim AS (SELECT customer_id, name, address AS current_address, CAST(NULL AS VARCHAR) AS previous_address,
               last_updated AS current_valid_from FROM pre)
SELECT d.customer_id, d.name,
       CASE WHEN l.customer_id IS NOT NULL AND d.current_address IS DISTINCT FROM l.address
            THEN l.address ELSE d.current_address END AS current_address,
       CASE WHEN l.customer_id IS NOT NULL AND d.current_address IS DISTINCT FROM l.address
            THEN d.current_address ELSE d.previous_address END AS previous_address,
       CASE WHEN l.customer_id IS NOT NULL AND d.current_address IS DISTINCT FROM l.address
            THEN l.last_updated ELSE d.current_valid_from END AS current_valid_from
FROM dim d LEFT JOIN lat l ON d.customer_id = l.customer_id
UNION ALL
SELECT l.customer_id, CAST(NULL AS VARCHAR) AS name, l.address, CAST(NULL AS VARCHAR), l.last_updated
FROM lat l WHERE l.customer_id NOT IN (SELECT customer_id FROM dim)""")
def q_scd3_apply_insert(spark, sf_dir):
    """Type 3 with new keys inserted (previous value NULL)."""
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", F.col("address").alias("current_address"),
                     F.lit(None).cast("string").alias("previous_address"),
                     F.col("last_updated").alias("current_valid_from"))
    changes = staged.select("customer_id", F.col("address").alias("current_address"), "last_updated", "seq")
    return scd.scd3_apply(dim, changes, ["customer_id"], "current_address", previous="previous_address",
                          valid_from="current_valid_from", effective="last_updated", tiebreak=["seq"],
                          insert_new=True)


# ---------------------------------------------------------------- text dates and late drops

@query("scd1_text_dates", "WITH " + fx.SQL_STAGING + """,
pre AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, seq DESC) AS rn
        FROM staging WHERE last_updated < DATE '1998-01-01') WHERE rn = 1),
txt AS (SELECT *, CASE WHEN seq % 3 = 0 THEN 'n/a' ELSE strftime(last_updated, '%Y-%m-%d') END AS raw
        FROM staging WHERE last_updated >= DATE '1998-01-01'),
lat AS (SELECT *, TRY_CAST(raw AS DATE) AS parsed FROM (
          SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY TRY_CAST(raw AS DATE) DESC NULLS LAST, seq DESC) AS rn FROM txt)
        WHERE rn = 1),
j AS (SELECT d.customer_id, d.name, d.address, d.last_updated, l.address AS n_address, l.parsed,
             COALESCE(l.parsed > d.last_updated AND (d.name IS DISTINCT FROM l.name OR d.address IS DISTINCT FROM l.address), FALSE) AS upd
      FROM pre d LEFT JOIN lat l ON d.customer_id = l.customer_id)
SELECT customer_id, name, CASE WHEN upd THEN n_address ELSE address END AS address,
       CASE WHEN upd THEN parsed ELSE last_updated END AS last_updated_date FROM j
UNION ALL
SELECT customer_id, name, address, parsed FROM lat WHERE customer_id NOT IN (SELECT customer_id FROM pre)""")
def q_scd1_text_dates(spark, sf_dir):
    """Staged dates come as text and a third of them don't parse."""
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", F.col("last_updated").alias("last_updated_date"))
    text = F.when(F.col("seq") % 3 == 0, F.lit("n/a")).otherwise(F.date_format("last_updated", "yyyy-MM-dd"))
    return scd.scd1_apply(dim, staged.withColumn("file_date", text), ["customer_id"], ["name", "address"],
                          dim_date="last_updated_date", staged_date="file_date", tiebreak=["seq"])


@query("scd2_replay_late_drop", "WITH RECURSIVE " + fx.SQL_STAGING + """,
pre AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, seq DESC) AS rn
        FROM staging WHERE last_updated < DATE '1998-01-01') WHERE rn = 1),
per AS (SELECT customer_id, address, last_updated, row_number() OVER (PARTITION BY customer_id ORDER BY drp) AS pos FROM (
          SELECT *, seq % 4 AS drp, row_number() OVER (PARTITION BY customer_id, seq % 4 ORDER BY last_updated DESC, seq DESC) AS rn
          FROM staging WHERE last_updated >= DATE '1998-01-01') WHERE rn = 1),
fold AS (
  SELECT k.customer_id, 0::BIGINT AS pos, p.address, p.last_updated AS since, FALSE AS changed
  FROM (SELECT customer_id FROM pre UNION SELECT customer_id FROM per) k LEFT JOIN pre p USING (customer_id)
  UNION ALL
  SELECT customer_id, pos, CASE WHEN go THEN n_address ELSE address END, CASE WHEN go THEN n_since ELSE since END, go FROM (
    SELECT f.customer_id, r.pos, f.address, f.since, r.address AS n_address, r.last_updated AS n_since,
           (f.since IS NULL OR (r.last_updated > f.since AND r.address IS DISTINCT FROM f.address)) AS go
    FROM fold f JOIN per r ON r.customer_id = f.customer_id AND r.pos = f.pos + 1)),
chg AS (SELECT customer_id, address, since, lead(since) OVER (PARTITION BY customer_id ORDER BY pos) AS nxt FROM fold WHERE changed),
firsts AS (SELECT customer_id, min(since) AS since FROM chg GROUP BY customer_id)
SELECT p.customer_id, p.name, p.address, p.last_updated AS start_date, f.since AS end_date, f.since IS NULL AS is_current
FROM pre p LEFT JOIN firsts f USING (customer_id)
UNION ALL
SELECT c.customer_id, n.name, c.address, c.since, c.nxt, c.nxt IS NULL
FROM chg c JOIN (SELECT DISTINCT customer_id, name FROM staging) n USING (customer_id)""")
def q_scd2_replay_late_drop(spark, sf_dir):
    """Four drops whose dates don't rise with the drop: a late, older row changes nothing."""
    pre, staged = _scd_inputs(spark, sf_dir)
    dim = pre.select("customer_id", "name", "address", F.col("last_updated").alias("start_date"),
                     F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
    return scd.scd2_replay(dim, staged.withColumn("drop", F.col("seq") % 4), ["customer_id"], ["name", "address"],
                           drop="drop", effective="last_updated", tiebreak=["seq"])
