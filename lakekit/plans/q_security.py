"""Registered masking and row/column/table filter queries over customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.operators import access as ac
from lakekit.operators import mask as mk
from lakekit.plans.registry import query
from lakekit.sources.tables import load

VIEWER = "viewer@example.com"
OWNER = "BUILDING"            # c_mktsegment doubles as the row owner
MAPPED_USER = "NATION_7"      # nation name doubles as the user in the user -> region mapping
SALARY_LO, SALARY_HI = 6500, 7500

SQL_CUST = """cust AS (SELECT c_custkey, c_name, 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
                       c_mktsegment, c_acctbal, c_nationkey FROM customer)"""


def _cust(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_name",
                    F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
                    "c_mktsegment", "c_acctbal", "c_nationkey")


@query("mask_default", f"""WITH {SQL_CUST}
SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN 'xxxx' END AS c_name,
       CASE WHEN c_mktsegment IS NOT NULL THEN 'xxx' END AS c_mktsegment,
       CASE WHEN c_acctbal IS NOT NULL THEN CAST(0.0 AS DOUBLE) END AS c_acctbal
FROM cust""")
def q_mask_default(spark, sf_dir):
    policy = (mk.MaskPolicy().add("c_name", mk.default()).add("c_mktsegment", mk.Mask("default", length=3))
              .add("c_acctbal", mk.default()))
    return mk.apply_masks(_cust(spark, sf_dir).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"),
                          policy, VIEWER)


@query("mask_email", f"""WITH {SQL_CUST}
SELECT c_custkey, CASE WHEN email IS NOT NULL THEN left(email, 1) || 'XXX@XXX.com' END AS email FROM cust""")
def q_mask_email(spark, sf_dir):
    policy = mk.MaskPolicy().add("email", mk.email())
    return mk.apply_masks(_cust(spark, sf_dir).select("c_custkey", "email"), policy, VIEWER)


@query("mask_partial", f"""WITH {SQL_CUST}
SELECT c_custkey,
       CASE WHEN c_name IS NULL THEN NULL WHEN length(c_name) > 4 THEN left(c_name, 2) || '-MASKED-' || right(c_name, 2)
            ELSE '-MASKED-' END AS c_name,
       CASE WHEN c_mktsegment IS NULL THEN NULL WHEN length(c_mktsegment) > 1 THEN left(c_mktsegment, 1) || 'XXXXXXX'
            ELSE 'XXXXXXX' END AS c_mktsegment
FROM cust""")
def q_mask_partial(spark, sf_dir):
    policy = (mk.MaskPolicy().add("c_name", mk.partial(2, "-MASKED-", 2))
              .add("c_mktsegment", mk.partial(1, "XXXXXXX", 0)))
    return mk.apply_masks(_cust(spark, sf_dir).select("c_custkey", "c_name", "c_mktsegment"), policy, VIEWER)


@query("masked_query", f"""WITH {SQL_CUST}
SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN 'xxxx' END AS c_name,
       CASE WHEN email IS NOT NULL THEN left(email, 1) || 'XXX@XXX.com' END AS email,
       CASE WHEN c_acctbal IS NOT NULL THEN CAST(0.0 AS DOUBLE) END AS c_acctbal
FROM cust WHERE c_acctbal >= {SALARY_LO} AND c_acctbal <= {SALARY_HI}""")
def q_masked_query(spark, sf_dir):
    policy = mk.MaskPolicy().add("c_name", mk.default()).add("email", mk.email()).add("c_acctbal", mk.default())
    df = _cust(spark, sf_dir).select("c_custkey", "c_name", "email", "c_acctbal")
    return mk.masked_query(df, policy, VIEWER, F.col("c_acctbal").between(SALARY_LO, SALARY_HI))


@query("mask_random", """
SELECT c_custkey, c_nationkey IS NULL AS is_null, CASE WHEN c_nationkey IS NOT NULL THEN TRUE END AS in_range FROM customer""")
def q_mask_random(spark, sf_dir):
    """The numbers are keyed by a salted hash: returned is whether each lies in the mask's range."""
    policy = mk.MaskPolicy(row_key="c_custkey").add("c_nationkey", mk.random(1000, 9999))
    masked = mk.apply_masks(_cust(spark, sf_dir).select("c_custkey", "c_nationkey"), policy, VIEWER)
    return masked.select("c_custkey", F.col("c_nationkey").isNull().alias("is_null"),
                         F.col("c_nationkey").between(1000, 9999).alias("in_range"))


@query("mask_default_types", """
SELECT o_orderkey, CASE WHEN o_orderdate IS NOT NULL THEN TIMESTAMP '1900-01-01' END AS placed,
       CASE WHEN o_orderdate IS NOT NULL THEN DATE '1900-01-01' END AS day,
       CASE WHEN o_orderstatus IS NOT NULL THEN '00' END AS status_hex, CASE WHEN o_totalprice IS NOT NULL THEN FALSE END AS large
FROM orders""")
def q_mask_default_types(spark, sf_dir):
    """The default mask on times, dates, binary values and booleans."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("placed"), F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderstatus").cast("binary").alias("status"), (F.col("o_totalprice") > 1000).alias("large"))
    policy = mk.MaskPolicy()
    for c in ("placed", "day", "status", "large"):
        policy.add(c, mk.default())
    return mk.apply_masks(o, policy, VIEWER).withColumn("status_hex", F.hex("status")).drop("status")


@query("mask_add_drop", f"""WITH {SQL_CUST}
SELECT c_custkey, c_name, CASE WHEN email IS NOT NULL THEN left(email, 1) || 'XXX@XXX.com' END AS email FROM cust""")
def q_mask_add_drop(spark, sf_dir):
    """A mask added and dropped again leaves its column as it was; the other one stays."""
    policy = mk.MaskPolicy().add("c_name", mk.default()).add("email", mk.email()).drop("c_name")
    return mk.apply_masks(_cust(spark, sf_dir).select("c_custkey", "c_name", "email"), policy, VIEWER)


@query("unmask_grant", f"""WITH {SQL_CUST}
SELECT c_custkey, email, 'granted' AS reader FROM cust
UNION ALL SELECT c_custkey, left(email, 1) || 'XXX@XXX.com', 'revoked' FROM cust""")
def q_unmask_grant(spark, sf_dir):
    """A reader with UNMASK sees the values; one whose grant was revoked does not."""
    policy = mk.MaskPolicy().add("EMAIL", mk.email()).grant_unmask("a").grant_unmask("b").revoke_unmask("b")
    c = _cust(spark, sf_dir).select("c_custkey", "email")
    granted = mk.apply_masks(c, policy, "a").withColumn("reader", F.lit("granted"))
    return granted.unionByName(mk.apply_masks(c, policy, "b").withColumn("reader", F.lit("revoked")))


@query("cls_deny_select", "SELECT c_custkey, c_name FROM customer")
def q_cls_deny_select(spark, sf_dir):
    """Denied columns can't be had by any spelling; the others can."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    policy = ac.AccessPolicy().grant_table("customer", VIEWER).deny_columns("customer", VIEWER, ["c_acctbal"])
    for asked in (["*"], ["c_custkey", "C_ACCTBAL"], ["`c_acctbal`"], None):
        try:
            ac.cls_select(c, policy, "customer", VIEWER, asked)
        except ac.AccessDenied:
            continue
        raise AssertionError(f"a denied column was selected by {asked}")
    return ac.cls_select(c, policy, "customer", VIEWER, ["c_custkey", "`c_name`"])


@query("rls_filter_owner", f"""
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = '{OWNER}'""")
def q_rls_filter_owner(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ac.rls_filter_owner(c, "c_mktsegment", OWNER)


SQL_REGIONAL = """regional AS (SELECT c.c_custkey, c.c_name, r.r_name AS region FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
user_region AS (SELECT n.n_name AS user_email, r.r_name AS region FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("rls_filter_mapping", f"""WITH {SQL_REGIONAL}
SELECT c_custkey, c_name, region FROM regional
WHERE region IN (SELECT region FROM user_region WHERE user_email = '{MAPPED_USER}')""")
def q_rls_filter_mapping(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", F.col("r_name").alias("region"))
    mapping = geo.select(F.col("n_name").alias("user_email"), "region")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    geo_small = geo.select("n_nationkey", "region")
    regional = c.join(geo_small, c.c_nationkey == geo_small.n_nationkey).select("c_custkey", "c_name", "region")
    return ac.rls_filter_mapping(regional, "region", mapping, MAPPED_USER)


@query("cls_select", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_cls_select(spark, sf_dir):
    policy = ac.AccessPolicy().grant_columns("customer", VIEWER, ["c_custkey", "c_name", "c_mktsegment"])
    c = load(spark, sf_dir, "customer")
    return ac.cls_select(c, policy, "customer", VIEWER, ["c_custkey", "c_name", "c_mktsegment"])


@query("ols_load", "SELECT * FROM nation")
def q_ols_load(spark, sf_dir):
    policy = ac.AccessPolicy().grant_table("nation", VIEWER).deny_table("supplier", VIEWER)
    return ac.ols_load(policy, VIEWER, "nation", lambda: load(spark, sf_dir, "nation"))
