from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lk_helpers import D, rows
from lakekit.operators import access as ac
from lakekit.operators import mask as mk

VIEWER = "viewer@x.com"


def test_stated_mask_output(spark):
    df = spark.createDataFrame([(29485, "Catherine", "Abel", "555-555-5555", "catherine0@example.com")],
                               "CustomerID int, FirstName string, LastName string, Phone string, Email string")
    p = (mk.MaskPolicy().add("FirstName", mk.partial(1, "XXXXXXX", 0)).add("Phone", mk.default())
         .add("Email", mk.email()))
    assert rows(mk.apply_masks(df, p, VIEWER)) == [(29485, "CXXXXXXX", "Abel", "xxxx", "cXXX@XXX.com")]


DEMO = "user_id int, short_text string, email_address string, credit_card_number string, custom_id string, " \
       "random_code string, salary decimal(10,2), birth_date date, access_code binary, random_number int"


def _demo(spark):
    return spark.createDataFrame([
        (1, "Yes", "alice@company.com", "1234-5678-9012-3456", "USR1234567890", "XYZ789", Decimal("72000.00"),
         D(1990, 5, 15), bytearray(b"ZZZZZZZZ"), 1234),
        (5, "No", "e@x.org", "1234-4321-5678-8765", "TEM", "BETA9", Decimal("39000.00"), D(1999, 7, 7),
         bytearray(b"\x22" * 8), 4567),
        (6, None, None, None, None, None, None, None, None, None),
        (7, "", "", "1357-2468-1357-2468", "", "DELTA4", Decimal("95000.00"), D(1906, 12, 9),
         bytearray(b"\x44" * 8), 9823),
        (8, None, "this is not an email", "2468-1357-2468-1357", "H", "ZETA3", Decimal("47000.00"),
         D(1988, 3, 11), bytearray(b"\x55" * 8), 1289),
    ], DEMO)


def _policy():
    return (mk.MaskPolicy(row_key="user_id")
            .add("short_text", mk.Mask("default", length=3)).add("email_address", mk.email())
            .add("credit_card_number", mk.partial(0, "XXXX-XXXX-XXXX-", 4))
            .add("custom_id", mk.partial(2, "-MASKED-", 2)).add("random_code", mk.partial(0, "XXXXXX", 0))
            .add("salary", mk.default()).add("birth_date", mk.default()).add("access_code", mk.default())
            .add("random_number", mk.random(1000, 9999)))


def test_masking_demo_rows(spark):
    out = {r.user_id: r for r in mk.apply_masks(_demo(spark), _policy(), VIEWER).collect()}
    a = out[1]
    assert (a.short_text, a.email_address, a.credit_card_number, a.custom_id, a.random_code) == \
        ("xxx", "aXXX@XXX.com", "XXXX-XXXX-XXXX-3456", "US-MASKED-90", "XXXXXX")
    assert (a.salary, a.birth_date, bytes(a.access_code)) == (Decimal("0.00"), D(1900, 1, 1), b"\x00")
    assert 1000 <= a.random_number <= 9999
    assert out[5].custom_id == "-MASKED-"                      # too short: padding only
    assert all(v is None for v in list(out[6])[1:])           # NULL stays NULL
    assert (out[7].short_text, out[7].email_address, out[7].custom_id) == ("xxx", "XXX@XXX.com", "-MASKED-")
    assert out[8].email_address == "tXXX@XXX.com"


def test_random_mask_is_repeatable_and_keyed(spark):
    p = _policy()
    a = rows(mk.apply_masks(_demo(spark), p, VIEWER).select("user_id", "random_number"))
    b = rows(mk.apply_masks(_demo(spark), p, VIEWER).select("user_id", "random_number"))
    assert a == b


def test_unmask_grant_revoke_and_drop(spark):
    p = _policy().grant_unmask(VIEWER)
    assert rows(mk.apply_masks(_demo(spark), p, VIEWER)) == rows(_demo(spark))
    p.revoke_unmask(VIEWER).drop("custom_id")
    out = mk.apply_masks(_demo(spark), p, VIEWER).filter("user_id = 1").first()
    assert out.custom_id == "USR1234567890" and out.email_address == "aXXX@XXX.com"


def test_filters_on_masked_columns(spark):
    p = _policy()
    raw = mk.masked_query(_demo(spark), p, VIEWER, F.col("salary").between(65000, 75000))
    assert [r.user_id for r in raw.collect()] == [1]          # raw values are filtered
    strict = mk.masked_query(_demo(spark), p, VIEWER, F.col("custom_id") == "USR1234567890", strict=True)
    assert strict.count() == 0                                # strict: predicates see masked values


def _sales(spark):
    return spark.createDataFrame([(101, "north", "Alice Johnson", Decimal("10000")),
                                  (102, "south", "Bob Smith", Decimal("12000")),
                                  (103, "north", "Carol Lee", Decimal("8000")),
                                  (104, "west", "David Lee", Decimal("15000"))],
                                 "sale_id int, region string, sales_person string, amount decimal(18,2)")


def test_row_filter_by_mapping(spark):
    mapping = spark.createDataFrame([(VIEWER, "north")], "user_email string, region string")
    out = ac.rls_filter_mapping(_sales(spark), "region", mapping, VIEWER)
    assert [r.sale_id for r in out.orderBy("sale_id").collect()] == [101, 103]
    assert ac.rls_filter_mapping(_sales(spark), "region", mapping, "nobody").count() == 0


def test_row_filter_by_owner(spark):
    s = spark.createDataFrame([(1, "u1", "Valve", 5), (2, "u1", "Wheel", 2), (3, "u1", "Valve", 4),
                               (4, "u2", "Bracket", 2), (5, "u2", "Wheel", 5), (6, "u2", "Seat", 5)],
                              "OrderID int, SalesRep string, Product string, Quantity int")
    assert [r.OrderID for r in ac.rls_filter_owner(s, "SalesRep", "u1").orderBy("OrderID").collect()] == [1, 2, 3]


def test_column_deny_and_grant(spark):
    orders = spark.createDataFrame([(1234, 5678, "111111111111111")], "OrderID int, CustomerID int, CreditCard string")
    p = ac.AccessPolicy().grant_table("Orders", VIEWER).deny_columns("Orders", VIEWER, ["CreditCard"])
    with pytest.raises(ac.AccessDenied):
        ac.cls_select(orders, p, "Orders", VIEWER)
    assert ac.cls_select(orders, p, "Orders", VIEWER, ["OrderID", "CustomerID"]).count() == 1
    g = ac.AccessPolicy().grant_columns("employees", VIEWER, ["employee_id", "full_name", "department"])
    emp = spark.createDataFrame([(1, "A", "HR", Decimal("1"))], "employee_id int, full_name string, department string, "
                                                                "salary decimal(18,2)")
    with pytest.raises(ac.AccessDenied):
        ac.cls_select(emp, g, "employees", VIEWER)
    assert ac.cls_select(emp, g, "employees", VIEWER, ["employee_id", "full_name"]).columns == ["employee_id",
                                                                                                "full_name"]


def test_table_deny(spark):
    p = ac.AccessPolicy().grant_table("Parts", "admin").deny_table("Parts", VIEWER)
    with pytest.raises(ac.AccessDenied):
        ac.ols_load(p, VIEWER, "Parts", lambda: None)
    assert ac.ols_load(p, "admin", "Parts", lambda: "loaded") == "loaded"


def test_secure_read_order(spark):
    mapping = spark.createDataFrame([(VIEWER, "north")], "user_email string, region string")
    acc = ac.AccessPolicy().grant_columns("sales", VIEWER, ["sale_id", "region", "sales_person"])
    masks = mk.MaskPolicy().add("sales_person", mk.partial(1, "***", 0))
    out = ac.secure_read(_sales(spark), VIEWER, "sales", access=acc,
                         row_filter=lambda d: ac.rls_filter_mapping(d, "region", mapping, VIEWER),
                         columns=["sale_id", "sales_person"], masks=masks)
    assert rows(out, "sale_id") == [(101, "A***"), (103, "C***")]


def test_denied_columns_by_any_spelling(spark):
    from lakekit.operators import access as ac
    df = spark.createDataFrame([(1, 100)], "id int, salary int")
    policy = ac.AccessPolicy().grant_table("t", "u").deny_columns("t", "u", ["Salary"])
    for asked in (["*"], ["id", "SALARY"], ["`salary`"], ["salary + 0"], ["t.salary"], [df.salary], None):
        with pytest.raises(ac.AccessDenied):
            ac.cls_select(df, policy, "t", "u", asked)
    assert ac.cls_select(df, policy, "t", "u", ["ID"]).columns == ["id"]


def test_masks_resolve_names_and_refuse_unknown_ones(spark):
    from lakekit.operators import mask as mk
    df = spark.createDataFrame([(1, 100)], "id int, salary int")
    assert mk.apply_masks(df, mk.MaskPolicy().add("Salary", mk.default()), "u").collect() == [(1, 0)]
    with pytest.raises(ValueError):
        mk.apply_masks(df, mk.MaskPolicy().add("salry", mk.default()), "u")
