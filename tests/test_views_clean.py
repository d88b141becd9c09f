from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lk_helpers import D, rows
from lakekit.functions import scalar as S
from lakekit.plans import medallion as md
from lakekit.plans import views as vw
from lakekit.sources import files as fs

EMP = "employee_id int, name string, department_id int, hire_date date, salary decimal(18,2)"


def _emp(spark):
    return spark.createDataFrame([
        (1, "john doe", 101, D(2025, 6, 1), Decimal("75000.00")),
        (2, "jane Smith", 102, D(2018, 9, 15), Decimal("85000.00")),
        (3, "Alex johnson", 103, D(2020, 1, 10), Decimal("68000.00")),
        (4, "Sara Lee", 101, D(2017, 3, 12), Decimal("72000.00")),
        (5, "Michael Brown", 102, D(2019, 11, 20), Decimal("95000.00")),
        (6, "Emma Davis", 103, D(2021, 7, 18), Decimal("62000.00")),
    ], EMP)


def test_high_earners(spark):
    out = vw.high_earners_by_dept(_emp(spark), 102, 80000)
    assert sorted(r.employee_id for r in out.collect()) == [2, 5]


def test_bonus_sql_function(spark):
    vw.register_sql_functions(spark)
    df = spark.createDataFrame([(Decimal("75000.00"), 5), (Decimal("75000.00"), 3)], "s decimal(18,2), r int")
    got = [r[0] for r in df.select(vw.annual_bonus("s", "r")).collect()]
    assert got == [Decimal("7500.00"), Decimal("3750.00")]


def test_seniority_edges_and_year_boundaries(spark):
    as_of = F.lit(D(2025, 6, 1))
    df = spark.createDataFrame([(1, "a", 1, D(2020, 12, 31), None), (2, "b", 1, D(2021, 1, 1), None),
                                (3, "c", 1, D(2023, 6, 1), None), (4, "d", 1, D(2024, 12, 31), None)], EMP)
    out = rows(vw.seniority_view(df, as_of).select("employee_id", "years_employed", "seniority_level"), "employee_id")
    assert out == [(1, 5, "Senior"), (2, 4, "Mid-Level"), (3, 2, "Mid-Level"), (4, 1, "Junior")]
    one = spark.range(1).select(S.year_boundaries(F.lit(D(2018, 12, 31)), F.lit(D(2019, 1, 1)))).first()[0]
    assert one == 1


def test_procedure_optional_parameter(spark):
    view = vw.seniority_view(_emp(spark), F.lit(D(2025, 6, 1)))
    assert sorted(r.employee_id for r in vw.employees_by_seniority(view, "Senior").collect()) == [2, 3, 4, 5]
    assert sorted(r.employee_id for r in vw.employees_by_seniority(view, "Senior", 102).collect()) == [2, 5]


def test_sql_table_functions(spark):
    vw.register_table_functions(spark, _emp(spark).withColumn("employee_id", F.col("employee_id").cast("bigint")))
    assert spark.sql("SELECT * FROM employee_function(2)").first().name == "jane Smith"
    got = spark.sql("SELECT employee_id FROM get_high_earners_by_dept(102, 80000) ORDER BY 1").collect()
    assert [r[0] for r in got] == [2, 5]


def test_name_default_and_date_flag(spark):
    df = spark.createDataFrame([(None, D(2019, 7, 31)), ("", D(2019, 8, 1)), ("Ann", None)],
                               "CustomerName string, OrderDate date")
    out = md.silver_enrich(df, flag_before=D(2019, 8, 1), as_of="2024-01-01 00:00:00")
    assert [(r.CustomerName, r.IsFlagged) for r in out.collect()] == [("Unknown", True), ("Unknown", False),
                                                                      ("Ann", False)]


def test_split_one_word_is_null(spark):
    df = spark.createDataFrame([("Mountain",), ("Mountain-200 Black",)], "Item string")
    out = md.product_parts(df).select("Item", "ItemName", "ItemInfo")
    assert rows(out, "Item") == [("Mountain", "Mountain", ""), ("Mountain-200 Black", "Mountain-200", "Black")]
    assert df.select(S.split_word("Item", 1)).first()[0] is None


SCHEMA = StructType([StructField("Country", StringType()), StructField("Region", StringType()),
                     StructField("Happiness_Rank", IntegerType())])


def _csv(tmp_dir, text):
    path = f"{tmp_dir}/in.csv"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_bad_row_modes(spark, tmp_dir):
    path = _csv(tmp_dir, "Country,Region,Happiness_Rank\nA,West,1\nB,East,notanumber\n")
    assert rows(fs.read_csv_typed(spark, path, SCHEMA)) == [("A", "West", 1), ("B", "East", None)]
    assert rows(fs.read_csv_typed(spark, path, SCHEMA, bad_rows="drop")) == [("A", "West", 1)]
    good, bad = fs.read_csv_typed(spark, path, SCHEMA, bad_rows="quarantine")
    assert rows(good) == [("A", "West", 1)] and bad.count() == 1
    with pytest.raises(Exception):
        fs.read_csv_typed(spark, path, SCHEMA, bad_rows="fail").collect()


def test_copy_into_first_row(spark, tmp_dir):
    path = _csv(tmp_dir, "Country;Region;Happiness_Rank\nA;West;1\nB;East;2\n")
    out = fs.copy_into(spark, f"{tmp_dir}/t", path, SCHEMA, field_terminator=";", first_row=2)
    assert rows(out) == [("A", "West", 1), ("B", "East", 2)]
    with pytest.raises(ValueError):
        fs.copy_into(spark, f"{tmp_dir}/t2", path, SCHEMA, first_row=3)


def test_dated_files_by_offset(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/drops")
    for day in ("2026-03-17", "2026-03-18"):
        with open(f"{tmp_dir}/drops/customer_{day}.csv", "w") as f:
            f.write("Country,Region,Happiness_Rank\nA,West,1\n")
    out = fs.read_dated_files(spark, f"{tmp_dir}/drops", SCHEMA, offset=9, length=10)
    assert sorted(r.file_date for r in out.collect()) == [D(2026, 3, 17), D(2026, 3, 18)]
    lin = fs.with_lineage(spark.read.schema(SCHEMA).option("header", True).csv(f"{tmp_dir}/drops"))
    assert all(r.FileName.endswith(".csv") for r in lin.collect())


def test_ensure_table_append_rows_and_query(spark, tmp_dir):
    from lakekit.sources import tables as tb
    schema = "employee_id int, name string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    path = f"{tmp_dir}/emp"
    assert tb.ensure_table(spark, path, st).count() == 0
    tb.append_rows(spark, path, [(1, "John Doe"), (2, "Jane Smith")], st)
    tb.append_query(spark.createDataFrame([(12, "John Smith")], schema), path)
    assert sorted(r.employee_id for r in tb.ensure_table(spark, path, st).collect()) == [1, 2, 12]
    with pytest.raises(Exception):
        tb.ctas(spark.createDataFrame([(3, "x")], schema), path)     # CTAS needs a new table
