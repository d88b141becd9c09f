"""Registered views, functions and procedures over customers-as-employees, plus the store union."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.functions.scalar import year_boundaries
from lakekit.plans import fixtures as fx
from lakekit.plans import views as vw
from lakekit.plans import warehouse as wh
from lakekit.plans.registry import query
from lakekit.sources.tables import load

SQL_ASOF_DATE = "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"
SQL_VIEW = fx.SQL_EMPLOYEES + f""",
vw AS (SELECT employee_id, name, department_id, hire_date, salary,
              CAST(year({SQL_ASOF_DATE}) - year(hire_date) AS INTEGER) AS years_employed,
              CASE WHEN year({SQL_ASOF_DATE}) - year(hire_date) >= 5 THEN 'Senior'
                   WHEN year({SQL_ASOF_DATE}) - year(hire_date) >= 2 THEN 'Mid-Level'
                   ELSE 'Junior' END AS seniority_level
       FROM employees)"""

SENIORITY_DEPT = 7
EMPLOYEE_ID = 2
HIGH_EARNER_DEPT, HIGH_EARNER_MIN = 10, 50000
SALARY_LO, SALARY_HI = 65000, 75000


def _asof_date(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(F.max("o_orderdate").cast("date")).scalar()


def _view(spark, sf_dir):
    return vw.seniority_view(fx.employees(spark, sf_dir), _asof_date(spark, sf_dir))


@query("seniority_level", f"WITH {SQL_VIEW} SELECT * FROM vw")
def q_seniority_level(spark, sf_dir):
    return _view(spark, sf_dir)


@query("employees_by_seniority", f"WITH {SQL_VIEW} SELECT * FROM vw WHERE seniority_level = 'Senior'")
def q_employees_by_seniority(spark, sf_dir):
    return vw.employees_by_seniority(_view(spark, sf_dir), "Senior")


@query("employees_by_seniority_dept", f"""WITH {SQL_VIEW}
SELECT * FROM vw WHERE seniority_level = 'Senior' AND department_id = {SENIORITY_DEPT}""")
def q_employees_by_seniority_dept(spark, sf_dir):
    return vw.employees_by_seniority(_view(spark, sf_dir), "Senior", SENIORITY_DEPT)


@query("employee_by_id", f"WITH {fx.SQL_EMPLOYEES} SELECT * FROM employees WHERE employee_id = {EMPLOYEE_ID}")
def q_employee_by_id(spark, sf_dir):
    return vw.employee_by_id(fx.employees(spark, sf_dir), EMPLOYEE_ID)


@query("high_earners_by_dept", f"""WITH {fx.SQL_EMPLOYEES}
SELECT employee_id, name, salary FROM employees
WHERE department_id = {HIGH_EARNER_DEPT} AND salary >= {HIGH_EARNER_MIN}""")
def q_high_earners_by_dept(spark, sf_dir):
    return vw.high_earners_by_dept(fx.employees(spark, sf_dir), HIGH_EARNER_DEPT, HIGH_EARNER_MIN)


@query("employee_tenure", f"""WITH {fx.SQL_EMPLOYEES}
SELECT name, hire_date, CAST(year({SQL_ASOF_DATE}) - year(hire_date) AS INTEGER) AS years_employed
FROM employees WHERE employee_id = {EMPLOYEE_ID}""")
def q_employee_tenure(spark, sf_dir):
    return vw.employee_tenure(fx.employees(spark, sf_dir), EMPLOYEE_ID, _asof_date(spark, sf_dir))


@query("years_employed", f"""WITH {fx.SQL_EMPLOYEES}
SELECT employee_id, hire_date, CAST(year({SQL_ASOF_DATE}) - year(hire_date) AS INTEGER) AS years_employed
FROM employees""")
def q_years_employed(spark, sf_dir):
    e = fx.employees(spark, sf_dir)
    return e.select("employee_id", "hire_date",
                    year_boundaries("hire_date", _asof_date(spark, sf_dir)).alias("years_employed"))


@query("annual_bonus", f"""WITH {fx.SQL_EMPLOYEES}
SELECT employee_id, name, salary, CAST(department_id % 5 + 1 AS INTEGER) AS rating,
       CAST(CASE WHEN department_id % 5 + 1 = 5 THEN salary * 0.10 ELSE salary * 0.05 END AS DECIMAL(18,2)) AS bonus
FROM employees""")
def q_annual_bonus(spark, sf_dir):
    vw.register_sql_functions(spark)
    e = fx.employees(spark, sf_dir).withColumn("rating", (F.col("department_id") % 5 + 1).cast("int"))
    return e.select("employee_id", "name", "salary", "rating", vw.annual_bonus("salary", "rating").alias("bonus"))


@query("range_filter", f"""WITH {fx.SQL_EMPLOYEES}
SELECT * FROM employees WHERE salary >= {SALARY_LO} AND salary <= {SALARY_HI}""")
def q_range_filter(spark, sf_dir):
    return vw.salary_range(fx.employees(spark, sf_dir), SALARY_LO, SALARY_HI)


# Two stores overlapping in the middle of the balance range (fixed split values).
STORE_A_BELOW, STORE_B_FROM = 5000.0, 2000.0


@query("union_all_stores", f"""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal < {STORE_A_BELOW}
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal >= {STORE_B_FROM}""")
def q_union_all_stores(spark, sf_dir):
    s = load(spark, sf_dir, "supplier")
    a = s.filter(F.col("s_acctbal") < STORE_A_BELOW)
    b = s.filter(F.col("s_acctbal") >= STORE_B_FROM)
    return wh.union_all_stores(a, b)


@query("compare_stores", f"""
(SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'a' AS only_in FROM (
   SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal < {STORE_A_BELOW}
   EXCEPT ALL
   SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal >= {STORE_B_FROM}))
UNION ALL
(SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'b' AS only_in FROM (
   SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal >= {STORE_B_FROM}
   EXCEPT ALL
   SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal < {STORE_A_BELOW}))""")
def q_compare_stores(spark, sf_dir):
    """The comparison the reference's comment announces next to its store union."""
    s = load(spark, sf_dir, "supplier")
    a = s.filter(F.col("s_acctbal") < STORE_A_BELOW)
    b = s.filter(F.col("s_acctbal") >= STORE_B_FROM)
    return wh.compare_stores(a, b)


# ------------------------------------------------------------------ the same functions, called from SQL

def _sql_functions(spark, sf_dir):
    vw.register_table_functions(spark, fx.employees(spark, sf_dir), fx.taxi_trips(spark, sf_dir))
    return spark


@query("sql_employee_function", f"WITH {fx.SQL_EMPLOYEES} SELECT * FROM employees WHERE employee_id = {EMPLOYEE_ID}")
def q_sql_employee_function(spark, sf_dir):
    return _sql_functions(spark, sf_dir).sql(f"SELECT * FROM employee_function({EMPLOYEE_ID})")


@query("sql_high_earners", f"""WITH {fx.SQL_EMPLOYEES}
SELECT employee_id, name, salary FROM employees WHERE department_id = {HIGH_EARNER_DEPT} AND salary >= {HIGH_EARNER_MIN}""")
def q_sql_high_earners(spark, sf_dir):
    return _sql_functions(spark, sf_dir).sql(f"SELECT * FROM get_high_earners_by_dept({HIGH_EARNER_DEPT}, {HIGH_EARNER_MIN})")


@query("sql_employee_tenure", f"""WITH {fx.SQL_EMPLOYEES}
SELECT name, hire_date, CAST(2000 - year(hire_date) AS INTEGER) AS years_employed FROM employees WHERE employee_id = {EMPLOYEE_ID}""")
def q_sql_employee_tenure(spark, sf_dir):
    return _sql_functions(spark, sf_dir).sql(f"SELECT * FROM get_employee_tenure({EMPLOYEE_ID}, DATE '2000-06-01')")


@query("sql_trips_function", f"WITH {fx.SQL_TRIPS} SELECT trip_id, pickup_datetime FROM trips WHERE passenger_count >= 3")
def q_sql_trips_function(spark, sf_dir):
    return _sql_functions(spark, sf_dir).sql("SELECT * FROM trips_by_min_passenger_count(3)")
