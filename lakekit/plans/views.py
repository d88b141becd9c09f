"""Views, table functions, scalar functions and procedures.

A view or table function is a Python function of DataFrames (so it composes with
snapshot reads: bind the inputs at one time and call it).  The same objects are
also registered in Spark SQL — a temp view, SQL table functions and a SQL scalar
function — so SQL users get them too.  None of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.scalar import year_boundaries

# Seniority thresholds in years (>= 5 Senior, >= 2 Mid-Level, else Junior).
SENIOR_YEARS = 5
MID_YEARS = 2


def seniority_view(employees: DataFrame, as_of: Column) -> DataFrame:
    """``vw_employees``: years employed (year boundaries, as DATEDIFF(year)) and a level (V1)."""
    years = F.col("years_employed")
    level = F.when(years >= SENIOR_YEARS, "Senior").when(years >= MID_YEARS, "Mid-Level").otherwise("Junior")
    return employees.select("employee_id", "name", "department_id", "hire_date", "salary",
                            year_boundaries("hire_date", as_of).alias("years_employed")).withColumn("seniority_level", level)


def employees_by_seniority(view: DataFrame, seniority_level: str, department_id: int | None = None) -> DataFrame:
    """Procedure with an optional parameter (V10, P16): the department filter is added only
    when the argument is given, so no ``@d IS NULL OR`` predicate reaches the scan."""
    out = view.filter(F.col("seniority_level") == seniority_level)
    if department_id is not None:
        out = out.filter(F.col("department_id") == department_id)
    return out


def employee_by_id(employees: DataFrame, employee_id: int) -> DataFrame:
    """Inline table function by id (V6)."""
    return employees.filter(F.col("employee_id") == employee_id)


def high_earners_by_dept(employees: DataFrame, dept_id: int, min_salary) -> DataFrame:
    """Table function with two parameters (V7)."""
    return (employees.filter((F.col("department_id") == dept_id) & (F.col("salary") >= F.lit(min_salary)))
            .select("employee_id", "name", "salary"))


def employee_tenure(employees: DataFrame, employee_id: int, as_of: Column) -> DataFrame:
    """Table function with date arithmetic."""
    return (employees.filter(F.col("employee_id") == employee_id)
            .select("name", "hire_date", year_boundaries("hire_date", as_of).alias("years_employed")))


def salary_range(employees: DataFrame, lo, hi) -> DataFrame:
    """Closed range ``salary >= lo AND salary <= hi`` (P5)."""
    return employees.filter(F.col("salary").between(F.lit(lo), F.lit(hi)))


BONUS_FUNCTION = "calculate_annual_bonus"


def register_sql_functions(spark: SparkSession) -> None:
    """SQL scalar function for the bonus (V9): 10 % at rating 5, else 5 %.  Runs in the JVM."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {BONUS_FUNCTION}(salary DECIMAL(18,2), performance_rating INT)
        RETURNS DECIMAL(18,2)
        RETURN CAST(CASE WHEN performance_rating = 5 THEN salary * 0.10 ELSE salary * 0.05 END AS DECIMAL(18,2))""")


def annual_bonus(salary: Column | str, rating: Column | str) -> Column:
    """Column expression calling the registered SQL function."""
    s = F.col(salary) if isinstance(salary, str) else salary
    r = F.col(rating) if isinstance(rating, str) else rating
    return F.call_function(BONUS_FUNCTION, s.cast("decimal(18,2)"), r.cast("int"))


def register_table_functions(spark: SparkSession, employees: DataFrame, trips: DataFrame | None = None) -> None:
    """SQL table functions over temp views, for SQL users (V5-V8)."""
    employees.createOrReplaceTempView("lk_employees")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION employee_function(p_id BIGINT)
                 RETURNS TABLE (employee_id BIGINT, name STRING, department_id INT, hire_date DATE,
                                salary DECIMAL(18,2))
                 RETURN SELECT employee_id, name, department_id, hire_date, salary FROM lk_employees
                        WHERE employee_id = p_id""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION get_high_earners_by_dept(p_dept INT, p_min DECIMAL(18,2))
                 RETURNS TABLE (employee_id BIGINT, name STRING, salary DECIMAL(18,2))
                 RETURN SELECT employee_id, name, salary FROM lk_employees
                        WHERE department_id = p_dept AND salary >= p_min""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION get_employee_tenure(p_id BIGINT, p_as_of DATE)
                 RETURNS TABLE (name STRING, hire_date DATE, years_employed INT)
                 RETURN SELECT name, hire_date, year(p_as_of) - year(hire_date) FROM lk_employees
                        WHERE employee_id = p_id""")
    if trips is not None:
        trips.createOrReplaceTempView("lk_trips")
        spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION trips_by_min_passenger_count(num_passengers BIGINT)
                     RETURNS TABLE (trip_id BIGINT, pickup_datetime TIMESTAMP_NTZ)
                     RETURN SELECT trip_id, pickup_datetime FROM lk_trips WHERE passenger_count >= num_passengers""")
