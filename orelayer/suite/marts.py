"""Marts and reports: suppliers as departments, parts as jobs, lineitems as hires."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import marts
from ..plans.marts import HireColumns
from .base import query, table

LINES = HireColumns("l_suppkey", "l_partkey", "l_shipdate", "s_suppkey", "s_name", "p_partkey", "p_name")
ORDERS = HireColumns(department_id="o_custkey", hired_at="o_orderdate", dim_id="c_custkey", department="c_name")
YEAR = 1997

MART_SQL = """
select s_name as department, p_name as job, cast(year(l_shipdate) as integer) as hire_year,
       count(*) filter (where quarter(l_shipdate) = 1) as q1,
       count(*) filter (where quarter(l_shipdate) = 2) as q2,
       count(*) filter (where quarter(l_shipdate) = 3) as q3,
       count(*) filter (where quarter(l_shipdate) = 4) as q4
from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey
group by s_name, p_name, year(l_shipdate)
"""
DEPARTMENT_SQL = f"""
select c_custkey as id, c_name as department, count(o_orderkey) as hired
from customer left join orders on c_custkey = o_custkey and year(o_orderdate) = {YEAR}
group by c_custkey, c_name
"""


def mart(spark: SparkSession, sf: str, year: int | None = None) -> DataFrame:
    return marts.hires_by_quarter(
        table(spark, sf, "lineitem"), table(spark, sf, "supplier"), table(spark, sf, "part"), LINES, year
    )


def per_department(spark: SparkSession, sf: str) -> DataFrame:
    return marts.department_hires(
        table(spark, sf, "customer"), table(spark, sf, "orders"), YEAR, ORDERS, hire_id="o_orderkey"
    )


@query("mart_by_quarter", MART_SQL)
def mart_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf)


@query("mart_one_year", f"select * from ({MART_SQL}) where hire_year = {YEAR}")
def mart_one_year(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, YEAR)


@query("mart_one_year_pivot", f"select department, job, q1, q2, q3, q4 from ({MART_SQL}) where hire_year = {YEAR}")
def mart_one_year_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return marts.hires_pivot(
        table(spark, sf, "lineitem"), table(spark, sf, "supplier"), table(spark, sf, "part"), YEAR, LINES
    )


@query("department_hires", DEPARTMENT_SQL)
def department_hires(spark: SparkSession, sf: str) -> DataFrame:
    return per_department(spark, sf)


@query("above_mean", f"""
with dept_counts as ({DEPARTMENT_SQL}), mean_val as (select avg(hired) as m from dept_counts)
select id, department, hired from dept_counts cross join mean_val where hired > m""")
def above_mean(spark: SparkSession, sf: str) -> DataFrame:
    return marts.above_mean(per_department(spark, sf))


@query("mean_hires", f"select round(avg(hired), 2) as mean_hires from ({DEPARTMENT_SQL})")
def mean_hires(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mean_hires(per_department(spark, sf))


@query("above_mean_listing", f"""
with dept_counts as ({DEPARTMENT_SQL}), mean_val as (select avg(hired) as m from dept_counts)
select department, hired from dept_counts cross join mean_val where hired > m order by hired desc, department""")
def above_mean_listing(spark: SparkSession, sf: str) -> DataFrame:
    return marts.above_mean_listing(marts.above_mean(per_department(spark, sf)))


@query("mart_total", f"select *, q1 + q2 + q3 + q4 as total from ({MART_SQL})")
def mart_total(spark: SparkSession, sf: str) -> DataFrame:
    return marts.with_total(mart(spark, sf))


@query("mart_sorted", f"select * from ({MART_SQL}) order by department, job, hire_year")
def mart_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return marts.sorted_mart(mart(spark, sf))


@query("by_year", f"""
select hire_year, cast(sum(q1 + q2 + q3 + q4) as bigint) as total_hires from ({MART_SQL}) group by hire_year""")
def by_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.hires_by_year(mart(spark, sf))


@query("quarter_trend", f"""
with m as ({MART_SQL}), t as (
  select hire_year, 1 as q, sum(q1) as hires from m group by hire_year union all
  select hire_year, 2, sum(q2) from m group by hire_year union all
  select hire_year, 3, sum(q3) from m group by hire_year union all
  select hire_year, 4, sum(q4) from m group by hire_year)
select hire_year || '-Q' || q as period, cast(sum(hires) as bigint) as hires from t group by hire_year, q""")
def quarter_trend(spark: SparkSession, sf: str) -> DataFrame:
    return marts.quarterly_trend(mart(spark, sf))


@query("top15", f"""
select department, cast(sum(q1 + q2 + q3 + q4) as bigint) as total_hires
from ({MART_SQL}) group by department order by total_hires desc, department limit 15""")
def top15(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_departments(mart(spark, sf))


@query("staging_hires", """
select event_id, user_id, trim('  ' || event_type || ' ') as name, ts as hired_at,
       cast(year(ts) as integer) as hire_year, cast(quarter(ts) as integer) as hire_quarter
from events""")
def staging_hires(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("name", F.concat(F.lit("  "), "event_type", F.lit(" ")))
    return marts.stage_hires(events, hired_at="ts", keep=("event_id", "user_id"))


@query("staging_dimension", "select p_partkey, trim(' ' || p_name || '  ') as p_name from part")
def staging_dimension(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").withColumn("p_name", F.concat(F.lit(" "), "p_name", F.lit("  ")))
    return marts.stage_dimension(part, "p_partkey", "p_name")
