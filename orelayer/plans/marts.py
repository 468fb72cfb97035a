"""Staging projections, the two marts and the reports on top of them.

The functions take any fact and dimension tables by column name; the staffing
tables are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import period_label, year_range
from ..session import fits_broadcast

GROUPS_PER_TASK = 250_000  # a row and its place in a hash map take some 200 to 400 bytes
YEARS = 10  # a mart seldom spans more
QUARTERS = (1, 2, 3, 4)
QUARTER_COLUMNS = ["q1", "q2", "q3", "q4"]


@dataclass(frozen=True)
class HireColumns:
    """Where the fact and dimension columns are found."""

    department_id: str = "department_id"
    job_id: str = "job_id"
    hired_at: str = "datetime"
    dim_id: str = "id"
    department: str = "department"
    job_dim_id: str = "id"
    job: str = "job"


HIRES = HireColumns()


# --- staging ----------------------------------------------------------------

def stage_dimension(df: DataFrame, id_column: str, name_column: str) -> DataFrame:
    return df.select(id_column, F.trim(name_column).alias(name_column))


def stage_hires(df: DataFrame, name: str = "name", hired_at: str = "datetime", keep: tuple[str, ...] = ("id", "department_id", "job_id")) -> DataFrame:
    moment = F.col(hired_at).cast("timestamp_ntz")
    return df.select(
        *keep,
        F.trim(name).alias(name),
        moment.alias("hired_at"),
        F.year(moment).alias("hire_year"),
        F.quarter(moment).alias("hire_quarter"),
    )


# --- marts ------------------------------------------------------------------

def _hire_facts(hires: DataFrame, columns: HireColumns, year: int | None) -> DataFrame:
    moment = F.col(columns.hired_at)
    facts = hires.filter(year_range(moment, year)) if year is not None else hires
    dep, job = F.col(columns.department_id), F.col(columns.job_id)
    return facts.filter(dep.isNotNull() & job.isNotNull()).select(
        dep.alias("_dep"),
        job.alias("_job"),
        F.year(moment).alias("hire_year"),
        F.quarter(moment).alias("_quarter"),
    )


def _with_names(
    facts: DataFrame, departments: DataFrame, jobs: DataFrame, columns: HireColumns, keys: list[str], counts: list[Column]
) -> tuple[DataFrame, bool]:
    """Facts with department and job names, and whether they are counted already.

    Where there are few pairs of departments and jobs, both are joined to the
    facts where they lie, and one shuffle of partial counts is left. Otherwise
    nearly every fact is a group of its own, and counts within the tasks that
    read them would only fill their memory: facts are dealt by their whole key
    to as many tasks as their number asks for and counted there, so that the
    joins move one row per group, a department that holds a third of all hires
    is no hot key, and no task holds more groups when there are more facts.
    Names are dealt likewise, for the counts per name that follow.
    """
    dep = departments.select(F.col(columns.dim_id).alias("_dep"), F.col(columns.department).alias("department"))
    job = jobs.select(F.col(columns.job_dim_id).alias("_job"), F.col(columns.job).alias("job"))
    small = fits_broadcast(dep) and fits_broadcast(job)
    if small and dep.count() * job.count() * YEARS <= GROUPS_PER_TASK:
        return facts.join(F.broadcast(dep), "_dep").join(F.broadcast(job), "_job"), False
    tasks = -(-facts.count() // GROUPS_PER_TASK) or 1
    counted = facts.repartition(tasks, "_dep", "_job", *keys).groupBy("_dep", "_job", *keys).agg(*counts)
    if small:
        dep, job = F.broadcast(dep), F.broadcast(job)
    return counted.join(dep, "_dep").join(job, "_job").repartition(tasks, "department", "job"), True


def hires_by_quarter(
    hires: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
    columns: HireColumns = HIRES,
    year: int | None = None,
) -> DataFrame:
    """Hires per department, job and year, one column per quarter."""
    counts = [F.count_if(F.col("_quarter") == q).alias(f"q{q}") for q in QUARTERS]
    facts = _hire_facts(hires, columns, year)
    named, counted = _with_names(facts, departments, jobs, columns, ["hire_year"], counts)
    sums = [F.sum(q).cast("bigint").alias(q) for q in QUARTER_COLUMNS]
    return named.groupBy("department", "job", "hire_year").agg(*(sums if counted else counts))


def hires_pivot(
    hires: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
    year: int,
    columns: HireColumns = HIRES,
) -> DataFrame:
    """One year of the first mart by pivot, without the year column."""
    facts = _hire_facts(hires, columns, year)
    named, counted = _with_names(
        facts, departments, jobs, columns, ["_quarter"], [F.count("*").alias("_n")]
    )
    wide = named.groupBy("department", "job").pivot("_quarter", list(QUARTERS))
    wide = wide.agg(F.sum("_n") if counted else F.count("_quarter"))
    renamed = wide.withColumnsRenamed({str(q): f"q{q}" for q in QUARTERS})
    return renamed.fillna(0, subset=QUARTER_COLUMNS)


def department_hires(
    departments: DataFrame,
    hires: DataFrame,
    year: int,
    columns: HireColumns = HIRES,
    hire_id: str = "id",
) -> DataFrame:
    """Hires of one year per department, zero included."""
    counted = (
        hires.filter(year_range(F.col(columns.hired_at), year))
        .filter(F.col(columns.department_id).isNotNull())
        .groupBy(F.col(columns.department_id).alias("_dep"))
        .agg(F.count(hire_id).alias("_n"))
    )
    dep = departments.select(F.col(columns.dim_id).alias("id"), F.col(columns.department).alias("department"))
    return (
        dep.join(counted, dep["id"] == counted["_dep"], "left")
        .groupBy("id", "department")
        .agg(F.sum(F.coalesce("_n", F.lit(0))).alias("hired"))
    )


def mean_hires(per_department: DataFrame) -> DataFrame:
    """The mean over all departments, rounded for display."""
    return per_department.agg(F.round(F.avg("hired"), 2).alias("mean_hires"))


def above_mean(per_department: DataFrame) -> DataFrame:
    """Departments strictly above the mean; the mean stays inside the plan."""
    mean = per_department.agg(F.avg("hired")).scalar()
    return per_department.filter(F.col("hired") > mean)


# --- reports ----------------------------------------------------------------

def _total() -> Column:
    return sum((F.col(q) for q in QUARTER_COLUMNS[1:]), F.col(QUARTER_COLUMNS[0]))


def with_total(mart: DataFrame) -> DataFrame:
    return mart.select("department", "job", "hire_year", *QUARTER_COLUMNS, _total().alias("total"))


def hires_by_year(mart: DataFrame) -> DataFrame:
    return mart.groupBy("hire_year").agg(F.sum(_total()).alias("total_hires"))


def quarterly_trend(mart: DataFrame) -> DataFrame:
    """Hires per period label. Sums per year first, then turns the four sums
    into rows, so the mart is read once and nothing is multiplied."""
    per_year = mart.groupBy("hire_year").agg(*[F.sum(q).alias(q) for q in QUARTER_COLUMNS])
    long = per_year.unpivot("hire_year", QUARTER_COLUMNS, "_quarter", "hires")
    return long.select(
        period_label(F.col("hire_year"), F.substring("_quarter", 2, 1)).alias("period"), "hires"
    )


def top_departments(mart: DataFrame, n: int = 15) -> DataFrame:
    """Largest departments; the name decides between equal totals."""
    totals = mart.groupBy("department").agg(F.sum(_total()).alias("total_hires"))
    return totals.orderBy(F.desc("total_hires"), F.asc("department")).limit(n)


def sorted_mart(mart: DataFrame) -> DataFrame:
    return mart.orderBy("department", "job", "hire_year")


def above_mean_listing(mart: DataFrame) -> DataFrame:
    return mart.select("department", "hired").orderBy(F.desc("hired"), F.asc("department"))
