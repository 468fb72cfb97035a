from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orelayer.plans import marts

HIRED = "id int, name string, datetime timestamp_ntz, department_id int, job_id int"


@pytest.fixture
def tables(spark):
    d = spark.createDataFrame([(1, "HR"), (2, "Ops"), (3, "Idle"), (4, "Even")], "id int, department string")
    j = spark.createDataFrame([(1, "Clerk"), (2, "Boss")], "id int, job string")
    h = spark.createDataFrame([
        (1, "a", datetime(2021, 1, 1), 1, 1), (2, "b", datetime(2021, 12, 31, 23, 59, 59), 1, 1),
        (3, "c", datetime(2022, 1, 1), 1, 1), (4, "d", datetime(2021, 5, 1), 2, 2), (5, "e", datetime(2021, 5, 1), 4, 2),
        (6, "f", datetime(2021, 5, 1), None, 2), (7, "g", datetime(2021, 5, 1), 9, 2), (8, "h", datetime(2021, 6, 1), 1, None),
    ], HIRED)
    return h, d, j


EXPECTED = [("Even", "Boss", 2021, 0, 1, 0, 0), ("HR", "Clerk", 2021, 1, 0, 0, 1), ("HR", "Clerk", 2022, 1, 0, 0, 0),
            ("Ops", "Boss", 2021, 0, 1, 0, 0)]


def test_by_quarter(tables, rows):
    mart = marts.hires_by_quarter(*tables)
    assert mart.columns == ["department", "job", "hire_year", "q1", "q2", "q3", "q4"]
    assert rows(mart) == EXPECTED
    assert rows(marts.hires_by_quarter(*tables, year=2021)) == [r for r in EXPECTED if r[2] == 2021]


def test_large_dimensions_give_the_same(spark, tables, rows):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        mart = marts.hires_by_quarter(*tables)
        assert "BroadcastHashJoin" not in mart._jdf.queryExecution().executedPlan().toString()
        assert rows(mart) == EXPECTED
        assert rows(marts.hires_pivot(*tables, 2021)) == [(r[0], r[1], *r[3:]) for r in EXPECTED if r[2] == 2021]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_tasks_hold_no_more_groups_when_there_are_more_facts(spark, work, rows, monkeypatch):
    """Nearly every hire is a group of its own: they are counted in as many tasks as their number asks for."""
    monkeypatch.setattr(marts, "GROUPS_PER_TASK", 100)
    spark.range(60).selectExpr("cast(id as int) id", "concat('d', id % 50) department").write.parquet(work.path("d"))
    spark.range(60).selectExpr("cast(id as int) id", "concat('j', id) job").write.parquet(work.path("j"))
    spark.range(3000).selectExpr(
        "cast(id as int) id", "timestamp_ntz'2021-01-01' + make_interval(0, cast(id % 30 as int)) as datetime",
        "cast(id % 60 as int) department_id", "cast(id div 60 as int) job_id",
    ).coalesce(1).write.parquet(work.path("h"))
    hires, dep, job = (spark.read.parquet(work.path(n)) for n in "hdj")
    mart = marts.hires_by_quarter(hires, dep, job)
    want = hires.join(dep, hires.department_id == dep.id).join(job, hires.job_id == job.id).groupBy(
        "department", "job", F.year("datetime"), F.quarter("datetime")).count()
    got = {(r[0], r[1], r[2], q): r[f"q{q}"] for r in mart.collect() for q in marts.QUARTERS if r[f"q{q}"]}
    assert got == {tuple(r)[:4]: r[4] for r in want.collect()}
    assert max(r[1] for r in mart.groupBy(F.spark_partition_id()).count().collect()) <= 400
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.rindex("Exchange hashpartitioning(_dep")  # no counts where the files are read
    year = marts.hires_pivot(hires, dep, job, 2021)
    assert rows(year) == rows(mart.where("hire_year = 2021").drop("hire_year"))


def test_repeated_dimension_rows_multiply_like_a_join(spark, tables, rows):
    hires, dep, job = tables
    twice = dep.unionAll(dep.filter("id = 2"))
    got = rows(marts.hires_by_quarter(hires, twice, job))
    assert ("Ops", "Boss", 2021, 0, 2, 0, 0) in got


def test_pivot(tables, rows):
    assert rows(marts.hires_pivot(*tables, 2021)) == [(r[0], r[1], *r[3:]) for r in EXPECTED if r[2] == 2021]


def test_above_mean(tables, rows):
    hires, dep, _ = tables
    per = marts.department_hires(dep, hires, 2021)
    assert rows(per) == [(1, "HR", 3), (2, "Ops", 1), (3, "Idle", 0), (4, "Even", 1)]
    assert marts.mean_hires(per).first()[0] == 1.25  # zero counts too
    assert rows(marts.above_mean(per)) == [(1, "HR", 3)]
    equal = marts.department_hires(dep.filter("id in (2, 4)"), hires, 2021)
    assert marts.above_mean(equal).count() == 0  # at the mean is not above it


def test_reports(tables, rows):
    mart = marts.hires_by_quarter(*tables)
    assert rows(marts.hires_by_year(mart)) == [(2021, 4), (2022, 1)]
    trend = dict(rows(marts.quarterly_trend(mart)))
    assert trend["2021-Q2"] == 2 and trend["2022-Q4"] == 0 and len(trend) == 8
    top = [tuple(r) for r in marts.top_departments(mart, 2).collect()]
    assert top == [("HR", 3), ("Even", 1)]  # the name decides the tie
    assert {r["total"] for r in marts.with_total(mart).collect()} == {1, 2}
    assert [r["department"] for r in marts.sorted_mart(mart).collect()] == ["Even", "HR", "HR", "Ops"]
    listing = marts.above_mean_listing(marts.department_hires(tables[1], tables[0], 2021)).collect()
    assert [r["department"] for r in listing] == ["HR", "Even", "Ops", "Idle"]


def test_quarters_add_up(tables):
    hires, dep, job = tables
    joined = hires.join(dep, hires.department_id == dep.id).join(job, hires.job_id == job.id).count()
    assert marts.hires_by_year(marts.hires_by_quarter(*tables)).agg(F.sum("total_hires")).first()[0] == joined


def test_year_filter_reaches_the_scan(spark, work, tables):
    hires, dep, job = tables
    hires.write.parquet(work.path("h"))
    plan = marts.hires_by_quarter(spark.read.parquet(work.path("h")), dep, job, year=2021)
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(datetime,2021-01-01T00:00)" in text and "LessThan(datetime,2022-01-01T00:00)" in text
    assert "ReadSchema: struct<datetime:timestamp_ntz,department_id:int,job_id:int>" in text


def test_mean_reuses_the_counts(spark, tables):
    """The comparison and the mean share one shuffle of the counts."""
    hires, dep, _ = tables
    above = marts.above_mean(marts.department_hires(dep, hires, 2021))
    above.collect()
    text = above._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
