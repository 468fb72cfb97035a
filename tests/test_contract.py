from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orelayer.functions import iso_timestamp, strip
from orelayer.operators import contract as c
from orelayer.operators.contract import DEPARTMENTS, HIRED_EMPLOYEES, JOBS, Contract
from orelayer.operators.keys import annotate_fk, orphan_values, orphans


def staff(spark, *values):
    return spark.createDataFrame(list(values), HIRED_EMPLOYEES.string_schema())


def reasons(df):
    return [r["reason"] for r in c.rejected(df, "t").collect()]


def test_department_accepts_and_strips(spark):
    df = spark.createDataFrame([("1", "Engineering"), ("2", "\tHR\n"), ("3", " Ops ")], DEPARTMENTS.string_schema())
    got = {r["id"]: r["department"] for r in c.accepted(DEPARTMENTS.annotate(df)).collect()}
    assert got == {1: "Engineering", 2: "HR", 3: "Ops"}


@pytest.mark.parametrize("row, reason", [
    (("1", "   "), "department is empty"),
    (("3", "\t"), "department is empty"),
    (("4", None), "department is empty"),
    (("abc", "Sales"), "id is null/invalid"),
    ((None, None), "id is null/invalid; department is empty"),
])
def test_department_rejects(spark, row, reason):
    df = spark.createDataFrame([row], DEPARTMENTS.string_schema())
    assert reasons(DEPARTMENTS.annotate(df)) == [reason]


def test_job(spark):
    df = spark.createDataFrame([("12", "Data Engineer"), ("12", "")], JOBS.string_schema())
    marked = JOBS.annotate(df)
    assert c.accepted(marked).count() == 1
    assert reasons(marked) == ["job is empty"]


def test_employee_rows(spark):
    good = "2021-11-07T02:48:00Z"
    df = staff(
        spark,
        ("101", "John Doe", good, "5", "96"),
        ("102", "John Doe", "2021/11/07 02:48", "5", "96"),
        ("103", " ", good, "5", "96"),
        ("104", "Ana", "2021-01-01T02:00:00+05:00", "5", "96"),
        ("105", "Bo", "2021", "5", "96"),
        ("106", "Cy", "2021-11-07", "5", "96"),
        (None, "Di", good, "5", "96"),
        (None, "Di", good, "5", "96"),
        ("x", "", None, "y", "z"),
    )
    marked = HIRED_EMPLOYEES.annotate(df)
    ok = {r["id"]: r["datetime"] for r in c.accepted(marked).collect()}
    assert ok == {
        101: datetime(2021, 11, 7, 2, 48),
        104: datetime(2021, 1, 1, 2, 0),  # the offset is dropped, not applied
        106: datetime(2021, 11, 7),
    }
    assert sorted(reasons(marked)) == sorted([
        "datetime is empty/invalid format",
        "name is empty",
        "datetime is empty/invalid format",
        "id is null/invalid",
        "id is null/invalid",
        "id is null/invalid; name is empty; datetime is empty/invalid format; "
        "department_id is null/invalid; job_id is null/invalid",
    ])


def test_no_row_is_lost(spark):
    """An id that only fails in the cast is rejected, not dropped."""
    df = spark.createDataFrame(
        [("1", "a"), ("abc", "b"), (None, "c"), ("2", " ")], DEPARTMENTS.string_schema()
    )
    marked = DEPARTMENTS.annotate(df)
    assert c.accepted(marked).count() + c.rejected(marked, "t").count() == df.count()


def test_rejected_row_keeps_the_source_text(spark):
    df = spark.createDataFrame([("abc", " x ")], DEPARTMENTS.string_schema())
    row = c.rejected(DEPARTMENTS.annotate(df), "departments").first()
    assert row["raw_row"] == '{"id":"abc","department":" x "}'
    assert row["table_name"] == "departments"


@pytest.mark.parametrize("text, value", [
    ("2021-11-07T02:48:00.123456", datetime(2021, 11, 7, 2, 48, 0, 123456)),
    ("2021-11-07 02:48", datetime(2021, 11, 7, 2, 48)),
    ("2021-11-07T02:48:00-03:30", datetime(2021, 11, 7, 2, 48)),
    ("2021-13-01", None),
    ("2021-02-30T00:00:00", None),
    ("20211107T024800", None),
    ("2021-11-07T02:48:00.1234567", None),
    ("2021-11-07T02:48:00+99:00", None),
    ("2021-11-07T25:00:00", None),
    (" 2021-11-07", None),
    ("", None),
    (None, None),
])
def test_iso_timestamp(spark, text, value):
    df = spark.createDataFrame([(text,)], "s string").select(iso_timestamp(F.col("s")).alias("t"))
    assert df.first()["t"] == value


def test_strip_is_the_same_as_python(spark):
    texts = ["", "  a b ", "\t\n x\r\f\v", "\x1c\x1fy\x1e", " z　", "\x85w\xa0", "a​b"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [tuple(r) for r in df.select("s", strip(F.col("s")).alias("t")).collect()]
    assert got == [(t, t.strip()) for t in texts]


def test_typed_source_is_accepted(spark):
    df = spark.sql("select 1 as id, 'A' as name, timestamp_ntz'2021-01-02 03:04:05' as datetime, 2 as department_id, 3L as job_id")
    assert c.accepted(HIRED_EMPLOYEES.annotate(df)).first()["datetime"] == datetime(2021, 1, 2, 3, 4, 5)


def test_declared_schema(spark):
    sales = c.SALES
    row = ("t1", "c1", "p1", "2", "1.5", "3.0", "2024-01-01", None, None)
    df = spark.createDataFrame(
        [row, ("t2", "c", "p", "0", "1", "1", "2024-01-01", None, None), ("t3", "c", "p", "many", "-1", "1", "x", None, None)],
        sales.string_schema(),
    )
    marked = sales.annotate(df)
    first = c.accepted(marked).first()
    assert (first["quantity"], first["unit_price"], first["transaction_date"]) == (2, 1.5, datetime(2024, 1, 1))
    assert sorted(reasons(marked)) == [
        "quantity is below 1",
        "quantity is null/invalid; unit_price is below 0; transaction_date is empty/invalid format",
    ]


def test_declared_schema_missing_column(spark):
    df = spark.createDataFrame([("t1",)], "transaction_id string")
    with pytest.raises(c.MissingColumnsError, match="customer_id"):
        c.SALES.annotate(df)


def test_undeclared_columns_pass_through(spark):
    small = Contract.from_declared({"columns": [{"name": "a", "type": "integer", "required": True}]})
    df = spark.createDataFrame([("1", "keep")], "a string, b string")
    assert tuple(c.apply_contract(df, small).first()) == (1, "keep")


def parents(spark):
    return {
        "departments": spark.createDataFrame([(5, "a"), (6, "b")], "id int, department string"),
        "jobs": spark.createDataFrame([(96, "j")], "id int, job string"),
    }


def test_fk_violation_texts(spark):
    good = "2021-11-07T02:48:00Z"
    df = staff(spark, ("1", "Harold", good, "5", "96"), ("2", "Mimi", good, "10", "96"), ("3", "Zoe", good, "11", "7"),
               ("4", "", good, "12", "96"))
    checked = annotate_fk(HIRED_EMPLOYEES.annotate(df), HIRED_EMPLOYEES.foreign_keys, parents(spark))
    assert [r["id"] for r in c.accepted(checked).collect()] == [1]
    assert sorted(reasons(checked)) == sorted([
        "FK Violation: department_id 10 not in raw.departments",
        "FK Violation: department_id 11 not in raw.departments; job_id 7 not in raw.jobs",
        "name is empty",  # already rejected: not checked again
    ])
    raw = [r["raw_row"] for r in c.rejected(checked, "t").collect()]
    assert all(good in r for r in raw)  # the text as it was read


def test_fk_with_many_parents_gives_the_same(spark, work, rows):
    good = "2021-11-07T02:48:00Z"
    df = staff(spark, *[(str(i), "n", good, str(i % 9), "96") for i in range(60)])
    marked = HIRED_EMPLOYEES.annotate(df)
    few = annotate_fk(marked, HIRED_EMPLOYEES.foreign_keys, parents(spark))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        many = annotate_fk(marked, HIRED_EMPLOYEES.foreign_keys, parents(spark), work)
        plain = annotate_fk(marked, HIRED_EMPLOYEES.foreign_keys, parents(spark))
        expected = rows(few.select("id", c.REASONS))
        assert rows(many.select("id", c.REASONS)) == expected
        assert rows(plain.select("id", c.REASONS)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_null_keys_are_no_orphans(spark, rows):
    child = spark.createDataFrame([(1, None), (2, 5), (3, 9), (4, 9)], "id int, department_id int")
    parent = parents(spark)["departments"]
    assert rows(orphan_values(child, "department_id", parent)) == [(9, 2)]
    assert rows(orphans(child, "department_id", parent)) == [(3, 9), (4, 9)]


def test_quarantine_null_predicate_is_no_violation(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    ok, bad = c.quarantine(df, {"positive": "v > 0"}, "t")
    assert sorted(r["id"] for r in ok.collect()) == [1, 2]
    assert [r["reason"] for r in bad.collect()] == ["positive"]


def test_each_pattern_is_matched_once(spark, work):
    """Reasons are found from the typed values, not by matching every pattern a second time."""
    spark.createDataFrame([("1", " x ", "2021-01-01T10:00:00+05:00", "2", "3"), ("x", "\t", "2021/01/01", None, "4")], HIRED_EMPLOYEES.string_schema()).write.parquet(work.path("h"))
    checked = HIRED_EMPLOYEES.annotate(spark.read.parquet(work.path("h")))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(") == 1 and plan.count("regexp_replace(") == 2
    assert checked.columns == [*HIRED_EMPLOYEES.columns, c.REASONS, c.SOURCE]
    got = {r["_source"]["id"]: (r["name"], r["datetime"] is None, r[c.REASONS]) for r in checked.collect()}
    assert got == {"1": ("x", False, []), "x": ("", True, [
        "id is null/invalid", "name is empty", "datetime is empty/invalid format", "department_id is null/invalid"])}
