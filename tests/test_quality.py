import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orelayer.operators import profiling, quality as q
from orelayer.operators.quality import Rule, utc

NOW = utc(2026, 1, 14, 0, 0)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(i, n, datetime(2026, 1, 13, i)) for i, n in enumerate(["Alice", "Bob", None, "David", "Eve"], 1)],
        "id bigint, name string, created_at timestamp_ntz",
    )


def one(df, kind, severity="error", now=NOW, **config):
    return q.validate(df, [Rule("r", kind, severity, config)], now)


def test_schema_rule(frame):
    assert one(frame, "schema", columns=["id", "name"]).passed
    result = one(frame, "schema", columns=["id", "phone"])
    assert result.failures[0]["message"] == "Missing required columns: ['phone']"


def test_null_rule_counts_one_result_per_column(frame):
    result = one(frame, "null_check", columns=["id", "name", "phone"], max_null_percentage=10)
    assert (result.rules_executed, result.rules_passed, result.rules_failed) == (3, 1, 2)
    assert [f["message"] for f in result.failures] == [
        "Column 'name' has 20.00% nulls (max: 10%)", "Column 'phone' not found"]


def test_null_rule_exactly_at_the_limit_passes(frame):
    assert one(frame, "null_check", columns=["name"], max_null_percentage=20).passed


def test_business_rule(frame):
    assert one(frame, "business_rule", condition="id > 0").passed
    result = one(frame, "business_rule", condition="id > 2")
    assert result.failures[0]["message"] == "Business rule violated: 2 records don't satisfy 'id > 2'"
    assert one(frame, "business_rule", condition="name <> 'Bob' or name is null").rules_failed == 1
    assert one(frame, "business_rule", condition="length(name) > 2").passed  # null is no violation
    assert one(frame, "business_rule").passed  # no condition


def test_freshness_rule(frame):
    assert one(frame, "freshness", column="created_at", max_age_hours=19).passed
    result = one(frame, "freshness", column="created_at", max_age_hours=18)
    assert result.failures[0]["message"] == "Data is 19.0 hours old (max: 18 hours)"
    assert one(frame, "freshness", column="nope").failures[0]["message"] == "Freshness column 'nope' not found"
    empty = frame.withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    assert one(empty, "freshness", column="created_at").passed


def test_volume_rule(frame):
    assert one(frame, "volume", min_rows=5, max_rows=5).passed
    assert one(frame, "volume", min_rows=6).failures[0]["message"] == "Row count 5 below minimum 6"
    assert one(frame, "volume", max_rows=4).failures[0]["message"] == "Row count 5 above maximum 4"


def test_uniqueness_rule(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, 3)], "a int, b int")
    assert one(df, "uniqueness", columns=["a"]).failures[0]["message"] == "Found 2 duplicate records on ['a']"
    assert one(df, "uniqueness", columns=["a", "b"]).failures[0]["details"]["measured"] == 1


def test_severities(frame):
    assert one(frame, "business_rule", "warning", condition="id > 2").passed
    result = one(frame, "business_rule", "warning", condition="id > 2")
    assert (len(result.warnings), len(result.failures), result.rules_executed) == (1, 0, 1)
    info = one(frame, "business_rule", "info", condition="id > 2")
    assert (len(info.warnings), len(info.failures), info.rules_executed, info.rules_passed) == (0, 0, 1, 0)


def test_unknown_type_passes(frame):
    assert one(frame, "magic").rules_passed == 1


def test_rule_that_does_not_resolve_is_an_error(frame):
    result = one(frame, "business_rule", "warning", condition="no_such > 1")
    assert result.rules_failed == 1
    assert result.failures[0]["message"].startswith("Rule execution failed: ")


def test_rule_that_raises_on_the_data_leaves_the_others(frame):
    result = q.validate(frame, [
        Rule("good", "business_rule", config={"condition": "id > 0"}),
        Rule("raises", "business_rule", "warning", {"condition": "1 / (id - 3) > -100"}),
        Rule("unique", "uniqueness", config={"columns": ["id"]}),
    ], NOW)
    assert (result.rules_executed, result.rules_passed, result.rules_failed) == (3, 2, 1)
    assert result.failures[0]["rule_name"] == "raises"


def test_empty_table(frame):
    empty = frame.filter("false")
    result = q.validate(empty, [
        Rule("nulls", "null_check", config={"columns": ["id"]}), Rule("volume", "volume", "warning", {"min_rows": 1}),
        Rule("unique", "uniqueness", config={"columns": ["id"]}), Rule("fresh", "freshness", config={"column": "created_at"}),
        Rule("rule", "business_rule", config={"condition": "id > 0"}),
    ], NOW)
    assert result.passed and len(result.warnings) == 1


def test_no_rules(frame):
    assert q.validate(frame, []).to_dict()["rules_executed"] == 0


def test_gate(frame):
    rules = [{"name": "a", "type": "business_rule", "config": {"condition": "id > 2"}},
             {"name": "b", "type": "volume", "config": {"min_rows": 99}}]
    with pytest.raises(q.ValidationFailed, match="a: .*; b: "):
        q.gate(frame, rules)
    assert q.gate(frame, [{"name": "ok", "type": "volume"}]).passed


def test_rules_from_files(tmp_path, frame):
    (tmp_path / "rules.json").write_text(json.dumps({"rules": q.BRONZE_RULES}))
    assert [r.name for r in q.load_rules(str(tmp_path / "rules.json"))] == [r["name"] for r in q.BRONZE_RULES]
    pytest.importorskip("yaml")
    (tmp_path / "rules.yaml").write_text("rules:\n  - name: v\n    type: volume\n    config: {min_rows: 9}\n")
    rules = q.load_rules(str(tmp_path / "rules.yaml"))
    assert (rules[0].severity, q.validate(frame, rules).rules_failed) == ("error", 1)


def test_shipped_sets():
    assert (len(q.BRONZE_RULES), len(q.SILVER_RULES)) == (8, 8)


def test_checks(frame):
    checks = q.QualityChecks(frame, fail_on_error=False, now=NOW)
    checks.schema(["id", "name", "created_at"]).nulls(["id", "name"]).volume(1, 1000).volume(0, 0)
    checks.freshness("created_at", 48).freshness("nope").duplicates(["id"])
    assert [r["status"] for r in checks.run()] == ["PASSED", "FAILED", "PASSED", "PASSED", "PASSED", "FAILED", "PASSED"]
    with pytest.raises(q.ValidationFailed, match="null_check.*volume_check"):
        q.QualityChecks(frame).nulls(["name"]).volume(min_rows=9).run()


def test_column_tests(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    assert q.not_null_test(df, "a").count() == 1
    assert rows(q.unique_test(df, "a")) == [(1, 2)]


def test_rule_pass_is_one_scan(spark, work):
    path = work.path("in")
    spark.range(10).select("id", (F.col("id") * 2).alias("v"), F.lit(1).alias("unused")).write.parquet(path)
    rules = [Rule("n", "null_check", config={"columns": ["id", "v"]}), Rule("b", "business_rule", config={"condition": "v > id"}),
             Rule("v", "volume", config={"min_rows": 1}), Rule("b2", "business_rule", config={"condition": "id >= 0"})]
    plan = q.rules_report(spark.read.parquet(path), rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "unused" not in q.rules_report(
        spark.read.parquet(path), rules)._jdf.queryExecution().executedPlan().toString()


# --- profiles ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def wild(spark):
    return spark.createDataFrame(
        [(1, None, 7, 0.0, "", datetime(2024, 1, 1)), (2, None, 7, -1.5, " ", datetime(2024, 1, 3, 12)),
         (3, None, 7, 2.0, "abc", None), (3, None, 7, 2.0, "abc", None)],
        "id int, nothing string, same int, amount double, text string, day timestamp_ntz",
    )


def profiled(df, **kw):
    return {r["name"]: r for r in profiling.profile_columns(df, **kw).collect()}


def test_profile_columns(wild):
    p = profiled(wild)
    assert (p["nothing"]["null_count"], p["nothing"]["null_percentage"], p["nothing"]["distinct_count"]) == (4, 100.0, 0)
    assert p["nothing"]["min_length"] is None and p["nothing"]["empty_count"] == 0
    assert (p["same"]["distinct_count"], p["same"]["std"], p["same"]["median"]) == (1, 0.0, 7.0)
    amount = p["amount"]
    assert (amount["min"], amount["max"], amount["median"], amount["zeros_count"], amount["negative_count"]) == (-1.5, 2.0, 1.0, 1, 1)
    assert (amount["mean"], amount["std"]) == (0.62, 1.7)  # half to even
    text = p["text"]
    assert (text["min_length"], text["max_length"], text["avg_length"], text["empty_count"]) == (0, 3, 1.75, 2)
    day = p["day"]
    assert (day["min_date"], day["max_date"], day["date_range_days"]) == ("2024-01-01 00:00:00", "2024-01-03 12:00:00", 2)
    assert list(p["id"]["sample_values"]) == ["1", "2", "3"]
    assert p["id"]["distinct_percentage"] == 75.0


def test_profile_median_against_pandas(spark, work):
    df = spark.range(999).select(((F.col("id") * 7919) % 500).alias("a"), F.sqrt("id").alias("b"), F.lit(3).alias("c"))
    got = {n: r["median"] for n, r in profiled(df, work=work).items()}
    assert got == df.toPandas().median().astype(float).to_dict()


def test_profile_median_of_large_integers(spark):
    df = spark.sql("select explode(array(9007199254740993L, 9007199254740992L)) as a")
    assert profiled(df)["a"]["distinct_count"] == 2  # equal as doubles


def test_profile_with_sketches(wild):
    p = profiled(wild, exact=False)
    assert p["amount"]["median"] is not None and p["id"]["distinct_count"] == 3


def test_profile_of_an_empty_frame(wild):
    p = profiled(wild.filter("false"))
    assert (p["id"]["null_percentage"], p["id"]["distinct_count"], p["id"]["min"]) == (0.0, 0, None)
    overview = profiling.profile_overview(wild.filter("false")).first()
    assert (overview["total_rows"], overview["duplicate_percentage"]) == (0, 0.0)
    score = profiling.quality_score(profiling.profile_columns(wild.filter("false"))).first()
    assert (score["overall_score"], score["completeness"], score["uniqueness"]) == (0.0, 0.0, 0.0)


def test_overview_and_score(wild):
    overview = profiling.profile_overview(wild).first()
    assert tuple(overview) == (4, 6, 1, 25.0)
    score = profiling.quality_score(profiling.profile_columns(wild)).first()
    # 6 of 24 cells are null; the distinct counts are 3, 0, 1, 3, 3, 2
    assert (score["completeness"], score["uniqueness"], score["overall_score"]) == (75.0, 50.0, 67.5)


def test_whole_profile(wild):
    row = profiling.profile(wild, "wild").first()
    assert row["source_name"] == "wild" and row["overview"]["total_rows"] == 4 and len(row["columns"]) == 6


def test_profile_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n2,\n")
    row = profiling.profile_file(spark, str(tmp_path / "a.csv")).first()
    assert row["source_name"] == "a.csv" and row["file_info"]["files"] == 1
    assert row["overview"]["total_rows"] == 2 and row["quality_score"]["completeness"] == 75.0


def test_column_tests(spark, rows):
    tables = {
        "departments": spark.createDataFrame([(1, "a"), (1, None)], "id int, department string"),
        "jobs": spark.createDataFrame([(1, "j")], "id int, job string"),
        "hired_employees": spark.createDataFrame(
            [(1, "n", datetime(2021, 1, 1), 1, 1), (2, None, None, 9, None)],
            "id int, name string, datetime timestamp_ntz, department_id int, job_id int"),
    }
    got = {tuple(r)[:3]: r["failures"] for r in q.run_column_tests(tables).collect()}
    assert got[("departments", "id", "unique")] == 1
    assert got[("departments", "department", "not_null")] == 1
    assert got[("hired_employees", "department_id", "relationships")] == 1
    assert got[("hired_employees", "job_id", "relationships")] == 0  # a null key is not an orphan
    assert got[("hired_employees", "job_id", "not_null")] == 1
    assert len(got) == 3 + 3 + 8


def test_names_with_dots(spark, work):
    df = spark.range(4).selectExpr("id as `a.b`", "cast(null as string) as `c``d`", "timestamp'2024-01-01 00:00:00' as `t.s`")
    found = {r["name"]: (r["null_count"], r["distinct_count"]) for r in profiling.profile_columns(df, work=work).collect()}
    assert found == {"a.b": (0, 4), "c`d": (4, 0), "t.s": (0, 1)}
    assert len(profiling.profile_columns(df, exact=False).collect()) == 3
    rules = [{"name": "n", "type": "null_check", "config": {"columns": ["a.b", "c`d"]}}, {"name": "f", "type": "freshness", "config": {"column": "t.s", "max_age_hours": 1}}]
    assert [r["passed"] for r in q.rules_report(df, rules).orderBy("position").collect()] == [True, False, False]
