from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orelayer.operators import quality as q
from orelayer.operators.contract import DEPARTMENTS, HIRED_EMPLOYEES, JOBS, SALES_DECLARED
from orelayer.plans import pipelines as p
from orelayer.plans.registry import Registry
from orelayer.sources import files, sinks
from orelayer.sources.files import SourceError

GOOD = "2021-11-07T02:48:00Z"


@pytest.fixture
def lake(work):
    return p.Lake.under(work.path("lake"))


def departments(spark, *rows):
    return spark.createDataFrame(list(rows), DEPARTMENTS.string_schema())


def staff(spark, *rows):
    return spark.createDataFrame(list(rows), HIRED_EMPLOYEES.string_schema())


def test_load_counts_and_tables(spark, lake, rows):
    p.load(spark, departments(spark, ("5", "HR"), ("6", "Ops")), DEPARTMENTS, lake, 1)
    p.load(spark, spark.createDataFrame([("96", "Recruiter")], JOBS.string_schema()), JOBS, lake, 1)
    batch = staff(spark, ("1", "Harold", GOOD, "5", "96"), ("2", "Mimi", GOOD, "10", "96"), ("3", " ", GOOD, "5", "96"))
    result = p.load(spark, batch, HIRED_EMPLOYEES, lake, "b1")
    assert (result.rows, result.inserted, result.rejected, result.conflicts, result.skipped) == (3, 1, 2, 0, 0)
    assert rows(p.read_silver(spark, lake, HIRED_EMPLOYEES)) == [(1, "Harold", datetime(2021, 11, 7, 2, 48), 5, 96)]
    log = p.read_rejections(spark, lake)
    assert rows(log, "table_name", "reason") == [
        ("hired_employees", "FK Violation: department_id 10 not in raw.departments"), ("hired_employees", "name is empty")]
    assert log.filter("rejected_at is null").count() == 0


def test_load_again_adds_nothing_and_replay_repeats(spark, lake, rows):
    batch = departments(spark, ("1", "A"), ("2", "B"))
    first = p.load(spark, batch, DEPARTMENTS, lake, 1)
    again = p.load(spark, batch, DEPARTMENTS, lake, 2)
    replay = p.load(spark, batch, DEPARTMENTS, lake, 1)
    assert (first.inserted, again.inserted, again.skipped, replay.inserted) == (2, 0, 2, 2)
    assert rows(p.read_silver(spark, lake, DEPARTMENTS)) == [(1, "A"), (2, "B")]


def test_existing_row_wins(spark, lake, rows):
    p.load(spark, departments(spark, ("1", "Sales")), DEPARTMENTS, lake, 1)
    result = p.load(spark, departments(spark, ("1", "Marketing")), DEPARTMENTS, lake, 2)
    assert result.conflicts == 1
    assert rows(p.read_silver(spark, lake, DEPARTMENTS)) == [(1, "Sales")]
    assert rows(p.read_rejections(spark, lake), "reason") == [
        ("CONFLICT: id=1 exists with different data — department: 'Sales' → 'Marketing'",)]


def test_only_bad_rows_are_still_logged(spark, lake):
    result = p.load(spark, departments(spark, ("x", "A"), (None, " ")), DEPARTMENTS, lake, 1)
    assert (result.inserted, result.rejected) == (0, 2)
    assert p.read_rejections(spark, lake).count() == 2


def test_empty_batch(spark, lake):
    result = p.load(spark, departments(spark, ("1", "A")).filter("false"), DEPARTMENTS, lake, 1)
    assert result.rows == 0
    assert p.read_silver(spark, lake, DEPARTMENTS).count() == 0


def test_staging_is_removed(spark, lake, work):
    from orelayer.session import list_names, shared_dir

    p.load(spark, departments(spark, ("1", "A")), DEPARTMENTS, lake, 1)
    assert not [n for n in list_names(spark, shared_dir(spark)) if n.startswith("load-departments")]


def test_batch_lands_in_bronze(spark, lake, rows):
    p.load_batch(spark, departments(spark, ("1", " A "), ("x", "B")), DEPARTMENTS, lake, 1, day="2024-01-01")
    landed = files.read_bronze(spark, lake.bronze, "departments")
    assert rows(landed.select("id", "department")) == [("1", "A")]
    assert p.bronze_to_silver(spark, DEPARTMENTS, lake, 2).skipped == 1


def test_load_csv_with_and_without_header(spark, lake, tmp_path):
    (tmp_path / "a.csv").write_text("id,department\n1,A\nabc,B\n")
    (tmp_path / "b.csv").write_text("2,C\n")
    assert p.load_csv(spark, str(tmp_path / "a.csv"), DEPARTMENTS, lake, 1).inserted == 1
    assert p.load_csv(spark, str(tmp_path / "b.csv"), DEPARTMENTS, lake, 2, header=False).inserted == 1
    (tmp_path / "c.csv").write_text('"department","id"\n"D, E",3\nF,4,LOST\n')
    turned = p.load_csv(spark, str(tmp_path / "c.csv"), DEPARTMENTS, lake, 3)
    assert (turned.inserted, turned.rejected) == (1, 1)
    assert p.read_rejections(spark, lake).where("reason = 'row has 3 fields, header has 2'").first()["raw_row"] == '{"id":"4","department":"F"}'


def test_batch_report_writes_nothing(spark, lake, rows):
    p.load(spark, departments(spark, ("1", "A")), DEPARTMENTS, lake, 1)
    report = p.batch_report(spark, departments(spark, ("1", "A"), ("1", "A"), ("2", "B"), ("x", "C")), DEPARTMENTS, lake)
    assert rows(report, "outcome", "copies", "reason") == [
        ("new", 1, None), ("rejected", 1, "id is null/invalid"), ("skipped", 2, None)]
    assert p.read_silver(spark, lake, DEPARTMENTS).count() == 1


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "departments.csv").write_text("1,HR\n2,Ops\n3,Idle\n")
    (tmp_path / "jobs.csv").write_text("1,Recruiter\n2,Manager\n")
    (tmp_path / "hired_employees.csv").write_text(
        "1,A,2021-01-01T00:00:00Z,1,1\n2,B,2021-12-31T23:59:59Z,1,1\n3,C,2022-01-01T00:00:00Z,1,1\n"
        "4,D,2021-04-01T00:00:00Z,2,2\n5,,2021-04-01T00:00:00Z,2,2\n6,F,2021-05-01T00:00:00Z,9,2\n"
        "7,G,2021-05-01T00:00:00Z,1,2\n,H,2021-05-01T00:00:00Z,1,2\n,H,2021-05-01T00:00:00Z,1,2\n")
    return str(tmp_path)


def test_full_run(spark, lake, csv_dir, rows):
    first = p.run_all(spark, csv_dir, lake, "2024-01-01")
    assert first["landed"] == ["departments", "jobs", "hired_employees"]
    loaded = first["loads"]["hired_employees"]
    assert (loaded["inserted"], loaded["rejected"]) == (5, 4)  # rows without id: one rejection each
    assert first["marts"] == {
        "status": "ok", "source_rows_total": 5, "mart_hires_by_quarter_rows": 4, "mart_departments_above_mean_rows": 1,
        "mean_hires_per_department_2021": 1.33}
    mart = spark.read.parquet(f"{lake.gold}/mart_hires_by_quarter").drop("_refreshed_at")
    assert rows(mart) == [
        ("HR", "Manager", 2021, 0, 1, 0, 0), ("HR", "Recruiter", 2021, 1, 0, 0, 1),
        ("HR", "Recruiter", 2022, 1, 0, 0, 0), ("Ops", "Manager", 2021, 0, 1, 0, 0)]
    above = spark.read.parquet(f"{lake.gold}/mart_departments_above_mean").drop("_refreshed_at")
    assert rows(above) == [(1, "HR", 3)]

    second = p.run_all(spark, csv_dir, lake, "2024-01-02")
    assert second["loads"]["hired_employees"]["inserted"] == 0
    assert second["loads"]["hired_employees"]["skipped"] == 5
    assert second["marts"]["source_rows_total"] == 5
    third = p.run_all(spark, csv_dir, lake, "2024-01-02")  # the same day again
    assert third["landed"] == [] and third["marts"] == second["marts"]


def test_missing_file_lands_nothing(spark, lake, tmp_path):
    (tmp_path / "departments.csv").write_text("1,HR\n")
    assert p.land_sources(spark, str(tmp_path), lake, "2024-01-01") == []
    assert p.bronze_to_silver(spark, DEPARTMENTS, lake, 1) is None
    with pytest.raises(SourceError, match="empty"):
        p.refresh_marts(spark, lake)


def test_last_partition_wins(spark, lake, rows):
    sinks.append_bronze(departments(spark, ("1", "Old"), ("2", "B")), lake.bronze, "departments", "2024-01-01")
    sinks.append_bronze(departments(spark, ("1", "New")), lake.bronze, "departments", "2024-01-02")
    p.bronze_to_silver(spark, DEPARTMENTS, lake, 1)
    assert rows(p.read_silver(spark, lake, DEPARTMENTS)) == [(1, "New"), (2, "B")]
    assert p.bronze_to_silver(spark, DEPARTMENTS, lake, 2, since="2024-01-02").rows == 1


def test_a_bad_row_never_stands_in_for_a_good_one(spark, lake, rows):
    sinks.append_bronze(departments(spark, ("1", "Good"), ("2", "Old")), lake.bronze, "departments", "2024-01-01")
    sinks.append_bronze(departments(spark, ("1", " "), ("2", "New")), lake.bronze, "departments", "2024-01-02")
    result = p.bronze_to_silver(spark, DEPARTMENTS, lake, 1)
    assert (result.rows, result.inserted, result.rejected, result.superseded) == (4, 2, 1, 1)
    assert rows(p.read_silver(spark, lake, DEPARTMENTS)) == [(1, "Good"), (2, "New")]
    assert rows(p.read_rejections(spark, lake), "raw_row") == [('{"id":"1","department":" "}',)]


def _land(spark, lake, day, *rows):
    sinks.append_bronze(departments(spark, *rows), lake.bronze, "departments", day)


def test_late_rows_and_days_are_loaded_once(spark, lake, rows):
    _land(spark, lake, "2024-01-01", ("1", "A"))
    _land(spark, lake, "2024-01-03", ("3", "C"), ("x", "bad"))
    assert p.load_new_files(spark, DEPARTMENTS, lake, "2024-01-03").inserted == 2
    _land(spark, lake, "2024-01-01", ("9", "late"))
    _land(spark, lake, "2024-01-02", ("2", "B"), ("y", "bad"))
    for _ in range(2):  # the run and its replay
        result = p.load_new_files(spark, DEPARTMENTS, lake, "2024-01-05")
        assert (result.rows, result.inserted, result.rejected) == (3, 2, 1)
    assert p.load_new_files(spark, DEPARTMENTS, lake, "2024-01-03").rows == 3  # its own files only
    assert p.load_new_files(spark, DEPARTMENTS, lake, "2024-01-06").rows == 0
    assert [r[0] for r in rows(p.read_silver(spark, lake, DEPARTMENTS))] == [1, 2, 3, 9]
    assert p.read_rejections(spark, lake).count() == 2


def test_a_load_that_broke_off_is_taken_back(spark, lake, rows, monkeypatch):
    _land(spark, lake, "2024-01-01", ("1", "A"), ("x", "bad"))
    with monkeypatch.context() as patch:
        patch.setattr(p.delta, "status_counts", lambda outcome: 1 / 0)  # after table and log were written
        with pytest.raises(ZeroDivisionError):
            p.load_new_files(spark, DEPARTMENTS, lake, "b1")
    assert p.read_silver(spark, lake, DEPARTMENTS).count() == 1
    _land(spark, lake, "2024-01-02", ("1", "other"))
    result = p.load_new_files(spark, DEPARTMENTS, lake, "b2")
    assert (result.rows, result.inserted, result.rejected, result.superseded) == (3, 1, 1, 1)
    assert rows(p.read_silver(spark, lake, DEPARTMENTS)) == [(1, "other")]
    assert p.read_rejections(spark, lake).count() == 1
    assert p.load_new_files(spark, DEPARTMENTS, lake, "b1").rows == 0  # its files are b2's now
    assert rows(p.read_silver(spark, lake, DEPARTMENTS)) == [(1, "other")]


def test_a_replaced_file_is_a_new_one(spark, lake, rows):
    sinks.append_files(departments(spark, ("1", "A")), lake.bronze, "departments", "2024-01-01", "s-0")
    p.load_new_files(spark, DEPARTMENTS, lake, "b1")
    sinks.append_files(departments(spark, ("1", "A"), ("2", "B")), lake.bronze, "departments", "2024-01-01", "s-0")
    result = p.load_new_files(spark, DEPARTMENTS, lake, "b2")
    assert (result.inserted, result.skipped) == (1, 1)


def test_restore_touches_one_table(spark, lake, work, csv_dir):
    p.run_all(spark, csv_dir, lake, "2024-01-01")
    root = work.path("backups")
    sinks.backup(spark.createDataFrame([(2, "Ops")], DEPARTMENTS.typed_schema()), root, DEPARTMENTS, "2024-01-01")
    result = p.restore_table(spark, root, DEPARTMENTS, lake)
    assert result["rows_restored"] == 1
    assert result["orphans"] == {"hired_employees.department_id": 4}
    assert p.read_silver(spark, lake, HIRED_EMPLOYEES).count() == 5


def test_backup_and_status_of_the_lake(spark, lake, work, csv_dir, rows):
    p.run_all(spark, csv_dir, lake, "2024-01-01")
    assert rows(p.lake_status(spark, lake)) == [("departments", 3), ("hired_employees", 5), ("jobs", 2), ("rejected_log", 4)]
    root, before = work.path("backups"), rows(p.read_silver(spark, lake, HIRED_EMPLOYEES, loaded_at=True))
    assert p.backup_table(spark, root, HIRED_EMPLOYEES, lake, "2024-01-01")["rows_backed_up"] == 5
    p.load(spark, staff(spark, ("50", "New", GOOD, "1", "1")), HIRED_EMPLOYEES, lake, "later")
    result = p.restore_table(spark, root, HIRED_EMPLOYEES, lake)
    assert result["rows_restored"] == 5 and set(result["orphans"].values()) == {0}
    assert rows(p.read_silver(spark, lake, HIRED_EMPLOYEES, loaded_at=True)) == before
    assert all(r[-1] is not None for r in before)


SALES = "transaction_id,customer_id,product_id,quantity,unit_price,total_amount,transaction_date,customer_email,notes\n"


def test_extract(spark, work, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(SALES + "t1,c,p,2,1.5,3.0,2024-01-01T00:00:00,,\nt2,c,p,0,1.5,3.0,2024-01-02T00:00:00,,\n"
                    "t3,c,p,1,1.5,1.5,2024-01-03T00:00:00,,\n")
    run = p.extract(spark, str(path), work.path("bronze"), SALES_DECLARED, now=datetime(2024, 1, 5, 6, 7, 8), reject_path=work.path("log"))
    assert run.target.endswith("sales_20240105_060708.parquet")
    assert (run.records, run.metadata["rejected"], run.metadata["schema_applied"]) == (2, 1, True)
    row = spark.read.parquet(run.target).first()
    assert (row["_source_entity"], row["_schema_version"], row["quantity"]) == ("sales.csv", "1.0", 2)
    assert spark.read.parquet(work.path("log")).first()["reason"] == "quantity is below 1"
    newer = p.extract(spark, str(path), work.path("inc"), SALES_DECLARED, watermark=("transaction_date", datetime(2024, 1, 2)))
    assert newer.records == 1 and newer.metadata["incremental"]
    none = p.extract(spark, str(path), work.path("none"), SALES_DECLARED, watermark=("transaction_date", datetime(2025, 1, 1)))
    assert none.records == 0
    plain = p.extract(spark, str(path), work.path("plain"))
    assert plain.records == 3 and spark.read.parquet(plain.target).first()["_schema_version"] == "inferred"


def test_gated_pipeline(spark, work, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(SALES + "t1,c,p,2,1.5,3.0,2024-01-01T00:00:00,e,n\n")
    run = lambda rules, out: p.gated_pipeline(
        spark, str(path), work.path(f"bronze-{out}"), work.path(out), lambda df: df.select("transaction_id", "quantity"),
        q.BRONZE_RULES, rules, SALES_DECLARED)
    done = run([{"name": "v", "type": "volume", "config": {"min_rows": 1}}], "ok")
    assert done.bronze.passed and done.silver.passed and done.run.records == 1
    with pytest.raises(q.ValidationFailed, match="below minimum"):
        run([{"name": "v", "type": "volume", "config": {"min_rows": 2}}], "bad")
    path.write_text(SALES + "t1,c,p,2,-1.5,-3.0,2024-01-01T00:00:00,e,n\n")
    declared = {"columns": [{**col, "validation": {}} for col in SALES_DECLARED["columns"]]}
    with pytest.raises(q.ValidationFailed, match="positive_prices"):
        p.gated_pipeline(spark, str(path), work.path("b3"), work.path("stop"), lambda df: df, q.BRONZE_RULES, [], declared)
    assert p.exists(spark, work.path("stop")) is False  # the transform never ran


def test_runs_leave_records(spark, work, tmp_path):
    path, records = tmp_path / "in.csv", work.path("records")
    path.write_text("id,v\n1,a\n2,b\n")
    rule = lambda n: [{"name": "v", "type": "volume", "config": {"min_rows": n}}]
    run = lambda n: p.gated_pipeline(spark, str(path), work.path(f"b{n}"), work.path("t"), lambda df: df, rule(1), rule(n), name="g", records=records)
    run(2)
    with pytest.raises(q.ValidationFailed):
        run(3)
    read = lambda kind: sinks.read_records(spark, records, kind).orderBy(F.col(sinks.RUN_RECORDS[kind].split()[0])).collect()
    assert [(r["pipeline_name"], r["status"], r["records_processed"]) for r in read("pipeline_runs")] == [("g", "success", 2), ("g", "failed", None)]
    assert "below minimum" in read("pipeline_runs")[1]["error_message"]
    assert [(r["transformer_name"], r["records_processed"], r["status"]) for r in read("transformation_runs")] == [("g", 2, "success")] * 2
    assert [(r["layer"], r["rules_failed"], r["passed"]) for r in read("validation_runs")] == [("bronze", 0, True), ("silver", 0, True), ("bronze", 0, True), ("silver", 1, False)]
    with pytest.raises(ZeroDivisionError):
        p.run_transform(spark.range(3), lambda df: 1 / 0, work.path("x"), "broken", records=records)
    last = read("transformation_runs")[-1]
    assert (last["transformer_name"], last["status"], last["error_message"]) == ("broken", "failed", "ZeroDivisionError: division by zero")


def test_a_transform_and_an_extract_read_their_source_once(spark, work, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(SALES + "".join(f"t{i},c,p,2,1.5,3.0,2024-01-01T00:00:00,,\n" for i in range(50)))
    seen = spark.sparkContext.accumulator(0)

    def counted(df):
        def each(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.mapInArrow(each, df.schema)

    run = p.run_transform(spark.range(1000), counted, work.path("t"))
    assert run.records == 1000 and seen.value == 1000
    read, scans = p.files.read_file, []
    p.files.read_file = lambda *a, **k: scans.append(1) or counted(read(*a, **k))
    try:
        done = p.extract(spark, str(path), work.path("b"), SALES_DECLARED, reject_path=work.path("log"))
    finally:
        p.files.read_file = read
    assert (done.records, done.metadata["rejected"], len(scans), seen.value) == (50, 0, 1, 1050)


def test_old_rejections_are_not_logged_again(spark, work, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(SALES + "t1,c,p,0,1.5,3.0,2024-01-01T00:00:00,,\nt2,c,p,0,1.5,3.0,2024-01-03T00:00:00,,\nt3,c,p,1,1.5,1.5,2024-01-04T00:00:00,,\n")
    for n, day, wanted in ((0, 1, 2), (1, 2, 3), (2, 5, 3)):
        mark = ("transaction_date", datetime(2023 if n == 0 else 2024, 1, day))
        p.extract(spark, str(path), work.path(f"b{n}"), SALES_DECLARED, watermark=mark, reject_path=work.path("log"))
        assert spark.read.parquet(work.path("log")).count() == wanted


def test_run_transform_counts_what_it_wrote(spark, work):
    target = work.path("t")
    for expected in (10, 10):
        run = p.run_transform(spark.range(20), lambda df: df.filter("id < 10"), target, "half", "src")
        assert run.records == expected
    assert p.run_transform(spark.range(3), lambda df: df, target, mode="overwrite").records == 3


def test_from_config(spark, work):
    spark.range(5).write.parquet(work.path("in"))
    steps = Registry()
    steps.register("even", lambda df: df.filter("id % 2 = 0"))
    run = p.from_config({"bronze_path": work.path("in"), "silver_table": work.path("out"), "config": {"steps": ["even"], "name": "e"}}, steps)
    assert run(spark).records == 3
    with pytest.raises(KeyError):
        p.from_config({"bronze_path": "x", "silver_table": "y", "config": {"steps": ["odd"]}}, steps)


def test_table_counts(spark, rows):
    assert rows(p.table_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
