import csv
import io
import pathlib
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orelayer.operators.contract import DEPARTMENTS, HIRED_EMPLOYEES
from orelayer.sources import config, files, jdbc, sinks


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_text(text, encoding=encoding)
    return str(path)


def test_csv_with_header(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", "id,name\n1,x\nabc,\n")
    assert rows(files.read_csv(spark, path)) == [("1", "x"), ("abc", None)]


def test_csv_without_header(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", "1,x\n2,\"y,z\"\n")
    df = files.read_csv(spark, path, ["id", "name"], files.CsvOptions(header=False))
    assert rows(df) == [("1", "x"), ("2", "y,z")]


def test_csv_options(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", "id;name\n1;é\n2;NA\n3;-\n", "iso-8859-1")
    df = files.read_file(spark, path, {"csv": {"delimiter": ";", "encoding": "iso-8859-1", "na_values": ["NA", "-"]}})
    assert rows(df) == [("1", "é"), ("2", None), ("3", None)]


@pytest.mark.parametrize("header", [True, False])
def test_csv_skiprows_over_many_splits(spark, tmp_path, header):
    body = "".join(f"{i},n{i}\n" for i in range(20000))
    path = write(tmp_path, "a.csv", "report\nof today\n" + ("id,name\n" if header else "") + body)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        df = files.read_csv(spark, path, None if header else ["id", "name"], files.CsvOptions(skiprows=2, header=header))
        assert df.columns == ["id", "name"]
        assert df.select(F.count("*"), F.min(F.col("id").cast("int")), F.max(F.col("id").cast("int"))).first() == (20000, 0, 19999)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_csv_skiprows_na_values(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", "x\nid,name\n1,NA\n2,b\n")
    df = files.read_csv(spark, path, options=files.CsvOptions(skiprows=1, na_values=("NA",)))
    assert rows(df) == [("1", None), ("2", "b")]
    write(tmp_path, "b.csv", "y\nname,id\nc,3\n")  # a folder: each file has its own lines and header
    assert rows(files.read_csv(spark, str(tmp_path), options=files.CsvOptions(skiprows=1))) == [("1", "NA"), ("2", "b"), ("3", "c")]


def _plain_csv(text, skip):
    return list(csv.reader(io.StringIO("\n".join(text.split("\n")[skip:]))))


@pytest.mark.parametrize("seed,skip", [(1, 0), (2, 3), (3, 0), (4, 1)])
def test_records_over_splits(spark, tmp_path, work, rows, seed, skip):
    """Line breaks, quotes and separators in quotes, in files that are cut anywhere, against Python's reader."""
    r = random.Random(seed)
    cell = lambda: "".join(r.choice(["a", "bc", "é", "\n", "\n\n", ",", '"', " "]) for _ in range(r.randrange(6)))
    want = []
    for name in ("a", "b", "c"):
        names = ["id", "name", 'odd "x", y']
        r.shuffle(names)
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL)
        writer.writerow(names)
        for i in range(60):
            row = {"id": f"{name}{i}", "name": cell() + "z", 'odd "x", y': cell() + "z"}
            writer.writerow([row[n] for n in names])
        text = "".join(f'skipped "line {k}\n' for k in range(skip)) + out.getvalue()
        write(tmp_path, f"{name}.csv", text)
        want += [tuple(dict(zip(names, x))[n] for n in ("id", "name", 'odd "x", y')) for x in _plain_csv(text, skip)[1:]]
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        found = files.read_csv_by_name(spark, str(tmp_path), ["id", "name", 'odd "x", y'], files.CsvOptions(skiprows=skip), work)
        assert found.where("_problem is not null").isEmpty()
        assert rows(found.drop("_problem")) == sorted(want, key=lambda x: tuple(map(str, x)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_records_are_written_once(spark, tmp_path, work):
    """Staging takes no more than one copy of the texts, and no text is shuffled but those that cross splits."""
    r = random.Random(5)
    want = {str(i): "\n".join(f"{r.getrandbits(400):x}" for _ in range(r.randrange(1, 40))) for i in range(400)}
    want["long"] = "\n".join(f'"{r.getrandbits(400):x}"' for _ in range(2000))  # over several splits
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([("id", "text"), *want.items()])
    path = write(tmp_path, "a.csv", out.getvalue())
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        found = files.read_csv_by_name(spark, path, work=work)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert dict(map(tuple, found.select("id", "text").collect())) == want
    staged = sum(f.stat().st_size for f in pathlib.Path(work.root).rglob("*.parquet"))
    assert staged < 1.5 * len(out.getvalue())
    assert spark.read.parquet(work.path("pieces")).where("not part").count() >= 400 - 20
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_headers_of_each_file(spark, tmp_path, work, rows):
    write(tmp_path, "a.csv", "id,department\n1,A\n2,B,LOST\n3,\n")
    write(tmp_path, "b.csv", '"department",id\n"C, D",4\n')
    write(tmp_path, "c.csv", "id,other\n5,x\n")
    got = files.read_csv_by_name(spark, str(tmp_path), ["id", "department"], work=work)
    assert rows(got) == [
        ("1", "A", None), ("2", "B", "row has 3 fields, header has 2"), ("3", None, None), ("4", "C, D", None),
        ("5", None, "column department is not in the header")]


def test_json(spark, tmp_path, rows):
    array = write(tmp_path, "a.json", '[{"id": 1},\n {"id": 2}]')
    lines = write(tmp_path, "a.jsonl", '{"id": 3}\n{"id": 4}\n')
    assert rows(files.read_file(spark, array)) == [(1,), (2,)]
    assert rows(files.read_file(spark, lines)) == [(3,), (4,)]


def test_detect_format(tmp_path, spark):
    assert [files.detect_format(f"x/y.{e}") for e in ("csv", "PARQUET", "json", "jsonl")] == ["csv", "parquet", "json", "jsonl"]
    with pytest.raises(files.SourceError):
        files.detect_format("a.xyz")
    path = write(tmp_path, "a.csv", "id\n")
    assert files.check_file(spark, path, "csv") == "csv"
    with pytest.raises(files.SourceError, match="expected"):
        files.check_file(spark, path, "json")
    with pytest.raises(files.SourceError, match="not found"):
        files.check_file(spark, str(tmp_path / "none.csv"))


def test_file_info(spark, tmp_path):
    path = write(tmp_path, "a.csv", "id\n" * 10)
    row = files.file_info(spark, path).first()
    assert (row["file_name"], row["size_bytes"]) == ("a.csv", 30)
    assert row["modified_at"] is not None


def test_required_sources(spark, tmp_path):
    there = write(tmp_path, "a.csv", "x")
    paths = {"a": there, "b": str(tmp_path / "b.csv")}
    assert files.missing_sources(spark, paths) == ["b"]
    assert files.require_sources(spark, paths, "skip") is False
    assert files.require_sources(spark, {"a": there})
    with pytest.raises(files.SourceError, match="'b'"):
        files.require_sources(spark, paths)


def test_path_or_table(spark, work):
    spark.range(3).write.parquet(work.path("x"))
    spark.range(2).createOrReplaceTempView("two_rows")
    assert files.read_path_or_table(spark, work.path("x")).count() == 3
    assert files.read_path_or_table(spark, table="two_rows").count() == 2
    with pytest.raises(files.SourceError):
        files.read_path_or_table(spark)


def test_newer_than_is_pushed_down(spark, work):
    spark.range(10).write.parquet(work.path("x"))
    df = files.newer_than(spark.read.parquet(work.path("x")), "id", 7)
    assert "GreaterThan(id,7)" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 2
    with pytest.raises(files.SourceError):
        files.newer_than(df, "nope", 1)


def test_bronze_append_and_landing(spark, work, rows):
    df, base = spark.range(2), work.path("bronze")
    sinks.append_bronze(df, base, "t", date(2024, 1, 1))
    sinks.append_bronze(df, base, "t", date(2024, 1, 1))  # adds files, rewrites none
    assert sinks.land_bronze(df, base, "t", "2024-01-02") is True
    assert sinks.land_bronze(df, base, "t", "2024-01-02") is False
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/u/ingested_date=2024-01-03")
    assert sinks.land_bronze(df.limit(0), base, "u", "2024-01-03") is False  # whole without a mark
    found = files.read_bronze(spark, base, "t")
    assert rows(found.groupBy("ingested_date").count()) == [(date(2024, 1, 1), 4), (date(2024, 1, 2), 2)]
    path = files.bronze_path(base, "t")
    assert files.partition_values(spark, path, "ingested_date") == ["2024-01-01", "2024-01-02"]
    assert files.latest_partition(spark, path, "ingested_date") == "2024-01-02"
    assert files.read_latest_partition(spark, path, "ingested_date").count() == 2
    assert files.partition_values(spark, work.path("none"), "x") == []


def test_bronze_merges_schemas(spark, work):
    base = work.path("bronze")
    sinks.append_bronze(spark.sql("select 1 as a"), base, "t", "2024-01-01")
    sinks.append_bronze(spark.sql("select 2 as a, 'x' as b"), base, "t", "2024-01-02")
    assert files.read_bronze(spark, base, "t", merge_schema=True).select("a", "b").filter("b is null").count() == 1


def test_extract_layout(spark, work):
    path = sinks.write_extract(spark.range(4).withColumn("p", F.col("id") % 2), work.root, "orders", datetime(2024, 1, 2, 3, 4, 5), ["p"])
    assert path.endswith("/orders_20240102_030405.parquet")
    assert files.partition_values(spark, path, "p") == ["0", "1"]


def test_batches_replace_themselves(spark, work, rows):
    path, schema = work.path("t"), spark.range(0).schema
    assert sinks.read_batches(spark, path, schema).count() == 0
    sinks.write_batch(spark.range(3), path, 1)
    sinks.write_batch(spark.range(5, 6), path, 2)
    sinks.write_batch(spark.range(2), path, 1)
    assert rows(sinks.read_batches(spark, path, schema)) == [(0,), (1,), (5,)]
    assert rows(sinks.read_batches(spark, path, schema, without=1)) == [(5,)]


def test_rejection_log(spark, work):
    df = spark.createDataFrame([("t", "{}", "bad")], "table_name string, raw_row string, reason string")
    sinks.append_rejections(df, work.path("log"))
    sinks.append_rejections(df, work.path("log"))
    log = spark.read.parquet(work.path("log"))
    assert log.columns == ["table_name", "raw_row", "reason", "rejected_at"] and log.count() == 2


def test_backup_and_restore(spark, work, rows):
    root, target = work.path("backup"), work.path("silver")
    df = spark.createDataFrame(
        [(1, "a", datetime(2021, 1, 2, 3, 4, 5), 1, 2), (2, "b", datetime(2021, 1, 2, 3, 4, 5, 600), 1, 2)],
        HIRED_EMPLOYEES.typed_schema(),
    ).withColumn("_loaded_at", F.lit(datetime(2024, 1, 1)))
    path = sinks.backup(df, root, HIRED_EMPLOYEES, date(2024, 1, 1))
    text = {r["id"]: r["datetime"] for r in spark.read.parquet(path).collect()}
    assert text == {1: "2021-01-02T03:04:05", 2: "2021-01-02T03:04:05.000600"}
    assert sinks.restore(spark, root, HIRED_EMPLOYEES, target) == 2
    assert rows(spark.read.parquet(target)) == rows(df)
    # a second backup of the day replaces the first; the latest day wins
    sinks.backup(df.filter("id = 1"), root, HIRED_EMPLOYEES, date(2024, 1, 1))
    assert sinks.read_backup(spark, root, HIRED_EMPLOYEES).count() == 1
    sinks.backup(df.filter("false"), root, HIRED_EMPLOYEES, date(2024, 1, 2))
    with pytest.raises(files.SourceError, match="empty"):
        sinks.restore(spark, root, HIRED_EMPLOYEES, target)
    assert spark.read.parquet(target).count() == 2  # refused: nothing was lost
    with pytest.raises(files.SourceError):
        sinks.read_backup(spark, root, DEPARTMENTS)


def test_mart_overwrite_counts(spark, work):
    assert sinks.overwrite_mart(spark.range(5), work.path("m")) == 5
    assert sinks.overwrite_mart(spark.range(2), work.path("m")) == 2


@pytest.mark.parametrize("kind", sorted(sinks.RUN_RECORDS))
def test_run_records(spark, work, kind):
    assert sinks.read_records(spark, work.root, kind).count() == 0
    number, name = sinks.read_records(spark, work.root, kind).columns[:2]
    value = 1 if name == "dataset_id" else "x"
    assert [sinks.append_record(spark, work.root, kind, {name: value}) for _ in range(2)] == [1, 2]
    got = sinks.read_records(spark, work.root, kind)
    assert sorted((r[number], r[name]) for r in got.collect()) == [(1, value), (2, value)]
    assert "created_at" not in got.columns or got.where("created_at is null").isEmpty()
    with pytest.raises(ValueError):
        sinks.append_record(spark, work.root, kind, {"nope": 1})


def test_json_sink(spark, work, rows):
    sinks.write_json(spark.range(3), work.path("j"))
    assert rows(files.read_json(spark, work.path("j"))) == [(0,), (1,), (2,)]


def test_jdbc_options():
    db = jdbc.Database("jdbc:x://h/d", "org.x.Driver", {"user": "u"})
    assert jdbc.table_options(db, "t", "s") == {
        "url": "jdbc:x://h/d", "driver": "org.x.Driver", "user": "u", "dbtable": "s.t", "fetchsize": "10000"}
    split = jdbc.table_options(db, "t", split=jdbc.Split("id", 0, 1000, 16))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "1000", "16")


def test_jdbc_binding():
    query = "select * from t where a = :a and b = :ab and c = :c and d = :d"
    got = jdbc.bind(query, {"a": 1, "ab": "x' or '1", "c": None, "d": True})
    assert got == "select * from t where a = 1 and b = 'x'' or ''1' and c = NULL and d = TRUE"
    assert jdbc.bind("select x::int, :a, :z", {"a": ":b", "b": 2, "int": 3}) == "select x::int, ':b', :z"


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("ORE_HOST", "db")
    assert config.substitute({"a": ["${ORE_HOST}", "${ORE_NONE}", "x${ORE_HOST}", 1]}) == {"a": ["db", "${ORE_NONE}", "x${ORE_HOST}", 1]}
    path = write(tmp_path, "c.json", '{"host": "${ORE_HOST}"}')
    assert config.load_config(path) == {"host": "db"}
    pytest.importorskip("yaml")
    assert config.load_config(write(tmp_path, "c.yaml", "host: ${ORE_HOST}\n")) == {"host": "db"}


def test_workspace_is_private_and_goes(spark):
    from orelayer.session import Workspace, exists

    with Workspace(spark, "x") as a, Workspace(spark, "x") as b:
        staged = a.stage(spark.range(3), "t")
        assert staged.count() == 3 and a.root != b.root
        with pytest.raises(Exception, match="(?i)exists"):
            a.stage(spark.range(3), "t")
    assert not exists(spark, a.root)


def test_source_from_config(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setenv("ORE_FILE", write(tmp_path, "a.csv", "id;v\n1;x\n"))
    described = {"path": "${ORE_FILE}", "expected_format": "csv", "csv": {"delimiter": ";"}}
    assert rows(files.read_source(spark, described)) == [("1", "x")]
    with pytest.raises(files.SourceError):
        files.read_source(spark, {**described, "expected_format": "parquet"})
    with pytest.raises(files.SourceError):
        files.read_source(spark, {})


def test_csv_quotes_and_backslashes(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", 'id,name\n1,"a ""b"", c\\"\n2,d\\e\n')
    assert rows(files.read_csv(spark, path)) == [("1", 'a "b", c\\'), ("2", "d\\e")]


def test_broadcast_only_below_a_known_size(spark, work):
    from orelayer.session import broadcast_limit, fits_broadcast

    spark.range(1000).write.parquet(work.path("small"))
    small = spark.read.parquet(work.path("small"))
    assert broadcast_limit(spark) == 10 << 20
    assert fits_broadcast(small.filter("id > 1"))
    assert not fits_broadcast(small.select(F.explode(F.sequence(F.lit(1), F.lit(10**6)))))
    assert not fits_broadcast(spark.range(10**9))
    # the same long text in every row: files of a few bytes a row, far more in memory
    spark.range(0, 300_000, 1, 1).select(F.lit("x" * 200).alias("t")).write.parquet(work.path("dense"))
    assert not fits_broadcast(spark.read.parquet(work.path("dense")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1t")
    assert broadcast_limit(spark) == 1 << 40
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert broadcast_limit(spark) == 1024 and not fits_broadcast(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
