"""How silver lies on disk: buckets of keys, versions, and what is left when something stops midway."""

import pytest
from pyspark.sql import functions as F

from orelayer.operators import delta, quality
from orelayer.operators.contract import DEPARTMENTS
from orelayer.plans import pipelines as p
from orelayer.session import Workspace, list_names
from orelayer.sources import sinks


@pytest.fixture
def lake(work):
    return p.Lake.under(work.path("lake"))


def departments(spark, *rows):
    return spark.createDataFrame(list(rows), DEPARTMENTS.string_schema())


def many(spark, n, name="d"):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.concat(F.lit(name), F.col("id")).alias("department"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_batch_reads_only_its_buckets(spark, lake):
    p.load(spark, many(spark, 2000), DEPARTMENTS, lake, 1)
    batch = departments(spark, ("7", "d7"), ("5000", "new")).select(F.col("id").cast("int"), "department")
    buckets = p.buckets_of(lake, batch, DEPARTMENTS.key)
    stored = p.read_silver(spark, lake, DEPARTMENTS, buckets=buckets)
    assert 1 <= len(buckets) <= 2
    assert "PartitionFilters: [" in _plan(stored) and sinks.BUCKET in _plan(stored).split("PartitionFilters: [")[1].split("]")[0]
    read = {r[0] for r in stored.select(F.input_file_name()).distinct().collect()}
    every = {r[0] for r in p.read_silver(spark, lake, DEPARTMENTS).select(F.input_file_name()).distinct().collect()}
    assert 0 < len(read) <= len(buckets) and len(every) == lake.buckets
    assert stored.filter("id = 7").count() == 1


def test_keys_come_first_and_values_only_for_known_keys(spark, lake, work):
    p.load(spark, many(spark, 500), DEPARTMENTS, lake, 1)
    asked = []

    def values_of(known):
        asked.append(sorted(r[0] for r in known.collect()))
        return p.read_silver(spark, lake, DEPARTMENTS)

    typed = [F.col("id").cast("int"), "department"]
    batch = departments(spark, ("7", "other"), ("8", "d8"), ("900", "new")).select(*typed)
    out = delta.classify(batch, p.read_silver(spark, lake, DEPARTMENTS), ["id"], work, values_of)
    assert {r["id"]: r[delta.STATUS] for r in out.collect()} == {7: "conflict", 8: "skipped", 900: "new"}
    assert asked == [[7, 8]]
    keys = p.read_silver(spark, lake, DEPARTMENTS).select("id")
    assert "ReadSchema: struct<id:int>" in _plan(keys)
    again = Workspace(spark, "test")
    fresh = delta.classify(departments(spark, ("901", "x")).select(*typed), p.read_silver(spark, lake, DEPARTMENTS), ["id"], again, values_of)
    assert [r[delta.STATUS] for r in fresh.collect()] == ["new"] and len(asked) == 1  # no stored value was read


@pytest.mark.parametrize("rows", [1, 50])
def test_batches_that_overlap(spark, lake, rows, monkeypatch):
    """Repeated keys, known keys and new ones in one batch, with broadcasts and without."""
    if rows == 1:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p.load(spark, many(spark, 300), DEPARTMENTS, lake, 1)
        batch = many(spark, 310).unionByName(departments(spark, *[("1", "d1")] * rows, *[("305", "d305")] * rows, ("2", "other"), ("309", "two")))
        got = p.load(spark, batch, DEPARTMENTS, lake, 2)
        # 309 occurs with two texts, so neither is stored; 2 differs from the stored row once
        assert (got.rows, got.inserted, got.conflicts, got.skipped) == (312 + 2 * rows, 9, 3, 300 + 2 * rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_restore_that_stops_leaves_the_table(spark, lake, work, monkeypatch):
    p.load(spark, many(spark, 20), DEPARTMENTS, lake, 1)
    root = work.path("backups")
    sinks.backup(spark.createDataFrame([(1, "x")], DEPARTMENTS.typed_schema()), root, DEPARTMENTS, "2024-01-01")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "move", stop)  # the rows are written, the rename isn't done
        with pytest.raises(KeyboardInterrupt):
            p.restore_table(spark, root, DEPARTMENTS, lake)
    assert p.read_silver(spark, lake, DEPARTMENTS).count() == 20
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "delete", stop)  # renamed, the old version not yet removed
        p.load(spark, many(spark, 3), DEPARTMENTS, lake, 2)
        sinks.publish_version  # noqa: B018
        try:
            p.restore_table(spark, root, DEPARTMENTS, lake)
        except KeyboardInterrupt:
            pass
    assert [tuple(r) for r in p.read_silver(spark, lake, DEPARTMENTS).collect()] == [(1, "x")]
    p.load(spark, departments(spark, ("9", "later")), DEPARTMENTS, lake, 3)
    assert p.restore_table(spark, root, DEPARTMENTS, lake)["rows_restored"] == 1
    assert len([n for n in list_names(spark, lake.table("departments")) if n.startswith(sinks.VERSION)]) == 1


def test_a_failed_gate_leaves_the_target(spark, work, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,v\n1,a\n2,b\n")
    rule = lambda n: [{"name": "v", "type": "volume", "config": {"min_rows": n}}]
    run = lambda n, out: p.gated_pipeline(spark, str(path), work.path(f"b{n}{out}"), work.path("target"), lambda df: df, [], rule(n))
    first = run(2, 1)
    with pytest.raises(quality.ValidationFailed):
        run(3, 2)
    assert spark.read.parquet(work.path("target")).count() == 2
    assert spark.read.parquet(first.run.target).count() == 2
    assert list_names(spark, work.path("target_aside")) == []


def test_replaced_files_are_there_before_the_old_ones_go(spark, lake, monkeypatch):
    sinks.append_files(departments(spark, ("1", "A")), lake.bronze, "departments", "2024-01-01", "s-0")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "delete", stop)
        with pytest.raises(KeyboardInterrupt):
            sinks.append_files(departments(spark, ("1", "B")), lake.bronze, "departments", "2024-01-01", "s-0")
    folder = f"{lake.bronze}/departments/ingested_date=2024-01-01"
    assert sorted(r[0] for r in spark.read.parquet(folder).select("department").collect()) == ["A", "B"]
    sinks.append_files(departments(spark, ("1", "C")), lake.bronze, "departments", "2024-01-01", "s-0")
    assert [r[0] for r in spark.read.parquet(folder).select("department").collect()] == ["C"]


def test_bins():
    assert sinks.bins_of({"a": 5, "b": 4, "c": 3, "d": 2, "e": 100, "f": 10}, 9) == [["a", "b"], ["c", "d"]]
    assert sinks.bins_of({"a": 5}, 9) == sinks.bins_of({}, 9) == []


def test_compaction_keeps_every_row(spark, lake, monkeypatch):
    path = lambda: sinks.current_version(spark, lake.table("departments"))
    batches = lambda: [n for n in list_names(spark, path()) if n.startswith(sinks.BATCH)]
    for i in range(5):
        p.load(spark, many(spark, 10 * (i + 1)), DEPARTMENTS, lake, i)
    before = sorted(map(tuple, p.read_silver(spark, lake, DEPARTMENTS, loaded_at=True).collect()))

    def stop(*_):
        raise KeyboardInterrupt

    for name in ("move", "delete"):  # before the merged batch is in place, and right after
        with monkeypatch.context() as patch:
            patch.setattr(sinks, name, stop)
            with pytest.raises(KeyboardInterrupt):
                p.compact_silver(spark, lake, DEPARTMENTS)
        assert sorted(map(tuple, p.read_silver(spark, lake, DEPARTMENTS, loaded_at=True).collect())) == before
    assert p.compact_silver(spark, lake, DEPARTMENTS) == 0  # takes away what the last one left
    assert len(batches()) == 1 and sinks.merged_batches(spark, path()) == []
    assert sorted(map(tuple, p.read_silver(spark, lake, DEPARTMENTS, loaded_at=True).collect())) == before
    again = p.load(spark, many(spark, 50), DEPARTMENTS, lake, 3)  # a merged batch is run again
    assert (again.inserted, again.skipped) == (0, 50)
    assert p.load(spark, many(spark, 51), DEPARTMENTS, lake, 9).inserted == 1
    assert p.compact_silver(spark, lake, DEPARTMENTS) >= 1 and len(batches()) <= 2
    assert p.read_silver(spark, lake, DEPARTMENTS).count() == 51
