"""Profiles and uniqueness that are kept up to date, against the whole table."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from orelayer.operators import profiling, sketches, uniqueness
from orelayer.session import Workspace
from orelayer.sources.sinks import append_bronze


def _rows(spark, seed, n=600):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(200)]), r.choice([None, "", " ", "é", "long text " * 300, f"t{r.randrange(300)}"]), r.gauss(5, 90), [1, r.randrange(3)]) for _ in range(n)]
    return spark.createDataFrame(rows, "a.b int, t string, x double, l array<int>".replace("a.b", "`a.b`"))


def test_merged_profile_equals_the_profile_of_the_whole(spark, work, monkeypatch):
    base, store, read = work.path("bronze"), work.path("store"), []
    stage = sketches.stage_fresh
    monkeypatch.setattr(sketches, "stage_fresh", lambda *a: read.append(stage(*a)) or read[-1])
    for batch, day in (("b1", 3), ("b2", 1), ("b3", 3)):  # a late day, and more rows for a day that was there
        append_bronze(_rows(spark, len(read)), base, "t", f"2024-01-0{day}")
        got = sketches.profile_incremental(spark, base, "t", store, batch)
    assert [len(paths) > 0 for _, paths in read] == [True] * 3
    every = [p for _, paths in read for p in paths]
    assert len(every) == len(set(every))  # each file was read once
    whole = spark.read.parquet(f"{base}/t").drop("ingested_date")
    want = {r["name"]: r for r in profiling.profile_columns(whole.withColumnRenamed("a.b", "ab"), work=Workspace(spark, "t")).collect()}
    for r in got.collect():
        w = want[r["name"].replace(".", "")]
        for c in ("rows", "null_count", "null_percentage", "min", "max", "mean", "std", "zeros_count", "negative_count", "min_length", "max_length", "avg_length", "empty_count"):
            assert r[c] == w[c], (r["name"], c)
        assert abs(r["distinct_count"] - w["distinct_count"]) <= max(1, 0.04 * w["distinct_count"])
    values = sorted(v[0] for v in whole.select("x").collect())
    median = next(r["median"] for r in got.collect() if r["name"] == "x")
    assert values[int(len(values) * 0.48)] <= median <= values[int(len(values) * 0.52)]
    assert abs(statistics.median(values) - median) < 10
    part = sketches.merge_sketches(sketches.read_sketches(spark, store).where("ingested_date = date'2024-01-01'"))
    assert {r["rows"] for r in part.collect()} == {600}
    again = sketches.profile_incremental(spark, base, "t", store, "b3")
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_no_text_is_shuffled(spark, work):
    df = _rows(spark, 1).withColumn("d", F.lit("2024-01-01").cast("date"))
    df.write.parquet(work.path("t"))
    found = sketches.sketch_columns(spark.read.parquet(work.path("t")), "d")
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanged = [x for x in plan.split("\n") if "Exchange" in x]
    assert len(exchanged) == 1 and plan.count("FileScan") == 1
    below = plan.split("Exchange")[1]  # what is shuffled has been aggregated in its task
    assert "partial_" in below.split("FileScan")[0]


def test_empty_store(spark, work):
    assert sketches.profile_incremental(spark, work.path("none"), "t", work.path("store"), "b").collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_uniqueness_over_history(spark, work, seed):
    r, path, held = random.Random(seed), work.path("u"), {}
    for batch in (1, 2, 3, 1, 2, 4):
        held[batch] = [(r.choice([None, "a", "b", "c"]), r.choice([None, 1, 2, 3, r.randrange(50)])) for _ in range(r.choice([0, 1, 80]))]
        uniqueness.add_batch(spark.createDataFrame(held[batch], "k string, `v.w` int"), ["k", "v.w"], path, batch)
        rows = [x for b in held.values() for x in b]
        assert tuple(uniqueness.uniqueness(spark, path).first()) == (len(rows), len(set(rows)), len(rows) - len(set(rows)))


def test_a_batch_opens_only_its_buckets(spark, work):
    path = work.path("u")
    uniqueness.add_batch(spark.range(5000), ["id"], path, 1)
    known = uniqueness.known_hashes(spark, path, [3])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(known.select(F.input_file_name()).distinct().collect()) == 1
    hot = spark.range(20_000).select(F.lit("same").alias("k"))
    uniqueness.add_batch(hot, ["k"], work.path("h"), 1)
    assert tuple(uniqueness.uniqueness(spark, work.path("h")).first()) == (20_000, 1, 19_999)


def test_overview_has_one_scan_and_no_join(spark, work):
    spark.range(1000).selectExpr("id % 10 as `a.b`", "map('k', id % 2) as m").write.parquet(work.path("t"))
    found = profiling.profile_overview(spark.read.parquet(work.path("t")))
    assert tuple(found.first()) == (1000, 2, 990, 99.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1
