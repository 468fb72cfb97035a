from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelayer.operators import catalog as cat
from orelayer.sources import sinks, slots


@pytest.fixture
def store(spark, work):
    c = cat.Catalog(spark, work.path("catalog"))
    c.register("raw_sales", "bronze", "/b", description="sales files", owner="ann", tags=["sales", "raw"], now=datetime(2024, 1, 1))
    c.register("raw_hr", "bronze", "/h", description="staff", owner="bob", tags=["people"], now=datetime(2024, 1, 2))
    c.register("clean", "silver", "/s", df=spark.range(1), sources=["raw_sales", "raw_hr"], transformation=("transformer", "clean"),
               owner="ann", tags=["Sales"], size_mb=1.239, metadata={"k": "v"}, now=datetime(2024, 1, 3))
    c.register("mart_a", "gold", "/ga", sources=["clean"], tags=["x"], now=datetime(2024, 1, 4))
    c.register("mart_b", "gold", "/gb", sources=["clean"], description="sales mart", now=datetime(2024, 1, 5))
    return c


def names(df):
    return [r["dataset_name"] for r in df.collect()]


def test_register(store):
    ids = {r["dataset_name"]: r["dataset_id"] for r in store.table("datasets").collect()}
    assert sorted(ids.values()) == [1, 2, 3, 4, 5]
    row = cat.get_dataset(store.table("datasets"), ids["clean"]).first()
    assert (str(row["size_mb"]), row["metadata"], row["tags"]) == ("1.24", {"k": "v"}, ["Sales"])
    for bad in ({"name": "clean", "layer": "gold"}, {"name": "n", "layer": "tin"}, {"name": "n", "layer": "gold", "format": "xls"},
                {"name": "n", "layer": "gold", "sources": ["none"]}):
        with pytest.raises(ValueError):
            store.register(location="/x", **bad)


def test_list(store):
    d = store.table("datasets")
    assert names(cat.list_datasets(d, layer="gold")) == ["mart_b", "mart_a"]
    assert names(cat.list_datasets(d, owner="ann")) == ["clean", "raw_sales"]
    assert names(cat.list_datasets(d, tags=["people", "raw"])) == ["raw_hr", "raw_sales"]
    page = cat.list_datasets(d, page=2, page_size=2).collect()
    assert [(r["dataset_name"], r["total"]) for r in page] == [("clean", 5), ("raw_hr", 5)]


def test_search_order(store):
    found = cat.search(store.table("datasets"), "SALES").collect()
    assert [(r["dataset_name"], r["relevance_score"]) for r in found] == [("raw_sales", 1.0), ("mart_b", 0.8), ("clean", 0.5)]
    assert names(cat.search(store.table("datasets"), "sales", layer="bronze")) == ["raw_sales"]
    assert names(cat.search(store.table("datasets"), "sales", tags=["Sales"])) == ["clean"]


def test_lineage(store, rows):
    d, edges = store.table("datasets"), store.table("dataset_lineage")
    assert rows(cat.neighbours(d, edges, 3), "direction", "dataset_name") == [
        ("downstream", "mart_a"), ("downstream", "mart_b"), ("upstream", "raw_hr"), ("upstream", "raw_sales")]
    counts = {r["dataset_name"]: (r["upstream_count"], r["downstream_count"]) for r in cat.with_lineage_counts(d, edges).collect()}
    assert counts["clean"] == (2, 2)  # two by two, not four
    assert counts["raw_hr"] == (0, 1) and counts["mart_a"] == (1, 0)


def test_schema_and_tags(store, rows):
    d = store.table("datasets")
    got = {r["dataset_name"]: r["schema_version"] for r in cat.with_current_schema(d, store.table("dataset_schemas")).collect()}
    assert got["clean"] == "1.0" and got["mart_a"] is None and len(got) == 5
    store.add_tag(2, "pii", "name", "name", 0.9)
    store.add_tag(2, "pii", "mail", "mail", 0.5)
    store.add_tag(1, "gdpr")
    tags = store.table("governance_tags")
    assert names(cat.tagged_datasets(d, tags)) == ["raw_hr"]
    assert cat.governance_of(tags, 2).count() == 2


def test_a_new_schema_retires_the_one_before(spark, store):
    store.add_schema(3, spark.range(1).selectExpr("id", "id as b"), "2.0")
    store.add_schema(3, spark.range(1).selectExpr("id as c"), "1.5")  # the last one added counts, not the highest
    schemas = store.table("dataset_schemas")
    assert {r["schema_version"]: r["is_current"] for r in schemas.collect()} == {"1.0": False, "2.0": False, "1.5": True}
    current = cat.with_current_schema(store.table("datasets"), schemas).collect()
    assert len(current) == 5 and [r["schema_version"] for r in current if r["dataset_id"] == 3] == ["1.5"]
    with pytest.raises(ValueError, match="already"):
        store.add_schema(3, spark.range(1), "2.0")
    with pytest.raises(ValueError, match="unknown"):
        store.add_schema(99, spark.range(1), "1.0")


def test_two_writers_get_different_ids(spark, work, store, monkeypatch):
    """The second writer looks at the log before the first one has written, as it may at once."""
    other = cat.Catalog(spark, work.path("catalog"))
    append = other.registered.append

    def late(records):
        monkeypatch.setattr(other.registered, "append", append)
        assert store.register("first", "gold", "/1") == 6
        return append(records)

    monkeypatch.setattr(other.registered, "append", late)
    assert other.register("second", "gold", "/2") == 7
    log = slots.SlotLog(spark, work.path("log"))
    assert [log.append(lambda slot: [("t", {"n": slot})]) for _ in range(3)] == [1, 2, 3]
    monkeypatch.setattr(log, "last", lambda: 0)  # a listing from long ago: every number is tried
    assert log.append(lambda slot: [("t", {"n": slot})]) == 4
    assert sorted(tuple(r) for r in slots.SlotLog(spark, work.path("log")).read("t", T.StructType().add("n", "long")).collect()) == [(n, n) for n in (1, 2, 3, 4)]


def test_one_name_from_two_writers(spark, work, store, monkeypatch):
    other = cat.Catalog(spark, work.path("catalog"))
    append = other.registered.append

    def late(records):
        store.register("same", "gold", "/1", df=spark.range(1))
        return append(records)

    monkeypatch.setattr(other.registered, "append", late)
    with pytest.raises(ValueError, match="already registered"):
        other.register("same", "silver", "/2", df=spark.range(1), sources=["raw_hr"])
    found = store.table("datasets").where("dataset_name = 'same'").collect()
    assert [(r["dataset_id"], r["layer"]) for r in found] == [(6, "gold")]
    assert store.table("dataset_lineage").where("dataset_id = 7").isEmpty()
    assert store.table("dataset_schemas").where("dataset_id = 7").isEmpty()
    assert store.register("next", "gold", "/n") == 8


def test_quality_summary(spark, work, rows):
    at = datetime(2024, 1, 1)
    sinks.append_record(spark, work.root, "source_profiles", {"source_name": "s", "profile_timestamp": at, "quality_score": 88.5, "null_percentage": 1.0})
    for executed, passed in ((8, 5), (0, 0)):
        sinks.append_record(spark, work.root, "validation_runs", {
            "pipeline_name": f"p{executed}", "validation_timestamp": at, "rules_executed": executed, "rules_passed": passed})
    got = cat.quality_summary(sinks.read_records(spark, work.root, "source_profiles"), sinks.read_records(spark, work.root, "validation_runs"))
    assert rows(got, "metric_type", "entity_name", "score", "null_percentage") == [
        ("profiling", "s", 88.5, 1.0), ("validation", "p0", None, None), ("validation", "p8", 62.5, None)]


def test_null_source_is_no_upstream(spark, rows):
    d = spark.createDataFrame([(1,), (2,)], "dataset_id int")
    edges = spark.createDataFrame([(1, None), (1, 2), (1, 2)], "dataset_id int, source_dataset_id int")
    assert rows(cat.with_lineage_counts(d, edges)) == [(1, 1, 0), (2, 0, 1)]
