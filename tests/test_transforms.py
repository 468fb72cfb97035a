from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orelayer.operators import metadata, transforms as tr
from orelayer.operators.keys import consecutive_key
from orelayer.plans.registry import Registry


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "a", 2.0), (2, None, None), (None, "c", 0.5)], "id int, name string, amount double"
    )


def test_select_rename_cast(people, rows):
    df = tr.cast_columns(tr.rename_columns(people, {"name": "n", "nope": "x"}), {"n": "int", "amount": "string"})
    assert df.columns == ["id", "n", "amount"]
    assert [r["n"] for r in df.collect()] == [None, None, None]  # cannot be cast: null, no error
    assert tr.select_columns(people, ["amount", "id"]).columns == ["amount", "id"]


def test_clean_nulls(people, rows):
    assert rows(tr.clean_nulls(people)) == [(1, "a", 2.0)]
    assert len(rows(tr.clean_nulls(people, ["id"]))) == 2
    assert rows(tr.clean_nulls(people, strategy="fill_zero")) == [(0, "c", 0.5), (1, "a", 2.0), (2, None, 0.0)]
    assert rows(tr.clean_nulls(people, strategy="fill_empty")) == [(1, "a", 2.0), (2, "", None), (None, "c", 0.5)]
    assert rows(tr.clean_nulls(people, ["amount"], "fill_zero"))[-1] == (None, "c", 0.5)
    with pytest.raises(ValueError):
        tr.clean_nulls(people, strategy="other")


def test_dates(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5),), (None,)], "t timestamp_ntz")
    assert [r["t"] for r in tr.standardize_dates(df, "t").collect()] == ["2024-01-02 03:04:05", None]
    assert tr.standardize_dates(df, "t", "yyyy/MM").first()["t"] == "2024/01"


def test_calculated_and_filter(people, rows):
    df = tr.add_calculated_column(people, "twice", "amount * 2")
    assert rows(tr.filter_by_condition(df, "twice > 1"), "id", "twice") == [(1, 4.0)]


@pytest.mark.parametrize("keep, expected", [
    ("first", [(1, None), (2, 5), (None, 7), (None, 8)]),  # rows without a key are no duplicates
    ("last", [(1, 3), (2, 5), (None, 7), (None, 8)]),
])
def test_deduplicate(spark, rows, keep, expected):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, None), (2, 5), (2, 5), (None, 7), (None, 8)], "k int, v int")
    assert rows(tr.deduplicate(df, ["k"], keep)) == expected


def test_deduplicate_on_all_columns(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert rows(tr.deduplicate(df, ["a", "b"])) == [(1, 2), (3, 4)]


def test_latest_by_key_keeps_rows_without_key(spark, rows):
    df = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "a", 1), (2, "b", 1), (None, "x", 1), (None, "x", 1)], "id int, v string, day int"
    )
    got = rows(tr.latest_by_key(df, ["id"], ["day"]))
    assert got == [(1, "new", 2), (2, "b", 1), (None, "x", 1), (None, "x", 1)]


def test_consecutive_key(spark, work):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g")).repartition(9)
    got = consecutive_key(df, ["v"], "k", 5, work).collect()
    assert sorted(r["k"] for r in got) == list(range(5, 1005))
    assert all(r["k"] == r["v"] + 5 for r in got)


def test_consecutive_key_with_equal_order_values(spark, work):
    """Nearly all rows share one order value; they still spread and number on."""
    df = spark.range(5000).select(F.when(F.col("id") < 4900, 1).otherwise(2).alias("v")).repartition(6)
    got = consecutive_key(df, ["v"], "k", 1, work)
    assert sorted(r["k"] for r in got.collect()) == list(range(1, 5001))
    assert got.filter("v = 2").agg(F.min("k")).first()[0] == 4901


def test_spread_key_is_unique(spark):
    df = tr.add_surrogate_key(spark.range(100).repartition(5), "k", 10)
    keys = [r["k"] for r in df.collect()]
    assert len(set(keys)) == 100 and min(keys) == 10


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_lookup_is_the_plain_join(spark, rows, how):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    lookup = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, w string")
    got, plain = tr.enrich_with_lookup(df, lookup, "k", how), df.join(lookup, "k", how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_lookup_with_shared_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    lookup = spark.createDataFrame([(2, "b")], "k int, v string")
    assert tr.enrich_with_lookup(df, lookup, "k", "outer").count() == 2


def test_aggregate_names(spark, rows):
    df = spark.createDataFrame([("a", 1, 2), ("a", 3, 4), ("b", 5, None)], "g string, x int, y int")
    got = tr.aggregate_metrics(df, ["g"], {"x": "sum", "y": "count"})
    assert got.columns == ["g", "x_sum", "y_count"]
    assert rows(got) == [("a", 4, 2), ("b", 5, 0)]


def test_registry(spark):
    steps = Registry()
    steps.register("one", lambda df: df.withColumn("a", F.lit(1)), "1.1", "adds a")
    steps.register("two", lambda df: df.withColumn("b", F.col("a") + 1))
    assert steps.compose("one", "two")(spark.range(1)).first()["b"] == 2
    assert steps.list()[0] == {"name": "one", "version": "1.1", "description": "adds a"}
    assert len(steps) == 2
    with pytest.raises(KeyError, match="three"):
        steps.get("three")


def test_trace_columns(spark, work):
    path = work.path("in")
    spark.range(2).write.parquet(path)
    df = metadata.add_trace(spark.read.parquet(path), "file", None, "X", "2.0", custom_team="a", other=1)
    row = df.first()
    assert row["_source_entity"].endswith(".parquet")
    assert (row["_source_system"], row["_schema_version"], row["_custom_team"]) == ("file", "2.0", "a")
    assert "other" not in df.columns and "_other" not in df.columns
    silver = metadata.add_silver_metadata(spark.range(1), "p", "t").first()
    assert (silver["_bronze_source_path"], silver["_transformer_name"], silver["_transformation_version"]) == ("p", "t", "1.0")


def test_rows_without_a_key_are_no_duplicates(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 2), (1, 3)], "k int, v int")
    assert rows(tr.deduplicate(df, ["k"])) == [(1, 3), (None, 1), (None, 1)]
    assert rows(tr.latest_by_key(df, ["k"], ["v"])) == [(1, 3), (None, 1), (None, 1)]
