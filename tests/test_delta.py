from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orelayer.operators import delta
from orelayer.session import Workspace

SCHEMA = "id int, name string, at timestamp_ntz"
T = datetime(2021, 11, 7, 2, 48)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def outcome(spark, incoming, existing=()):
    return delta.classify(frame(spark, *incoming), frame(spark, *existing), ["id"])


def statuses(df):
    return sorted((r["id"], r[delta.STATUS], r[delta.COPIES]) for r in df.collect())


def test_new(spark):
    assert statuses(outcome(spark, [(7, "A", T)])) == [(7, "new", 1)]


def test_identical_is_skipped(spark):
    assert statuses(outcome(spark, [(1, "A", T)], [(1, "A", T)])) == [(1, "skipped", 1)]


def test_fraction_of_a_second_and_empty_text_are_equal(spark):
    incoming = [(1, "A", T + timedelta(microseconds=500000)), (2, None, T)]
    assert statuses(outcome(spark, incoming, [(1, "A", T), (2, "", T)])) == [(1, "skipped", 1), (2, "skipped", 1)]


def test_changed_row_is_a_conflict_with_its_diff(spark):
    df = outcome(spark, [(1, "Marketing", T)], [(1, "Sales", T)])
    row = df.first()
    assert row[delta.STATUS] == "conflict"
    assert [tuple(x) for x in row[delta.CHANGES]] == [("name", "Sales", "Marketing")]
    log = delta.conflict_log(df, "departments", ["id"]).first()
    assert log["reason"] == "CONFLICT: id=1 exists with different data — name: 'Sales' → 'Marketing'"
    assert '"name":"Marketing"' in log["raw_row"]


def test_conflict_text_of_numbers_and_nulls(spark):
    new = spark.createDataFrame([(1, 5, None)], "id int, n int, s string")
    old = spark.createDataFrame([(1, 4, "a")], "id int, n int, s string")
    log = delta.conflict_log(delta.classify(new, old, ["id"]), "t", ["id"]).first()
    assert log["reason"].endswith("n: 4 → 5, s: 'a' → None")


def test_copies_in_one_batch(spark):
    assert statuses(outcome(spark, [(8, "A", T)] * 3)) == [(8, "new", 1), (8, "skipped", 2)]
    assert statuses(outcome(spark, [(9, "A", T), (9, "B", T)])) == [(9, "conflict", 1), (9, "conflict", 1)]
    assert statuses(outcome(spark, [(9, "B", T), (9, "A", T)])) == [(9, "conflict", 1), (9, "conflict", 1)]


def test_mixed_copies_against_a_stored_row(spark):
    df = outcome(spark, [(1, "A", T), (1, "B", T), (1, "A", T)], [(1, "A", T)])
    assert statuses(df) == [(1, "conflict", 1), (1, "skipped", 1), (1, "skipped", 1)]


def test_batch_conflict_text(spark):
    log = delta.conflict_log(outcome(spark, [(9, "A", T), (9, "B", T)]), "t", ["id"])
    assert {r["reason"] for r in log.collect()} == {"CONFLICT: id=9 occurs with different data in one batch"}


def test_null_in_a_stored_value(spark):
    df = outcome(spark, [(1, "A", T)], [(1, "A", None)])
    assert [x["field"] for x in df.first()[delta.CHANGES]] == ["at"]


def test_kept_row_is_whole(spark):
    """Null texts and exact times survive the comparison."""
    at = T + timedelta(microseconds=7)
    kept = delta.new_rows(outcome(spark, [(1, None, at), (1, None, at), (2, "b", None), (2, "b", None)]))
    assert sorted((tuple(r) for r in kept.collect()), key=lambda r: r[0]) == [(1, None, at), (2, "b", None)]


def test_composite_key(spark):
    incoming = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, v string")
    existing = spark.createDataFrame([("a", 1, 1)], "v string, x int, y int")  # other column order
    df = delta.classify(incoming, existing, ["x", "y"])
    assert sorted((r["y"], r[delta.STATUS]) for r in df.collect()) == [(1, "skipped"), (2, "new")]


def brute_force(incoming, existing):
    """Outcome counts row by row."""
    norm = lambda name: name or ""
    stored = {i: norm(n) for i, n in existing}
    groups = {}
    for i, n in incoming:
        groups.setdefault(i, []).append(norm(n))
    counts = Counter()
    for i, names in groups.items():
        if len(set(names)) == 1:
            if i not in stored:
                counts["new"] += 1
                counts["skipped"] += len(names) - 1
            else:
                counts["skipped" if stored[i] == names[0] else "conflict"] += len(names)
        else:
            for n in names:
                counts["skipped" if stored.get(i) == n else "conflict"] += 1
    return {k: v for k, v in counts.items() if v}


pairs = st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["a", "b", "", None])), max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(incoming=pairs, existing=st.dictionaries(st.integers(1, 5), st.sampled_from(["a", "b", None]), max_size=4))
def test_counts_against_brute_force(spark, incoming, existing):
    new = spark.createDataFrame(incoming, "id int, name string")
    old = spark.createDataFrame(list(existing.items()), "id int, name string")
    for work in (None, Workspace(spark, "test")):
        got = {r[0]: r[1] for r in delta.status_counts(delta.classify(new, old, ["id"], work)).collect()}
        assert got == brute_force(incoming, list(existing.items()))
        assert sum(got.values()) == len(incoming)


def test_hot_key_result_does_not_depend_on_partitions(spark, rows):
    """A third of the batch shares one key."""
    n = 3000
    incoming = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("id"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("name"),
    )
    existing = spark.createDataFrame([(0, "a"), (1, "b"), (2, "x")], "id int, name string")
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "4", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(rows(delta.status_counts(delta.classify(incoming.repartition(7), existing, ["id"]))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
    # hot key: 500 rows equal to the stored one, 500 others; 1 skipped; 2 conflicts
    assert results[0] == [("conflict", 501), ("new", 1998), ("skipped", 501)]
