import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from orelayer.operators.contract import DEPARTMENTS
from orelayer.plans.pipelines import Lake, load, read_rejections, read_silver
from orelayer.sources import sinks
from orelayer.sources.files import read_bronze
from orelayer.streaming import streams as st

T = datetime(2024, 1, 1)
EVENTS = "k string, ts timestamp_ntz, v int"


def put(spark, path, *rows, schema=EVENTS):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def test_landing_takes_new_files_once(spark, work):
    src = work.path("src")
    put(spark, src, ("a", T, 1))
    run = lambda day: st.land_stream(
        st.read_stream(spark, src, spark.read.parquet(src).schema), work.path("bronze"), "e", work.path("ck"), day)
    run("2024-01-01")
    put(spark, src, ("b", T, 2))
    run("2024-01-02")
    run("2024-01-03")
    got = read_bronze(spark, work.path("bronze"), "e").select("k", F.col("ingested_date").cast("string")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "2024-01-01"), ("b", "2024-01-02")]


def test_stream_load_equals_batch_load(spark, work, rows):
    src, schema = work.path("src"), DEPARTMENTS.string_schema()
    batches = [[("1", "A"), ("x", "B"), ("2", "C")], [("1", "A"), ("2", "Z"), ("3", " ")]]
    streamed, batched = Lake.under(work.path("s")), Lake.under(work.path("b"))
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        st.load_stream(st.read_stream(spark, src, schema), DEPARTMENTS, streamed, work.path("ck"))
        load(spark, spark.createDataFrame(batch, schema), DEPARTMENTS, batched, number)
    assert rows(read_silver(spark, streamed, DEPARTMENTS)) == rows(read_silver(spark, batched, DEPARTMENTS)) == [(1, "A"), (2, "C")]
    assert rows(read_rejections(spark, streamed), "reason") == rows(read_rejections(spark, batched), "reason")
    assert read_rejections(spark, streamed).count() == 3


def test_keep_first_over_batches(spark, work, rows):
    src = work.path("src")
    late, hours = T + timedelta(minutes=1), T + timedelta(hours=3)
    for batch in ([("a", late, 1), ("a", T, 2), ("b", T, 4), ("b", T, 3), (None, T, 9)], [("a", late, 4), ("c", T, 5), (None, late, 8)], [("a", hours, 6)]):
        put(spark, src, *batch)
        for _ in range(2):  # the second run finds nothing new
            source = st.read_stream(spark, src, spark.read.parquet(src).schema)
            st.keep_first(source, ["k"], "ts", "1 hour", work.path("out"), work.path("ck"))
    got = rows(spark.read.parquet(work.path("out")), "k", "v")
    assert got == [(None, 9), ("a", 2), ("a", 6), ("b", 3), ("c", 5)]  # the earliest; anew after the delay


def test_keep_first_is_the_same_in_one_batch_and_many(spark, work, rows):
    rng = random.Random(7)
    minutes = {k: sorted(rng.sample(range(-2000, 3000), n)) for k, n in (("a", 300), ("b", 20), (None, 5), ("c", 1))}
    minutes["d"] = [0, 180]
    data = sorted(((k, T + timedelta(minutes=m), m) for k, ms in minutes.items() for m in ms), key=lambda r: r[1])
    want = []
    for k, ms in minutes.items():
        last = None
        for m in ms:
            if last is None or m - last > 60:
                want.append((k, m))
                last = m
    want.sort(key=lambda r: tuple(map(str, r)))
    for name, size in (("one", len(data)), ("many", 80)):
        src = work.path(f"{name}-src")
        for a in range(0, len(data), size):
            put(spark, src, *data[a : a + size])
            source = st.read_stream(spark, src, spark.read.parquet(src).schema)
            st.keep_first(source, ["k"], "ts", "1 hour", work.path(name), work.path(f"{name}-ck"))
        assert rows(spark.read.parquet(work.path(name)), "k", "v") == want


def test_keep_first_keeps_rows_long_before_and_without_a_time(spark, work, rows):
    src, days, near = work.path("src"), T - timedelta(days=2), T - timedelta(minutes=30)
    for batch in ([("a", T, 1), ("a", None, 2), ("a", None, 3)], [("a", days, 4), ("a", near, 5), ("a", None, 6), ("b", None, 7)]):
        put(spark, src, *batch)
        st.keep_first(st.read_stream(spark, src, spark.read.parquet(src).schema), ["k"], "ts", "1 hour", work.path("out"), work.path("ck"))
    assert rows(spark.read.parquet(work.path("out")), "k", "v") == [("a", 1), ("a", 2), ("a", 4), ("b", 7)]


def test_keep_first_with_one_hot_key(spark, work):
    src = work.path("src")
    spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(T).cast("timestamp_ntz").alias("ts"), F.col("id").cast("int").alias("v")).write.parquet(src)
    st.keep_first(st.read_stream(spark, src, spark.read.parquet(src).schema), ["k"], "ts", "1 hour", work.path("out"), work.path("ck"))
    out = spark.read.parquet(work.path("out"))
    assert out.count() == out.select("k").distinct().count() == 4001
    assert out.where("k = 'hot'").first()["v"] == 0


def test_keep_first_reads_only_the_days_beside_its_own(spark, work):
    src, schema = work.path("src"), None
    for day in (0, 40, 41):
        put(spark, src, ("a", T + timedelta(days=day), day), ("b", T + timedelta(days=day, minutes=5), day), ("n", None, day))
        schema = spark.read.parquet(src).schema
        st.keep_first(st.read_stream(spark, src, schema), ["k"], "ts", "1 hour", work.path("out"), work.path("ck"))
    out = st.kept_rows(spark, work.path("out"), schema)
    assert out.count() == 7
    slot = int((T + timedelta(days=41)).replace(tzinfo=timezone.utc).timestamp()) // 86400
    near = st.kept_rows(spark, work.path("out"), schema, [slot])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert st.SLOT in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r["v"] for r in near.collect()) == [40, 40, 41, 41]
    assert len(near.select(F.input_file_name()).distinct().collect()) < len(out.select(F.input_file_name()).distinct().collect())
    assert st.kept_rows(spark, work.path("out"), schema, [None]).count() == 1


@pytest.mark.parametrize("cells", [1, 7, 256])
def test_keep_first_with_very_many_times_of_one_key(spark, work, rows, monkeypatch, cells):
    monkeypatch.setattr(st, "CELLS", cells)
    rng, want, last = random.Random(cells), [], None
    seconds = sorted(rng.sample(range(-9000, 30_000), 6000))
    for x in seconds:
        if last is None or x - last > 600:
            want.append(x)
            last = x
    src = work.path("src")
    put(spark, src, *[("hot", T + timedelta(seconds=x), x) for x in seconds])
    st.keep_first(st.read_stream(spark, src, spark.read.parquet(src).schema), ["k"], "ts", "10 minutes", work.path("out"), work.path("ck"))
    assert sorted(r["v"] for r in spark.read.parquet(work.path("out")).select("v").collect()) == want


def test_two_streams_keep_their_rows(spark, work, rows):
    lake = Lake.under(work.path("lake"))
    for name, batch in (("a", [("1", "A"), ("2", "B")]), ("b", [("3", "C"), ("4", "D"), ("x", "bad")])):
        spark.createDataFrame(batch, DEPARTMENTS.string_schema()).write.parquet(work.path(name))
    for name in "abab":
        st.load_stream(st.read_stream(spark, work.path(name), DEPARTMENTS.string_schema()), DEPARTMENTS, lake, work.path("ck" + name))
    assert [r[0] for r in rows(read_silver(spark, lake, DEPARTMENTS))] == [1, 2, 3, 4]
    assert read_rejections(spark, lake).count() == 1


def test_batch_and_stream_landing_share_a_day(spark, work):
    src, base = work.path("src"), work.path("bronze")
    put(spark, src, ("a", T, 1))
    df = spark.read.parquet(src)
    st.land_stream(st.read_stream(spark, src, df.schema), base, "e", work.path("ck"), "2024-01-01")
    sinks.append_bronze(df, base, "e", "2024-01-01")
    assert sinks.land_bronze(df, base, "e", "2024-01-01") is False
    assert read_bronze(spark, base, "e").count() == 2


def test_late_rows_are_dropped(spark, work, rows):
    src = work.path("src")
    batches = (
        [("a", T, 1), ("a", T + timedelta(hours=5), 1)],
        [("a", T + timedelta(minutes=1), 1), ("a", T + timedelta(hours=5, minutes=1), 1)],  # the first is too late
        [("a", T + timedelta(hours=9), 1)],
    )
    for batch in batches:
        put(spark, src, *batch)
        counts = st.windowed_counts(st.read_stream(spark, src, spark.read.parquet(src).schema), "k", "ts", "1 hour", "1 hour")
        st.append_to(counts, work.path("out"), work.path("ck"))
    got = rows(spark.read.parquet(work.path("out")), "window_start", "n")
    assert got == [(T, 1), (T + timedelta(hours=5), 2)]


def test_quarters_keep_running(spark, work, rows):
    src = work.path("src")
    for batch in ([("a", T, 1), ("b", datetime(2024, 4, 1), 1)], [("a", datetime(2024, 3, 31, 23), 1)]):
        put(spark, src, *batch)
        q = st.quarterly_counts(st.read_stream(spark, src, spark.read.parquet(src).schema), "k", "ts")
        st.replace_in(q, work.path("out"), work.path("ck"))
    assert rows(spark.read.parquet(work.path("out"))) == [(T, "a", 2), (datetime(2024, 4, 1), "b", 1)]
