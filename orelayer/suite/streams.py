"""Streaming loads over the events: each runs what is available and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import Contract, Field, ForeignKey
from ..plans.pipelines import Lake, read_rejections, read_silver
from ..session import Workspace
from ..sources.files import read_bronze
from ..sources.sinks import append_bronze, land_bronze
from ..streaming import streams as st
from .base import query, table


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return st.read_stream(spark, f"{sf.rstrip('/')}/events.parquet", schema)


@query("stream_land", "select *, cast('2024-02-01' as date) as ingested_date, 'file' as _source_system from events")
def stream_land(spark: SparkSession, sf: str) -> DataFrame:
    work = Workspace(spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        st.land_stream(_events(spark, sf), work.path("bronze"), "events", work.path("checkpoint"), "2024-02-01")
    df = read_bronze(spark, work.path("bronze"), "events")
    return df.drop("_extraction_timestamp", "_source_entity", "_extractor_name", "_schema_version")


EVENT_CONTRACT = Contract(
    "events",
    (
        Field("event_id", "bigint"), Field("user_id", "bigint"), Field("event_type", "string", non_blank=True),
        Field("value", "double", minimum=1),
    ),
    key=("event_id",),
    foreign_keys=(ForeignKey("user_id", "supplier", "s_suppkey", label="supplier"),),
)


def _stream_loaded(spark: SparkSession, sf: str) -> Lake:
    work = Workspace(spark, "stream")
    lake = Lake.under(work.path("lake"))
    parents = {"supplier": table(spark, sf, "supplier")}
    st.load_stream(_events(spark, sf), EVENT_CONTRACT, lake, work.path("checkpoint"), parents)
    return lake


@query("stream_split_ok", """
select event_id, user_id, event_type, value from events where value >= 1 and user_id in (select s_suppkey from supplier)""")
def stream_split_ok(spark: SparkSession, sf: str) -> DataFrame:
    return read_silver(spark, _stream_loaded(spark, sf), EVENT_CONTRACT)


@query("stream_split_bad", """
select 'events' as table_name, case when value < 1 then 'value is below 1'
       else 'FK Violation: user_id ' || user_id || ' not in supplier' end as reason
from events where value < 1 or user_id not in (select s_suppkey from supplier)""")
def stream_split_bad(spark: SparkSession, sf: str) -> DataFrame:
    return read_rejections(spark, _stream_loaded(spark, sf)).select("table_name", "reason")


@query("stream_dedup", """
select * exclude (r) from (
  select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r from events) where r = 1""")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    work = Workspace(spark, "stream")
    st.keep_first(_events(spark, sf), ["user_id", "event_type"], "ts", "60 days", work.path("out"), work.path("checkpoint"))
    return st.kept_rows(spark, work.path("out"), table(spark, sf, "events").schema)


@query("stream_two_sources", "select event_id, user_id, event_type, value from events where value >= 1 and user_id in (select s_suppkey from supplier)")
def stream_two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams, each with its own checkpoint, into one table; each runs twice."""
    work = Workspace(spark, "stream")
    lake, parents = Lake.under(work.path("lake")), {"supplier": table(spark, sf, "supplier")}
    for name, odd in (("a", 0), ("b", 1), ("a", 0), ("b", 1)):
        half = _events(spark, sf).where(F.col("event_id") % 2 == odd)
        st.load_stream(half, EVENT_CONTRACT, lake, work.path(name), parents)
    return read_silver(spark, lake, EVENT_CONTRACT)


@query("land_mixed", """
select event_id, cast('2024-02-01' as date) as ingested_date, n from events, (values (1), (2)) as t(n)
union all select event_id, cast('2024-02-02' as date), 3 from events""")
def land_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Stream, batch append and repeated landing in one table and day, and a landing of another day."""
    work = Workspace(spark, "stream")
    base, one = work.path("bronze"), table(spark, sf, "events").select("event_id")
    stream = _events(spark, sf).select("event_id", F.lit(1).alias("n"))
    for _ in range(2):
        st.land_stream(stream, base, "events", work.path("checkpoint"), "2024-02-01")
        land_bronze(one.withColumn("n", F.lit(9)), base, "events", "2024-02-01")  # the day is there: skipped
    append_bronze(one.withColumn("n", F.lit(2)), base, "events", "2024-02-01")
    for n in (3, 9):
        land_bronze(one.withColumn("n", F.lit(n)), base, "events", "2024-02-02")
    return read_bronze(spark, base, "events").select("event_id", "ingested_date", "n")


@query("stream_window", """
with w as (select date_trunc('hour', ts) as window_start, event_type, count(*) as n from events group by all)
select window_start, window_start + interval 1 hour as window_end, event_type, n from w
where window_start + interval 1 hour <= (select max(ts) - interval 2 hour from events)""")
def stream_window(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the watermark has closed."""
    work = Workspace(spark, "stream")
    counts = st.windowed_counts(_events(spark, sf), "event_type", "ts", "1 hour", "2 hours")
    st.append_to(counts, work.path("out"), work.path("checkpoint"))
    return spark.read.parquet(work.path("out"))


@query("stream_quarters", """
select cast(date_trunc('quarter', ts) as timestamp) as quarter_start, event_type, count(*) as n from events group by all""")
def stream_quarters(spark: SparkSession, sf: str) -> DataFrame:
    work = Workspace(spark, "stream")
    st.replace_in(st.quarterly_counts(_events(spark, sf), "event_type", "ts"), work.path("out"), work.path("checkpoint"))
    return spark.read.parquet(work.path("out"))
