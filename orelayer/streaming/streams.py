"""Incremental variants of the loads on Structured Streaming.

Every query processes what is available and stops, so it can be scheduled;
progress lives in the checkpoint folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.contract import Contract
from ..operators.metadata import add_trace
from ..plans.pipelines import Lake, load
from ..session import Workspace, is_dir
from ..sources.sinks import append_files, read_batches, write_batch

def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: Any) -> DataFrame:
    """New files below a folder; a single file is picked out of its folder."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if is_dir(spark, path):
        return reader.load(path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return reader.option("pathGlobFilter", name).load(folder)


def run_available(writer) -> StreamingQuery:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark keeps in a checkpoint: the same over restarts, another for a new one."""
    rows = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r[0] for r in rows))["id"]


def land_stream(
    source: DataFrame, base: str, table: str, checkpoint: str, day: date | str, system: str = "file"
) -> StreamingQuery:
    """New source files into the bronze partition of the day, with trace columns.

    Each micro-batch adds plain files named after the stream and its number, so batch and stream
    landings share a partition, all readers see both, and a replay replaces its own files.
    """
    traced = add_trace(source, system, table, "stream")

    def each(batch: DataFrame, number: int) -> None:
        name = f"stream-{stream_identity(batch.sparkSession, checkpoint)}-{number}"
        append_files(batch, base, table, day, name)

    return run_available(traced.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))


def load_stream(
    source: DataFrame,
    contract: Contract,
    lake: Lake,
    checkpoint: str,
    parents: dict[str, DataFrame] | None = None,
) -> StreamingQuery:
    """Each micro-batch through the same load as a batch run.

    The stream's identity and the batch number key both sinks: a replayed micro-batch replaces its
    own rows in the table and in the log, and no other stream's.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        load(spark, batch, contract, lake, f"stream-{stream_identity(spark, checkpoint)}-{number}", parents)

    return run_available(source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))


def _event_time(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp"))


def keep_first(
    source: DataFrame, keys: Sequence[str], time_column: str, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Into a table: of each key the earliest row, and each later one that is more than the delay
    after the row kept before it, however many rows arrive at once.

    A row within the delay of one that an earlier micro-batch kept, on either side, is a repeat of it.
    Equal times are decided by the other columns. Rows without a time are kept once for each key.
    Null keys are equal to each other. Months in a delay are counted from 1970-01-01. A micro-batch
    writes a folder of its own, so a replay replaces its own rows; in it rows lie by days, or by
    delays that are longer, and a micro-batch reads only the days beside its own.
    """
    rest = [c for c in source.columns if c not in keys and c != time_column]

    def each(batch: DataFrame, number: int) -> None:
        spark, part = batch.sparkSession, f"stream-{stream_identity(batch.sparkSession, checkpoint)}-{number}"
        width = spark.sql(f"select unix_micros(timestamp_seconds(0) + interval {delay})").first()[0] + 1  # least step between kept rows
        slot = F.expr(f"floor(_at / {max(width, DAY)})")
        with Workspace(spark, "keep-first") as work:
            timed = _event_time(batch, time_column)
            micros = F.unix_micros(F.col(time_column))
            rows = timed.groupBy(F.struct(*keys).alias("_key"), micros.alias("_at")).agg(F.min(F.struct(time_column, *rest)).alias("_row"))
            rows = work.stage(rows.withColumn(SLOT, slot).withColumn("_bucket", _bucket("_at", width)), "batch")
            slots = [r[0] for r in rows.select(SLOT).distinct().collect()]  # a number for each day that the micro-batch touches
            # times a step or less apart lie in the same bucket or in the next
            near = kept_rows(spark, path, timed.schema, slots, without=part).select(F.struct(*keys).alias("_key"), micros.alias("_seen"))
            near = near.withColumn("_bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: _bucket("_seen", width) + i)))
            late = F.abs(F.col("r._at") - F.col("s._seen")) < width
            same = (F.col("r._key") == F.col("s._key")) & F.col("r._bucket").eqNullSafe(F.col("s._bucket"))
            rows = rows.alias("r").join(near.alias("s"), same & (late | F.col("r._at").isNull()), "left_anti")
            rows = work.stage(rows, "rows")
            first = _first_of_runs(rows.where("_at is not null").select("_key", "_at", "_bucket"), width, work)
            chosen = rows.join(first, ["_key", "_at"], "left_semi").unionByName(rows.where("_at is null"))
            write_batch(chosen.select("_key.*", "_row.*", SLOT).select(*source.columns, SLOT), path, part, F.col(SLOT), SLOT)

    return run_available(source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))


SLOT, DAY = "time_slot", 86_400_000_000


def kept_rows(spark: SparkSession, path: str, schema: T.StructType, slots: Sequence[int | None] | None = None, without: str | None = None) -> DataFrame:
    """What ``keep_first`` has kept. With time slots only these and those beside them are read: the
    folders of all others are never opened, however long the stream has run."""
    wanted = None
    if slots is not None:
        wanted = sorted({s + i for s in slots if s is not None for i in (-1, 0, 1)}) + ([None] if None in slots else [])
    return read_batches(spark, path, schema, without, wanted, by=SLOT, kind=T.LongType())


def _bucket(at: str, width: int) -> Column:
    return F.expr(f"{at} div {width}") - F.when(F.col(at) % width < 0, 1).otherwise(0)


def _first_of_runs(rows: DataFrame, width: int, work: Workspace) -> DataFrame:
    """(_key, _at) of each key's earliest time and, from a time taken, the next one ``width`` or more later.

    Keys whose times span less need an aggregate only. For the others each time points at its next
    one, see ``_next_times``; where a bucket is empty, the first time after it is taken in any case.
    What can be reached from such starts is found by doubling the pointers, in as many rounds as the
    longest chain has binary digits.
    """
    span = work.stage(rows.groupBy("_key").agg(F.min("_at").alias("_at"), (F.max("_at") - F.min("_at")).alias("span")), "span")
    short = span.where(F.col("span") < width).select("_key", "_at")
    long = work.stage(rows.join(span.where(F.col("span") >= width).select("_key"), "_key", "left_semi"), "long")
    if long.isEmpty():
        return short
    least = work.stage(long.groupBy("_key", "_bucket").agg(F.min("_at").alias("least")), "least")
    after = least.select("_key", (F.col("_bucket") + 1).alias("_bucket"))
    taken = work.stage(least.join(after, ["_key", "_bucket"], "left_anti").select("_key", F.col("least").alias("_at")), "taken-0")
    jump, turn = work.stage(_next_times(long, least, width), "jump-0"), 0
    while not jump.isEmpty():
        turn += 1
        reached = taken.join(jump, ["_key", "_at"]).select("_key", F.col("next").alias("_at"))
        taken = work.stage(taken.union(reached).distinct(), f"taken-{turn}")
        beyond = jump.select("_key", F.col("_at").alias("next"), F.col("next").alias("far"))
        jump = work.stage(jump.join(beyond, ["_key", "next"]).select("_key", "_at", F.col("far").alias("next")), f"jump-{turn}")
    return short.union(taken)


CELLS = 256


def _next_times(long: DataFrame, least: DataFrame, width: int) -> DataFrame:
    """(_key, _at, next): the key's first time that is ``width`` or more after ``_at`` and lies in its
    bucket's two successors.

    A bucket is cut into ``CELLS`` cells, so that a key with very many times in one bucket is dealt to
    as many tasks: the next time is sought in the asked cell, then among the first times of the
    bucket's later cells, then it is the first one of the bucket after.
    """
    fine = -(-width // CELLS)
    cell = F.expr(f"(place - _bucket * {width}) div {fine}").alias("cell")
    asked = long.select("_key", (F.col("_bucket") + 1).alias("_bucket"), (F.col("_at") + width).alias("place"), F.col("_at").alias("of"), F.lit(None).cast("bigint").alias("target"))
    there = long.select("_key", "_bucket", F.col("_at").alias("place"), F.lit(None).cast("bigint").alias("of"), F.col("_at").alias("target"))
    both = asked.unionByName(there).select("*", cell)
    onward = Window.partitionBy("_key", "_bucket", "cell").orderBy("place").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    inside = both.withColumn("inside", F.min("target").over(onward)).where("of is not null").drop("target", "place")
    later = Window.partitionBy("_key", "_bucket").orderBy("cell").rangeBetween(1, Window.unboundedFollowing)
    cells = both.groupBy("_key", "_bucket", "cell").agg(F.min("target").alias("first"))  # CELLS rows for a key and bucket at most
    cells = cells.select("_key", "_bucket", "cell", F.min("first").over(later).alias("later"))
    second = least.select("_key", (F.col("_bucket") - 1).alias("_bucket"), "least")
    found = inside.join(cells, ["_key", "_bucket", "cell"]).join(second, ["_key", "_bucket"], "left")
    return found.select("_key", F.col("of").alias("_at"), F.coalesce("inside", "later", "least").alias("next")).where("next is not null")


def windowed_counts(source: DataFrame, group: str, time_column: str, width: str, delay: str) -> DataFrame:
    """Rows per group and time window; rows later than the delay are dropped."""
    timed = _event_time(source, time_column).withWatermark(time_column, delay)
    counted = timed.groupBy(F.window(time_column, width), F.col(group)).agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        group,
        "n",
    )


def quarterly_counts(source: DataFrame, group: str, time_column: str) -> DataFrame:
    """Running rows per group and calendar quarter. The state is one row per
    group and quarter; it is kept, so late rows still count."""
    quarter = F.date_trunc("quarter", F.col(time_column)).cast("timestamp_ntz").alias("quarter_start")
    return source.groupBy(quarter, F.col(group)).agg(F.count("*").alias("n"))


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return run_available(writer.option("checkpointLocation", checkpoint))


def replace_in(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Complete results: each micro-batch writes the whole current result."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = df.writeStream.outputMode("complete").foreachBatch(each)
    return run_available(writer.option("checkpointLocation", checkpoint))
