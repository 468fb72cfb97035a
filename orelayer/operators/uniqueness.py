"""Uniqueness over all that was ever loaded, without reading it again.

An index keeps a 128-bit hash of each distinct key of each batch, in buckets. When a batch comes, is
replaced or goes, only the buckets that its keys fall in are counted anew; their counts and the
batch's rows are one record in a log. Rows and distinct keys of the whole history are sums over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Workspace, quoted
from ..sources.sinks import key_bucket, read_batches, write_batch
from ..sources.slots import SLOT, SlotLog

INDEX = T.StructType([T.StructField(n, T.LongType()) for n in ("h1", "h2")])
_COUNTS = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def key_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits that stand for a key; a null is a value of its own, unlike any other."""
    parts = [x for c in columns for x in (F.col(quoted(c)).isNull(), F.col(quoted(c)))]
    return F.xxhash64(F.lit(0), *parts).alias("h1"), F.xxhash64(F.lit(7), *parts).alias("h2")


def known_hashes(spark: SparkSession, path: str, buckets: Sequence[int]) -> DataFrame:
    """The indexed keys of some buckets, of all batches; no other folder is opened."""
    return read_batches(spark, f"{path.rstrip('/')}/keys", INDEX, buckets=buckets)


def add_batch(rows: DataFrame, columns: Sequence[str], path: str, batch_id: int | str, buckets: int = 16) -> None:
    """Count a batch into the index. A batch that is added again replaces what it brought before,
    whether its rows are the same or others.

    Keys are reduced in each task before they are shuffled, so a key of a third of all rows is a
    row for each task. ``buckets`` is the same for as long as an index is kept.
    """
    spark, root, batch = rows.sparkSession, path.rstrip("/"), str(batch_id)
    bucket, index = key_bucket(["h1"], buckets), f"{path.rstrip('/')}/keys"
    touched_by = lambda df: {r[0] for r in df.select(bucket.alias("bucket")).distinct().collect()}  # noqa: E731  no more than there are buckets
    with Workspace(spark, "unique") as work:
        keys = work.stage(rows.select(*key_hashes(columns)).groupBy("h1", "h2").agg(F.count("*").alias("n")), "keys")
        touched = touched_by(keys) | touched_by(read_batches(spark, index, INDEX, bucketed=True, only=batch))
        write_batch(keys.select("h1", "h2"), index, batch, bucket)
        counted = known_hashes(spark, root, sorted(touched)).distinct().groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
        counts = {b: 0 for b in touched} | {r["bucket"]: r["n"] for r in counted.collect()}
        n_rows = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    records = [("batches", {"name": batch, "n": n_rows}), *(("buckets", {"name": str(b), "n": n}) for b, n in sorted(counts.items()))]
    SlotLog(spark, f"{root}/counts").append(lambda _: records)


def uniqueness(spark: SparkSession, path: str) -> DataFrame:
    """(total_rows, distinct_keys, duplicate_rows) over all batches, from the last count of each batch
    and each bucket."""
    log = SlotLog(spark, f"{path.rstrip('/')}/counts")
    latest = lambda table: log.read(table, _COUNTS).groupBy("name").agg(F.max_by("n", SLOT).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)))
    totals = spark.range(1).select(latest("batches").scalar().alias("total_rows"), latest("buckets").scalar().alias("distinct_keys"))
    return totals.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
