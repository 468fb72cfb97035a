"""Profiles that are kept up to date: mergeable sketches of each bronze day, added up for the table.

A column's numbers for one day of files are a row of sums and sketches, from one aggregate over
those files: values never leave their task, texts least of all. A profile merges these rows and
reads no data. New files are found by the ledger, so each file is read once, whatever day it lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Workspace, delete, exists
from ..sources.files import BRONZE_PARTITION, bronze_path
from ..sources.ledger import Ledger, stage_fresh
from ..sources.sinks import BATCH, write_batch
from .profiling import _kind

#: Distinct counts have a standard error of 1.04 / sqrt(2 ** HLL_BITS), 0.8 %; ranks of quantiles one
#: of about 2.3 / KLL_SIZE ** 0.9, 0.4 %, with 99 % confidence.
HLL_BITS, KLL_SIZE = 14, 1000

_SKETCH = (
    ("name", "string"), ("dtype", "string"), ("rows", "bigint"), ("null_count", "bigint"), ("values", "binary"),
    ("min", "double"), ("max", "double"), ("n", "bigint"), ("mean", "double"), ("m2", "double"), ("quantiles", "binary"),
    ("zeros_count", "bigint"), ("negative_count", "bigint"), ("min_length", "int"), ("max_length", "int"),
    ("total_length", "bigint"), ("empty_count", "bigint"), ("min_date", "timestamp_ntz"), ("max_date", "timestamp_ntz"),
)


def _hashable(c: Column, kind: str) -> Column:
    """A form that the distinct sketch takes: texts and numbers as they are, all else by its hash."""
    return c if kind == "text" else F.xxhash64(c)


def _measures(name: str, kind: str) -> dict[str, Column]:
    c = F.col(name)
    found = {"null_count": F.count_if(c.isNull()), "values": F.hll_sketch_agg(F.when(c.isNotNull(), _hashable(c, kind)), F.lit(HLL_BITS))}
    if kind == "number":
        x = c.cast("double")
        found |= {
            "min": F.min(x), "max": F.max(x), "n": F.count(x), "mean": F.avg(x), "m2": F.var_pop(x) * F.count(x),
            "quantiles": F.kll_sketch_agg_double(x, F.lit(KLL_SIZE)), "zeros_count": F.count_if(x == 0), "negative_count": F.count_if(x < 0),
        }
    elif kind == "text":
        length = F.length(c)
        found |= {
            "min_length": F.min(length), "max_length": F.max(length), "total_length": F.sum(length).cast("bigint"), "n": F.count(c),
            "empty_count": F.count_if(F.regexp_replace(c, r"(?U)^\s+", "") == ""),
        }
    elif kind == "date":
        found |= {"min_date": F.min(c).cast("timestamp_ntz"), "max_date": F.max(c).cast("timestamp_ntz")}
    return found


def sketch_columns(df: DataFrame, by: str) -> DataFrame:
    """One row for each value of ``by`` and each other column: sums and sketches of its values."""
    fields = [f for f in df.schema.fields if f.name != by]
    measures, rows = [F.count("*").alias("_rows")], []
    renamed = df.select(F.col(f"`{by}`").alias("_by"), *[F.col("`" + f.name.replace("`", "``") + "`").alias(f"c{i}") for i, f in enumerate(fields)])
    for i, f in enumerate(fields):
        values = {"name": F.lit(f.name), "dtype": F.lit(f.dataType.simpleString()), "rows": F.col("_rows")}
        for key, measure in _measures(f"c{i}", _kind(f.dataType)).items():
            measures.append(measure.alias(f"m{i}_{key}"))
            values[key] = F.col(f"m{i}_{key}")
        rows.append(F.struct(*[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in _SKETCH]))
    return renamed.groupBy("_by").agg(*measures).select(F.col("_by").alias(by), F.inline(F.array(*rows)))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row for each column over all given sketch rows; counts are exact, distinct counts and the
    median are estimates within the errors named above."""
    n = F.coalesce(F.col("n"), F.lit(0))
    whole = sketches.groupBy("name", "dtype").agg(
        F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count"), F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_count"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.sum("n").alias("_n"),
        (F.sum(n * F.col("mean")) / F.sum(F.when(F.col("mean").isNotNull(), n))).alias("_mean"),
        F.sum("m2").alias("_m2"), F.sum(n * F.col("mean") * F.col("mean")).alias("_q"),
        F.kll_merge_agg_double("quantiles").alias("_quantiles"), F.count("mean").alias("_parts"),
        F.sum("zeros_count").alias("zeros_count"), F.sum("negative_count").alias("negative_count"),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"), F.sum("total_length").alias("_length"), F.sum("empty_count").alias("empty_count"),
        F.min("min_date").alias("_from"), F.max("max_date").alias("_to"),
    )
    # squares about the whole mean: those within each part, and of the parts' means about it
    spread = F.col("_m2") + F.greatest(F.col("_q") - F.col("_n") * F.col("_mean") * F.col("_mean"), F.lit(0.0))
    share = lambda c: F.when(F.col("rows") > 0, F.bround(F.col(c) / F.col("rows") * 100, 2)).otherwise(0.0)
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    return whole.select(
        "name", "dtype", "rows", "null_count", share("null_count").alias("null_percentage"), "distinct_count", share("distinct_count").alias("distinct_percentage"),
        "min", "max", F.bround("_mean", 2).alias("mean"), F.when(F.col("_parts") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(0.5))).alias("median"), F.when(F.col("_n") > 1, F.bround(F.sqrt(spread / (F.col("_n") - 1)), 2)).alias("std"),
        "zeros_count", "negative_count", "min_length", "max_length", F.bround(F.col("_length") / F.col("_n"), 2).alias("avg_length"), "empty_count",
        F.col("_from").cast("string").alias("min_date"), F.col("_to").cast("string").alias("max_date"), F.floor((seconds("_to") - seconds("_from")) / 86400).alias("date_range_days"),
    )


def profile_incremental(spark: SparkSession, base: str, table: str, store: str, batch: str) -> DataFrame:
    """The profile of a bronze table over all its files, after sketching those that no batch before
    has taken. A batch that is run again, or that broke off, replaces its own sketches."""
    path, sketches = bronze_path(base, table), f"{store.rstrip('/')}/sketches"
    ledger = Ledger(spark, f"{store.rstrip('/')}/files")
    ledger.recover(batch, lambda b: delete(spark, f"{sketches}/{BATCH}={b}"))
    with Workspace(spark, "sketches") as work:
        found, paths = stage_fresh(ledger, path, batch, work)
        with ledger.batch(batch, found):
            if paths:
                landed = spark.read.option("basePath", path).parquet(*paths)
                write_batch(sketch_columns(landed, BRONZE_PARTITION), sketches, batch)
            else:
                delete(spark, f"{sketches}/{BATCH}={batch}")
    return merge_sketches(read_sketches(spark, store))


def read_sketches(spark: SparkSession, store: str) -> DataFrame:
    """The stored rows, by day and batch; any part of them can be merged, as the days of a month."""
    path = f"{store.rstrip('/')}/sketches"
    schema = ", ".join([f"{BRONZE_PARTITION} date", *(f"`{n}` {t}" for n, t in _SKETCH), f"{BATCH} string"])
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
