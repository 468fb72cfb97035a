"""Source profile: per-column statistics, duplicates and a quality score.

Three passes at most, each bounded: a plain aggregate without a shuffle; the
counts per (column, value), reduced on the map side, for exact distinct counts,
medians and samples; and the counts of whole rows for duplicates.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Workspace, quoted
from ..sources.files import file_info, read_file
from .keys import ordered_parts

# Weights of the overall score.
COMPLETENESS_WEIGHT = 0.7
UNIQUENESS_WEIGHT = 0.3

SAMPLE_SIZE = 10

_STATS = (
    ("name", "string"), ("dtype", "string"), ("rows", "bigint"), ("null_count", "bigint"),
    ("min", "double"), ("max", "double"), ("mean", "double"), ("std", "double"),
    ("zeros_count", "bigint"), ("negative_count", "bigint"),
    ("min_length", "int"), ("max_length", "int"), ("avg_length", "double"), ("empty_count", "bigint"),
    ("min_date", "string"), ("max_date", "string"), ("date_range_days", "bigint"),
)
_DATES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return "number"
    if isinstance(dtype, _DATES):
        return "date"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return "other"


def _number(c: str) -> Column:
    return F.col(quoted(c)).cast("double")


def _column_measures(f: T.StructField) -> dict[str, Column]:
    c = F.col(quoted(f.name))
    found = {"null_count": F.count_if(c.isNull())}
    kind = _kind(f.dataType)
    if kind == "number":
        n = _number(f.name)
        found |= {
            "min": F.min(c).cast("double"),
            "max": F.max(c).cast("double"),
            "mean": F.bround(F.avg(n), 2),
            "std": F.bround(F.stddev_samp(n), 2),
            "zeros_count": F.count_if(n == 0),
            "negative_count": F.count_if(n < 0),
        }
    elif kind == "text":
        length = F.length(c)
        found |= {
            "min_length": F.min(length),
            "max_length": F.max(length),
            "avg_length": F.bround(F.avg(length), 2),
            "empty_count": F.count_if(F.regexp_replace(c, r"(?U)^\s+", "") == ""),
        }
    elif kind == "date":
        seconds = F.unix_seconds(c.cast("timestamp"))
        found |= {
            "min_date": F.min(c).cast("string"),
            "max_date": F.max(c).cast("string"),
            "date_range_days": F.floor((F.max(seconds) - F.min(seconds)) / 86400),
        }
    return found


def _stats(df: DataFrame, extra: dict[str, dict[str, Column]] | None = None, extra_types=()) -> DataFrame:
    """One row per column from a single aggregate."""
    measures, rows = [F.count("*").alias("_rows")], []
    layout = (*_STATS, *extra_types)
    for i, f in enumerate(df.schema.fields):
        found = _column_measures(f) | (extra or {}).get(f.name, {})
        values = {"name": F.lit(f.name), "dtype": F.lit(f.dataType.simpleString()), "rows": F.col("_rows")}
        for name, measure in found.items():
            alias = f"c{i}_{name}"
            measures.append(measure.alias(alias))
            values[name] = F.col(alias)
        rows.append(
            F.struct(*[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in layout])
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


# --- values -------------------------------------------------------------------

def value_counts(df: DataFrame) -> DataFrame:
    """Rows per (column, value) over all columns, one scan and one shuffle.

    A value sits in the slot of its type, so it is compared as what it is;
    slots no column needs are left out of the grouping. Null values are left
    out. While being counted a column is known by its number, not its name.
    """
    fields = df.schema.fields
    filled = [_slots(f, F.col(quoted(f.name))) for f in fields]
    used = [k for k in _SLOT_TYPES if any(k in slots for slots in filled)]
    entries = [
        F.struct(
            F.lit(i).alias("column"),
            F.col(quoted(f.name)).isNull().alias("_null"),
            *[slots.get(k, F.lit(None)).cast(_SLOT_TYPES[k]).alias(k) for k in used],
        )
        for i, (f, slots) in enumerate(zip(fields, filled))
    ]
    flat = df.select(F.inline(F.array(*entries))).filter("not _null")
    counted = flat.groupBy("column", *used).agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(f.name) for f in fields])
    absent = [F.lit(None).cast(t).alias(k) for k, t in _SLOT_TYPES.items() if k not in used]
    return counted.select(F.get(names, F.col("column")).alias("name"), *used, *absent, "n")


_SLOT_TYPES = {
    "whole": "bigint", "frac": "double", "wall": "timestamp_ntz", "instant": "timestamp", "text": "string",
}


def _slots(f: T.StructField, c: Column) -> dict[str, Column]:
    kind = _kind(f.dataType)
    if isinstance(f.dataType, T.DecimalType):
        return {"frac": c, "text": c}  # the text keeps the digits a double loses
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return {"frac": c}
    if kind == "number":
        return {"whole": c}
    if isinstance(f.dataType, T.TimestampType):
        return {"instant": c}
    if kind == "date":
        return {"wall": c}
    return {"text": c if kind == "text" else F.to_json(F.struct(c))}


def _samples(counts: DataFrame, size: int) -> DataFrame:
    """The first distinct values of each column in sort order."""
    order = Window.partitionBy("name").orderBy(*_SLOT_TYPES)
    shown = F.coalesce(
        F.col("whole").cast("string"),
        F.col("frac").cast("string"),
        F.col("wall").cast("string"),
        F.col("instant").cast("string"),
        F.col("text"),
    )
    first = counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size)
    listed = first.groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct("_rank", shown.alias("shown")))).alias("_s")
    )
    return listed.select("name", F.col("_s.shown").alias("sample_values"))


def exact_medians(counts: DataFrame, work: Workspace) -> DataFrame:
    """Median per numeric column from the value counts.

    The values are put into global order over range parts; the part totals
    tell each value the ranks it covers, and the one or two middle ranks are
    picked. No task ever holds the values of a whole column.
    """
    numbers = counts.filter("whole is not null or frac is not null").select(
        "name", F.coalesce(F.col("whole").cast("double"), F.col("frac")).alias("value"), "n"
    )
    parts = ordered_parts(numbers, ["name", "value"], work, "values")
    # Part totals per column: at most (parts + columns) rows.
    totals = parts.groupBy("name", "_part").agg(F.sum("n").alias("_total"))
    every, upto = Window.partitionBy("name"), Window.partitionBy("name").orderBy("_part")
    ends = totals.withColumns({"_end": F.sum("_total").over(upto), "_all": F.sum("_total").over(every)})
    ranges = ends.select(
        "name",
        "_part",
        (F.col("_end") - F.col("_total")).alias("_offset"),
        "_end",
        F.floor((F.col("_all") + 1) / 2).alias("_lo"),
        F.floor((F.col("_all") + 2) / 2).alias("_hi"),
    )
    # Only the parts that hold a middle rank are looked into: two per column at most.
    hit = ranges.filter("(_lo > _offset and _lo <= _end) or (_hi > _offset and _hi <= _end)")
    inside = Window.partitionBy("name", "_part").orderBy("_pos")
    ranked = (
        parts.join(F.broadcast(hit), ["name", "_part"])
        .withColumn("_upto", F.col("_offset") + F.sum("n").over(inside))
        .withColumn("_from", F.col("_upto") - F.col("n"))
    )
    picked = ranked.select(
        "name",
        F.when((F.col("_lo") > F.col("_from")) & (F.col("_lo") <= F.col("_upto")), F.col("value")).alias("a"),
        F.when((F.col("_hi") > F.col("_from")) & (F.col("_hi") <= F.col("_upto")), F.col("value")).alias("b"),
    )
    return picked.groupBy("name").agg(((F.max("a") + F.max("b")) / 2).alias("median"))


# --- the profile ----------------------------------------------------------------

def _share(part: str) -> Column:
    return F.when(F.col("rows") > 0, F.bround(F.col(part) / F.col("rows") * 100, 2)).otherwise(F.lit(0.0))


_ORDER = [
    "name", "dtype", "null_count", "null_percentage", "distinct_count", "distinct_percentage",
    "min", "max", "mean", "median", "std", "zeros_count", "negative_count",
    "min_length", "max_length", "avg_length", "empty_count",
    "min_date", "max_date", "date_range_days", "sample_values", "rows",
]


def profile_columns(
    df: DataFrame,
    exact: bool = True,
    sample_size: int = SAMPLE_SIZE,
    work: Workspace | None = None,
) -> DataFrame:
    """One row per column.

    ``exact=False`` takes sketches for distinct counts and medians: a single
    aggregate, without samples.
    """
    if not exact:
        sketches = {}
        for f in df.schema.fields:
            sketches[f.name] = {"distinct_count": F.approx_count_distinct(quoted(f.name))}
            if _kind(f.dataType) == "number":
                sketches[f.name]["median"] = F.percentile_approx(_number(f.name), 0.5)
        types = (("distinct_count", "bigint"), ("median", "double"), ("sample_values", "array<string>"))
        stats = _stats(df, sketches, types)
    else:
        work = work or Workspace(df.sparkSession, "profile")
        counts = work.stage(value_counts(df), "counts")
        distinct = counts.groupBy("name").agg(F.count("*").alias("distinct_count"))
        stats = (
            _stats(df)
            .join(F.broadcast(distinct), "name", "left")  # one row per column
            .join(F.broadcast(exact_medians(counts, work)), "name", "left")
            .join(F.broadcast(_samples(counts, sample_size)), "name", "left")
            .fillna(0, subset=["distinct_count"])
        )
    return stats.withColumns(
        {"null_percentage": _share("null_count"), "distinct_percentage": _share("distinct_count")}
    ).select(*_ORDER)


def profile_overview(df: DataFrame) -> DataFrame:
    """Rows, columns and repeated rows.

    One scan and one shuffle, of whole rows that each task has counted before: a
    row that was copied any number of times is one row for each task. Maps are
    compared by their JSON form.
    """
    whole = [F.to_json(F.struct(quoted(f.name))).alias(f"c{i}") if "map<" in f.dataType.simpleString() else F.col(quoted(f.name)).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]
    counted = df.select(*whole).groupBy(*[f"c{i}" for i in range(len(whole))]).agg(F.count("*").alias("_n"))
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
    share = F.bround(F.col("duplicate_rows") / F.col("total_rows") * 100, 2)
    return total.select(
        "total_rows",
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        "duplicate_rows",
        F.when(F.col("total_rows") > 0, share).otherwise(F.lit(0.0)).alias("duplicate_percentage"),
    )


def quality_score(columns: DataFrame) -> DataFrame:
    """Completeness, uniqueness and weighted score from a column profile."""
    totals = columns.agg(
        F.sum("null_count").alias("nulls"),
        F.sum("rows").alias("cells"),
        F.avg("distinct_count").alias("distinct_mean"),
        F.max("rows").alias("rows"),
    )
    complete = F.bround((1 - F.col("nulls") / F.col("cells")) * 100, 2)
    unique = F.bround(F.col("distinct_mean") / F.col("rows") * 100, 2)
    scored = totals.select(
        F.when(F.col("cells") > 0, complete).otherwise(F.lit(0.0)).alias("completeness"),
        F.when(F.col("cells") > 0, unique).otherwise(F.lit(0.0)).alias("uniqueness"),
    )
    overall = F.col("completeness") * COMPLETENESS_WEIGHT + F.col("uniqueness") * UNIQUENESS_WEIGHT
    return scored.select(F.bround(overall, 2).alias("overall_score"), "completeness", "uniqueness")


def profile(df: DataFrame, source_name: str, exact: bool = True, work: Workspace | None = None) -> DataFrame:
    """The whole profile as one row: overview, columns and score."""
    columns = profile_columns(df, exact, work=work)
    listed = columns.agg(F.array_sort(F.collect_list(F.struct(*_ORDER))).alias("columns"))
    return listed.select(
        F.lit(source_name).alias("source_name"),
        F.current_timestamp().alias("timestamp"),
        profile_overview(df).select(F.struct("*")).scalar().alias("overview"),
        "columns",
        quality_score(columns).select(F.struct("*")).scalar().alias("quality_score"),
    )


def profile_file(spark: SparkSession, path: str, config: Mapping[str, Any] | None = None, exact: bool = True) -> DataFrame:
    """Profile of a file, with the size and time of what lies at the path."""
    info = file_info(spark, path).agg(
        F.count("*").alias("files"),
        F.round(F.sum("size_bytes") / 1024 / 1024, 2).alias("file_size_mb"),
        F.max("modified_at").alias("modified_at"),
    )
    name = path.rstrip("/").rsplit("/", 1)[-1]
    described = info.select(F.struct(F.lit(name).alias("file_name"), F.lit(path).alias("file_path"), "*"))
    found = profile(read_file(spark, path, config), name, exact)
    return found.withColumn("file_info", described.scalar())


__all__ = [
    "exact_medians", "profile_file", "profile", "profile_columns", "profile_overview",
    "quality_score", "value_counts",
]
