"""File sources: CSV, JSON, Parquet, bronze partitions, file checks."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Workspace, exists, list_names, quoted
from . import records
from .config import substitute

# Readable formats by file extension.
FORMATS = {
    ".csv": "csv",
    ".parquet": "parquet",
    ".json": "json",
    ".jsonl": "jsonl",
}
BRONZE_PARTITION = "ingested_date"


class SourceError(ValueError):
    """A source is missing, empty or of an unknown format."""


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# --- readers -------------------------------------------------------------------

@dataclass(frozen=True)
class CsvOptions:
    delimiter: str = ","
    encoding: str = "utf-8"
    header: bool = True
    skiprows: int = 0
    na_values: tuple[str, ...] = ()
    multiline: bool = False
    escape: str = '"'  # a quote inside quotes is doubled


def _null_out(df: DataFrame, na_values: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    if not na_values:
        return df
    texts = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(quoted(c)).isin(*na_values), F.col(quoted(c))) for c in texts})


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    options: CsvOptions = CsvOptions(),
) -> DataFrame:
    """CSV as text columns. Without names they are taken from the header line."""
    if options.skiprows:
        return read_csv_by_name(spark, path, columns, options).drop(records.PROBLEM)
    reader = (
        spark.read.option("sep", options.delimiter)
        .option("encoding", options.encoding)
        .option("header", options.header)
        .option("multiLine", options.multiline)
        .option("escape", options.escape)
        .option("mode", "PERMISSIVE")
    )
    if columns is not None:
        # Names are given: columns are matched by position, as in the file.
        reader = reader.schema(strings(columns)).option("enforceSchema", True)
    return _null_out(reader.csv(path), options.na_values)


def read_csv_by_name(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, options: CsvOptions = CsvOptions(), work: Workspace | None = None
) -> DataFrame:
    """CSV by the names in each file's header, with a ``_problem`` column, see ``records.by_name``.

    Files are read by splits, also where line breaks stand in quotes or leading lines are skipped.
    """
    found = records.by_name(
        spark, path, columns, work or Workspace(spark, "csv"), sep=options.delimiter, escape=options.escape, encoding=options.encoding,
        skiprows=options.skiprows, header=options.header,
    )
    texts = [c for c in found.columns if c != records.PROBLEM]
    return _null_out(found, options.na_values, texts)


def read_json(spark: SparkSession, path: str, lines: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines, or one array of records per file with ``lines=False``."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def detect_format(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in FORMATS:
        raise SourceError(f"unsupported file format: {suffix or path}")
    return FORMATS[suffix]


def read_file(spark: SparkSession, path: str, config: Mapping[str, Any] | None = None) -> DataFrame:
    """Read by extension; ``config`` holds the options per format."""
    config = config or {}
    kind = detect_format(path)
    if kind == "csv":
        options = dict(config.get("csv", {}))
        columns = options.pop("columns", None)
        if "na_values" in options:
            options["na_values"] = tuple(options["na_values"] or ())
        options["skiprows"] = options.get("skiprows") or 0
        if "header" in options:  # a line number means the file has a header
            options["header"] = options["header"] is not None and options["header"] is not False
        return read_csv(spark, path, columns, CsvOptions(**options))
    if kind == "parquet":
        return spark.read.parquet(path)
    return read_json(spark, path, lines=kind == "jsonl")


def read_source(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """A source described by ``path``, an optional ``expected_format`` and the
    options per format; ``${NAME}`` values come from the environment."""
    described = substitute(dict(config))
    if "path" not in described:
        raise SourceError("a source needs a path")
    check_file(spark, described["path"], described.get("expected_format"))
    return read_file(spark, described["path"], described)


def read_path_or_table(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    if path:
        return spark.read.parquet(path)
    if table:
        return spark.table(table)
    raise SourceError("a path or a table name is needed")


def newer_than(df: DataFrame, column: str, last: Any) -> DataFrame:
    """Rows after the last seen value; the filter reaches the file scan."""
    if column not in df.columns:
        raise SourceError(f"column '{column}' not found")
    return df.filter(F.col(column) > F.lit(last))


# --- bronze --------------------------------------------------------------------

def bronze_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def read_bronze(spark: SparkSession, base: str, table: str, merge_schema: bool = False) -> DataFrame:
    """All partitions of a bronze table; the partition date is a column."""
    reader = spark.read.option("basePath", bronze_path(base, table)).option("mergeSchema", merge_schema)
    return reader.parquet(bronze_path(base, table))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column from the folder names, sorted; reads no data."""
    mark = f"{column}="
    return [n[len(mark):] for n in list_names(spark, path) if n.startswith(mark)]


def latest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    found = partition_values(spark, path, column)
    return found[-1] if found else None


def read_latest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    latest = latest_partition(spark, path, column)
    if latest is None:
        raise SourceError(f"no {column} partition below {path}")
    return spark.read.option("basePath", path).parquet(f"{path}/{column}={latest}")


def latest_by_column(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the largest value of a column."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


# --- file checks -----------------------------------------------------------------

def file_info(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of every file, without reading the contents."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("file_path"),
        F.round(F.col("length") / 1024 / 1024, 2).alias("size_mb"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def check_file(spark: SparkSession, path: str, expected_format: str | None = None) -> str:
    """The format of an existing source; raises otherwise."""
    if not exists(spark, path):
        raise SourceError(f"file not found: {path}")
    kind = detect_format(path)
    if expected_format and kind != expected_format:
        raise SourceError(f"expected {expected_format}, found {kind}: {path}")
    return kind


def missing_sources(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    return [name for name, path in paths.items() if not exists(spark, path)]


def require_sources(spark: SparkSession, paths: Mapping[str, str], on_missing: str = "fail") -> bool:
    """True when all sources are there; otherwise raise, or return False to skip."""
    missing = missing_sources(spark, paths)
    if missing and on_missing == "fail":
        raise SourceError(f"missing sources: {missing}")
    return not missing
