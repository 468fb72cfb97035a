"""Database sources and sinks over JDBC."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Database:
    url: str
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        found = {"url": self.url, **self.properties}
        if self.driver:
            found["driver"] = self.driver
        return found


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: ranges of a numeric, date or time column."""

    column: str
    lower: Any
    upper: Any
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def table_options(
    db: Database, table: str, schema: str | None = None, split: Split | None = None, fetch_size: int = 10000
) -> dict[str, str]:
    name = f"{schema}.{table}" if schema else table
    found = {**db.options(), "dbtable": name, "fetchsize": str(fetch_size)}
    return {**found, **split.options()} if split else found


_NAME = re.compile(r"(?<!:):(\w+)")


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def bind(query: str, params: Mapping[str, Any] | None = None) -> str:
    """Replace ``:name`` by a quoted literal, in one pass; ``::type`` is left alone.

    Values only, never table or column names.
    """
    known = params or {}
    return _NAME.sub(lambda m: _literal(known[m.group(1)]) if m.group(1) in known else m.group(0), query)


def read_table(
    spark: SparkSession,
    db: Database,
    table: str,
    columns: Sequence[str] | None = None,
    schema: str | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A table; chosen columns and later filters run in the database."""
    df = spark.read.format("jdbc").options(**table_options(db, table, schema, split)).load()
    return df.select(*columns) if columns else df


def read_table_since(
    spark: SparkSession,
    db: Database,
    table: str,
    column: str,
    last: Any,
    schema: str | None = None,
    split: Split | None = None,
) -> DataFrame:
    return read_table(spark, db, table, schema=schema, split=split).filter(F.col(column) > F.lit(last))


def read_query(spark: SparkSession, db: Database, query: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**db.options()).option("query", bind(query, params)).load()


def write_table(df: DataFrame, db: Database, table: str, mode: str = "append", batch_size: int = 10000) -> None:
    """Append or overwrite; overwriting keeps the table and empties it first."""
    writer = df.write.format("jdbc").options(**db.options()).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size))
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()
