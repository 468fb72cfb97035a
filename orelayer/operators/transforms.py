"""Reusable DataFrame transformations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Workspace, broadcast_if_small
from .keys import consecutive_key, spread_key


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names that do not occur are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by mapping; a value that cannot be cast becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def add_calculated_column(df: DataFrame, name: str, expression: str) -> DataFrame:
    return df.withColumn(name, F.expr(expression))


def filter_by_condition(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(condition)


def clean_nulls(df: DataFrame, columns: Sequence[str] | None = None, strategy: str = "drop") -> DataFrame:
    """Drop rows with nulls, or fill the columns whose type fits the filler."""
    chosen = list(columns or df.columns)
    if strategy == "drop":
        return df.dropna(subset=chosen)
    if strategy == "fill_zero":
        kind, filler = T.NumericType, 0
    elif strategy == "fill_empty":
        kind, filler = T.StringType, ""
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    fitting = [f.name for f in df.schema.fields if f.name in chosen and isinstance(f.dataType, kind)]
    return df.fillna(filler, subset=fitting) if fitting else df


def standardize_dates(df: DataFrame, column: str, output_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return df.withColumn(column, F.date_format(F.col(column), output_format))


def deduplicate(df: DataFrame, key_columns: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key, the smallest (``first``) or largest (``last``) by value.

    All columns take part in the order. ``row_number() = 1`` is applied on the
    map side too, so each task sends at most one row per key. Rows with a null
    key are no duplicates of each other: all are kept.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    rest = [c for c in df.columns if c not in key_columns]
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in rest or key_columns]
    return _first_of_key(df, key_columns, order)


def _first_of_key(df: DataFrame, key_columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in one scan; a row without a key has a tag of its own."""
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key_columns])
    tagged = df.withColumn("_tag", F.when(keyless, F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    ranked = Window.partitionBy(*key_columns, "_tag").orderBy(*order)
    return tagged.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank", "_tag")


def latest_by_key(df: DataFrame, key_columns: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key, the one that arrived last; ties go to the largest value.

    Rows with a null key are no duplicates of each other: all are kept.
    """
    rest = [c for c in df.columns if c not in key_columns and c not in arrival]
    return _first_of_key(df, key_columns, [F.col(c).desc() for c in (*arrival, *rest)])


def add_surrogate_key(
    df: DataFrame,
    key_column: str = "id",
    start_value: int = 1,
    order_by: Sequence[str] | None = None,
    work: Workspace | None = None,
) -> DataFrame:
    """Consecutive keys over ``order_by``; without an order, unique gapped keys."""
    if order_by is None:
        return spread_key(df, key_column, start_value)
    return consecutive_key(df, order_by, key_column, start_value, work)


def enrich_with_lookup(df: DataFrame, lookup: DataFrame, join_column: str, join_type: str = "left") -> DataFrame:
    """Join on a shared column. A small lookup is broadcast after a size check.

    ``right`` and ``full`` are put together from the matched rows and the
    lookup rows whose key is never used. The keys in use are reduced before
    they are shuffled, so neither form sends the rows of a hot key to one task,
    which a plain right or full join of two large tables would do.
    """
    kind = join_type.lower().replace("_", "").replace("outer", "") or "full"
    small = broadcast_if_small(lookup)
    shared = set(df.columns) & set(lookup.columns) - {join_column}
    if kind not in ("right", "full") or shared:
        plain = kind in ("inner", "left", "leftsemi", "leftanti", "semi", "anti")
        return df.join(small if plain else lookup, join_column, join_type)
    matched = df.join(small, join_column, "inner" if kind == "right" else "left")
    used = df.select(join_column).filter(F.col(join_column).isNotNull()).distinct()
    unused = lookup.join(used, join_column, "left_anti")
    return matched.unionByName(unused, allowMissingColumns=True)


def aggregate_metrics(
    df: DataFrame, group_by_columns: Sequence[str], aggregations: Mapping[str, str]
) -> DataFrame:
    """Any aggregate by name per column; outputs are named ``{column}_{function}``."""
    metrics = [
        F.call_function(fn, F.col(column)).alias(f"{column}_{fn}") for column, fn in aggregations.items()
    ]
    return df.groupBy(*group_by_columns).agg(*metrics)
