"""Column expressions shared by the operators. All are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every Unicode blank plus the four ASCII separators, at either end.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# Extended ISO-8601: a date, then optionally a time with up to six fraction
# digits, then optionally Z or an offset below 24 hours.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)?)?$"
)
_OFFSET = r"(Z|[+-]\d{2}:\d{2})$"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return c.isNull() | (strip(c) == "")


def iso_timestamp(c: Column) -> Column:
    """Wall-clock timestamp of an ISO-8601 text, null for anything else.

    An offset is dropped, not applied, so a value never moves to another day.
    """
    local = F.regexp_replace(c, _OFFSET, "")
    return F.when(c.rlike(ISO_PATTERN), local.try_cast("timestamp_ntz"))


def year_range(c: Column, year: int) -> Column:
    """Rows of one calendar year as a range, which reaches the file scan."""
    start = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= start) & (c < end)


def canonical(c: Column, dtype: T.DataType) -> Column:
    """Form used to decide whether two stored values are the same.

    Times are compared to the second and a null text equals an empty one.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("second", c).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.coalesce(c, F.lit(""))
    return c


def period_label(year: Column, quarter: Column) -> Column:
    """``2021-Q3``."""
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))
