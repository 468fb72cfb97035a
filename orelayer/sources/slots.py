"""A log of small records in numbered files, each made by whoever gets its number first.

A writer takes the number after the last one and creates that file; if another writer was there
before, it goes on to the next number. Files are never changed, so the number is an id without a
lock and the order of numbers is the order of the log. What a record says is decided by the reader:
of two records that exclude each other, the lower number counts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import create_new, list_names

SLOT = "_slot"


def _plain(value: Any) -> Any:
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%dT%H:%M:%S.%f")
    if isinstance(value, (date, Decimal)):
        return str(value)
    return value


class SlotLog:
    """Records of several tables in one log; a file holds what belongs together, and is there as a whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def last(self) -> int:
        """The highest number in the log just now, 0 if it is empty."""
        return max([int(n.split(".")[0]) for n in list_names(self.spark, self.path) if n.endswith(".json")], default=0)

    def append(self, records: Callable[[int], Sequence[tuple[str, Mapping[str, Any]]]]) -> int:
        """Write the (table, row) records that belong to a number, and return the number that was won."""
        slot = self.last() + 1
        while True:
            lines = [json.dumps({"table": t, "row": json.dumps({k: _plain(v) for k, v in row.items()})}) for t, row in records(slot)]
            if create_new(self.spark, f"{self.path}/{slot:012d}.json", "\n".join(lines) + "\n"):
                return slot
            slot += 1

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """All rows of one table with the number of their file, ``_slot``."""
        slotted = T.StructType([*schema.fields, T.StructField(SLOT, T.LongType())])
        if not self.last():
            return self.spark.createDataFrame([], slotted)
        lines = self.spark.read.schema("table string, row string").json(self.path)
        slot = F.split(F.col("_metadata.file_name"), r"\.")[0].cast("long").alias(SLOT)
        rows = lines.where(F.col("table") == table).select(F.from_json("row", schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("r"), slot)
        return rows.select("r.*", SLOT)
