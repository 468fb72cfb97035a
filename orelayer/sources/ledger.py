"""Which bronze files have been loaded, by which batch.

A load takes the files that no other batch has taken, whatever day they lie in, so a late append or a
late day is found and nothing is read twice. The batch's list of files is written last and renamed
into place: that is the moment at which a batch counts as loaded. Until then a marker says that it is
open, and the next load first takes away what an open batch left behind.

One load of a table runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Workspace, delete, exists, list_names, make_dir, move
from .files import partition_values

FILES = "path string, length bigint, modified timestamp"
BATCH = "batch_id"


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, modified) of all files below a folder; no contents are read."""
    if not exists(spark, path):
        return spark.createDataFrame([], FILES)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


class Ledger:
    """The files of one table, by batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def taken(self, but: str | None = None) -> DataFrame:
        """Files that batches have loaded, without those of one batch."""
        schema = f"{FILES}, {BATCH} string"
        if not partition_values(self.spark, self.root, BATCH):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.root)
        return rows if but is None else rows.where(F.col(BATCH) != but)

    def fresh(self, source: str, batch: str) -> DataFrame:
        """Files below ``source`` that no other batch has loaded. A file that was replaced, by its
        length or time, is another file."""
        same = ["path", "length", "modified"]
        return list_files(self.spark, source).join(self.taken(but=batch).select(*same), same, "left_anti")

    def open_batches(self) -> list[str]:
        return list_names(self.spark, f"{self.root}/_open")

    @contextmanager
    def batch(self, batch: str, files: DataFrame) -> Iterator[None]:
        """The body loads ``files`` (a written table) as ``batch``; they are taken once it has ended."""
        marker = f"{self.root}/_open/{batch}"
        make_dir(self.spark, marker)
        yield
        aside = f"{self.root}/_aside/{uuid.uuid4().hex}"
        files.select("path", "length", "modified").coalesce(1).write.parquet(aside)
        target = f"{self.root}/{BATCH}={batch}"
        delete(self.spark, target)  # the same batch before; its files are all in the new list or gone
        move(self.spark, aside, target)
        delete(self.spark, marker)

    def recover(self, batch: str, undo: Callable[[str], None]) -> list[str]:
        """Take away what other batches left that broke off: ``undo(b)`` removes their output, and
        their files are free again, also those of an earlier run of theirs, which the broken one had
        begun to replace."""
        broken = [b for b in self.open_batches() if b != batch]
        for b in broken:
            undo(b)
            delete(self.spark, f"{self.root}/{BATCH}={b}")
            delete(self.spark, f"{self.root}/_open/{b}")
        return broken


def stage_fresh(ledger: Ledger, source: str, batch: str, work: Workspace) -> tuple[DataFrame, list[str]]:
    """The fresh files as a written table and as a list of paths, which a scan holds as well."""
    files = work.stage(ledger.fresh(source, batch), "fresh_files")
    return files, [r[0] for r in files.select("path").orderBy("path").collect()]
