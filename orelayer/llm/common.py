"""What the operators of this folder share: words, folds, byte arrays, connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelayer.session import Workspace

SPACES = " \t\n\x0b\f\r"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: By byte: white space as the contracts mean it; and the lower case of A-Z.
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Lets the Python workers of a session on one machine import this package from where it is.
    On a cluster it is installed, on the executors' PYTHONPATH, or sent by --py-files."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, home]))


def in_tasks(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with workers that can import this package."""
    importable(df.sparkSession)
    return df.mapInArrow(work, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a row without an id has fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged. Plain ASCII takes the fast way to the same result."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text column and each row's limits in them; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_limits(data: np.ndarray, offsets: np.ndarray, is_break: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each row; no word crosses rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_break[data]
    begin, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[first] = inside[1:-1][first]
    end[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = inside[offsets[1:][offsets[:-1] < offsets[1:]]]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, np.array([base], np.uint64)  # an array wraps around silently
    while done < n:
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done, step = 2 * done, step * step
    return out


ODD = 0x9E3779B97F4A7C15


class WordHash:
    """64-bit hashes of byte spans from one running sum; the powers are kept between calls."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(1 << 16, 2 * len(data))
            self.up, self.down = powers(ODD, n), powers(pow(ODD, -1, 1 << 64), n)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * self.down[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def components(edges: DataFrame, work: Workspace, name: str = "links") -> DataFrame:
    """Connected components of the links (a, b): one row (id, component) for every id that is not
    the smallest of its component.

    Alternating large-star and small-star rounds: each link ends up pointing at the smallest id.
    Every step is written to the shared folder, so that neither the plan nor what a lost executor
    held grows with the rounds, and joins with a hot id can be split.
    """
    links = work.stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), f"{name}-0"
    )
    before, turn = _state(links), 0
    while before[0]:
        turn += 1
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = work.stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-{turn}-low")
        large = work.stage(
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct(),
            f"{name}-{turn}-large",
        )
        least = work.stage(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{turn}-least")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = work.stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{turn}")
        now = _state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _state(links: DataFrame) -> tuple[int, int]:
    """Number of links and a checksum that does not depend on their order."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]
