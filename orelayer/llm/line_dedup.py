"""Line deduplication over a whole corpus, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import SPACES, lower_ascii
from orelayer.session import Workspace


def _row_key() -> list[Column]:
    """128 bits that stand for a row's id and text: equal rows share them and have equal lines."""
    return [F.xxhash64("_id", "_text").alias("_k1"), F.xxhash64(F.lit(1), "_text", "_id").alias("_k2")]


def dedup_lines(docs: DataFrame, work: Workspace, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The documents without the lines that other documents hold already.

    Lines end at ``\\n``. A line's key is the line stripped of ASCII white space with A-Z in lower
    case; keys go on as 128-bit hashes. A key of at least ``min_chars`` code points that is found
    in at least ``min_docs`` documents stays only in the smallest id that holds it, with all its
    lines there. All other lines stay and are joined again by ``\\n`` in their order.

    Columns of the result: those of ``docs`` in a struct ``row``, ``kept_text``, ``n_lines`` (before
    dropping) and ``n_dropped``.

    Null or empty text is one empty line. Rows without an id pass whole and count as no document.
    Repeated rows, and rows that share an id, count as one document for that id. An empty table
    gives an empty result. Columns of other names, whatever they are, are only carried along.

    Shuffles: (hash, id) pairs for the count, with partial aggregation, so a line that a third of
    all documents hold is one row for each task; the pairs again, against the few repeated hashes,
    in a join that adaptive execution can split; and the texts once, by row, to drop positions.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    lines = rows.where("_id is not null").select("_id", *_row_key(), F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    keys = lines.withColumn("key", lower_ascii(F.btrim("line", F.lit(SPACES)))).where(F.length("key") >= min_chars)
    hashed = work.stage(keys.select("_id", "_k1", "_k2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")), "lines")
    held = hashed.groupBy("h1", "h2")
    if min_docs == 2:  # two documents or more: the smallest and the largest id differ
        repeated = held.agg(F.min("_id").alias("first"), F.max("_id").alias("last")).where("first < last")
    else:
        repeated = held.agg(F.min("_id").alias("first"), F.countDistinct("_id").alias("n")).where(F.col("n") >= min_docs)
    repeated = work.stage(repeated.select("h1", "h2", "first"), "repeated")
    out = hashed.join(repeated, ["h1", "h2"]).where("_id != first").groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("drop"))
    out = work.stage(out, "dropped")
    joined = rows.select("row", "_text", *_row_key()).join(out, ["_k1", "_k2"], "left")
    cut = F.split("_text", "\n")
    gone = F.coalesce(F.size("drop"), F.lit(0)).cast("bigint")
    parts = joined.select("row", "_text", "drop", F.size(cut).cast("bigint").alias("n_lines"), F.when(F.col("drop").isNull(), F.lit(0)).otherwise(gone).alias("n_dropped"))
    # sequence() without the dropped positions keeps the order; array_except hashes, so long texts stay linear
    left = F.array_except(F.sequence(F.lit(0), (F.col("n_lines") - 1).cast("int")), F.col("drop"))
    split = parts.withColumn("_lines", F.when(F.col("drop").isNotNull(), cut))
    kept = F.when(F.col("drop").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    return split.select("row", kept.alias("kept_text"), "n_lines", F.col("n_dropped").cast("bigint").alias("n_dropped"))
