"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir); all but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from orelayer.llm.byte_bpe import encode_texts
from orelayer.llm.common import table
from orelayer.llm.decontaminate import contaminated
from orelayer.llm.line_dedup import dedup_lines
from orelayer.llm.minhash import exact_links
from orelayer.llm.simhash import near_groups
from orelayer.llm.toxicity import fit_toxicity, without_toxic
from orelayer.session import Workspace


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from these documents and ``labels``."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), Workspace(spark, "stage-toxicity"))
    return without_toxic(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; those left without text go."""
    out = dedup_lines(docs, Workspace(spark, "stage-lines"))
    same = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    text = F.when(F.col("n_dropped") == 0, F.col("row.text")).otherwise(F.col("kept_text"))
    out = out.where((F.col("n_dropped") == 0) | (F.btrim("kept_text") != "")).select(
        *same, text.alias("text"), F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("kept_text").cast("bigint")).alias("n_chars")
    )
    return out.select(*docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id.

    Near copies have a Jaccard similarity of 0.8 or more of their sets of five-word shingles, and
    groups are what links between such pairs join. Candidates are found by SimHash: 14 of 64 bits
    and 56 of 256 may differ, and the numbers of different shingles are within 0.8 of each other,
    which a pair at 0.8 meets 19 times in 20 and more alike ones nearly always. All pairs of a
    candidate group are then compared exactly. Rows without an id stay; rows that share an id, and
    repeated rows, stay or go together; texts without words are copies of each other. An empty
    table stays empty.
    """
    work = Workspace(spark, "stage-copies")
    verify = lambda links: exact_links(links, docs, Workspace(spark, "stage-copies-exact"), width=5, threshold=0.8)
    groups = near_groups(docs, work, width=5, max_bits=14, confirm_bits=56, size_ratio=0.8, verify=verify)
    gone = work.stage(groups.where("component_id < doc_id").select("doc_id").distinct(), "gone")
    unique = docs.join(gone, "doc_id", "left_anti")
    return unique.select(*docs.columns)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor most of one."""
    work = Workspace(spark, "stage-leaks")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"), work)
    found = work.stage(found.select("doc_id").distinct(), "found")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the check that they decode to its bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("simhash near-dedup", copies),
    ("benchmark decontamination", leaks),
    ("byte-level bpe", tokens),
]

#: No SQL: several stages can't be written in it. The tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = work.stage(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
