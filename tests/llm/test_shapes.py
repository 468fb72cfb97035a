"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orelayer.llm import stages
from orelayer.llm.byte_bpe import encode_texts
from orelayer.llm.decontaminate import contaminated
from orelayer.llm.lattice_lm import lattice_scores, read_pieces
from orelayer.llm.line_dedup import dedup_lines
from orelayer.llm.quality_votes import judge
from orelayer.llm.simhash import near_groups
from orelayer.llm.token_spans import section_tokens
from orelayer.llm.toxicity import fit_toxicity, score_toxicity
from orelayer.llm.transcripts import recover_roles
from orelayer.llm.wrappers import extract_text

LONG = "word " * 30_000 + "x" * 20_000
DOCS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One line here.\nA second line of text\nA second line of text"), (4, "One line here.\nA second line of text\nA second line of text"),
    (5, "a second line of text  \nshort"), (None, "A second line of text"), (6, LONG), (7, LONG), (8, "Ünïcode Ça\u0085  x"), (8, "another text of the same id, a second line"),
]
CLASH = ["row", "_text", "_id", "_k1", "drop", "pos", "key", "h", "h1", "fp", "id", "n", "kind", "block", "words", "class", "score", "label", "start", "chunk", "host", "main"]
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit(c) for c in CLASH}).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in (1, 2, 4, 5, 6, 8)] + [(None, 1), (4, None)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "A second line of text"), (3, "A second line of text"), (None, "x")], "item_id long, text string")


def _operators(spark, work, docs, labels, benchmark):
    pieces = read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.example/x").alias("url"), F.col("text").alias("html"), *CLASH)
    talks = docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), "text", *[c for c in CLASH])
    return {
        "toxicity": lambda: score_toxicity(docs, fit_toxicity(docs, labels, work)),
        "spans": lambda: section_tokens(docs, PATH, public_tokenizers.PATTERN),
        "wrappers": lambda: extract_text(pages, work),
        "lattice": lambda: lattice_scores(docs, *pieces, work, class_col="lang"),
        "transcripts": lambda: recover_roles(talks, work),
        "lines": lambda: dedup_lines(docs, work),
        "leaks": lambda: contaminated(docs, benchmark, work),
        "simhash": lambda: near_groups(docs, work),
        "bpe": lambda: encode_texts(docs, PATH, public_tokenizers.PATTERN),
        "votes": lambda: judge(docs, work)[0],
    }


NAMES = ["toxicity", "spans", "wrappers", "lattice", "transcripts", "lines", "leaks", "simhash", "bpe", "votes"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, work, docs, labels, benchmark, name):
    got = _operators(spark, work, docs, labels, benchmark)[name]().collect()
    if name in ("toxicity", "wrappers", "lattice", "lines", "simhash", "bpe", "votes"):
        assert len(got) == len(DOCS)  # a row for each row, repeated ones too
    by = {}
    for r in got:
        r = r.asDict()
        by.setdefault(r["row"]["doc_id"] if name == "lines" else next(iter(r.values())), []).append(r)
    if name == "lines":
        assert [r["kept_text"] for r in by[4]] == [DOCS[3][1]] * 2  # the smallest id keeps its lines
        assert by[5][0]["kept_text"] == "short" and (by[5][0]["n_lines"], by[5][0]["n_dropped"]) == (2, 1)
        assert by[None][0]["kept_text"] == "A second line of text"  # no id: passes whole
        assert by[1][0]["kept_text"] == "" and by[1][0]["n_lines"] == 1
        assert by[7][0]["kept_text"] == "" and by[6][0]["kept_text"] == LONG
    if name == "simhash":
        assert {r["fingerprint"] for i in (1, 2, 3) for r in by[i]} == {"0" * 16}
        assert by[3][0]["component_id"] == 1 and by[7][0]["component_id"] == 6 and by[None][0]["component_id"] is None
    if name == "bpe":
        assert by[1][0]["n_tokens"] == by[2][0]["n_tokens"] == 0
        for i, text in DOCS:
            assert hashlib.sha256((text or "").encode()).hexdigest() in {r["decoded_sha256"] for r in by[i]}
    if name == "leaks":
        assert {(i, r["item_id"]) for i, rows in by.items() for r in rows} == {(4, 3), (5, 3)}
    if name == "lattice":
        assert by[1][0]["n_tokens"] == 1 and by[6][0]["n_tokens"] == 30_002
        assert all(r["score"] < 0 and r["score"] == r["score"] for rows in by.values() for r in rows)
    if name == "spans":
        assert sum(r["n_tokens"] for r in by[4]) % 2 == 0 and {r["section"] for r in by[1]} == {"0"}
    if name == "votes":
        assert by[2][0]["n_words"] == 0 and by[2][0]["base_failed"] and not by[2][0]["kept"]
        assert by[6][0]["n_words"] == 30_001 and by[6][0]["n_repeat_words"] == 30_000
    if name == "toxicity":
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for rows in by.values() for r in rows)
    if name == "transcripts":
        assert len([r for r in got if r["text"] is None]) == 0 and None not in by


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, work, docs, labels, benchmark, name):
    none = docs.where("false")
    assert _operators(spark, work, none, labels.where("false"), benchmark.where("false"))[name]().collect() == []


@pytest.fixture(scope="module")
def folder(spark, docs, labels, benchmark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{top}/documents.parquet")
    labels.write.parquet(f"{top}/labels.parquet")
    benchmark.write.parquet(f"{top}/benchmark.parquet")
    return top


@pytest.mark.parametrize("number", range(len(stages.STAGES)))
def test_stage_keeps_columns(spark, folder, number):
    name, stage = stages.STAGES[number]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(spark, docs, folder)
    if number < len(stages.STAGES) - 1:
        assert dict(out.dtypes) == dict(docs.dtypes)
    kept = [r[0] for r in out.collect()]
    if name == "benchmark decontamination":
        assert set(kept) == {1, 2, 3, None, 6, 7, 8}
    if name == "simhash near-dedup":
        assert set(kept) == {1, 4, 5, 6, 8, None} and kept.count(4) == 2
    if name == "line dedup":
        assert set(kept) >= {4, 5, 6, 8, None} and 7 not in kept
    assert stage(spark, docs.where("false"), folder).collect() == []


def test_pipeline(spark, folder):
    rows = stages.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} <= {i for i, _ in DOCS}
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
