"""Ranked lexical search: bundles of items go from one owner of terms to the next and gather scores."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orelayer.llm.common import TO_LOWER, WordHash, importable, in_tasks, text_bytes, word_limits
from orelayer.session import Workspace

#: By byte: whether it ends a term. ASCII letters and digits and all that is not ASCII make up terms.
ENDS_TERM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LISTS = "shard long, term int, df long, docs binary, tf binary, n binary, ids binary, n_docs long, n_terms long"
_BUNDLE = "shard long, item int, docs binary, scores binary"


def term_hashes(column, hasher: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms of a text column, and the number of terms before each row."""
    data, offsets = text_bytes(column)
    data = TO_LOWER[data]
    starts, ends, first = word_limits(data, offsets, ENDS_TERM)
    return hasher(data, starts, ends), first


def item_terms(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term): each item's distinct terms as hashes; rows that share an id are one item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash()
        for batch in batches:
            h, first = term_hashes(batch.column("text"), hasher)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(first))
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(rows)), pa.array(h.view(np.int64))], ["item", "term"])

    plain = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    return in_tasks(plain, work, "item long, term long").distinct()


def postings(docs: DataFrame, terms: np.ndarray, *, id_col: str, text_col: str, shard_docs: int, shard_bytes: int) -> DataFrame:
    """The inverted lists of ``terms`` (sorted hashes), one row for each term and shard of documents.

    A shard is a run of at most ``shard_docs`` documents of one task, numbered by ascending id.
    ``docs``, ``tf`` and ``n`` are arrays of 32-bit numbers: the document's number, how often the
    term occurs in it, how many terms it has. The row without a term is the shard's directory:
    ``ids`` by number, and the shard's documents and terms in all.
    """
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = WordHash(), TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for part, n_bytes in _pieces(batch, min(shard_docs, 1024), shard_bytes // 4):
                if held and (size + n_bytes > shard_bytes or sum(len(x[0]) for x in held) + part.num_rows > shard_docs):
                    yield _shard_rows(held, number)
                    held, size, number = [], 0, number + 1
                held.append(_tally(part, known.value, hasher))
                size += n_bytes
        if held:
            yield _shard_rows(held, number)

    return in_tasks(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), work, _LISTS)


def _pieces(batch: pa.RecordBatch, rows: int, most: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices of at most ``rows`` rows and about ``most`` bytes of text, with their bytes."""
    _, offsets = text_bytes(batch.column("text"))
    a = 0
    while a < batch.num_rows:
        b = min(a + rows, max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1))
        yield batch.slice(a, b - a), int(offsets[b] - offsets[a])
        a = b


def _tally(part: pa.RecordBatch, known: np.ndarray, hasher: WordHash):
    """Ids, terms in each document, and (term, document, occurrences) of the known terms."""
    h, first = term_hashes(part.column("text"), hasher)
    n = np.diff(first)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = np.flatnonzero(known[at] == h)
    doc = np.searchsorted(first, hit, "right") - 1
    pair, tf = np.unique(at[hit] * part.num_rows + doc, return_counts=True)
    return part.column("id"), n, pair // part.num_rows, pair % part.num_rows, tf


def _shard_rows(held: list, number: int) -> pa.RecordBatch:
    ids = pa.concat_arrays([x[0] for x in held])
    named = ids.is_valid().to_numpy(zero_copy_only=False)
    ids, n = ids.fill_null(0).to_numpy(), np.concatenate([x[1] for x in held])
    order = np.lexsort((ids, ~named))  # rows without an id come last and get no number
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    base = np.cumsum([0] + [len(x[1]) for x in held])
    term = np.concatenate([x[2] for x in held])
    doc = np.concatenate([x[3] + b for x, b in zip(held, base)])
    tf = np.concatenate([x[4] for x in held])
    sort = np.lexsort((place[doc], term))
    term, doc, tf = term[sort], doc[sort], tf[sort]
    cuts = np.flatnonzero(np.diff(term, prepend=-1))
    raw = lambda x: x.astype(np.int32).tobytes()
    rows = {c: [] for c in ("term", "df", "docs", "tf", "n")}
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(term)).tolist()):
        keep = slice(a, b) if named.all() else np.flatnonzero(named[doc[a:b]]) + a
        for c, v in zip(rows, (int(term[a]), b - a, raw(place[doc[keep]]), raw(tf[keep]), raw(n[doc[keep]]))):
            rows[c].append(v)
    k = len(cuts)
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([number] * (k + 1)), "term": pa.array([*rows["term"], None], pa.int32()), "df": pa.array([*rows["df"], None], pa.int64()),
        **{c: pa.array([*rows[c], None], pa.binary()) for c in ("docs", "tf", "n")},
        "ids": pa.array([None] * k + [ids[order][: named.sum()].astype(np.int64).tobytes()], pa.binary()),
        "n_docs": pa.array([None] * k + [int((n > 0).sum())], pa.int64()), "n_terms": pa.array([None] * k + [int(n.sum())], pa.int64()),
    })


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def part_scores(tf: np.ndarray, n: np.ndarray, w: int, n_docs: int, n_terms: int) -> np.ndarray:
    """What one term adds to each document's score, in 64-bit integers."""
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Owner:
    """One owner of terms: adds what its lists hold to the bundles that come by.

    ``terms``: term -> (weight, items that ask for it). ``rest``: by item, the most that all later
    owners can still add. A document is let go once that can't lift it to the ``top`` best of its
    own shard, so it could not be among the ``top`` best of all; nothing else is let go.
    """

    def __init__(self, terms: dict[int, tuple[int, np.ndarray]], rest: np.ndarray, n_docs: int, n_terms: int, top: int):
        self.terms, self.rest, self.n_docs, self.n_terms, self.top = terms, rest, n_docs, n_terms, top

    def __call__(self, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        held, asked, size = {}, {}, 0
        for item, docs, scores in zip(*(bundles.column(c).to_pylist() for c in ("item", "docs", "scores"))):
            held[item] = np.frombuffer(docs, np.int32), np.frombuffer(scores, np.int64)
            size = max(size, int(held[item][0].max()) + 1)
        for term, docs, tf, n in zip(*(lists.column(c).to_pylist() for c in ("term", "docs", "tf", "n"))):
            w, items = self.terms[term]
            docs, tf, n = (np.frombuffer(x, np.int32) for x in (docs, tf, n))
            if len(docs) and w:
                size = max(size, int(docs.max()) + 1)
                adds = part_scores(tf.astype(np.int64), n.astype(np.int64), w, self.n_docs, self.n_terms)
                for i in items.tolist():
                    asked.setdefault(i, []).append((docs, adds))
        shard = next((t.column("shard")[0].as_py() for t in (bundles, lists) if t.num_rows), None)
        total, out = np.zeros(size, np.int64), {"item": [], "docs": [], "scores": []}
        for i in sorted(held.keys() | asked.keys()):
            total[:] = 0
            if i in held:
                total[held[i][0]] = held[i][1]
            for docs, adds in asked.get(i, []):
                total[docs] += adds  # a list names a document once
            found = np.flatnonzero(total)
            scores = total[found]
            if len(found) > self.top:
                keep = scores + self.rest[i] >= np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
                found, scores = found[keep], scores[keep]
            for c, v in zip(out, (i, found.astype(np.int32).tobytes(), scores.tobytes())):
                out[c].append(v)
        return pa.table({
            "shard": pa.array([shard] * len(out["item"]), pa.int64()), "item": pa.array(out["item"], pa.int32()),
            "docs": pa.array(out["docs"], pa.binary()), "scores": pa.array(out["scores"], pa.binary()),
        })


def _select(top: int, items: list):
    """The best of each item in one shard, with the documents' ids from the shard's directory."""

    def best(bundles: pa.Table, directory: pa.Table) -> pa.Table:
        out = {"item_id": [], "doc_id": [], "score": []}
        ids = np.frombuffer(directory.column("ids")[0].as_py(), np.int64)
        for item, docs, scores in zip(*(bundles.column(c).to_pylist() for c in ("item", "docs", "scores"))):
            docs, scores = np.frombuffer(docs, np.int32), np.frombuffer(scores, np.int64)
            first = np.lexsort((docs, -scores))[:top]  # numbers ascend with the ids
            out["item_id"] += [items[item]] * len(first)
            out["doc_id"] += ids[docs[first]].tolist()
            out["score"] += scores[first].tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return best


def rank_documents(
    docs: DataFrame, items: DataFrame, work: Workspace, *, top: int = 50, owners: int = 4, block_terms: int = 50_000, block_items: int = 500,
    shard_docs: int = 4096, shard_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, scores above 0.

    Terms are runs of ASCII letters and digits and of all that is not ASCII, A-Z in lower case; the
    score is that of ``weight`` and ``part_scores``. Equal scores are ranked by ascending doc_id.

    Items are taken in blocks of about ``block_items`` items and ``block_terms`` terms (by hash; one
    larger item is a block of its own at worst). For a block, each shard of documents gets inverted
    lists of the block's terms, staged once. The terms are dealt to ``owners``, rare ones first,
    with about the same number of postings each. An item's bundle holds the scores of a shard's
    documents so far; each owner in turn is cogrouped with the bundles by shard and adds its part.
    A bundle holds ``shard_docs`` documents at most, so no task's memory grows with the corpus.

    Null and empty texts have no term. Rows without an id count as documents in the statistics, but
    are not ranked. Rows that share an id are documents of their own. Rows that share an item's id
    are one item, also those without an id. No items or no documents, no rows.
    """
    spark = docs.sparkSession
    asked = work.stage(item_terms(items, id_col=item_col, text_col=item_text_col), "item-terms")
    n_rows, n_items = asked.agg(F.count("*"), F.countDistinct(F.struct("item"))).first()
    blocks = max(-(-n_rows // block_terms), -(-n_items // block_items))
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
        if block.num_rows:
            found = _rank_block(spark, docs, block, work, b, top, owners, shard_docs, shard_bytes, id_col, text_col)
            out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _rank_block(spark: SparkSession, docs, asked: pa.Table, work, block, top, owners, shard_docs, shard_bytes, id_col, text_col) -> DataFrame:
    ids = asked.column("item").unique().to_pylist()
    number = {i: k for k, i in enumerate(ids)}
    terms, term_of = np.unique(asked.column("term").to_numpy().view(np.uint64), return_inverse=True)
    item_of = np.array([number[i] for i in asked.column("item").to_pylist()])
    index = work.stage(postings(docs, terms, id_col=id_col, text_col=text_col, shard_docs=shard_docs, shard_bytes=shard_bytes), f"index-{block}")
    n_docs, n_terms = index.where("term is null").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = np.zeros(len(terms), np.int64)
    for term, n in index.where("term is not null").groupBy("term").agg(F.sum("df")).collect():  # no more than the block's terms
        df[term] = n
    weights = [weight(n_docs, int(n)) if n else 0 for n in df]
    rare_first = np.argsort(df, kind="stable")
    share = np.cumsum(df[rare_first]) - df[rare_first]
    owner_of = np.empty(len(terms), np.int64)
    owner_of[rare_first] = share * owners // max(int(df.sum()), 1)
    most = np.zeros((owners, len(ids)), np.int64)  # a term adds less than a million times its weight
    np.add.at(most, (owner_of[term_of], item_of), np.array(weights, np.int64)[term_of] * 1_000_000)
    by_term = np.argsort(term_of, kind="stable")
    items_of = np.split(item_of[by_term], np.searchsorted(term_of[by_term], np.arange(1, len(terms))))

    importable(spark)
    owned = spark.createDataFrame([(int(t), int(o)) for t, o in enumerate(owner_of)], "term int, owner int")
    lists = index.where("term is not null").select("shard", "term", "docs", "tf", "n").join(F.broadcast(owned), "term")  # bounded as the block is
    bundles = spark.createDataFrame([], _BUNDLE)
    for o in range(owners):
        mine = {t: (weights[t], items_of[t]) for t in np.flatnonzero(owner_of == o).tolist()}
        add = Owner(mine, most[o + 1 :].sum(0), n_docs, n_terms, top)
        stage = lists.where(F.col("owner") == o).select("shard", "term", "docs", "tf", "n")
        bundles = bundles.groupBy("shard").cogroup(stage.groupBy("shard")).applyInArrow(_cogrouped(add), _BUNDLE)
    directory = index.where("term is null").select("shard", "ids")
    return bundles.groupBy("shard").cogroup(directory.groupBy("shard")).applyInArrow(_cogrouped(_select(top, ids)), "item_id long, doc_id long, score long")


def _cogrouped(f):
    return lambda left, right: f(left, right)
