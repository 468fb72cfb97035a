"""Benchmark leaks, also reworded ones: latent search for passages, then word by word checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import TO_LOWER, WordHash, importable, in_tasks, text_bytes, word_limits
from orelayer.session import Workspace

STEP = 32  # words: passages of a document are two steps long and begin at each
SHORT = 8  # words: items shorter than that must be met word for word
BUCKETS = 1 << 17  # of hashed words, for the counts of passages

#: Bytes that part words: all ASCII but letters and digits.
IS_BREAK = ~np.isin(np.arange(256), [*range(48, 58), *range(97, 123), *range(128, 256)])


def hashed_words(column, hasher: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of words before each row."""
    data, offsets = text_bytes(column)
    data = TO_LOWER[data]
    starts, ends, before = word_limits(data, offsets, IS_BREAK)
    return hasher(data, starts, ends), before


def steps_of(before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's words in steps: the row of each step, and the limits of its words."""
    words = np.diff(before)
    n = -(-words // STEP)
    row = np.repeat(np.arange(len(words)), n)
    first = before[:-1][row] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STEP
    return row, first, np.minimum(first + STEP, before[1:][row])


def words_of(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of its span and the place of each word in the spans from ``first`` to ``stop``."""
    n = stop - first
    span = np.repeat(np.arange(len(n)), n)
    return span, np.arange(len(span)) + np.repeat(first - np.cumsum(n) + n, n)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins in sorted ``keys``, and its length."""
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return begin, np.diff(np.append(begin, len(keys)))


def weighed(table: np.ndarray, rows: np.ndarray, value: np.ndarray, begin: np.ndarray, cells: int = 1 << 13) -> np.ndarray:
    """Sums of ``value`` times the ``rows`` of a table over the runs that begin at ``begin``; no more
    than ``cells`` rows are copied at a time, however long a run is."""
    out = np.zeros((len(begin), table.shape[1]), table.dtype)
    for lo in range(0, len(rows), cells):
        v, some = value[lo : lo + cells], table[rows[lo : lo + cells]]
        of, stop = int(np.searchsorted(begin, lo, "right")) - 1, int(np.searchsorted(begin, lo + len(v)))
        cuts = [0, *(begin[of + 1 : stop] - lo).tolist(), len(v)]
        for run, a, b in zip(range(of, stop), cuts, cuts[1:]):
            out[run] += v[a:b] @ some[a:b]
    return out


def _pieces(batch: pa.RecordBatch, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    _, limits = text_bytes(batch.column("text"))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(limits, limits[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def passage_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each hash bucket, the steps of all documents that hold a word of it; and all steps."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hasher, n = np.zeros(BUCKETS, np.int64), WordHash(), 0
        for batch in batches:
            for part in _pieces(batch):
                h, before = hashed_words(part.column("text"), hasher)
                row, first, last = steps_of(before)
                step = np.repeat(np.arange(len(row)), last - first)
                met = np.sort(step * BUCKETS + (h % BUCKETS).astype(np.int64))
                total += np.bincount(met[runs(met)[0]] % BUCKETS, minlength=BUCKETS)
                n += len(row)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1).astype(np.int32)), pa.array(np.append(total[met], n))], ["bucket", "n"])

    out, steps = np.zeros(BUCKETS, np.int64), 0
    for bucket, n in in_tasks(docs, work, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        if bucket < 0:
            steps = n
        else:
            out[bucket] = n
    return out, steps


@dataclass
class Targets:
    """Passages of benchmark items, their terms, and the latent space."""

    idf: np.ndarray  # by bucket
    terms: np.ndarray  # sorted hashes of the benchmark's words
    items: list  # item id of each passage
    passages: list[np.ndarray]  # word hashes of each passage
    answers: list[np.ndarray]  # word hashes of the end of each passage's item
    whole: list[int]  # words of each passage's item
    basis: np.ndarray | None = None  # terms x dimensions
    latent: np.ndarray | None = None  # dimensions x passages, of unit items
    share: np.ndarray | None = None  # of each passage's square, in the latent space

    def __post_init__(self) -> None:
        bucket = (self.terms % BUCKETS).astype(np.int64)
        self.by_term = self.idf[bucket]  # each term's weight
        self.slot = np.full(BUCKETS, -1, np.int32)  # the term of a bucket, -1 for none, -2 for several
        self.slot[bucket] = np.arange(len(bucket), dtype=np.int32)
        self.slot[np.bincount(bucket, minlength=BUCKETS) > 1] = -2

    def weights(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's weight, and its term number or -1."""
        bucket = (hashes % BUCKETS).astype(np.int64)
        at = self.slot[bucket]
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self.terms, hashes[several]), len(self.terms) - 1)
        return self.idf[bucket], np.where((at >= 0) & (self.terms[at] == hashes), at, -1)

    def cells(self, span: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The TF-IDF cells of spans, from the span and the term (-1 for none) of each word: span, term
        and value, by span and term. A value is the root of the sum of its words' squared weights."""
        key = np.sort((span * len(self.terms) + term)[term >= 0])
        begin, uses = runs(key)
        of, col = np.divmod(key[begin], len(self.terms))
        return of, col, np.sqrt(uses) * self.by_term[col]

    def matrix(self) -> np.ndarray:
        """Unit TF-IDF rows of the passages."""
        out = np.zeros((len(self.passages), len(self.terms)))
        for row, words in zip(out, self.passages):
            w, t = self.weights(words)
            np.add.at(row, t, w * w)
        out = np.sqrt(out)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def targets(items: pd.DataFrame, counts: np.ndarray, steps: int) -> Targets:
    """Passages of at most one step of words, beginning at every half step, for each item."""
    idf = np.log(1 + (steps + 1) / (counts + 1.0))
    hasher = WordHash()
    ids, passages, answers, whole = [], [], [], []
    for item, text in zip(items["item"], items["text"]):
        words, _ = hashed_words(pa.array([text]), hasher)
        for a in range(0, max(1, len(words) - STEP // 2), STEP // 2) if len(words) > STEP else [0]:
            if len(words):
                ids.append(item)
                passages.append(words[a : a + STEP])
                answers.append(words[-SHORT:])
                whole.append(len(words))
    terms = np.unique(np.concatenate(passages)) if passages else np.zeros(0, np.uint64)
    return Targets(idf, terms, ids, passages, answers, whole)


def latent_space(docs: DataFrame, t: Targets, *, rank: int, seed: int = 7) -> Targets:
    """The leading right singular directions of all passages, by one randomised pass.

    Rows of the matrix are all steps of all documents and the benchmark's passages, the latter
    weighed to half of the whole; columns are the benchmark's terms. Each task sketches its rows,
    A'(A G) for a random G of ``rank`` columns; the sketches are added by groups of terms. The
    sum's Nystrom form gives the directions. The sketch is bounded by terms x ``rank``.
    """
    n = len(t.terms)
    rank = min(rank, n, len(t.passages) + 32)
    g = np.random.default_rng(seed).standard_normal((n, rank)).astype(np.float32)
    group = 128

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, square, hasher = np.zeros((n, rank)), 0.0, WordHash()
        for batch in batches:
            for part in _pieces(batch):
                h, before = hashed_words(part.column("text"), hasher)
                row, first, last = steps_of(before)
                step = np.repeat(np.arange(len(row)), last - first)
                of, col, value = t.cells(step, t.weights(h)[1])
                square += float((value**2).sum())
                value = value.astype(np.float32)
                begin, held = runs(of)
                by_step = weighed(g, col, value, begin)
                order = np.argsort(col, kind="stable")
                run = runs(col[order])[0]
                sketch[col[order[run]]] += weighed(by_step, np.repeat(np.arange(len(begin)), held)[order], value[order], run)
        cols = [list(range(0, n, group)), [sketch[a : a + group].astype(np.float32).tobytes() for a in range(0, n, group)]]
        yield pa.RecordBatch.from_arrays([pa.array([*cols[0], -1], pa.int32()), pa.array([*cols[1], np.float64(square).tobytes()], pa.binary())], ["part", "sums"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = np.float64 if pdf["part"].iat[0] < 0 else np.float32
        total = sum(np.frombuffer(x, kind).astype(np.float64) for x in pdf["sums"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "sums": [total.tobytes()]})

    importable(docs.sparkSession)
    got = {p: np.frombuffer(x, np.float64) for p, x in in_tasks(docs, work, "part int, sums binary").groupBy("part").applyInPandas(added, "part int, sums binary").collect()}
    q = t.matrix()
    square = float(got.pop(-1)[0]) if -1 in got else 0.0
    y = np.concatenate([got[a] for a in sorted(got)]).reshape(n, rank) if got else np.zeros((n, rank))
    boost = max(square, 1.0) / max((q * q).sum(), 1e-12)
    y = y + boost * (q.T @ (q @ g))
    shift = 1e-6 * max(np.linalg.norm(y), 1e-12)
    y = y + shift * g
    core = g.T.astype(float) @ y
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > 1e-9 * value.max()
    half = y @ (vector[:, keep] / np.sqrt(value[keep]))
    t.basis = np.linalg.svd(half, full_matrices=False)[0]
    t.latent = (q @ t.basis).T
    t.share = (t.latent**2).sum(0)
    return t


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a word of ``b`` at a time over all of ``a`` as bits."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        met = places.get(x)
        if met:
            kept = row & met
            row = (row + kept | row - kept) & full
    return len(a) - row.bit_count()


def find_leaks(docs: DataFrame, t: Targets, *, min_cosine: float, min_lcs: float, weak_lcs: float, min_answer: float) -> DataFrame:
    """(id, item, passage, cosine, lcs, answer) of all pairs that pass the checks."""
    low = min_cosine
    block = max(1, min(128, (1 << 20) // len(t.passages)))  # passages of documents that are compared at a time

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash()
        for batch in batches:
            for part in _pieces(batch):
                ids = part.column("id").to_pylist()
                h, before = hashed_words(part.column("text"), hasher)
                row, first, last = steps_of(before)
                if not len(row):
                    continue
                w, term = t.weights(h)
                square = np.concatenate([[0.0], np.cumsum(w * w)])
                inside = np.concatenate([[0.0], np.cumsum(np.where(term >= 0, w * w, 0.0))])
                stop = np.minimum(first + 2 * STEP, before[1:][row])
                norm, own = square[stop] - square[first], inside[stop] - inside[first]
                # Cauchy-Schwarz: no cosine with any benchmark passage exceeds the share of the benchmark's
                # terms in the length of the document's passage
                able = np.flatnonzero(own >= low * low * norm)
                for some in (able[a : a + block] for a in range(0, len(able), block)):
                    out = []
                    span, at = words_of(first[some], stop[some])
                    of, col, value = t.cells(span, term[at])
                    # each of these passages has a term, so there is a run for each
                    cosine = weighed(t.basis, col, value, runs(of)[0]) @ t.latent / np.sqrt(norm[some])[:, None]
                    for k, p in zip(*np.nonzero(cosine >= min_cosine * t.share)):
                        a, b, of = first[some[k]], stop[some[k]], row[some[k]]
                        got = lcs(t.passages[p], h[a:b]) / len(t.passages[p])
                        if got < weak_lcs:
                            continue
                        end = lcs(t.answers[p], h[a : min(b + 2 * STEP, before[of + 1])]) / len(t.answers[p])
                        if (got >= min_lcs and (t.whole[p] >= SHORT or got == 1.0)) or (got >= weak_lcs and end >= min_answer and t.whole[p] >= SHORT):
                            out.append((ids[of], t.items[p], int(p), float(cosine[k, p] / max(t.share[p], 1e-12)), got, end))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["id", "item", "passage", "cosine", "lcs", "answer"])

    return in_tasks(docs, work, "id long, item long, passage long, cosine double, lcs double, answer double")


def contaminated(docs: DataFrame, benchmark: DataFrame, work: Workspace, *, rank: int = 128, min_cosine: float = 0.25, min_lcs: float = 0.6, weak_lcs: float = 0.45, min_answer: float = 0.75, block_chars: int = 2_000_000, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): the documents that hold a benchmark item, or most of it.

    Texts are cut into overlapping passages of 64 words, items into passages of 32. Words lie
    between other ASCII characters than letters and digits, A-Z in lower case. A document's passage
    is a candidate if its latent cosine with an item's passage is at least ``min_cosine``, as far as
    the latent space holds that passage; every passage of every document is compared, but for those
    whose benchmark terms are too few to reach ``min_cosine`` with anything. A candidate
    stays if the longest common subsequence has ``min_lcs`` of the item's passage, or ``weak_lcs``
    and the item's last words, its answer, follow for ``min_answer``. The row has the best values.

    The benchmark is taken in blocks of ``block_chars`` characters, whole items, so what each task
    gets is bounded; document counts come from one pass, sketch and search are one pass each for a
    block. Nothing of the corpus is collected but counts by hash bucket and the sketch.

    Null and empty texts and items hold nothing and match nothing. Rows without an id are not
    searched. Repeated documents and items give one row for each pair of ids. Empty tables give an
    empty result; extra columns are left out.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null and text is not null")
    size = int(items.agg(F.sum(F.length("text"))).first()[0] or 0)
    blocks = max(1, -(-size // block_chars))
    empty = "id long, item long, passage long, cosine double, lcs double, answer double"
    found = spark.createDataFrame([], empty)
    counted = None
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "text").toPandas()
        if not len(some):
            continue
        counted = counted or passage_counts(texts)
        t = targets(some, *counted)
        if not t.passages:
            continue
        t = latent_space(texts, t, rank=rank)
        found = found.union(find_leaks(texts, t, min_cosine=min_cosine, min_lcs=min_lcs, weak_lcs=weak_lcs, min_answer=min_answer))
    best = found.groupBy("id", "item").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "cosine", "lcs", "answer")
