"""A language model whose unseen words are sums over all segmentations into an existing vocabulary."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import ODD, TO_LOWER, WordHash, fold, importable, in_tasks, powers, text_bytes, word_limits
from orelayer.session import Workspace

MARK = "▁".encode()  # how the vocabulary writes the start of a word


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """The pieces of a vocabulary as bytes and their scores. Byte pieces stand for single bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        text = sp.id_to_piece(i)
        pieces.append(bytes([int(text[3:5], 16)]) if sp.is_byte(i) else text.encode())
        scores.append(-1e6 if sp.is_byte(i) else sp.get_score(i))
    return pieces, np.array(scores)


@dataclass
class Lattice:
    """Two distributions over pieces: ``first`` begins a word, ``inner`` goes on until its end.

    A word's probability is the sum over all ways to write it as a first piece, inner pieces and
    the end. The bare start mark is a first piece of no bytes, so any bytes can be written.
    """

    keys: np.ndarray  # sorted hashes of the pieces' bytes, with the length added
    first: np.ndarray  # ln P as first piece, by key
    inner: np.ndarray  # ln P as inner piece, by key
    bare: float  # ln P of the bare mark
    end: float  # ln P of the word's end
    longest: int

    @classmethod
    def start(cls, pieces: list[bytes], scores: np.ndarray) -> "Lattice":
        """Weights from the vocabulary's own scores. Where these are only ranks (whole numbers, as in
        merge vocabularies), a piece of rank r weighs 1 / (r + 3)."""
        ranks = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
        real = np.any(scores[scores > -1e5] % 1)
        logs = np.maximum(scores, -25.0) if real else -np.log(ranks + 3.0)
        weight: dict[bytes, list[float]] = {bytes([i]): [0.0, 1e-7] for i in range(256)}
        bare = 1e-3
        for piece, x in zip(pieces, np.exp(logs)):
            if piece.startswith(MARK):
                if piece[3:]:
                    weight.setdefault(piece[3:], [0.0, 0.0])[0] += x
                else:
                    bare += x
            elif MARK not in piece:
                weight.setdefault(piece, [0.0, 0.0])[1] += x
        spelled = list(weight)
        return cls.of(cls.hashes(spelled), np.array([weight[b] for b in spelled]).T, bare, 0.4 * sum(w[1] for w in weight.values()), max(map(len, spelled)))

    @classmethod
    def of(cls, keys: np.ndarray, weights: np.ndarray, bare: float, end: float, longest: int) -> "Lattice":
        order = np.argsort(keys)
        with np.errstate(divide="ignore"):
            first = np.log(weights[0][order] / (weights[0].sum() + bare))
            inner = np.log(weights[1][order] / (weights[1].sum() + end))
        return cls(keys[order], first, inner, math.log(bare / (weights[0].sum() + bare)), math.log(end / (weights[1].sum() + end)), longest)

    @staticmethod
    def hashes(spans: list[bytes]) -> np.ndarray:
        up = powers(ODD, max(map(len, spans), default=1) + 1)
        return np.array([((np.frombuffer(b, np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(b)]).sum(dtype=np.uint64) + np.uint64(len(b)) for b in spans], np.uint64)

    def log_prob(self, words: list[bytes]) -> np.ndarray:
        """ln P of each word; words of no bytes can't be written."""
        return Sums([self]).log_probs(words)[0]

    def expect(self, words: list[bytes], weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, first and inner, over all ways to write the weighted words;
        the last column has the bare mark and the ends."""
        return Sums([self]).expect(words, np.zeros(len(words), np.int64), weight)[0]

    def updated(self, uses: np.ndarray, strength: float = 500.0) -> "Lattice":
        """Weights from expected uses, with the present ones as a prior worth ``strength`` words."""
        first = uses[0, :-1] + strength * np.exp(self.first)
        inner = uses[1, :-1] + strength * np.exp(self.inner)
        return Lattice.of(self.keys, np.array([first, inner]), uses[0, -1] + strength * math.exp(self.bare), uses[1, -1] + strength * math.exp(self.end), self.longest)


@dataclass
class Arcs:
    """All pieces that match inside some words. A word of n bytes has n + 1 nodes, one before each
    byte and one at its end; arcs are sorted by their place in the word, then by their first node."""

    nodes: int
    begin: np.ndarray  # first node of each word
    final: np.ndarray  # last node of each word
    word: np.ndarray  # by arc: the word's number,
    start: np.ndarray  # the nodes,
    stop: np.ndarray
    at: np.ndarray  # and the piece's number
    steps: np.ndarray  # limits of the arcs that start at each place, from the words' begin on


class Sums:
    """Sums over all ways to write words under several lattices over the same pieces.

    Words of any length are taken together, one place in them after another. The sums are plain
    products; what they bring below ``LEAST``, such as a very long word, is summed again in logs.
    """

    LEAST = 1e-200
    SLOTS = 18  # bits

    def __init__(self, lattices: list[Lattice]) -> None:
        self.keys, self.longest, self.n = lattices[0].keys, lattices[0].longest, len(lattices)
        # by log or not: inner and first by piece and lattice, bare and end by lattice
        logs = [np.array([x.inner for x in lattices]).T, np.array([x.first for x in lattices]).T, np.array([x.bare for x in lattices]), np.array([x.end for x in lattices])]
        self.tables = {True: [np.ascontiguousarray(x) for x in logs], False: [np.ascontiguousarray(np.exp(x)) for x in logs]}
        self.up = self.down = np.ones(1, np.uint64)
        slot = self._slots(self.keys)
        self.slot = np.full(1 << self.SLOTS, -1, np.int32)  # the piece of a slot, -1 for none, -2 for several
        self.slot[slot] = np.arange(len(slot), dtype=np.int32)
        self.slot[np.bincount(slot, minlength=1 << self.SLOTS) > 1] = -2

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def arcs(self, words: list[bytes]) -> Arcs:
        size = np.array([len(w) for w in words], np.int64)
        final = np.cumsum(size + 1) - 1
        begin = final - size
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        n = len(data)
        if len(self.up) <= n:
            some = max(n + 1, 1 << 18)
            self.up, self.down = powers(ODD, some), powers(pow(ODD, -1, 1 << 64), some)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        of = np.repeat(np.arange(len(words)), size + 1)
        place = np.arange(n) - begin[of]
        left = size[of] - place
        node, starts, lengths, pieces = np.flatnonzero(left), [], [], []
        for length in range(1, self.longest + 1):
            node = node[left[node] >= length]
            if not len(node):
                break
            h = (sums[node + length] - sums[node]) * self.down[node] + np.uint64(length)
            at = self.slot[self._slots(h)]
            several = np.flatnonzero(at == -2)
            at[several] = np.minimum(np.searchsorted(self.keys, h[several]), len(self.keys) - 1)
            met = np.flatnonzero((at >= 0) & (self.keys[at] == h))
            starts.append(node[met])
            lengths.append(np.full(len(met), length))
            pieces.append(at[met].astype(np.int64))
        start, length, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lengths, pieces))
        order = np.argsort(place[start] * n + start)
        start, at = start[order], at[order]
        steps = np.searchsorted(place[start], np.arange(size.max(initial=0) + 1))
        return Arcs(n, begin, final, of[start], start, start + length[order], at, steps)

    @staticmethod
    def forward(arcs: Arcs, inner: np.ndarray, first: np.ndarray, bare: np.ndarray, log: bool) -> np.ndarray:
        """The sums over all ways to write the bytes before each node, from the values of each arc,
        of those at a word's begin as first piece, and of each word's bare mark."""
        plus, times = (np.logaddexp, np.add) if log else (np.add, np.multiply)
        alpha = np.full((arcs.nodes, *inner.shape[1:]), -np.inf if log else 0.0)
        alpha[arcs.begin] = bare
        for place, (a, b) in enumerate(zip(arcs.steps[:-1], arcs.steps[1:])):
            ways, stop = times(alpha[arcs.start[a:b]], inner[a:b]), arcs.stop[a:b]
            if place == 0:
                ways = plus(ways, first)
            alpha[stop] = plus(alpha[stop], ways)  # one arc at most for each word and end
        return alpha

    def log_probs(self, words: list[bytes]) -> np.ndarray:
        """ln P of each word under each lattice; words of no bytes can't be written."""
        out = np.full((self.n, len(words)), -np.inf)
        inner, first, bare, end = self.tables[False]
        for rows in _blocks(words):
            arcs = self.arcs([words[i] for i in rows])
            total = self.forward(arcs, inner[arcs.at], first[arcs.at[slice(arcs.steps[1])]], bare, False)[arcs.final] * end
            with np.errstate(divide="ignore"):
                out[:, rows] = np.log(total).T
            low, which = np.nonzero(total <= self.LEAST)
            if len(low):
                out[which, rows[low]] = self._log_totals([words[i] for i in rows[low]], which)
        return out

    def _log_totals(self, words: list[bytes], which: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words))
        inner, first, bare, end = self.tables[True]
        for rows in _blocks(words):
            arcs, mine = self.arcs([words[i] for i in rows]), which[rows]
            cell, begun = arcs.at * self.n + mine[arcs.word], slice(arcs.steps[1])
            out[rows] = self.forward(arcs, inner.ravel()[cell], first.ravel()[cell[begun]], bare[mine], True)[arcs.final] + end[mine]
        return out

    def expect(self, words: list[bytes], which: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses as ``Lattice.expect`` gives them, for each lattice; ``which`` is that of each word."""
        out = np.zeros((self.n, 2, len(self.keys) + 1))
        for rows in _blocks(words):
            low = rows[self._add_uses(out, [words[i] for i in rows], which[rows], weight[rows], False)]
            if len(low):
                self._add_uses(out, [words[i] for i in low], which[low], weight[low], True)
        return out

    def _add_uses(self, out: np.ndarray, words: list[bytes], which: np.ndarray, weight: np.ndarray, log: bool) -> np.ndarray:
        """Adds the uses of some words; returns the numbers of those left out as their sums are too small."""
        inner, first, bare, end = self.tables[log]
        plus, times = (np.logaddexp, np.add) if log else (np.add, np.multiply)
        arcs = self.arcs(words)
        cell, begun = arcs.at * self.n + which[arcs.word], slice(arcs.steps[1])
        inner, first, bare, end = inner.ravel()[cell], first.ravel()[cell[begun]], bare[which], end[which]
        alpha = self.forward(arcs, inner, first, bare, log)
        beta = np.full(arcs.nodes, -np.inf if log else 0.0)
        beta[arcs.final] = end
        for a, b in zip(arcs.steps[-2::-1], arcs.steps[:0:-1]):
            start = arcs.start[a:b]
            new = np.flatnonzero(np.append(True, start[1:] != start[:-1])) if a < b else []
            if len(new):
                beta[start[new]] = plus.reduceat(times(inner[a:b], beta[arcs.stop[a:b]]), new)
        total = times(alpha[arcs.final], end)
        low = np.zeros(0, np.int64) if log else np.flatnonzero(total <= self.LEAST)

        def uses(value: np.ndarray, word: np.ndarray) -> np.ndarray:
            return np.exp(value - total[word]) * weight[word] if log else value * share[word]

        if not log:
            weight = weight.astype(float)
            weight[low] = 0
            share = weight / np.where(weight, total, 1)
        into, every = beta[arcs.stop], np.arange(len(words))
        n, shape = self.n * len(self.keys), (len(self.keys), self.n)
        out[:, 1, :-1] += np.bincount(cell, uses(times(times(alpha[arcs.start], inner), into), arcs.word), n).reshape(shape).T
        out[:, 0, :-1] += np.bincount(cell[begun], uses(times(first, into[begun]), arcs.word[begun]), n).reshape(shape).T
        out[:, 0, -1] += np.bincount(which, uses(times(bare, beta[arcs.begin]), every), self.n)
        out[:, 1, -1] += np.bincount(which, weight, self.n)
        return low


def mixed(counts: np.ndarray, logs: np.ndarray, give: list[float], types: list[int], uses: list[int], part: np.ndarray, share: float) -> np.ndarray:
    """ln P of each word in each class: what its ``counts`` keep after the discount ``give``, the
    lattice's share (``logs``) for the rest, and ``share`` of it from the mixture of all classes.
    All in logs, as a long word's probability is far below the least double."""
    out = np.array(logs, float)
    with np.errstate(divide="ignore"):
        for k, of in enumerate(uses):
            if of:
                out[k] = np.logaddexp(np.log(np.maximum(counts[k] - give[k], 0) / of), np.log(give[k] * types[k] / of) + out[k])
        every = np.logaddexp.reduce(np.log(part)[:, None] + out, axis=0)
        return np.logaddexp(np.log(1 - share) + out, np.log(share) + every)


def _blocks(words: list[bytes], nodes: int = 1 << 17) -> Iterator[np.ndarray]:
    """Row numbers of words, short ones first, so many that their nodes stay few; without those of no bytes."""
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], 1) :]
    ends, at = np.cumsum(sizes[order] + 1), 0
    while at < len(order):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + nodes, "right")))
        yield order[at:stop]
        at = stop


def tokenised(docs: DataFrame, held_fold: int, classes: list[str], n_classes: int, *, block_bytes: int, id_col: str, text_col: str, class_col: str | None) -> DataFrame:
    """Blocks of documents, each with its own numbering of its distinct words.

    Two kinds of rows. kind 0: (block, number, word, n0, n1 ...), a row for each distinct word of a
    block with its uses in training texts of each class; what is in none of ``classes`` counts to
    the last. kind 1: (block, doc_id, held_out, numbers), a row for
    each document with its words' numbers. A block is up to ``block_bytes`` of whole texts that one
    task met in a row, one text at least.
    """
    schema = "kind int, block long, number int, word binary, " + "".join(f"n{k} long, " for k in range(n_classes)) + "doc_id long, held_out boolean, numbers array<int>"
    names = [f.strip().split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part = WordHash(), TaskContext.get().partitionId()
        held: list[tuple] = []
        size, count = 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = (part << 24) + count
            # starts and lengths in four bytes, and the pieces are given up as soon as they are put together
            sizes = np.cumsum([0, *(len(h[0]) for h in held)])
            raw = b"".join(h[0].tobytes() for h in held)
            starts = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([h[2] for h in held])
            words = np.concatenate([h[4] for h in held])
            met = np.cumsum([len(h[1]) for h in held])
            hashes = np.concatenate([h[3] for h in held])
            ids, flags, of = ([x for h in held for x in h[k]] for k in (5, 6, 7))
            held.clear()
            _, where, number, uses = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-uses, kind="stable")  # the most frequent words get the smallest numbers
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            number = rank[number]
            del hashes
            kind = np.repeat(np.where(np.array(flags, bool), -1, np.array(of, int)).astype(np.int16), words)
            n_train = [np.bincount(number[kind == k], minlength=len(order)).astype(np.int64) for k in range(n_classes)]
            first = where[order]
            spelled = [raw[a : a + k] for a, k in zip((starts[first] + sizes[np.searchsorted(met, first, "right")]).tolist(), lengths[first].tolist())]
            del starts, lengths
            n = len(spelled)
            no = lambda k, kind: pa.nulls(k, kind)
            for a in range(0, n, 50_000):
                k = min(50_000, n - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(k, np.int32)), pa.array(np.full(k, block)), pa.array(np.arange(a, a + k, dtype=np.int32)), pa.array(spelled[a : a + k], pa.binary()),
                     *[pa.array(x[a : a + k]) for x in n_train], no(k, pa.int64()), no(k, pa.bool_()), no(k, pa.list_(pa.int32()))], names,
                )
            limits = np.concatenate([[0], np.cumsum(words)])
            for a in range(0, len(ids), 512):
                k = min(512, len(ids) - a)
                lists = pa.ListArray.from_arrays(pa.array((limits[a : a + k + 1] - limits[a]).astype(np.int32)), pa.array(number[limits[a] : limits[a + k]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(k, np.int32)), pa.array(np.full(k, block)), no(k, pa.int32()), no(k, pa.binary()), *[no(k, pa.int64())] * n_classes,
                     pa.array(ids[a : a + k], pa.int64()), pa.array(flags[a : a + k], pa.bool_()), lists], names,
                )

        for batch in batches:
            _, limits = text_bytes(batch.column("text"))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(limits, limits[a] + 2_000_000, "right")) - 1)
                some = batch.slice(a, b - a)
                data, offsets = text_bytes(some.column("text"))
                data = TO_LOWER[data]
                starts, ends, before = word_limits(data, offsets)
                held.append((data, starts.astype(np.int32), (ends - starts).astype(np.int32), hasher(data, starts, ends), np.diff(before), some.column("doc_id").to_pylist(), some.column("held_out").to_pylist(), some.column("class").to_pylist()))
                size += len(data)
                a = b
                if size >= block_bytes:
                    yield from flush()
                    size, count = 0, count + 1
        if held:
            yield from flush()

    of = F.coalesce(F.array_position(F.lit(classes), F.col(class_col)), F.lit(0)) if classes else F.lit(0)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col)) == held_fold).alias("held_out"), F.col(text_col).cast("string").alias("text"),
        F.when(of > 0, of - 1).otherwise(len(classes)).cast("int").alias("class"),
    )
    return in_tasks(rows, work, schema)


def _written(work: Workspace, df: DataFrame, name: str, partition_by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """As ``Workspace.stage``, but packed tighter, as these tables hold every word of every block."""
    df.write.mode("errorifexists").option("compression", "zstd").partitionBy(*partition_by).parquet(work.path(name))
    return df.sparkSession.read.schema(df.schema).parquet(work.path(name))


def lattice_scores(docs: DataFrame, pieces: list[bytes], scores: np.ndarray, work: Workspace, *, held_fold: int = 1, rounds: int = 3, share: float = 0.05, max_classes: int = 8, block_bytes: int = 16_000_000, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. Training texts
    are those whose id's fold is not ``held_fold``; ``base_score`` is the sum of
    log10((c + 0.5) / (N + 0.5 (V + 1))).

    ``score`` is the log10 probability of the text under the model. A word seen c times in training
    has (c - D) / N, and the D = n1 / (n1 + 2 n2) that each seen word gives up goes to all words by
    their lattice probability, the sum over all segmentations into ``pieces``. The pieces' weights
    start from the vocabulary's ``scores``; ``rounds`` steps of expectation-maximisation over all
    distinct training words, each counted once, fit them to the corpus.

    With ``class_col`` (a language, say) there is one such model for each of the ``max_classes``
    most frequent values among the training texts and one for all others. A text's probability is
    the sum over all classes, weighed by their share of the training texts: the class of the scored
    text itself is never read. In each class ``share`` of every word's probability comes from the
    mixture of all. All probabilities add up to one at most.

    Word counts, vocabulary and word probabilities are tables that grow with the corpus and are
    never collected: blocks of documents number their own words, only a row for each distinct word
    of a block is shuffled by word, and comes back to its block with its probability. The driver
    gets sums for each piece and class, and five counts for each class.

    Null and empty texts have one token, the end. Without training texts only the lattice scores.
    Repeated rows are scored each by itself and count each in training. An empty table gives an
    empty result; extra columns are left out.
    """
    importable(docs.sparkSession)
    classes: list[str] = []
    if class_col:
        some = docs.where(fold(F.col(id_col)) != held_fold).where(F.col(class_col).isNotNull()).groupBy(F.col(class_col).alias("c")).count()
        classes = [r.c for r in some.orderBy(F.desc("count"), "c").limit(max_classes).collect()]
    others = docs.where(fold(F.col(id_col)) != held_fold).where(~F.coalesce(F.col(class_col).isin(classes), F.lit(False))) if classes else docs
    n_classes = len(classes) + (not classes or not others.isEmpty())
    kinds = range(n_classes)
    rows = _written(work, tokenised(docs, held_fold, classes, n_classes, block_bytes=block_bytes, id_col=id_col, text_col=text_col, class_col=class_col), "blocks", ["kind"])
    counts = [f"n{k}" for k in kinds]
    words = rows.where("kind = 0").select("block", "number", "word", *counts)
    again = docs.sparkSession.read.schema(rows.schema).parquet(work.path("blocks"))  # apart, as both sides meet later
    texts = again.where("kind = 1").select("block", "doc_id", "held_out", "numbers")
    vocab = _written(work, words.groupBy("word").agg(*[F.sum(c).alias(c) for c in counts]), "vocab")
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    total = sum((F.col(c) for c in counts), F.lit(0))
    sums = [x for c in counts for x in (F.sum(c), one(F.col(c) > 0), one(F.col(c) == 1), one(F.col(c) == 2))]
    got = [int(x or 0) for x in vocab.agg(one(total > 0), *sums).first()]
    types, by_class = got[0], [got[1 + 4 * k : 5 + 4 * k] for k in kinds]
    ends = texts.where("not held_out").count()
    uses = sum(x[0] for x in by_class)
    n, v = uses + ends, types + bool(ends)
    give = [min(0.95, max(0.3, once / (once + 2 * twice))) if once else 0.5 for _, _, once, twice in by_class]
    part = np.array([x[0] for x in by_class], float)
    part = part / part.sum() if uses else np.eye(n_classes)[-1]
    lattices = [Lattice.start(pieces, scores)] * n_classes

    for _ in range(rounds if types else 0):

        def expected(batches: Iterator[pa.RecordBatch], lattices: list[Lattice] = lattices) -> Iterator[pa.RecordBatch]:
            model, sums = Sums(lattices), np.zeros((n_classes, 2, len(lattices[0].keys) + 1))
            for batch in batches:
                spelled = batch.column("word").to_pylist()
                mine, of = np.nonzero(np.array([batch.column(c).to_numpy() for c in counts]).T)
                sums += model.expect([spelled[i] for i in mine], of, np.ones(len(mine)))
            which, key = np.nonzero(sums.any(1))
            cols = [pa.array(which.astype(np.int32)), pa.array(key.astype(np.int32)), pa.array(sums[which, 0, key]), pa.array(sums[which, 1, key])]
            yield pa.RecordBatch.from_arrays(cols, ["class", "key", "first", "inner"])

        met = in_tasks(vocab, expected, "class int, key int, first double, inner double")
        found = np.zeros((n_classes, 2, len(lattices[0].keys) + 1))
        for k, key, first, inner in met.groupBy("class", "key").agg(F.sum("first"), F.sum("inner")).collect():
            found[k, :, key] = first, inner
        lattices = [lattice.updated(x) for lattice, x in zip(lattices, found)]

    models = [f"m{k}" for k in kinds]

    def priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Sums(lattices)
        for batch in batches:
            c = np.array([batch.column(x).to_numpy() for x in counts], float)
            p = mixed(c, model.log_probs(batch.column("word").to_pylist()), give, [x[1] for x in by_class], [x[0] for x in by_class], part, share)
            p = (p + math.log(uses / n if n and uses else 0.5)) / math.log(10)
            cols = [batch.column("word"), pa.array(c.sum(0).astype(np.int64)), *map(pa.array, p.astype(np.float32))]
            yield pa.RecordBatch.from_arrays(cols, ["word", "c", *models])

    # probabilities travel as four bytes: a word's logarithm is right to seven digits
    schema = "word binary, c long, " + ", ".join(f"{m} float" for m in models)
    prices = _written(work, in_tasks(vocab, priced, schema), "prices")
    back = words.select("block", "number", "word").join(prices, "word").drop("word")
    end_base = math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
    end_model = math.log10(ends / n) if ends and uses else math.log10(0.5)
    with np.errstate(divide="ignore"):
        log_part = np.log(part)

    def summed(texts: pd.DataFrame, prices: pd.DataFrame) -> pd.DataFrame:
        at = prices["number"].to_numpy()
        table = np.zeros((n_classes + 2, len(prices)))
        c = prices["c"].to_numpy(float)
        table[0, at], table[1, at] = c > 0, np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        table[2:, at] = prices[models].to_numpy(float).T
        sums = np.array([table[:, np.asarray(x, np.int64)].sum(1) for x in texts["numbers"]]).reshape(-1, n_classes + 2)
        by = sums[:, 2:] * math.log(10) + log_part
        most = by.max(1, keepdims=True)
        model = (most[:, 0] + np.log(np.exp(by - most).sum(1))) / math.log(10)
        return pd.DataFrame({
            "doc_id": texts["doc_id"].astype("Int64"), "held_out": texts["held_out"],
            "n_tokens": [len(x) + 1 for x in texts["numbers"]], "n_known": sums[:, 0].astype(np.int64) + bool(ends), "train_tokens": n,
            "base_score": sums[:, 1] + end_base, "score": model + end_model,
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(summed, schema)
