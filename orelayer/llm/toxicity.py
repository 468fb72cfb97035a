"""Toxicity of texts whose words may be disguised: restore first, then score."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import TO_LOWER, fold, importable, in_tasks, text_bytes
from orelayer.session import Workspace

#: The character model's alphabet: 0 is any border, 1-26 a-z, 27 any byte of a letter beyond ASCII.
SYMBOLS = 28
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:] = 27

#: What a character may stand for, beside itself.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "*": "aeiou", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
JOINTS = " .-_·~'"

#: Costs of the channel, natural logarithms: a swap, a doubled letter left out or kept, a joint left out.
SWAP, DROP, KEEP, JOINT, ODD_CHAR = -1.0, -0.7, -0.7, -0.1, -6.0


def count_chars(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of all four-symbol runs over whole texts, as an array of 28**4. A row leaves each task
    for each run that it met; the sums, bounded by the alphabet, go to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**4, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a in range(0, len(data), 1 << 21):
                s = SYMBOL[TO_LOWER[data[a : a + (1 << 21)]]]
                s = np.concatenate([[0, 0, 0], s, [0]])
                s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]  # one border between words
                s = np.concatenate([[0, 0], s])
                run = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
                total += np.bincount(run, minlength=SYMBOLS**4)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["run", "n"])

    rows = in_tasks(docs.select(F.col(text_col).cast("string").alias("text")), work, "run int, n long")
    out = np.zeros(SYMBOLS**4, np.int64)
    for run, n in rows.groupBy("run").agg(F.sum("n")).collect():
        out[run] = n
    return out


def char_model(counts: np.ndarray) -> np.ndarray:
    """ln P(symbol | the three before), orders 1 to 4 mixed; even where nothing was counted."""
    c = counts.reshape((SYMBOLS,) * 4).astype(float)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, 5):
        part = c.sum(axis=tuple(range(4 - order))) if order < 4 else c
        p = (part + 4 * p) / (part.sum(-1, keepdims=True) + 4)
    return np.log(p).astype(np.float32)


@dataclass
class Restorer:
    """Viterbi over the lattice of what each character of a disguised span may have been."""

    model: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    #: A word with a stand-in next to a letter, or with a letter three times in a row.
    odd = re.compile(r"[^\W\d_][0-9@$!|+(€*]+[^\W\d_]|[0-9@$!|+(€][^\W\d_]{2}|[^\W\d_]{2}[0-9@$€]|([^\W\d_])\1\1")
    #: Three or more single characters with a joint between each two, by themselves.
    spaced = re.compile(r"(?<![^\s])(?:[^\W_]|[@$!|+(€])(?:[ .\-_·~'](?:[^\W_]|[@$!|+(€])){2,}(?![^\s.,;:!?])")
    edge = re.compile(r"^[^\w@$€|(+]+|[^\w@$€]+$")

    def __getstate__(self):
        return {"model": self.model, "known": {}}

    def word(self, token: str) -> str:
        """A token without what clings to its edges; restored if it looks disguised."""
        core = self.edge.sub("", token)
        bare = re.sub(r"(?<=[^\W\d_])[$@€]{2,}$", "", core)
        return self.decode(bare) if self.odd.search(bare) or re.fullmatch(r"(?:\w[.\-_·~'])+\w", bare) else bare

    def decode(self, span: str) -> str:
        got = self.known.get(span)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self._best(span)
            if len(span) <= 64:
                self.known[span] = got
        return got

    def _arcs(self, span: str, i: int) -> list[tuple[str, float]]:
        """(restored, cost) of character i; an empty string leaves it out."""
        c, again = span[i], i > 0 and span[i] == span[i - 1]
        arcs = [(c, KEEP if again else 0.0)] if c.isalpha() else []
        arcs += [(x, SWAP) for x in STANDS_FOR.get(c, "")]
        if c in JOINTS:
            arcs.append(("", JOINT))
        elif again:
            arcs.append(("", DROP))
        return arcs or [("", ODD_CHAR)]

    def _best(self, span: str) -> str:
        # long spans by stretches: the state is the last three letters, carried over
        beams: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
        lp = self.model
        for i in range(len(span)):
            nxt: dict[tuple[int, int, int], tuple[float, str]] = {}
            arcs = self._arcs(span, i)
            for state, (score, text) in beams.items():
                for char, cost in arcs:
                    s, total = state, score + cost
                    if char:
                        sym = 27 if char > "z" else int(SYMBOL[ord(char)])
                        total += float(lp[(*state, sym)])
                        s = (state[1], state[2], sym)
                    if s not in nxt or total > nxt[s][0]:
                        nxt[s] = (total, text + char)
            beams = nxt
        return max((score + float(lp[(*s, 0)]), text) for s, (score, text) in beams.items())[1]

    def text(self, text: str) -> str:
        """The whole text, lower case, with disguised spans restored."""
        text = self.spaced.sub(lambda m: self.decode(m[0]), text.lower())
        return " ".join(filter(None, map(self.word, text.split())))


def features(word: str) -> list[str]:
    """The word as a whole, and its beginnings of three to seven letters."""
    return [word + "$", *(word[:k] for k in range(3, min(len(word), 7) + 1))]


@dataclass
class ToxicModel:
    """Weights of word features, and a logistic model over how much of a text they make up."""

    restorer: Restorer
    lexicon: dict[str, float]
    coef: np.ndarray = field(default_factory=lambda: np.zeros(5))
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def weight(self, token: str) -> float:
        got = self.known.get(token)
        if got is None:
            if len(self.known) > 600_000:
                self.known.clear()
            got = self._weight(self.restorer.word(token))
            if len(token) <= 64:
                self.known[token] = got
        return got

    def _weight(self, word: str) -> float:
        return max((self.lexicon.get(f, 0.0) for f in features(word)), default=0.0)

    def evidence(self, text: str) -> list[float]:
        """What the logistic model sees: a constant; number, weight and share of toxic words; length."""
        text = text.lower()
        restorer = self.restorer
        found: list[float] = []

        def spaced(m: re.Match) -> str:
            word = restorer.decode(m[0])  # a single word before or behind may have been drawn in
            found.append(max(self._weight(w) for w in (word, word[1:], word[:-1])))
            return " "

        tokens = restorer.spaced.sub(spaced, text).split()
        get = self.known.get
        weights = list(map(get, tokens))
        if None in weights:
            weights = [self.weight(t) if w is None else w for t, w in zip(tokens, weights)]
        hits = [w for w in (*weights, *found) if w]
        n = len(tokens) + len(found)
        return [1.0, math.log1p(len(hits)), math.sqrt(sum(hits)), min(1.0, 20 * len(hits) / n) if n else 0.0, math.log1p(n) / 10]

    def score(self, text: str) -> float:
        z = float(np.dot(self.coef, self.evidence(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, work: Workspace, *, max_labelled: int = 10_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicModel:
    """A model from the labelled rows of the folds 1 to 4.

    The character model counts all texts of ``docs``. The classifier sees at most ``max_labelled``
    labelled documents, those with the smallest hash of their id, whatever the corpus holds; only
    their words and five numbers for each reach the driver. A word feature is kept if the share of
    toxic documents that have it is beyond chance well above that of the others (three standard
    errors); its weight is the log-ratio of its rates. Without labels of both classes every text
    scores below one half. Rows without label or id teach nothing; of several labels the highest
    counts, and of repeated documents one.
    """
    restorer = Restorer(char_model(count_chars(docs, text_col)))
    importable(docs.sparkSession)
    truth = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
    truth = truth.where(fold(F.col("id")) != 0).groupBy("id").agg(F.max("y").alias("y"))
    picked = truth.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    taught = work.stage(texts.join(picked, "id").dropDuplicates(["id"]), "taught")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text")):
                tokens = restorer.text(text.as_py()).split()
                seen: dict[str, int] = {}
                for t in tokens:
                    seen[t] = seen.get(t, 0) + 1
                total: dict[str, int] = {}
                for t, n in seen.items():
                    for f in features(t):
                        total[f] = total.get(f, 0) + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64()), pa.array([y] * len(total), pa.int32())], ["feature", "n", "y"]
                )

    of = {y: n for y, n in taught.groupBy("y").count().collect()}
    if not (of.get(0) and of.get(1)):
        return ToxicModel(restorer, {}, np.array([-1.0, 0, 0, 0, 0]))
    rows = in_tasks(taught.select("y", "text"), words, "feature string, n long, y int")
    s = lambda y, what: F.sum(F.when(F.col("y") == y, what).otherwise(0))
    counted = rows.groupBy("feature").agg(s(1, F.lit(1)).alias("d1"), s(0, F.lit(1)).alias("d0"), s(1, F.col("n")).alias("n1"), s(0, F.col("n")).alias("n0"))
    ratio = F.log((F.col("d1") + 0.5) / of[1]) - F.log((F.col("d0") + 0.5) / of[0])
    error = F.sqrt(1 / (F.col("d1") + 0.5) + 1 / (F.col("d0") + 0.5))
    rate = F.log((F.col("n1") + 0.5) / of[1]) - F.log((F.col("n0") + 0.5) / of[0])
    chosen = counted.where((F.col("d1") >= 5) & (ratio - 3 * error > 0.3) & (rate > 1.5)).select("feature", F.least(rate, F.lit(5.0)).alias("w")).collect()
    model = ToxicModel(restorer, {r.feature: r.w for r in chosen})

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.evidence(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    got = in_tasks(taught.select("y", "text"), seen, "x array<double>, y int").collect()
    model.coef = fit_logistic(np.array([r.x for r in got]), np.array([r.y for r in got], float))
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, and with ``keep_text`` the restored text.

    Only the text decides the score; null and empty texts score as texts without words. Rows are
    independent, so repeated rows get equal scores. ``held_out``: the id's fold is 0.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [t.as_py() or "" for t in part.column("text")]
                cols = [part.column("doc_id"), part.column("held_out"), pa.array([model.score(t) for t in texts], pa.float64())]
                cols += [pa.array([model.restorer.text(t) for t in texts], pa.string())] if keep_text else []
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "restored"][: len(cols)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col)) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    out = in_tasks(rows, work, "doc_id long, held_out boolean, score double" + ", restored string" * keep_text)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicModel, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(str(t.as_py() or "")) < threshold for t in batch.column(text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    importable(docs.sparkSession)
    return docs.mapInArrow(work, docs.schema)
