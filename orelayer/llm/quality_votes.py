"""Quality rules that vote, weighed by expectation-maximisation, with DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import SPACES, WORD_BREAK
from orelayer.session import Workspace

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts for each document: (doc_id, text, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_blank, n_upper, n_distinct).

    Words lie between ASCII white space. ``n_repeat_words`` counts the words that lie in an 8-word
    window found twice or more in the same text. Windows are compared as 64-bit hashes: sorted
    with their positions, equal neighbours are repeats, and the gaps between their positions give
    the covered words, so a text of n words takes n log n steps however much it repeats.

    Null and empty texts have no word and no line with a word. Each row is measured by itself, so
    ties and repeated rows need no rule; other columns are left out.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bare = F.btrim("text", F.lit(SPACES))
    empty_text, none = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    d = d.withColumn("_words", F.when(bare == "", empty_text).otherwise(F.split(bare, WORD_BREAK)))
    full = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.withColumn("_lines", full).withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    n, h = F.size("_words"), F.col("_hash")
    window = F.transform(
        F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
    )
    d = d.select(
        "doc_id", "text", n.cast("bigint").alias("n_words"),
        F.size(F.array_distinct("_hash")).cast("bigint").alias("n_distinct"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n > WINDOW, window).otherwise(none).alias("_win"),
    )
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    d = d.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    s = F.col("_sorted")
    again = F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)) | F.coalesce((i > 0) & (x["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"]), F.lit(False)))
    d = d.withColumn("_at", F.sort_array(F.transform(again, lambda x: x["p"])))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("bigint"), lambda a, x: a + x,
    )
    t = F.col("text")
    return d.select(
        "doc_id", "text", "n_words", F.length(_without(t, SPACES)).cast("bigint").alias("word_chars"),
        (F.octet_length(t) - F.octet_length(_without(t, SYMBOLS))).cast("bigint").alias("n_symbols"),
        "n_dup_lines", F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"), "n_lines", "n_distinct",
    )


@dataclass(frozen=True)
class Rule:
    """Votes -1 (bad) where ``bad`` holds, else 1 (good) where ``good`` holds, else abstains (0).

    A rule that looks for one fault has no ``good``: a text without that fault may have another.
    """

    name: str
    bad: Column
    good: Column | None = None

    def vote(self) -> Column:
        vote = F.when(self.bad, -1)
        return (vote if self.good is None else vote.when(self.good, 1)).otherwise(0).cast("tinyint").alias(self.name)


def standard_rules() -> list[Rule]:
    """Rules over the columns of ``measures``; all but the first are ratios."""
    w = F.greatest(F.col("n_words"), F.lit(1))
    t = F.col("text")
    count = lambda chars: F.octet_length(t) - F.octet_length(_without(t, chars))
    shouts = (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("!!"), F.lit("")))) / 2 / w
    marks, ends, mean = (F.col("n_symbols") + count("!")) / w, count(".?!") / w, F.col("word_chars") / w
    return [
        Rule("short", F.col("n_words") < 20),
        Rule("symbols", F.col("n_symbols") / w > 0.1),
        Rule("repeats", F.col("n_repeat_words") / w > 0.3),
        Rule("lines", (F.col("n_dup_lines") * 10 > 3 * F.col("n_lines")) & (F.col("n_dup_lines") > 3)),
        Rule("shouting", shouts > 0.1),
        Rule("tables", count("|") / w > 0.1),
        Rule("variety", F.col("n_distinct") / w < 0.1),
        Rule("marks", marks > 0.5, marks <= 0.1),
        Rule("word_length", (mean < 2.5) | (mean > 12), mean.between(3.0, 9.0)),
        Rule("sentences", ((ends == 0) & (F.col("n_words") >= 50)) | (ends > 0.5), ends.between(0.02, 0.25)),
    ]


@dataclass(frozen=True)
class VoteModel:
    """P(good), and for each rule P(vote | good) and P(vote | bad) of the votes -1, 0 and 1."""

    prior: float
    names: tuple[str, ...]
    good: tuple[tuple[float, float, float], ...]
    bad: tuple[tuple[float, float, float], ...]
    rounds: int = 0

    def weights(self) -> list[tuple[float, float, float]]:
        """What each vote adds to the log-odds of good. A vote never counts as its opposite, and
        abstaining says nothing."""
        logs = [[math.log(g / b) for g, b in zip(*pair)] for pair in zip(self.good, self.bad)]
        return [(min(0.0, no), 0.0, max(0.0, yes)) for no, _, yes in logs]

    def accuracies(self) -> dict[str, float]:
        """For each rule, the probability that a vote it gives is right."""
        p, out = self.prior, {}
        for name, g, b in zip(self.names, self.good, self.bad):
            out[name] = (p * g[2] + (1 - p) * b[0]) / (p * (g[0] + g[2]) + (1 - p) * (b[0] + b[2]))
        return out

    def posterior(self) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, (no, none, yes) in zip(self.names, self.weights()):
            total = total + F.when(F.col(name) > 0, yes).when(F.col(name) < 0, no).otherwise(none)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


#: Votes -1, 0, 1 of a rule before any data: right rules rarely accuse good texts, and a bad text has one fault of many.
START_GOOD, START_BAD, START_PRIOR = (0.01, 0.19, 0.8), (0.4, 0.2, 0.4), 0.8


def fit_votes(votes: DataFrame, names: list[str], *, rounds: int = 12, strength: float = 20.0, tolerance: float = 1e-3) -> VoteModel:
    """Expectation-maximisation over vote patterns.

    ``votes`` holds a column for each rule and ``n``, the documents with that pattern: at most
    3**rules rows, whatever the size of the corpus. Each round is one aggregate by rule and vote;
    only its rows, three for a rule, reach the driver. The start values also are a prior worth
    ``strength`` documents of either class, so that good and bad can't swap and a rule that nearly
    always abstains keeps them. Without any row the start values are returned.
    """
    model = VoteModel(START_PRIOR, tuple(names), (START_GOOD,) * len(names), (START_BAD,) * len(names))
    patterns = votes.select(F.array(*[F.col(x).cast("int") for x in names]).alias("v"), F.col("n").cast("double").alias("n"))
    for turn in range(1, rounds + 1):
        # as an array the weights are data, not code, and no round compiles anew
        flat = F.lit([x for w in model.weights() for x in w])
        start = F.lit([math.log(model.prior / (1 - model.prior))])
        odds = F.aggregate(F.transform("v", lambda x, i: F.get(flat, i * 3 + x + 1)), F.get(start, F.lit(0)), lambda a, x: a + x)
        rows = patterns.select("n", (1 / (1 + F.exp(-odds))).alias("p"), F.posexplode("v").alias("rule", "vote"))
        sums = {(r, v): (g, b) for r, v, g, b in rows.groupBy("rule", "vote").agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))).collect()}
        if not sums:
            return model
        of = [sum(sums.get((0, v), (0, 0))[k] for v in (-1, 0, 1)) for k in (0, 1)]
        share = lambda r, k, start: tuple((sums.get((r, v), (0, 0))[k] + strength * s) / (of[k] + strength) for v, s in zip((-1, 0, 1), start))
        good = tuple(share(r, 0, START_GOOD) for r in range(len(names)))
        bad = tuple(share(r, 1, START_BAD) for r in range(len(names)))
        prior = (of[0] + START_PRIOR * strength) / (of[0] + of[1] + strength)
        moved = max(abs(x - y) for old, new in ((model.good, good), (model.bad, bad)) for a, b in zip(old, new) for x, y in zip(a, b))
        moved, model = max(moved, abs(prior - model.prior)), VoteModel(prior, tuple(names), good, bad, turn)
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, work: Workspace, *, rules: list[Rule] | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, VoteModel]:
    """Measures, votes and the posterior probability of good quality for each document.

    The result has the measures without the text, a vote for each rule, ``quality`` (0 to 1),
    ``base_failed`` and ``kept``: quality of at least ``threshold`` and not ``base_failed``. The
    votes are written once, as the fit and the result both read them. See ``measures`` and
    ``fit_votes`` for nulls, empty texts and empty tables.
    """
    rules = rules or standard_rules()
    names = [r.name for r in rules]
    m = measures(docs, id_col=id_col, text_col=text_col)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    voted = work.stage(m.select(*base, *[r.vote() for r in rules]), "votes")
    patterns = work.stage(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    model = fit_votes(patterns, names)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = voted.withColumn("quality", model.posterior()).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)), model
