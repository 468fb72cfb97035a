"""Ranked search against plain Python, over many shards, owners and blocks."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from orelayer.llm.lexical_search import rank_documents
from orelayer.session import Workspace

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(docs, items, top):
    bags = [(i, _terms(t)) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(_terms(t))
    df = {t: sum(t in set(b) for _, b in bags) for terms in asked.values() for t in terms}
    out = []
    for item, terms in asked.items():
        scores = []
        for i, bag in bags:
            if i is None or not bag:
                continue
            m = 100 - 50 + (50 * len(bag) * n_docs) // total
            score = 0
            for t in terms:
                tf = bag.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, i))
        out += [(item, k, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def _words(r, n):
    common, rare = ["the", "Der", "de"], ["Äpfel", "x1", "naïve", "日本語", "zeta", "QUOTE", "42", "mu", "nu"]
    return r.choice([" ", "\n", "-", "."]).join(r.choice(common if r.random() < 0.7 else rare) for _ in range(n))


def _docs(seed, n=120):
    r = random.Random(seed)
    rows = [(i, _words(r, r.choice([0, 1, 5, 30]))) for i in r.sample(range(-50, 500), n)]
    rows += [(600 + k, "zeta mu the the") for k in range(20)]  # equal scores
    rows += [(601, "zeta mu the the"), (None, "zeta zeta 42"), (700, None), (701, "...\t\x00 "), (702, "zeta " * 20_000)]
    r.shuffle(rows)
    return rows


ITEMS = [(1, "the zeta Mu"), (2, "DER der äpfel Äpfel"), (3, None), (4, "..."), (5, "nowhere to be found"), (6, "日本語 42!"), (6, "nu"), (7, "the de der"), (None, "zeta naïve")]


@pytest.mark.parametrize("seed,top,how", [(1, 5, dict(shard_docs=7, owners=3)), (2, 50, dict(block_items=2, owners=1)), (3, 3, dict(shard_docs=1, owners=9)), (4, 200, dict(shard_bytes=64, block_terms=3))])
def test_against_plain_python(spark, work, seed, top, how):
    docs = _docs(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit(c) for c in ("id", "term", "shard", "item", "score", "rank")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(c) for c in ("item", "term", "doc_id")})
    got = rank_documents(df, items, work, top=top, **how).collect()
    assert sorted((tuple(x) for x in got), key=str) == _brute(docs, ITEMS, top)


def test_empty_tables(spark):
    rank = lambda docs, items: rank_documents(docs, items, Workspace(spark, "test")).collect()
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rank(docs, items.where("false")) == []
    assert rank(docs.where("false"), items) == []
    # one document: the only term is in all of them, so its weight is floor(1000 * ln(4 / 3))
    assert [tuple(r) for r in rank(docs, items)] == [(1, 1, 1, 287 * (10**9 // (1000 + 20 * 100)))]
