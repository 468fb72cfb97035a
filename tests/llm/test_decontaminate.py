"""The search for leaks in blocks against one passage at a time."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa

from orelayer.llm import decontaminate
from orelayer.llm.common import WordHash
from orelayer.llm.decontaminate import BUCKETS, SHORT, STEP, hashed_words, lcs, steps_of, targets, weighed

LIMITS = {"min_cosine": 0.25, "min_lcs": 0.6, "weak_lcs": 0.45, "min_answer": 0.75}


class Counted(np.ndarray):
    """A matrix that tells how often it was a factor of a product."""

    products = 0

    def __array_ufunc__(self, ufunc, method, *inputs, **more):
        Counted.products += ufunc is np.matmul
        return getattr(ufunc, method)(*(np.asarray(x) for x in inputs), **more)


def texts_of(seed=3):
    """Items of 20 and 50 words, and texts with whole items, reworded ones and none."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    some = lambda n: rng.choice(words, n).tolist()
    items = [some(n) for n in (20, 50) * 6]
    texts = []
    for i in range(60):
        inside = list(items[i % 12]) if i % 3 else some(5)
        for _ in range(i % 4):
            inside[int(rng.integers(len(inside)))] = "new"
        texts.append(" ".join(some(40 * (i % 5)) + inside + some(90)))
    return [" ".join(x) for x in items], [*texts, "", None, "new"]


def space(items, texts, rank=16):
    """The benchmark's passages in a random latent space, and the counts they rest on."""
    counts, steps = np.zeros(BUCKETS, np.int64), 0
    for text in texts:
        h, before = hashed_words(pa.array([text or ""]), WordHash())
        _, first, last = steps_of(before)
        for a, b in zip(first, last):
            counts[np.unique(h[a:b] % BUCKETS).astype(np.int64)] += 1
            steps += 1
    t = targets(pd.DataFrame({"item": range(len(items)), "text": items}), counts, steps)
    t.basis = np.linalg.qr(np.random.default_rng(1).standard_normal((len(t.terms), rank)))[0]
    t.latent = (t.matrix() @ t.basis).T
    t.share = (t.latent**2).sum(0)
    return t, counts, steps


def plain(t, ids, texts):
    """All leaks, a passage at a time."""
    out = set()
    place = {int(x): i for i, x in enumerate(t.terms)}
    for i, text in zip(ids, texts):
        h, before = hashed_words(pa.array([text or ""]), WordHash())
        weight = [t.idf[int(x) % BUCKETS] for x in h]
        for a in range(0, len(h), STEP):
            b, x = min(a + 2 * STEP, len(h)), np.zeros(len(t.terms))
            for k in range(a, b):
                if int(h[k]) in place:
                    x[place[int(h[k])]] += weight[k] ** 2
            norm = sum(w * w for w in weight[a:b])
            if x.sum() < LIMITS["min_cosine"] ** 2 * norm:
                continue
            cosine = np.sqrt(x) @ t.basis @ t.latent / math.sqrt(norm)
            for p in np.flatnonzero(cosine >= LIMITS["min_cosine"] * t.share):
                got = lcs(t.passages[p], h[a:b]) / len(t.passages[p])
                end = lcs(t.answers[p], h[a : min(b + 2 * STEP, len(h))]) / len(t.answers[p])
                long = t.whole[p] >= SHORT
                if (got >= 0.6 and (long or got == 1.0)) or (got >= 0.45 and end >= 0.75 and long):
                    out.add((i, t.items[p], int(p), round(cosine[p] / t.share[p], 9), got, end))
    return out


def test_passages_are_compared_in_blocks(monkeypatch):
    items, texts = texts_of()
    t, _, _ = space(items, texts)
    ids = list(range(len(texts)))
    want = plain(t, ids, texts)
    monkeypatch.setattr(decontaminate, "in_tasks", lambda docs, work, schema: work)
    t.latent, Counted.products = t.latent.view(Counted), 0
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], ["id", "text"])
    found = [r for b in decontaminate.find_leaks(None, t, **LIMITS)(iter([batch])) for r in zip(*b.to_pydict().values())]
    assert {(i, item, p, round(c, 9), got, end) for i, item, p, c, got, end in found} == want and len(found) == len(want) > 30
    assert 0 < Counted.products <= 4  # some 200 passages, 128 at a time


def test_terms_that_share_a_bucket_are_told_apart():
    items, texts = texts_of()
    t, counts, steps = space(items, texts)
    t.terms = np.unique(np.concatenate([t.terms, t.terms[:9] + np.uint64(BUCKETS), t.terms[:3] + np.uint64(5 * BUCKETS)]))
    t.__post_init__()
    asked = np.concatenate([t.terms, t.terms + np.uint64(3 * BUCKETS), t.terms + np.uint64(1)])
    weight, term = t.weights(asked)
    place = {int(x): i for i, x in enumerate(t.terms)}
    assert term.tolist() == [place.get(int(x), -1) for x in asked]
    assert weight.tolist() == [t.idf[int(x) % BUCKETS] for x in asked]


def test_sums_of_runs_longer_than_a_block():
    rng = np.random.default_rng(5)
    table, lengths = rng.standard_normal((30, 4)), [1, 25, 1, 3, 10, 40]
    begin, n = np.cumsum([0, *lengths[:-1]]), sum(lengths)
    rows, value = rng.integers(0, 30, n), rng.standard_normal(n)
    want = [(table[rows[a : a + k]] * value[a : a + k, None]).sum(0) for a, k in zip(begin, lengths)]
    for cells in (1, 7, 10, n, 1000):
        assert np.allclose(weighed(table, rows, value, begin, cells), want)
