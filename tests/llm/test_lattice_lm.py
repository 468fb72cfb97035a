"""The lattice language model against plain sums over a few texts."""

import math
import zlib

import numpy as np

from orelayer.llm import lattice_lm
from orelayer.llm.lattice_lm import Lattice, lattice_scores
from orelayer.session import Workspace

PIECES = ["▁a".encode(), "▁ab".encode(), b"b", b"ab", b"a", b"bab"]
SCORES = np.array([-1.5, -2.0, -1.0, -2.5, -3.0, -3.5])
TRAIN = ["ab a ab b", "ab bab a aab", "b b ab a a"]


def docs_of(spark, held, train=TRAIN):
    """(rows, held-out ids): the ids' folds decide what is held out."""
    ids = iter(range(10_000))
    of = lambda out: next(i for i in ids if (zlib.crc32(str(i).encode()) % 5 == 1) == out)
    rows = [(of(False), t) for t in train] + [(of(True), t) for t in held]
    return spark.createDataFrame(rows, "doc_id long, text string"), [i for i, _ in rows[len(train):]]


def plain_log_sum(lattice, word):
    """ln of the sum over all segmentations, letter by letter."""
    p = {k: (f, i) for k, f, i in zip(lattice.keys.tolist(), lattice.first, lattice.inner)}
    sums = [lattice.bare]
    for stop in range(1, len(word) + 1):
        ways = []
        for start in range(max(0, stop - lattice.longest), stop):
            if (key := int(Lattice.hashes([word[start:stop]])[0])) in p:
                ways += [sums[start] + p[key][1], *([p[key][0]] if start == 0 else [])]
        most = max(ways)
        sums.append(most + math.log(sum(math.exp(x - most) for x in ways)))
    return sums[-1] + lattice.end


def test_long_words_keep_their_price(spark):
    held = ["ab" * 10_000, "z" * 60, "z" * 90]
    docs, ids = docs_of(spark, held)
    got = {r.doc_id: r.score for r in lattice_scores(docs, PIECES, SCORES, Workspace(spark, "long-words"), rounds=0).collect()}
    words = [w for t in TRAIN for w in t.split()]
    seen = {w: words.count(w) for w in words}
    once, twice = (sum(c == k for c in seen.values()) for k in (1, 2))
    give, n = min(0.95, max(0.3, once / (once + 2 * twice))), len(words) + len(TRAIN)
    lattice = Lattice.start(PIECES, SCORES)
    for i, text in zip(ids, held):
        word = plain_log_sum(lattice, text.encode()) + math.log(give * len(seen) / len(words)) + math.log(len(words) / n)
        assert math.isclose(got[i], (word + math.log(len(TRAIN) / n)) / math.log(10), rel_tol=1e-6)
    assert got[ids[0]] < -2000 and got[ids[2]] < got[ids[1]] - 100


def test_pieces_are_fitted_in_three_rounds(spark):
    docs, ids = docs_of(spark, ["abab zb bab", "aabba"])
    of = lambda name, **more: {r.doc_id: r.score for r in lattice_scores(docs, PIECES, SCORES, Workspace(spark, name), **more).collect()}
    default, one, three = of("default"), of("one", rounds=1), of("three", rounds=3)
    assert all(math.isclose(default[i], three[i], rel_tol=1e-9) for i in default)
    assert any(abs(default[i] - one[i]) > 1e-3 for i in ids)


def test_rounds_raise_the_likelihood(spark):
    lattice, words = Lattice.start(PIECES, SCORES), sorted({w.encode() for t in TRAIN for w in t.split()})
    found = []
    for _ in range(4):
        found.append(lattice.log_prob(words).sum())
        lattice = lattice.updated(lattice.expect(words, np.ones(len(words))))
    assert found == sorted(found)


def three_lattices():
    """Lattices over the same pieces with different weights, and words of 1 to 14 bytes."""
    start = Lattice.start(PIECES, SCORES)
    rng = np.random.default_rng(2)
    uses = rng.gamma(0.3, 300, (2, 2, len(start.keys) + 1))
    words = sorted({bytes(rng.choice(list(b"aabbz"), n).tolist()) for n in range(1, 15) for _ in range(4)})
    return [start, *(start.updated(x, 20.0) for x in uses)], [words[i] for i in rng.permutation(len(words))]


def plain_uses(lattice, word):
    """Expected uses of each piece, all ways to write the word spelled out."""
    at = {k: i for i, k in enumerate(lattice.keys.tolist())}
    piece = lambda b: at.get(int(Lattice.hashes([b])[0]))

    def ways(left):  # (probability, pieces) of all ways to go on
        if not left:
            yield math.exp(lattice.end), []
        for k in range(1, len(left) + 1):
            if (i := piece(left[:k])) is not None:
                for p, then in ways(left[k:]):
                    yield p * math.exp(lattice.inner[i]), [(1, i), *then]

    every = [(p * math.exp(lattice.bare), [(0, -1), *of]) for p, of in ways(word)]
    for k in range(1, len(word) + 1):
        if (i := piece(word[:k])) is not None:
            every += [(p * math.exp(lattice.first[i]), [(0, i), *of]) for p, of in ways(word[k:])]
    out, total = np.zeros((2, len(lattice.keys) + 1)), sum(p for p, _ in every)
    for p, of in every:
        for kind, i in of:
            out[kind, i] += p / total
    out[1, -1] = 1
    return out


def test_words_of_all_lengths_and_classes_are_summed_together(monkeypatch):
    lattices, words = three_lattices()
    which, weight = np.arange(len(words)) % 3, np.arange(len(words)) % 5 + 0.5
    want = np.zeros((3, 2, len(lattices[0].keys) + 1))
    for word, k, w in zip(words, which, weight):
        want[k] += w * plain_uses(lattices[k], word)
    calls, arcs = [], lattice_lm.Sums.arcs
    monkeypatch.setattr(lattice_lm.Sums, "arcs", lambda self, some: calls.append(len(some)) or arcs(self, some))
    for least in (1e-200, 1e-9, 1.0):  # none, some and all of the sums in logs
        monkeypatch.setattr(lattice_lm.Sums, "LEAST", least)
        sums = lattice_lm.Sums(lattices)
        assert np.allclose(sums.expect(words, which, weight), want, rtol=1e-9, atol=1e-12)
        assert np.allclose(sums.log_probs(words), [[plain_log_sum(x, w) for w in words] for x in lattices], rtol=1e-12)
    assert calls[:2] == [len(words)] * 2  # once for all lengths and lattices
    monkeypatch.setattr(lattice_lm._blocks, "__defaults__", (40,))
    assert np.allclose(sums.expect(words, which, weight), want, rtol=1e-9, atol=1e-12)


def test_unlikely_words_are_fitted_in_logs():
    lattices, _ = three_lattices()
    words = [b"z" * 70, b"ab" * 300, b"a", b"zz"]
    sums = lattice_lm.Sums(lattices)
    got = sums.log_probs([*words, b""])
    assert np.allclose(got[:, :4], [[plain_log_sum(x, w) for w in words] for x in lattices], rtol=1e-10)
    assert np.isneginf(got[:, 4]).all() and got[0, 0] < -500
    uses = sums.expect(words, np.array([0, 1, 2, 0]), np.array([1.0, 2.0, 3.0, 4.0]))
    z, both = int(np.searchsorted(lattices[0].keys, Lattice.hashes([b"z"])[0])), plain_uses(lattices[0], b"zz")
    assert np.isclose(uses[0, :, z].sum(), 70 + 4 * both[:, z].sum())  # one byte a piece, as first or inner one
    assert np.allclose(uses[:, 1, -1], [5, 2, 3]) and np.allclose(uses[:, 0].sum(1), [5, 2, 3])  # one end and one first piece a word
