"""Fingerprints and near-duplicate groups against plain Python."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orelayer.llm import minhash
from orelayer.llm.common import WordHash
from orelayer.llm.minhash import alike, document_prints, fingerprints
from orelayer.session import Workspace

SPACES = " \t\n\x0b\x0c\r"


def _shingles(text, width=5):
    words = [w for w in "".join(c if c not in SPACES else " " for c in text or "").split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def _edited(rows):
    """(id, text) -> the edited text, by the order that the docstring states."""
    key = lambda i: -(1 << 63) if i is None else i
    signed = lambda t: (h := xxhash.xxh64_intdigest((t or "").encode(), 42)) - (1 << 64 if h >> 63 else 0)
    first = {}
    for i, t in rows:
        k, h = key(i), (signed(t), t or "")
        first[k] = min(first.get(k, h), h)
    ids = sorted(first)
    after = {k: first[ids[(n + 1) % len(ids)]][1] for n, k in enumerate(ids)}
    return [(t or "")[: len(t or "") - len(t or "") // 4] + after[key(i)][: len(t or "") // 4] for i, t in rows]


def _corpus(seed, n=150):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["Ünter", "日本", "X"]
    text = lambda k: r.choice([" ", "\n", " \t"]).join(r.choice(vocabulary) for _ in range(k))
    rows = []
    for i in r.sample(range(-100, 3000), n):
        rows.append((i, text(r.choice([0, 1, 4, 5, 30, 200]))))
    base = text(300).split()
    for i in range(40):  # a family around one text
        w = list(base)
        for k in r.sample(range(300), r.choice([0, 1, 3, 6, 12])):
            w[k] = f"new{r.random()}"
        rows.append((4000 + i, " ".join(w)))
    rows += [(5000, "hot id " + str(k)) for k in range(60)] + [(5000, "hot id 1")] * 5 + [(5001, None), (5002, ""), (5003, " \n"), (None, text(20)), (None, None), (5004, "word " * 20_000 + "x" * 5000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,parts,chunk", [(1, 1, 1 << 20), (2, 5, 300), (3, 60, 2000)])
def test_fingerprints(spark, seed, parts, chunk):
    rows = _corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("id", "key", "h", "part", "kind", "bands", "s1")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = fingerprints(df, Workspace(spark, "test"), chunk=chunk).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    edited = _edited(rows)
    want = sorted((str(i), len(t or ""), hashlib.sha256(e.encode()).hexdigest()) for (i, t), e in zip(rows, edited))
    assert sorted((str(x.id), x.n_chars, x.edited_sha256.hex()) for x in got) == want
    by_edit = {}
    for (i, t), e in zip(rows, edited):
        by_edit.setdefault((i, len(t or ""), hashlib.sha256(e.encode()).digest()), []).append((_shingles(t), _shingles(e)))
    off = []
    for x in got:
        cases = by_edit[x.id, x.n_chars, bytes(x.edited_sha256)]
        off.append(min(abs(x.near_edited - _jaccard(a, b)) for a, b in cases))
        assert x.n_shingles in {len(a) for a, _ in cases}
    assert np.mean(off) < 0.03 and max(off) < 0.2  # 128 permutations: a standard error of 0.044 at most
    prints = {}
    for x in got:
        prints.setdefault((x.s1, x.s2), set()).add(bytes(x.fingerprint))
    assert all(len(v) == 1 for v in prints.values())


def test_permutations_estimate_similarity(spark):
    r = np.random.default_rng(3)
    hits = []
    for j in (0.2, 0.5, 0.8):
        got = []
        for _ in range(60):
            both, one = int(300 * j), 300 - int(300 * j)
            x = r.integers(0, 1 << 63, both + one, dtype=np.uint64)
            y = np.concatenate([x[: both + one // 2]])
            z = np.concatenate([x[:both], x[both + one // 2 :]])
            least = minhash.minima(np.concatenate([y, z]), np.array([0, len(y), len(y) + len(z)]))
            got.append(minhash.likeness(*least.astype(np.uint8)) - both / (both + one))
        hits.append(abs(np.mean(got)))
    assert max(hits) < 0.02


@pytest.mark.parametrize("seed,block", [(5, 512), (6, 4)])
def test_groups_are_those_of_all_pairs(spark, seed, block):
    rows = [(i, t) for i, t in _corpus(seed) if i != 5000]
    df, work = spark.createDataFrame(rows, "doc_id long, text string"), Workspace(spark, "test")
    prints = fingerprints(df, work).cache()
    groups = alike(prints, df, work, block=block)
    got = {x.id: x.component_id for x in prints.join(groups, ["s1", "s2"]).where("id is not null").collect()}
    sets = {i: _shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if _jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {i: find(i) for i in ids}
    assert len({v for i, v in got.items() if i >= 4000 and i < 4040}) > 1  # the family is not all one group


def test_recall_at_the_threshold(spark):
    """Pairs of similarity 0.8 to 0.83, each on its own: nearly all must be found, and none below."""
    r = random.Random(11)
    rows, near = [], 0
    for k in range(300):
        words = [f"p{k}x{i}" for i in range(104)]  # 100 shingles
        other = words[: r.choice([92, 93, 94, 90])] + [f"q{k}x{i}" for i in range(10)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    df, work = spark.createDataFrame(rows, "doc_id long, text string"), Workspace(spark, "test")
    got = {x.id: x.component_id for x in document_prints(df, work).collect()}
    for k in range(300):
        alike_ = _jaccard(_shingles(rows[2 * k][1]), _shingles(rows[2 * k + 1][1])) >= 0.8
        near += alike_
        if not alike_:
            assert got[2 * k + 1] == 2 * k + 1
    found = sum(got[2 * k + 1] == 2 * k for k in range(300))
    assert near > 50 and found >= 0.97 * near


def test_empty_table(spark, work):
    assert document_prints(spark.createDataFrame([], "doc_id long, text string"), work).collect() == []


def test_short_texts_have_one_shingle():
    import pyarrow as pa

    h, limits = minhash.shingles(pa.array(["a b", "A\tB ", None, "a b c d e f", ""]), 5, WordHash())
    assert np.diff(limits).tolist() == [1, 1, 0, 2, 0] and h[0] == h[1]
