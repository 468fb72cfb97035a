"""The operators against plain versions of themselves over the smallest tables."""

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from oracle import compare, duck
from orelayer.llm.byte_bpe import PrefixEncoder, TextCoder, read_ranks
from orelayer.llm.decontaminate import lcs
from orelayer.llm.lattice_lm import Lattice
from orelayer.llm.queries import ORACLES, QUERIES
from orelayer.llm.simhash import Ring

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    return dict(duck(SF).sql("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF).toArrow(), duck(SF).sql(ORACLES[name]).to_arrow_table()) == []


def test_simhash(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op8_simhash"](spark, SF).collect()}
    ids = sorted(got)
    fp = np.array([int(got[i].fingerprint, 16) for i in ids], np.uint64)
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp[i] ^ fp[i + 1 :]) <= 3) + i + 1:
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    assert [got[i].component_id for i in ids] == [ids[r] for r in root]


def test_no_chain_misses_a_near_pair():
    rng = random.Random(5)
    for bits in (3, 12):
        ring = Ring(bits)
        for _ in range(500):
            diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits)))
            assert any(all((diff & m).bit_count() <= ring.budget(k + 1) for k, m in enumerate(chain)) for chain in ring.masks())


def test_quality_counts(spark, texts):
    for r in QUERIES["op10_quality_votes"](spark, SF).collect():
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        times = collections.Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r.kept and r.base_failed)


def test_base_scores(spark, texts):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in texts.items()}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for r in QUERIES["op4_lattice_lm"](spark, SF).collect():
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel_tol=1e-9)
        assert r.score < 0


def test_lattice_sums_all_segmentations():
    lattice = Lattice.start(["▁a".encode(), "▁ab".encode(), b"b", b"ab", b"a"], np.array([-1.5, -2.0, -1.0, -2.5, -3.0]))
    p = {k: (math.exp(f), math.exp(i)) for k, f, i in zip(lattice.keys.tolist(), lattice.first, lattice.inner)}
    of = lambda b: p[int(Lattice.hashes([b])[0])]

    def brute(word):
        def rest(x):
            return math.exp(lattice.end) if not x else sum(of(x[:k])[1] * rest(x[k:]) for k in range(1, len(x) + 1) if int(Lattice.hashes([x[:k]])[0]) in p)

        return math.exp(lattice.bare) * rest(word) + sum(of(word[:k])[0] * rest(word[k:]) for k in range(1, len(word) + 1) if int(Lattice.hashes([word[:k]])[0]) in p)

    words = [b"a", b"ab", b"aab", b"abab", b"bba", b"z"]
    assert np.allclose(np.exp(lattice.log_prob(words)), [brute(w) for w in words], rtol=1e-9)


def test_bpe_is_what_the_library_gives(texts):
    ranks = read_ranks(PATH)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours, rng = TextCoder(PATH, public_tokenizers.PATTERN), random.Random(1)
    letters = [*"abc  \n\t\x1c\x85 éß漢字😀١½'stre01 ..!", "the ", "ing", "'ll", "     ", "\r\n"]
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["a" * 20_000, " " * 20_000 + "x"]
    for text in [*(t or "" for t in texts.values()), *odd]:
        ids, spelled = ours.encode(text)
        assert ids == theirs.encode_ordinary(text) and spelled == ",".join(map(str, ids))
        assert ours.bpe.decode(ids) == text.encode()


def test_bpe_appends_and_edits():
    bpe, rng = PrefixEncoder(read_ranks(PATH)), random.Random(2)
    for _ in range(100):
        text = bytes(rng.choice(b"theringaton") for _ in range(rng.randint(1, 300)))
        last = bpe.extend(text, [])
        more, at = bytes(rng.choice(b"thering") for _ in range(5)), rng.randrange(len(text))
        longer, grown = bpe.append(text, last, more)
        assert grown == bpe.extend(longer, []) and bpe.decode(bpe.tokens(grown)) == text + more
        changed, edited = bpe.edit(text, last, at, min(3, len(text) - at), more)
        assert edited == bpe.extend(changed, []) and bpe.tokens(edited) == bpe.merge(changed)


def test_longest_common_subsequence():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 30)), rng.integers(0, 6, rng.integers(0, 40))
        row = [0] * (len(b) + 1)
        for x in a:
            row = _lcs_row(row, x, b)
        assert lcs(a, b) == row[-1]


def _lcs_row(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


def test_held_out_toxicity(spark):
    con = duck("/root/testdata/sf0.01")
    labels = dict(con.sql("select doc_id, toxic from labels").fetchall())
    rows = [r for r in QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in rows]
    assert len(rows) > 30 and sum(right) >= 0.9 * len(right)


def test_roles_of_held_out_conversations(spark):
    rows = [r for r in QUERIES["op5_transcripts"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.role == r.given_role for r in rows) >= 0.9 * len(rows) > 0
