"""Token allocation, SimHash fingerprints and the fit of votes against plain Python."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tiktoken.load import load_tiktoken_bpe

from orelayer.llm import quality_votes as qv
from orelayer.llm.simhash import near_groups
from orelayer.llm.token_spans import RULES, allocate, section_tokens


def _allocate(lengths, spans, rule):
    """Byte by byte: the section of each byte of each token."""
    out, at = [0.0] * (len(spans) + 1), 0
    for n in lengths:
        touched = {}
        for byte in range(at, at + n):
            for k, (a, b) in enumerate(spans):
                if a <= byte < b:
                    touched[k] = touched.get(k, 0) + 1
        at += n
        if not touched:
            out[-1] += 1
        elif rule == "share":
            for k, c in touched.items():
                out[k] += c / sum(touched.values())
        elif rule == "first":
            out[min(touched)] += 1
        else:
            out[min(touched, key=lambda k: (-touched[k], k))] += 1
    return out


@pytest.mark.parametrize("rule", RULES)
def test_allocate(rule):
    r = random.Random(rule)
    for _ in range(500):
        lengths = [r.randrange(1, 7) for _ in range(r.randrange(0, 12))]
        cuts = sorted(r.randrange(0, sum(lengths) + 1) for _ in range(2 * r.randrange(0, 6)))
        spans = list(zip(cuts[::2], cuts[1::2]))
        got = allocate(np.array(lengths, np.int64), np.array([a for a, _ in spans], np.int64), np.array([b for _, b in spans], np.int64), rule)
        assert np.allclose(got, _allocate(lengths, spans, rule))
        assert math.isclose(got.sum(), len(lengths), abs_tol=1e-9)


@pytest.mark.parametrize("rule", RULES)
def test_sections_of_texts(spark, rule):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    texts = {1: "One héading\nsome words, über\n\n  more 日本語 words", 2: "", 3: None, 4: "plain text of one line"}
    spans = {1: [("a", 0, 7), ("b", 7, 20), ("c", 25, 400)], 2: [("a", 0, 5)], 3: None, 4: [("x", 3, 8), ("y", 6, 12), ("z", None, 3)]}
    schema = "doc_id long, text string, spans array<struct<section:string,start:long,stop:long>>"
    df = spark.createDataFrame([(i, t, spans[i]) for i, t in texts.items()], schema)
    got = section_tokens(df, path, public_tokenizers.PATTERN, rule=rule, spans_col="spans").collect()
    for i, text in texts.items():
        text = text or ""
        lengths = [len(own.decode_single_token_bytes(x)) for x in own.encode_ordinary(text)]
        given, last = [], 0
        for name, a, b in spans[i] or []:
            if a is None:
                continue
            a, b = max(min(a, len(text)), last), min(b, len(text))
            last = max(a, b)
            given.append((name, len(text[:a].encode()), len(text[: max(a, b)].encode())))
        want = _allocate(lengths, [(a, b) for _, a, b in given], rule)
        rows = [r for r in got if r["doc_id"] == i]
        assert math.isclose(sum(r["n_tokens"] for r in rows), len(lengths), abs_tol=1e-9)
        assert np.allclose([r["n_tokens"] for r in rows if r["section"] is not None], want[:-1])


def test_fingerprints_bit_by_bit(spark, work):
    r = random.Random(1)
    words = ["The", "über", "x", "日本", "Word"]
    texts = [r.choice([" ", "\n", "\t "]).join(r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 9, 40]))) for _ in range(80)] + [None, "  "]

    def fingerprint(text):
        found = "".join(" " if c in " \t\n\x0b\x0c\r" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")
        found = [w for w in found if w]
        runs = [" ".join(found[i : i + 3]) for i in range(max(len(found) - 2, 1))] if found else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
        return f"{sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)):016x}"

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["fingerprint"] for x in near_groups(df, work).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}


def test_votes_are_fitted_as_by_hand(spark):
    r, names = random.Random(2), ["a", "b", "c"]
    rows = {}
    for _ in range(400):
        good = r.random() < 0.7
        key = tuple(r.choices([-1, 0, 1], [0.1, 0.3, 0.6] if good else [0.6, 0.3, 0.1])[0] for _ in names)
        rows[key] = rows.get(key, 0) + 1
    fitted = qv.fit_votes(spark.createDataFrame([(*k, n) for k, n in rows.items()], "a int, b int, c int, n long"), names, rounds=5, tolerance=0.0)
    prior, good, bad, strength = qv.START_PRIOR, [qv.START_GOOD] * 3, [qv.START_BAD] * 3, 20.0
    for _ in range(5):
        posterior = {}
        for key in rows:
            odds = math.log(prior / (1 - prior))
            for k, v in enumerate(key):
                x = math.log(good[k][v + 1] / bad[k][v + 1])
                odds += min(0.0, x) if v < 0 else max(0.0, x) if v > 0 else 0.0  # a vote never counts as its opposite
            posterior[key] = 1 / (1 + math.exp(-odds))
        total = [sum(n * (posterior[k] if side else 1 - posterior[k]) for k, n in rows.items()) for side in (True, False)]
        share = lambda k, v, side, start: (sum(n * (posterior[x] if side else 1 - posterior[x]) for x, n in rows.items() if x[k] == v) + strength * start[v + 1]) / (total[0 if side else 1] + strength)
        good = [tuple(share(k, v, True, qv.START_GOOD) for v in (-1, 0, 1)) for k in range(3)]
        bad = [tuple(share(k, v, False, qv.START_BAD) for v in (-1, 0, 1)) for k in range(3)]
        prior = (total[0] + qv.START_PRIOR * strength) / (sum(total) + strength)
    assert math.isclose(fitted.prior, prior, rel_tol=1e-9)
    assert np.allclose(fitted.good, good) and np.allclose(fitted.bad, bad)
    assert 0.5 < prior < 0.9
