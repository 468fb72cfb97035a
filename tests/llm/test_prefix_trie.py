"""The prefix trie against plain Python, for shards of one conversation up to all in one."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelayer.llm.prefix_trie import DoubleArray, forked, prefix_nodes, turn_rows


def _brute(rows):
    """Every node by its sequence of (role, text)."""
    own = {}
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=key)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    kids = {n: {m for m in nodes if len(m) == len(n) + 1 and m[: len(n)] == n} for n in nodes} if len(nodes) < 3000 else None
    if kids is None:
        kids = {n: set() for n in nodes}
        for n in nodes:
            if n:
                kids[n[:-1]].add(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = sum(saved[k] for k in kids[n]) + ((len(nodes[n]) - 1) * len(n[-1][1].encode()) if n else 0)
    ends = {n: ",".join(map(str, sorted(c for c in nodes[n] if len(built[c]) == len(n)))) for n in nodes}
    return sorted(
        (min(nodes[n]), len(n), min(nodes[n[:-1]]) if n else None, len(nodes[n]), len(kids[n]), leaves[n], saved[n], hashlib.sha256(ends[n].encode()).hexdigest())
        for n in nodes
    )


def _talks(seed, n=60):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 200), n):
        kind = r.random()
        if kind < 0.3:  # a hot conversation, word for word
            rows += [(c, t, "user", f"hot {t}") for t in range(6)]
            continue
        for t in range(r.choice([1, 2, 3, 9, 12])):
            rows.append((c, r.choice([t, t, None]), r.choice(["user", "bot", None, ""]), r.choice(["a", "b", "ü", "", None, "longer"])))
    rows += [(300, t, "user", f"turn {t % 7}") for t in range(300)] + [(305, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(7, 0, "x", "y"), (7, 0, "x", "y"), (None, 1, "user", "no id")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard", [(1, 1), (2, 2), (3, 7), (4, 1000)])
def test_against_plain_python(spark, work, seed, shard):
    rows = _talks(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(c) for c in ("t", "turns", "path", "base", "key", "depth", "head")})
    got = prefix_nodes(forked(turn_rows(df)), work, shard_convs=shard).collect()
    assert sorted(tuple(x) for x in got) == _brute(rows)


def test_shard_of_few_turns(spark, work):
    rows = _talks(9, 20)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_nodes(forked(turn_rows(df)), work, shard_turns=5).collect()
    assert sorted(tuple(x) for x in got) == _brute(rows)


def test_empty_table(spark, work):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_nodes(forked(turn_rows(df)), work).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark, work):
    # 1 keeps nothing of its own (fewer turns than h) and conversation 0 is not there
    c = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    df = spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in prefix_nodes(forked(turn_rows(df)), work).collect()] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_double_array_finds_every_child_and_no_other():
    r = np.random.default_rng(5)
    parent, code = [-1], [0]
    for s in range(300):  # level by level: nodes are opened in the order in which they were made
        for c in sorted(r.choice(400, r.integers(0, 12), replace=False).tolist()):
            parent.append(s)
            code.append(c)
        if s + 1 >= len(parent):
            break
    trie = DoubleArray(np.array(parent), np.array(code))
    edges = {(parent[i], code[i]): i for i in range(1, len(parent))}
    assert len(set(trie.state.tolist())) == len(parent)
    for s in set(parent[1:]):
        at = trie.step(np.full(400, trie.state[s]), np.arange(400))
        for c in range(400):
            assert at[c] == (trie.state[edges[s, c]] if (s, c) in edges else -1)
