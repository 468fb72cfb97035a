"""The near-dedup stage against all pairs, and its recall at the threshold."""

import random

from orelayer.llm import stages


def _shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_pairs_at_the_threshold(spark):
    """Single pairs between 0.7 and 0.9 of different sizes: those at 0.8 and above go, no other does."""
    r, rows, want = random.Random(3), [], {}
    for k in range(400):
        n = r.choice([60, 104, 304])
        words = [f"p{k}x{i}" for i in range(n)]
        tail = r.choice([0.04, 0.08, 0.1, 0.11, 0.14, 0.17])
        kept = int(n * (1 - tail))
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:kept] + [f"q{k}x{i}" for i in range(n - kept)]))]
        want[2 * k + 1] = _jaccard(_shingles(rows[-2][1]), _shingles(rows[-1][1]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {x.doc_id for x in stages.copies(spark, df, "").collect()}
    assert all(i in left for i, j in want.items() if j < 0.8)
    near = [i for i, j in want.items() if j >= 0.8]
    assert len(near) > 100 and sum(i not in left for i in near) >= 0.93 * len(near)
    assert all(2 * k in left for k in range(400))


def test_a_family_is_split_as_all_pairs_say(spark):
    r, base = random.Random(4), [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in r.sample(range(200), r.choice([0, 1, 2, 4, 9])):
            words[k] = f"new{i}x{k}"
        rows.append((i, " ".join(words)))
    rows += [(100, " ".join(base * 2)), (101, None), (102, " "), (None, rows[0][1]), (3, rows[3][1])]
    sets = {i: _shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and _jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(str(x.doc_id) for x in stages.copies(spark, df, "").collect())
    assert left == sorted(str(i) for i, _ in rows if i is None or find(i) == i)
