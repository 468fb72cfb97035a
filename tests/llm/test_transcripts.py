"""Roles by Viterbi: whole conversations against chunks, marked transcripts, rendering."""

import itertools
import random

import numpy as np
import pytest

from orelayer.llm import transcripts as t
from orelayer.session import Workspace


def _talks(seed=1, n=40):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        turns = 60 if c == 3 else r.choice([1, 2, 5, 8])
        for k in range(turns):
            role = "system" if k == 0 and r.random() < 0.3 else ("user" if k % 2 == 0 else "assistant")
            text = {"system": "You are helpful.", "user": "why " * r.randrange(1, 6) + "?", "assistant": "Because of this.\n" * r.randrange(1, 9)}[role]
            rows.append((c, k, r.choice([role, role, None]), text))
    rows += [(5, 1, "user", "same turn"), (5, 1, "assistant", "same turn too."), (5, 1, "assistant", "same turn too."), (None, 1, "user", "x"), (77, None, None, None)]
    return rows


def _roles(spark, rows, parts, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    out = t.recover_roles(df, Workspace(spark, "test"), **how)
    return sorted((str(x["conv_id"]), -1 if x["turn"] is None else x["turn"], x["part"], x["text"], x["role"]) for x in out.collect())


def test_roles_do_not_depend_on_chunks_or_parts(spark):
    rows = _talks()
    whole = _roles(spark, rows, 1, chunk=100_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for chunk, parts in ((2, 3), (5, 1), (7, 6)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert _roles(spark, rows, parts, chunk=chunk) == whole
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_path_is_the_best_of_all(n):
    g = np.random.default_rng(n)
    model = t.RoleModel(g.normal(size=4), g.normal(size=(4, 4)), [])
    emit = g.normal(size=(n, 4))
    score = lambda p: model.start[p[0]] + emit[0, p[0]] + sum(model.step[a, b] + emit[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:])))
    best = max(itertools.product(range(4), repeat=n), key=score)
    assert tuple(t._path(model, emit, None, None)) == best


def test_marked_transcripts(spark):
    text = "### System:\nBe kind.\nUser: hello there\nAssistant: Hi.\nHow are you?\n[USER] fine\n**Bot:** good"
    rows = _talks() + [(500, 0, None, text)]
    got = [x for x in _roles(spark, rows, 2) if x[0] == "500"]
    assert [x[4] for x in got] == ["system", "user", "assistant", "user", "assistant"]
    assert [x[3] for x in got] == ["Be kind.", "hello there", "Hi.\nHow are you?", "fine", "good"]
