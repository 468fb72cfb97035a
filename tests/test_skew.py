"""One key holds a third of all rows: same results as brute force, whatever the partitions."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orelayer.operators import profiling
from orelayer.operators.keys import annotate_fk, orphan_values
from orelayer.operators.contract import Contract, Field, ForeignKey, REASONS
from orelayer.operators.quality import duplicate_rows
from orelayer.operators.transforms import aggregate_metrics, deduplicate, enrich_with_lookup, latest_by_key

N = 1500


@pytest.fixture(scope="module")
def facts():
    return [(0 if i % 3 == 0 else i % 97 + 1, i % 11, i) for i in range(N)]


@pytest.fixture(params=[("1", "10485760"), ("4", "-1"), ("32", "-1")], ids=["1-part", "4-parts", "32-parts"])
def setting(spark, request):
    names = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, request.param):
        spark.conf.set(name, value)
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.fixture
def df(spark, facts, setting):
    return spark.createDataFrame(facts, "k int, v int, u int").repartition(5)


def test_dedup(df, facts, rows):
    best = {}
    for r in facts:
        best[r[0]] = max(best.get(r[0], r), r)
    assert rows(deduplicate(df, ["k"])) == sorted(best.values(), key=lambda r: tuple(map(str, r)))


def test_latest(df, facts, rows):
    best = {}
    for r in facts:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda x: (x[2], x[1]))
    assert rows(latest_by_key(df, ["k"], ["u"])) == sorted(best.values(), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_lookup(spark, df, facts, rows, how):
    lookup = spark.createDataFrame([(k, f"n{k}") for k in (0, 5, 500)], "k int, name string")
    got = Counter(r[0] for r in rows(enrich_with_lookup(df, lookup, "k", how)))
    counts = Counter(r[0] for r in facts)
    expected = Counter({k: n for k, n in counts.items() if how != "right" or k in (0, 5)})
    if how != "left":
        expected[500] = 1
    assert got == expected


def test_fk(spark, df, facts, work, rows):
    contract = Contract("t", (Field("k", "int"), Field("u", "int")), ("u",), (ForeignKey("k", "p"),))
    parents = {"p": spark.createDataFrame([(i,) for i in range(1, 50)], "id int")}
    checked = annotate_fk(contract.annotate(df.select("k", "u")), contract.foreign_keys, parents, work)
    bad = Counter(r["k"] for r in checked.filter(F.size(REASONS) > 0).collect())
    assert bad == Counter(r[0] for r in facts if not 1 <= r[0] < 50)
    assert checked.count() == N
    assert dict(rows(orphan_values(df, "k", parents["p"]))) == dict(bad)


def test_duplicates_and_aggregates(df, facts, rows):
    distinct = len({r[:2] for r in facts})
    assert duplicate_rows(df, ["k", "v"]).first()[0] == N - distinct
    overview = profiling.profile_overview(df.select("k", "v")).first()
    assert (overview["total_rows"], overview["duplicate_rows"]) == (N, N - distinct)
    sums = defaultdict(int)
    for k, _, u in facts:
        sums[k] += u
    assert dict(rows(aggregate_metrics(df, ["k"], {"u": "sum"}))) == dict(sums)


def test_profile(df, facts, work):
    p = {r["name"]: r for r in profiling.profile_columns(df, work=work).collect()}
    for i, name in enumerate(("k", "v", "u")):
        values = sorted(r[i] for r in facts)
        assert p[name]["distinct_count"] == len(set(values))
        assert p[name]["median"] == (values[N // 2 - 1] + values[N // 2]) / 2
        assert list(p[name]["sample_values"]) == [str(v) for v in sorted(set(values))[:10]]
