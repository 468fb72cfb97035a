"""Wrappers: alignment against brute force, deep and wide pages, names, whole texts."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from orelayer.llm import wrappers as w


def _lcs(x, y):
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


@pytest.mark.parametrize("most", [1, 3, 10, 1_000_000])
def test_common_is_a_longest_subsequence(most):
    r = random.Random(most)
    for _ in range(400):
        x, y = ([r.choice("abcd") for _ in range(r.randrange(15))] for _ in "xy")
        pairs = w.common(x, y, most)
        assert len(pairs) == _lcs(x, y) and all(x[i] == y[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def test_many_siblings_take_linear_memory():
    r = random.Random(2)
    x, y = ([f"k{r.randrange(3000)}" for _ in range(8000)] for _ in "xy")
    start = time.time()
    pairs = w.common(x, y)
    assert len(pairs) > 100 and time.time() - start < 60
    page = lambda: "<body><article>" + "".join(f"<{r.choice(['p', 'h2', 'ul'])} class='c{'abcdefghij'[r.randrange(10)]}'>t</>" for _ in range(6000)) + "</article>"
    assert w.merge(*(w.skeleton(w.parse(page())) for _ in range(2))).kids


def test_deep_pages_keep_all_text_in_order():
    for n in (50, 900, 10_000):
        page = "<html><body><article>" + "<div>" * n + "deep <b>text</b> A<div>B</div>C" + "</div>" * n + "after</article></body></html>"
        one = w.skeleton(w.parse(page))
        both = w.Node.unpack(json.loads(json.dumps(w.merge(one, w.skeleton(w.parse(page))).pack())))
        assert str(both) and w.article_text(w.parse(page), w.main_path(both)) == "deep text A B C after"


def _texts(spark, work, *pages):
    rows = [(i, f"https://h{h}.example/{i}", p) for i, (h, p) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(c) for c in ("host", "main", "text", "wrapper")})
    return {r["page_id"]: r["text"] for r in w.extract_text(df, work).collect()}


def test_whole_texts(spark, work):
    site = "<html><head><title>T</title></head><body><nav><a>Menu</a></nav><{0}>{1}</{2}><div class='sidebar'>Side</div><footer>Foot</footer></body></html>"
    article = "<h1>Title &amp; more</h1><p>First   <b>bold</b> words.</p><p>Second one here, number {0}.</p>"
    want = "Title & more First bold words. Second one here, number {0}."
    kinds = ["article", "div id='content' class='has-sidebar'", "section class='post comments-open'", "main"]
    pages = [(h, site.format(kind, article.format(n), kind.split()[0])) for h, kind in enumerate(kinds) for n in range(3)]
    pages += [(9, None), (9, ""), (9, "<div>" * 3000 + "deep words" + "</div>" * 3000)]
    got = _texts(spark, work, *pages)
    for k in range(12):
        assert got[k] == want.format(k % 3)
    assert got[12] == got[13] == "" and got[14] == "deep words"


def test_comments_and_adverts_are_left_out(spark, work):
    page = "<body><article><p>The words of article {0} stand here and go on for a while.</p><div class='comments'>A reader says {0}</div><aside>Buy</aside></article></body>"
    got = _texts(spark, work, *[(1, page.format(n)) for n in range(4)])
    assert got == {n: f"The words of article {n} stand here and go on for a while." for n in range(4)}
