"""Main text of web pages, by wrappers inferred from the pages of each host."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import importable, in_tasks
from orelayer.session import Workspace

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|xmp|noscript|iframe|template)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|</?[a-zA-Z!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr label img".split())
_CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

#: What is never part of an article: by element, and by words of class, id and role.
NOT_TEXT = frozenset("head nav header footer aside form button select input menu dialog svg math canvas object audio video map script style noscript".split())
NOT_ARTICLE = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies "
    "disclaimer footer form header login menu menubar nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget widgets".split()
)
ARTICLE = frozenset("article articlebody body content entry main post story text".split())
#: Words that make a class name say something of the element's state, as in ``has-sidebar`` or ``comments-open``.
STATE_FIRST = frozenset("has with without no is not hide show".split())
STATE_LAST = frozenset("open closed enabled disabled on off none active left right".split())
#: Elements below this many levels stand beside each other, as they do in browsers, at a larger number.
DEPTH = 100


class Node:
    """An element, a text (key ``#text``) or a repeated group of elements (key ``(...)``).

    In a wrapper ``low`` and ``high`` are the least and most times it follows at its place: (1, 1) is
    plain, (0, 1) an optional, a higher ``high`` a repeated group. A text is a constant, or a slot
    where ``text`` is None. ``chars`` counts letters of own text over all pages.
    """

    __slots__ = ("key", "kids", "low", "high", "text", "chars", "block")

    def __init__(self, key: str, text: str | None = None, kids: list["Node"] | None = None, low: int = 1, high: int = 1, chars: int = 0):
        self.key, self.text, self.kids, self.low, self.high, self.chars = key, text, kids or [], low, high, chars

    def pack(self) -> list:
        return [self.key, self.text, self.low, self.high, self.chars, [k.pack() for k in self.kids]]

    @classmethod
    def unpack(cls, x: list) -> "Node":
        return cls(x[0], x[1], [cls.unpack(k) for k in x[5]], x[2], x[3], x[4])

    def __str__(self) -> str:
        """The union-free expression; ``_`` is a slot."""
        if self.key == "#text":
            inner = "_" if self.text is None else repr(self.text)
        else:
            inner = " ".join(map(str, self.kids))
            inner = f"({inner})" if self.key[0] == "(" else f"<{self.key}>{inner}</>"
        return inner + ("" if self.high == 1 and self.low else "?" if self.high == 1 else "+" if self.low else "*")


def _words(value: str) -> list[str]:
    return [w.lower() for w in re.split(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])", value) if w]


def _named(name: str) -> list[str]:
    """The words by which one name of a class or id calls the element; none if it tells its state."""
    words = _words(name)
    state = len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST)
    return [] if state else words


def _element(tag: str, attrs: str) -> tuple[str, bool]:
    """The element's key, tag and class words, and whether it holds anything but the article."""
    named: dict[str, str] = {}
    for name, *values in _ATTR.findall(attrs) if attrs else ():
        named.setdefault(name.lower(), html.unescape("".join(values)))
    words = [w for v in named.values() for name in v.split() for w in _named(name)]
    classes = sorted({re.sub(r"\d+", "", c) for c in named.get("class", "").lower().split()} - {""})
    key = ".".join([tag, *classes[:4]]).replace("(", "").replace("#", "")
    if tag in NOT_TEXT:
        return key, True
    if tag in ("html", "body", "main") or not words:
        return key, False
    bad = NOT_ARTICLE.intersection(words)
    strong = bad - {"header", "notice", "search", "form", "tags", "share", "social", "banner"}
    return key, bool(strong) if tag != "article" else bool(bad & {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo", "related"}) or (bool(bad) and not ARTICLE.intersection(words) and tag != "article")


def parse(page: str) -> Node:
    """A tree of the page's elements and texts, without what can't be article. Never fails: missing
    end tags end with the parent, stray ones are passed over, a cut tag is markup, and what is nested
    below ``DEPTH`` levels becomes a row of elements in page order."""
    root = Node("#root")
    stack: list[tuple[str, Node]] = [("#root", root)]
    dropped = 0  # depth at which a dropped element began, 0 outside

    def text(s: str) -> None:
        if dropped or not s:
            return
        if len(stack) > DEPTH + 1 and stack[DEPTH][1].kids[-1] is not stack[-1][1]:  # an element within it came between
            stack[-1] = stack[-1][0], Node(stack[-1][1].key)
            stack[DEPTH][1].kids.append(stack[-1][1])
        kids = stack[-1][1].kids
        if kids and kids[-1].key == "#text":
            kids[-1].text += s
        elif s.strip() or kids:
            kids.append(Node("#text", s))

    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main", "table", "body") and tag in _INLINE:
                    break
            if dropped and len(stack) <= dropped:
                dropped = 0
            continue
        if tag in _CLOSES_P or tag in _SAME:
            limits = _SAME.get(tag)
            for k in range(len(stack) - 1, 0, -1):
                name = stack[k][0]
                if name == "p" and tag in _CLOSES_P or limits and name in ({tag, "dt", "dd"} if tag in ("dt", "dd") else {tag}):
                    del stack[k:]
                    break
                if name not in _INLINE and name != "p" and (not limits or name in limits) or name in ("article", "body"):
                    break
            if dropped and len(stack) <= dropped:
                dropped = 0
        key, out = _element(tag, m["attrs"]) if not dropped else (tag, False)
        node = Node(key)
        if not dropped and not out:
            stack[min(len(stack) - 1, DEPTH)][1].kids.append(node)
        if tag in _VOID or m["attrs"].endswith("/") and tag not in _CLOSES_P | _INLINE:
            continue
        stack.append((tag, node))
        if out and not dropped:
            dropped = len(stack) - 1
    text(page[at:])
    return root


def _tag(key: str) -> str:
    return key.split(".", 1)[0]


def fold(nodes: list[Node]) -> list[Node]:
    """Equal neighbours, or runs of up to three that follow each other again, as repeated groups."""
    out: list[Node] = []
    i = 0
    keys = [n.key for n in nodes]
    while i < len(nodes):
        for size in (1, 2, 3):
            times = 1
            while keys[i : i + size] == keys[i + times * size : i + (times + 1) * size] and len(keys) >= i + (times + 1) * size:
                times += 1
            if times > 1:
                turns = [nodes[i + t * size : i + (t + 1) * size] for t in range(times)]
                if size == 1:
                    one = turns[0][0]
                    for t in turns[1:]:
                        one = merge(one, t[0])
                    one.low = one.high = times
                else:
                    one = Node("(" + " ".join(keys[i : i + size]) + ")", kids=turns[0], low=times, high=times)
                    for t in turns[1:]:
                        one.kids = [merge(a, b) for a, b in zip(one.kids, t)]
                out.append(one)
                i += times * size
                break
        else:
            out.append(nodes[i])
            i += 1
    return out


def skeleton(node: Node) -> Node:
    """The page's tree as a wrapper of this page alone."""
    if node.key == "#text":
        s = " ".join(html.unescape(node.text).split())
        return Node("#text", s if len(s) <= 200 else None, chars=len(s))
    return Node(node.key, kids=fold([s for s in map(skeleton, node.kids) if s.key != "#text" or s.chars]))


def merge(a: Node, b: Node) -> Node:
    """The least general wrapper of two nodes of one key: texts that differ become a slot."""
    text = a.text if a.text == b.text else None
    return Node(a.key, text, align(a.kids, b.kids), min(a.low, b.low), max(a.high, b.high), a.chars + b.chars)


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Both sequences in one: what only one of them has becomes optional, what one has more often a
    repeated group."""
    x, y = [n.key for n in a], [n.key for n in b]
    if x == y:
        return [merge(i, j) for i, j in zip(a, b)]
    out, i, j = [], 0, 0
    for p, q in [*common(x, y), (len(x), len(y))]:
        for only in (*a[i:p], *b[j:q]):
            only.low = 0
            out.append(only)
        if p < len(x):
            out.append(merge(a[p], b[q]))
        i, j = p + 1, q + 1
    # neighbours of one key, left by pages in which something stood between them, are one group
    joined: list[Node] = []
    for node in out:
        if joined and joined[-1].key == node.key:
            low = max(joined[-1].low, node.low)
            high = joined[-1].high + node.high
            joined[-1] = merge(joined[-1], node)
            joined[-1].low, joined[-1].high = low, high
        else:
            joined.append(node)
    return joined


def common(x: list[str], y: list[str], most: int = 1_000_000) -> list[tuple[int, int]]:
    """Places of a longest common subsequence. Beyond ``most`` pairs of places the longer problem is
    halved, so memory stays linear."""
    a, n, m = 0, len(x), len(y)
    while a < min(n, m) and x[a] == y[a]:
        a += 1
    found = [(k, k) for k in range(a)]
    if a == min(n, m):
        return found
    if (n - a) * (m - a) <= most or n - a == 1:
        best = [[0] * (m + 1) for _ in range(n + 1 - a)]
        for i in range(n - 1, a - 1, -1):
            row, below = best[i - a], best[i - a + 1]
            for j in range(m - 1, a - 1, -1):
                row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
        i = j = a
        while i < n and j < m:
            if x[i] == y[j] and best[i - a][j] == best[i - a + 1][j + 1] + 1:
                found.append((i, j))
                i, j = i + 1, j + 1
            elif best[i - a + 1][j] >= best[i - a][j + 1]:
                i += 1
            else:
                j += 1
        return found
    number: dict[str, int] = {}
    u, v = (np.array([number.setdefault(k, len(number)) for k in z[a:]]) for z in (x, y))
    half = len(u) // 2
    cut = int((_lengths(u[:half], v) + _lengths(u[half:][::-1], v[::-1])[::-1]).argmax())
    found += [(a + i, a + j) for i, j in common(x[a : a + half], y[a : a + cut], most)]
    return found + [(a + half + i, a + cut + j) for i, j in common(x[a + half :], y[a + cut :], most)]


def _lengths(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``u`` with each beginning of ``v``."""
    row = np.zeros(len(v) + 1, np.int64)
    for k in u:
        row[1:] = np.maximum(row[1:], row[:-1] + (v == k))
        np.maximum.accumulate(row, out=row)
    return row


def main_path(wrapper: Node) -> list[str]:
    """Keys from the root to the element that holds the article.

    Of all elements of like path the text of slots counts, constants being the template, unless
    all text is constant. An ``article`` wins, then ``main``, then one named like content, if it
    holds a quarter of the text; else the way goes down as long as one child holds most of it.
    """
    sizes: dict[tuple[str, ...], int] = {}
    order: list[tuple[str, ...]] = []

    def measure(node: Node, path: tuple[str, ...], slots: bool) -> int:
        if node.key == "#text":
            return node.chars if node.text is None or not slots else 0
        here = path if node.key[0] in "(#" else (*path, node.key)
        if here not in sizes:
            sizes[here] = 0
            order.append(here)
        n = sum(measure(k, here, slots) for k in node.kids)
        if here != path:
            sizes[here] += n
        return n

    total = measure(wrapper, (), True)
    if not total:
        sizes.clear()
        order.clear()
        total = measure(wrapper, (), False)
    if not total:
        return []
    for kind in (lambda k: _tag(k) == "article", lambda k: _tag(k) == "main", lambda k: bool(ARTICLE.intersection(_words(k.partition(".")[2])))):
        found = [p for p in order if p and kind(p[-1]) and not any(kind(k) for k in p[:-1]) and sizes[p] * 4 >= total]
        if found:
            return list(max(found, key=lambda p: sizes[p]))
    path: tuple[str, ...] = ()
    while True:
        kids = [p for p in order if len(p) == len(path) + 1 and p[: len(path)] == path]
        best = max(kids, key=lambda p: sizes[p], default=None)
        if best is None or _tag(best[-1]) in _INLINE | {"p"} or sizes[best] * 10 < 7 * max(sizes.get(path, total), 1):
            return list(path)
        path = best


def article_text(root: Node, path: list[str]) -> str | None:
    """The blocks below all elements of that path, in page order; None if the page has none."""
    found: list[Node] = []

    def seek(node: Node, depth: int) -> None:
        if depth == len(path):
            found.append(node)
            return
        for k in node.kids:
            if k.key == path[depth]:
                seek(k, depth + 1)

    seek(root, 0)
    if not found:
        return None
    blocks = [[]]

    def collect(node: Node) -> None:
        if node.key == "#text":
            blocks[-1].append(node.text)
            return
        if _tag(node.key) in _INLINE:
            for k in node.kids:
                collect(k)
        else:
            blocks.append([])
            for k in node.kids:
                collect(k)
            blocks.append([])

    for node in found:
        blocks.append([])
        collect(node)
    return " ".join(filter(None, (" ".join(html.unescape("".join(b)).split()) for b in blocks)))


def _host(pages: DataFrame, url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def infer_wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", most_hosts: int = 500) -> DataFrame:
    """(host, wrapper, expression, main): the wrapper of all pages of each host, as JSON and readable,
    and the path of its article.

    Each task aligns the pages it meets host by host, and one row leaves it for each host, so a
    host with a third of all pages is a row for each task where the wrappers are merged. Every page
    takes part. A task keeps ``most_hosts`` wrappers at a time at most.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}
        seen: dict[str, set[int]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(h, json.dumps(w.pack())) for h, w in known.items()]
            known.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["host", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                text = page.as_py() or ""
                if host in known and hash(text) in seen[host]:
                    continue  # the same page again changes nothing
                one = skeleton(parse(text))
                known[host] = merge(known[host], one) if host in known else one
                if len(seen.setdefault(host, set())) < 10_000:
                    seen[host].add(hash(text))
                if len(known) > most_hosts:
                    yield flush()
        if known:
            yield flush()

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        whole: Node | None = None
        for x in sorted(pdf["wrapper"]):
            one = Node.unpack(json.loads(x))
            whole = one if whole is None else merge(whole, one)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [json.dumps(whole.pack())], "expression": [str(whole)], "main": [json.dumps(main_path(whole))]})

    importable(pages.sparkSession)
    rows = in_tasks(pages.select(_host(pages, url_col).alias("host"), F.col(html_col).cast("string").alias("html")), partial, "host string, wrapper string")
    return rows.groupBy("host").applyInPandas(merged, "host string, wrapper string, expression string, main string")


def extract_text(pages: DataFrame, work: Workspace, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Wrappers of all hosts are inferred first and written. A page's text is what stands below its
    host's article path; a page without that path goes by a wrapper of its own. Menus, headers,
    footers, sidebars, notices, adverts, forms, scripts, styles and comments are left out by their
    elements and names, wherever they stand. Character references are decoded, white space inside
    a block is one space, blocks are joined by one space.

    Null and empty pages have no text. Pages without a URL share a wrapper. Broken markup never
    fails (see ``parse``). Repeated rows give repeated results; extra columns are left out; an
    empty table gives an empty result. Pages meet their host's path in a join whose right side
    is a short row for each host: Spark broadcasts it where it is small and else splits hot hosts.
    """
    hosts = work.stage(infer_wrappers(pages, url_col=url_col, html_col=html_col), "wrappers")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), _host(pages, url_col).alias("host"))
    joined = rows.join(hosts.select("host", "main"), "host", "left").drop("host")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: dict[str | None, list[str]] = {None: []}
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                out = []
                for page, main in zip(part.column("html"), part.column("main").to_pylist()):
                    if main not in paths:
                        paths[main] = json.loads(main)
                    root = parse(page.as_py() or "")
                    text = article_text(root, paths[main]) if paths[main] else None
                    out.append(article_text(root, main_path(skeleton(root))) or "" if text is None else text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

    return in_tasks(joined, texts, "page_id long, url string, text string, n_chars long")
