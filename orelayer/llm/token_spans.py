"""Token counts of a document's sections, from one encoding of the whole document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelayer.llm.byte_bpe import coder
from orelayer.llm.common import in_tasks

RULES = ("most", "first", "share")


def _byte_limits(text: str, raw: bytes, places: np.ndarray) -> np.ndarray:
    """Byte positions of code point positions."""
    if len(text) == len(raw):
        return places
    begins = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.append(begins, len(raw))[places]


def allocate(lengths: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section, and last those outside of all, from the tokens' byte lengths and the
    sections' disjoint, ordered byte limits.

    A token that lies in one section counts there, though it may reach over its limits into space
    between sections; one that touches no section counts as outside. One that touches several is
    allocated by ``rule``: ``most``, to the section that holds most of its bytes, the earlier of
    equals; ``first``, to the earliest; ``share``, to each by its bytes, all shares adding up to 1.
    """
    n = len(starts)
    if not n:
        return np.array([float(len(lengths))])
    real = np.flatnonzero(stops > starts)
    if len(real) < n:  # empty sections touch nothing
        out = np.zeros(n + 1)
        out[np.append(real, n)] = allocate(lengths, starts[real], stops[real], rule)
        return out
    ends = np.cumsum(lengths)
    begins = ends - lengths
    # only the sections' limits are searched for among the tokens; the tokens' own places follow by counting
    upto = lambda at: np.cumsum(np.bincount(at, minlength=len(lengths) + 1))[: len(lengths)]
    low = upto(np.searchsorted(begins, stops))  # first section that ends behind the token's start
    high = upto(np.searchsorted(ends, starts, "right")) - 1  # last one that begins before the token's end
    out = np.bincount(np.where(low > high, n, low)[low >= high], minlength=n + 1).astype(float)
    for t in np.flatnonzero(low < high):
        k = np.arange(low[t], high[t] + 1)
        part = np.minimum(stops[k], ends[t]) - np.maximum(starts[k], begins[t])
        part = np.maximum(part, 0)
        if not part.any():
            out[n] += 1
        elif rule == "share":
            out[k] += part / part.sum()
        else:
            out[k[np.argmax(part) if rule == "most" else np.flatnonzero(part)[0]]] += 1
    return out


def section_tokens(docs: DataFrame, path: str, pattern: str, *, rule: str = "most", id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None) -> DataFrame:
    """(doc_id, section, start, stop, n_tokens) for every section of every document.

    Each whole text is encoded once by the vocabulary at ``path``; the token offsets are joined
    with the sections by their positions, and tokens over a border are allocated by ``rule`` (see
    ``allocate``). ``spans_col`` names an array of (section, start, stop) in code points; without
    it the lines are the sections. Spans are cut to the text and taken in order of their starts;
    where two overlap, the later one begins where the earlier ends. What lies in no section makes a
    row with a null section, so the rows of a document add up to its tokens.

    Null and empty texts have no token and, by lines, one empty section. Null spans are none. Rows
    are independent: repeated rows give repeated results. Extra columns are left out; an empty
    table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    number = "double" if rule == "share" else "long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        length_of = np.zeros(max(c.bpe.by_rank) + 1, np.int64)
        for r, b in c.bpe.by_rank.items():
            length_of[r] = len(b)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids, names, begin, stop, count = [], [], [], [], []
                spans = part.column("spans").to_pylist() if spans_col else [None] * part.num_rows
                for doc, text, given in zip(part.column("doc_id").to_pylist(), part.column("text"), spans):
                    text = text.as_py() or ""
                    raw = text.encode()
                    lengths = length_of[c.ids(text)]
                    if spans_col:
                        given = sorted((g for g in given or () if g and g["start"] is not None and g["stop"] is not None), key=lambda g: (g["start"], g["stop"]))
                        label = [g["section"] for g in given]
                        a = np.clip(np.array([g["start"] for g in given], np.int64), 0, len(text))
                        b = np.clip(np.array([g["stop"] for g in given], np.int64), a, len(text))
                        if len(a):
                            reach = np.maximum.accumulate(b)
                            a[1:] = np.maximum(a[1:], reach[:-1])
                            b = np.maximum(a, b)
                        x, y = _byte_limits(text, raw, a), _byte_limits(text, raw, b)
                    else:
                        cut = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
                        x, y = np.append(0, cut + 1), np.append(cut, len(raw))
                        label = list(map(str, range(len(x))))
                        if len(text) == len(raw):
                            a, b = x, y
                        else:
                            before = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
                            a, b = before[x], before[y]
                    got = allocate(lengths, x, y, rule)
                    keep = len(x) + bool(got[-1])
                    ids += [doc] * keep
                    names += [*label, None][:keep] if keep > len(x) else label
                    begin += [*a.tolist(), None][:keep]
                    stop += [*b.tolist(), None][:keep]
                    count += got[:keep].tolist()
                n = pa.array(count, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(begin, pa.int64()), pa.array(stop, pa.int64()), n if rule == "share" else n.cast(pa.int64())],
                    ["doc_id", "section", "start", "stop", "n_tokens"],
                )

    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    cols += [F.col(spans_col).alias("spans")] if spans_col else []
    return in_tasks(docs.select(*cols), work, f"doc_id long, section string, start long, stop long, n_tokens {number}")
