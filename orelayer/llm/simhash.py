"""SimHash near-duplicates, with candidates filtered by chains of segments around a ring."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import TO_LOWER, components, importable, in_tasks, text_bytes, word_limits
from orelayer.session import Workspace

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)  # byte -> its bits, high first
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every run of ``width`` words joined by one space, A-Z in lower case, and
    the limits of each row's hashes. A row of fewer words has one hash, of all its words; a row
    without words has none."""
    data = TO_LOWER[data]
    starts, ends, first = word_limits(data, offsets)
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    inside = np.cumsum(step, dtype=np.int8) > 0
    keep = inside.copy()
    keep[ends] = True  # one byte after each word for the space; where rows meet there is none
    place = np.cumsum(keep) - 1
    lines = np.where(inside, np.append(data, 32), 32).astype(np.uint8)[keep].tobytes()
    begin, stop = place[starts], place[ends - 1] + 1
    words = np.diff(first)
    count = np.where(words == 0, 0, np.maximum(words - width + 1, 1))
    limits = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(words)), count)
    at = np.arange(limits[-1]) - limits[row] + first[:-1][row]
    last = np.minimum(at + width, first[1:][row]) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(begin[at].tolist(), stop[last].tolist())
    return np.fromiter((digest(lines[a:b], 42) for a, b in spans), np.uint64, limits[-1]), limits


def majority(hashes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For each row 64 bits, each set if it is set in over half of the row's hashes; no hash: zero."""
    n = len(limits) - 1
    out = np.zeros(n, np.uint64)
    raw = np.ascontiguousarray(hashes.astype(">u8")).view(np.uint8).reshape(-1, 8)
    shift, power = np.arange(8) * 256, (np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64))
    for i in range(n):
        a, b = limits[i], limits[i + 1]
        if a == b:
            continue
        seen = np.zeros(2048, np.int64)
        for k in range(a, b, 1 << 16):  # long rows by pieces, so that memory stays even
            seen += np.bincount((raw[k : min(b, k + (1 << 16))] + shift).ravel(), minlength=2048)
        bits = (seen.reshape(8, 256) @ _BITS).ravel()
        out[i] = (power[2 * bits > b - a]).sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, *, width: int, extra: int = 0, distinct: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, n_shingles) and with ``extra`` also ``more``, further independent fingerprints of
    the same shingles. Shingles count as often as they occur; ``n_shingles`` are the different ones
    with ``distinct``."""
    schema = "id long, fp long, n_shingles long" + (", more array<long>" if extra else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                hashes, limits = shingle_hashes(*text_bytes(part.column("text")), width)
                n = np.array([len(np.unique(hashes[a:b])) for a, b in zip(limits[:-1], limits[1:])], np.int64) if distinct else np.diff(limits)
                cols = [part.column("id"), pa.array(majority(hashes, limits).view(np.int64)), pa.array(n)]
                names = ["id", "fp", "n_shingles"]
                if extra:
                    rows = []
                    for k in range(extra):
                        h = hashes ^ (hashes >> np.uint64(29 + k))
                        h = h * np.uint64(_MIX[k])
                        rows.append(majority(h ^ (h >> np.uint64(32)), limits).view(np.int64))
                    cols.append(pa.array(list(np.stack(rows, 1)), pa.list_(pa.int64())))
                    names.append("more")
                yield pa.RecordBatch.from_arrays(cols, names)

    return in_tasks(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), work, schema)


def _pieces(batch: pa.RecordBatch, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text, a row at least."""
    _, offsets = text_bytes(batch.column("text"))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


@dataclass(frozen=True)
class Ring:
    """``max_bits + 1`` segments of a 64-bit fingerprint, in a ring.

    If two fingerprints differ in at most ``max_bits`` bits, some start exists from which every
    chain of 1, 2, 3 ... consecutive segments differs in no more than its share, chain length
    times max_bits / segments. The first segment of that chain is then equal: it is the key.
    """

    max_bits: int

    @property
    def segments(self) -> int:
        return self.max_bits + 1

    def masks(self) -> list[list[int]]:
        """For each start, the masks of the chains of 1, 2 ... segments; the last is all 64 bits."""
        cuts = [64 * i // self.segments for i in range(self.segments + 1)]
        each = [((1 << (b - a)) - 1) << (64 - b) for a, b in zip(cuts, cuts[1:])]
        out = []
        for s in range(self.segments):
            mask, chain = 0, []
            for k in range(self.segments):
                mask |= each[(s + k) % self.segments]
                chain.append(mask)
            out.append(chain)
        return out

    def budget(self, chain: int) -> int:
        return chain * self.max_bits // self.segments

    def signed(self) -> list[list[int]]:
        return [[m - (1 << 64) if m >> 63 else m for m in chain] for chain in self.masks()]

    def viable(self, a: Column, b: Column, start: Column) -> Column:
        """Whether every chain from ``start`` keeps its budget; the last chain is the full check."""
        masks, ok = self.signed(), F.lit(True)
        for k in range(1, self.segments):
            mask = F.get(F.lit([m[k] for m in masks]), start)
            ok = ok & (F.bit_count(a.bitwiseXOR(b).bitwiseAND(mask)) <= self.budget(k + 1))
        return ok


def _forest(fp: np.ndarray, chain: list[int], ring: Ring, fits, left: int) -> list[tuple[int, int]]:
    """Links that join all that is linked among the rows: at most one for each row.

    Rows before ``left`` are one block and the rest another; two blocks are compared with each
    other only, a single block (``left`` of 0) with itself.
    """
    n = len(fp)
    root = np.arange(n)
    out = []
    masks = [np.uint64(m) for m in chain]
    most = left or n
    step = max(1, (1 << 16) // max(n, 1))  # rows that are held against all others at once
    for base in range(0, most, step):
        at = left or base + 1
        diff = fp[base : min(base + step, most), None] ^ fp[None, at:]
        a, b = np.nonzero(np.bitwise_count(diff & masks[min(1, len(masks) - 1)]) <= ring.budget(min(2, len(masks))))
        a, b, diff = a + base, b + at, diff[a, b]
        if not left:
            a, b, diff = a[b > a], b[b > a], diff[b > a]
        for k in range(2, len(masks)):  # chains from the key's segment, the shortest first
            if not len(a):
                break
            ok = np.bitwise_count(diff & masks[k]) <= ring.budget(k + 1)
            a, b, diff = a[ok], b[ok], diff[ok]
        cuts = np.flatnonzero(np.diff(a, prepend=-1))
        for i, j in zip(a[cuts].tolist(), np.split(b, cuts[1:])):
            j = j[root[j] != root[i]]
            if len(j) and fits is not None:
                j = j[fits(i, j)]
            if not len(j):
                continue
            _, pick = np.unique(root[j], return_index=True)  # one link for each group that joins
            for x in j[pick]:
                out.append((i, int(x)))
                root[root == root[x]] = root[i]
    return out


def near_links(reps: DataFrame, work: Workspace, *, max_bits: int, small: int = 64, block: int = 2048, confirm_bits: int | None = None, size_ratio: float | None = None) -> DataFrame:
    """Links (a, b) that join all ids whose fingerprints differ in at most ``max_bits`` bits.

    ``reps``: (id, fp), one row for each fingerprint. Each row goes to one bucket for each start of
    the ring. Buckets of at most ``small`` rows are joined with themselves, chain by chain. In
    larger ones, rows are dealt over blocks of about ``block`` rows; each pair of blocks is one
    task's work and returns a spanning forest, so neither a task nor the output holds all pairs.
    No link between groups is lost: what a forest leaves out is joined by what it holds.

    With ``size_ratio`` linked rows must also have ``n`` within that ratio: rows of like size share
    a band and go to their own and the next. With ``confirm_bits`` the ``more`` fingerprints
    together with ``fp`` may differ in that many bits at most.
    """
    ring = Ring(max_bits)
    masks = ring.signed()
    key = lambda t: F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(masks[t][0])))
    extra = (["n"] if size_ratio else []) + (["more"] if confirm_bits else [])
    rows = reps.select("id", "fp", *extra, F.posexplode(F.array(*[key(t) for t in range(ring.segments)])).alias("start", "key"))
    if size_ratio:
        band = F.floor(F.log(F.greatest("n", F.lit(1))) / F.log(F.lit(1 / size_ratio)) + F.lit(1e-9))
        rows = rows.withColumn("band", F.explode(F.array(band, band + 1))).withColumn("key", F.xxhash64("key", "band")).drop("band")
    buckets = work.stage(rows, "buckets")
    counts = buckets.groupBy("start", "key").agg(F.count("*").alias("rows")).where("rows > 1")
    counts = work.stage(counts.withColumn("blocks", F.when(F.col("rows") > small, F.ceil(F.col("rows") / block)).cast("int")), "counts")
    near = buckets.join(counts.where("blocks is null").select("start", "key"), ["start", "key"])
    near = work.stage(near, "small")
    a, b = near.alias("a"), near.alias("b")
    cond = (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id"))
    cond = cond & ring.viable(F.col("a.fp"), F.col("b.fp"), F.col("a.start"))
    if size_ratio:
        cond = cond & (F.least("a.n", "b.n") >= size_ratio * F.greatest("a.n", "b.n"))
    if confirm_bits:
        total = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
        for k in range(3):
            total = total + F.bit_count(F.get("a.more", F.lit(k)).bitwiseXOR(F.get("b.more", F.lit(k))))
        cond = cond & (total <= confirm_bits)
    pairs = a.join(b, cond).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))

    large = buckets.join(counts.where("blocks is not null"), ["start", "key"])
    # a block meets itself once and every other one once: (own, other) with the smaller number first
    mine = F.pmod(F.xxhash64("fp", "id"), F.col("blocks")).cast("int")
    large = large.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select(
        "id", "fp", *extra, "start", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine"
    )
    all_masks = ring.masks()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mine", "id"], ignore_index=True)
        left = 0 if pdf["lo"].iat[0] == pdf["hi"].iat[0] else int((pdf["mine"] == pdf["lo"].iat[0]).sum())
        fp, ids = pdf["fp"].to_numpy().view(np.uint64), pdf["id"].to_numpy()
        size = pdf["n"].to_numpy() if size_ratio else None
        more = np.stack(pdf["more"].to_numpy()).astype(np.int64).view(np.uint64) if confirm_bits else None

        def fits(i, j):
            ok = np.ones(len(j), bool)
            if size is not None:
                ok &= np.minimum(size[i], size[j]) >= size_ratio * np.maximum(size[i], size[j])
            if more is not None:
                ok &= np.bitwise_count(fp[i] ^ fp[j]) + np.bitwise_count(more[i] ^ more[j]).sum(1) <= confirm_bits
            return ok

        if left == len(pdf) or (left == 0 and pdf["lo"].iat[0] != pdf["hi"].iat[0]):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        found = _forest(fp, all_masks[pdf["start"].iat[0]], ring, fits if extra else None, left)
        x = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ids[x[:, 0]], "b": ids[x[:, 1]]})

    importable(reps.sparkSession)
    forests = large.groupBy("start", "key", "lo", "hi").applyInPandas(compare, "a long, b long")
    return pairs.union(forests).distinct()


def near_groups(docs: DataFrame, work: Workspace, *, width: int = 3, max_bits: int = 3, confirm_bits: int | None = None, size_ratio: float | None = None, verify: Callable[[DataFrame], DataFrame] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Words lie between ASCII white space, A-Z in lower case; shingles have ``width`` words, repeats
    included; fewer words make one shingle of all; a text without words, empty or null, has
    fingerprint zero and is linked like any other. Fingerprints that differ in at most
    ``max_bits`` bits are linked (see ``near_links`` for the further conditions), and
    ``component_id`` is the smallest id reachable over links, the row's own included. With
    ``verify`` these links are candidates only: it gets them, written, as (a, b) and returns those that
    hold. ``size_ratio`` compares the numbers of different shingles.

    Equal fingerprints are one node, so copies cost a row each and no pair. Repeated rows give
    repeated results. A row without an id has a fingerprint, no component, and links nothing. An
    empty table gives an empty result. Fingerprints are written once, to the shared folder.
    """
    extra = 3 if confirm_bits else 0
    prints = work.stage(fingerprints(docs, width=width, extra=extra, distinct=bool(size_ratio), id_col=id_col, text_col=text_col), "prints")
    node = ["fp", *(["n_shingles"] if size_ratio else []), *(["more"] if extra else [])]
    reps = prints.where("id is not null").groupBy(*node).agg(F.min("id").alias("id"))
    reps = work.stage(reps.withColumnRenamed("n_shingles", "n") if size_ratio else reps, "reps")
    links = near_links(reps, work, max_bits=max_bits, confirm_bits=confirm_bits, size_ratio=size_ratio)
    if verify is not None:
        links = verify(work.stage(links, "candidate-links"))
    found = components(links, work)
    named = reps.withColumnRenamed("n", "n_shingles") if size_ratio else reps
    named = named.join(found, "id", "left").select(*node, F.coalesce("component", "id").alias("component_id"))
    named = work.stage(named, "named")
    out = prints.join(named, node, "left")
    return out.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
