"""MinHash fingerprints of documents, and groups of documents whose shingle sets are alike."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelayer.llm.common import ODD, TO_LOWER, WordHash, components, in_tasks, powers, text_bytes, word_limits
from orelayer.session import Workspace

HASHES, BANDS, BAND_ROWS = 128, 21, 6
CHUNK = 1 << 20  # characters of text that are worked on at once
U64 = np.uint64


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """a and b of x -> a * x + b modulo 2**64, a odd: each is a permutation of 64-bit numbers."""
    state, out = 0x5DEECE66D, []
    for _ in range(2 * HASHES):
        state = (state * 0x5851F42D4C957F2D + 0x14057B7EF767814F) % (1 << 64)
        out.append((state ^ (state >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64))
    pairs = np.array(out, U64).reshape(-1, 2)
    return pairs[:, 0] | U64(1), pairs[:, 1]


A, B = _permutations()


def _mix(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(by)
    return h ^ (h >> U64(31))


def shingles(column, width: int, hasher: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every run of ``width`` words, A-Z in lower case, and the limits of each row.
    A row of fewer words has one shingle, of all its words; a row without words has none."""
    data, offsets = text_bytes(column)
    data = TO_LOWER[data]
    starts, ends, first = word_limits(data, offsets)
    words = hasher(data, starts, ends)
    n = np.diff(first)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    limits = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(limits[-1]) - limits[row] + first[:-1][row]
    last = first[1:][row]
    out = np.zeros(limits[-1], U64)
    for k, factor in enumerate(powers(ODD, width)):
        inside = at + k < last
        out[inside] += (words[at[inside] + k] + U64(1)) * factor
    return _mix(out, 0x94D049BB133111EB), limits


def minima(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The least value of each stretch under each permutation, its upper 32 bits; all ones if empty."""
    out = np.full((len(limits) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(limits))
    if not len(full):
        return out
    starts, moved = limits[full], np.empty_like(values)
    for k in range(HASHES):
        np.multiply(values, A[k], out=moved)
        np.add(moved, B[k], out=moved)
        out[full, k] = np.minimum.reduceat(moved, starts) >> U64(32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of fingerprints of one byte a permutation. Unequal minima share
    a byte once in 256 times, which is taken off."""
    share = (a == b).mean(-1)
    return np.clip((share - 1 / 256) / (1 - 1 / 256), 0, 1)


def bands(least: np.ndarray) -> np.ndarray:
    """A key for each band of ``BAND_ROWS`` minima, another one in each band."""
    out = np.empty((len(least), BANDS), U64)
    for k in range(BANDS):
        h = np.full(len(least), k + 1, U64)
        for x in least[:, k * BAND_ROWS : (k + 1) * BAND_ROWS].T:
            h = _mix(h * U64(ODD) + x.astype(U64), 0xD6E8FEB86659FD93)
        out[:, k] = h
    return out.view(np.int64)


def distinct(values: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch sorted, without repeats."""
    values = values.copy()
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[limits[:-1][limits[:-1] < limits[1:]]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[limits]


def set_keys(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """128 bits that stand for each stretch as a set."""
    out = np.zeros((len(limits) - 1, 2), U64)
    full = np.flatnonzero(np.diff(limits))
    if len(full):
        for k, by in enumerate((0xBF58476D1CE4E5B9, 0xD6E8FEB86659FD93)):
            out[full, k] = np.add.reduceat(_mix(values, by), limits[full])
    return out.view(np.int64)


def edited_text(text: str, after: str) -> str:
    """The last quarter of the code points replaced by the first as many of ``after``."""
    q = len(text) // 4
    return text[: len(text) - q] + after[:q]


_PRINT = (
    "id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, "
    "bands array<long>, n_shingles long, s1 long, s2 long"
)
_SORTED = f"kind int, part int, key long, text string, {_PRINT}"


def _texts(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())


def _prints(ids: list, texts: list[str], after: list[str], width: int, hasher: WordHash) -> dict[str, pa.Array]:
    """All columns of ``_PRINT`` for documents and the texts that come after them."""
    place: dict[int, int] = {}  # a text that follows one document and is another's own counts once
    every: list[str] = []
    for t in (*texts, *after):
        if id(t) not in place:
            place[id(t)] = len(every)
            every.append(t)
    edited = [edited_text(t, x) for t, x in zip(texts, after)]
    own, own_at = shingles(_texts(every), width, hasher)
    new, new_at = shingles(_texts(edited), width, hasher)
    at = np.array([place[id(t)] for t in texts], np.int64)
    same = np.zeros(len(every), np.int64)  # leading shingles that the edited text shares
    for r, d in enumerate(at.tolist()):
        a, b = own_at[d], new_at[r]
        m = min(own_at[d + 1] - a, new_at[r + 1] - b)
        differ = own[a : a + m] != new[b : b + m]
        same[d] = differ.argmax() if differ.any() else m
    cuts = np.stack([own_at[:-1], own_at[:-1] + same], 1).ravel()
    tails = [new[b + s : c] for b, s, c in zip(new_at[:-1], same[at], new_at[1:])]
    ends = len(own) + np.concatenate([[0], np.cumsum([len(x) for x in tails])]).astype(np.int64)
    least = minima(np.concatenate([own, *tails]), np.concatenate([cuts, ends]))
    head, rest, tail = least[0 : 2 * len(every) : 2], least[1 : 2 * len(every) : 2], least[2 * len(every) :]
    whole = np.minimum(head, rest)
    mine, prints = whole[at], whole.astype(np.uint8)
    changed = np.minimum(head[at], tail).astype(np.uint8)
    values, limits = distinct(own, own_at)
    keys = set_keys(values, limits)[at]
    raw = lambda x: pa.array([y.tobytes() for y in x], pa.binary())
    return {
        "id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).digest() for t in edited], pa.binary()),
        "fingerprint": raw(prints[at]), "edited_fingerprint": raw(changed),
        "near_edited": pa.array(likeness(prints[at], changed)), "near_next": pa.array(likeness(prints[at], prints[[place[id(t)] for t in after]])),
        "bands": pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(at) + 1, BANDS), pa.int32()), pa.array(bands(mine).ravel())),
        "n_shingles": pa.array(np.diff(limits)[at]), "s1": pa.array(keys[:, 0]), "s2": pa.array(keys[:, 1]),
    }


def _typed(schema: str, n: int, columns: dict) -> pa.RecordBatch:
    """A batch of ``n`` rows with all columns of a schema, null where none is given."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.large_string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names = [c.strip().split(" ") for c in schema.split(",")]
    return pa.RecordBatch.from_pydict({c: columns[c] if c in columns else pa.nulls(n, kinds[t]) for c, t in names})


DONE, WAITS, FOLLOWS = 0, 1, 2


def _pass_over(width: int, chunk: int):
    """Over documents sorted by id: each is done once the next id has come. What still waits at a
    partition's end is passed on with its text, as are the texts that may follow such a one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part = WordHash(), TaskContext.get().partitionId()
        ready, ready_size = [], 0  # (id, text, next text)
        held, held_size = [], 0  # (id, text) of the last key so far
        key, changes, flushed = None, 0, False

        def tell(kind: int, rows: list[tuple]) -> pa.RecordBatch:
            columns = {"kind": [kind], "part": [part], "key": [key]}
            typed = {c: pa.array(v * len(rows), t) for (c, v), t in zip(columns.items(), (pa.int32(), pa.int32(), pa.int64()))}
            return _typed(_SORTED, len(rows), typed | {"id": pa.array([r[0] for r in rows], pa.int64()), "text": _texts([r[1] for r in rows])})

        def done() -> pa.RecordBatch:
            columns = _prints(*(list(x) for x in zip(*ready)), width, hasher)
            return _typed(_SORTED, len(ready), columns | {"kind": pa.array([DONE] * len(ready), pa.int32())})

        for batch in batches:
            for k, i, text in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "text"))):
                if k != key:
                    for j, t in held:
                        ready.append((j, t, text))
                    ready_size, held, held_size, key = ready_size + held_size, [], 0, k
                    if changes < 2 or flushed:
                        yield tell(FOLLOWS, [(i, text)])
                    changes, flushed = changes + 1, False
                held.append((i, text))
                held_size += len(text) + 100
                if ready_size >= chunk:
                    yield done()
                    ready, ready_size = [], 0
                if held_size >= chunk and len(held) > 1:  # an id with very many rows
                    yield tell(WAITS, held)
                    held, held_size, flushed = [], 0, True
        if ready:
            yield done()
        if held:
            yield tell(WAITS, held)

    return work


def fingerprints(docs: DataFrame, work: Workspace, *, width: int = 5, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """A row for each row of ``docs``, see ``_PRINT``: the fingerprint of its text and of its edited
    text, of which the last quarter gives way to the beginning of the next document.

    A fingerprint has one byte of the least value under each of ``HASHES`` universal hash
    permutations over the text's shingles of ``width`` words. Texts with equal words have equal
    fingerprints; without words it is all ones.

    Documents follow each other by ascending id; a row without an id comes before all, and the
    first follows the last. Rows that share an id all have the same next document; among the rows of
    that one, the smallest XXH64 of the text stands for it. Null is an empty text. An empty table
    gives an empty result.

    The texts are shuffled once, by range of (id, text hash, row), so that an id that very many rows
    share is spread too. A partition's last id needs the first of a later one: those rows are passed
    on, two or three for each partition, and worked on after.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = plain.withColumn("key", F.coalesce("id", F.lit(-(1 << 63)))).withColumn("h", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(parts, "key", "h", "spread").sortWithinPartitions("key", "h").select("key", "id", "text")
    with _freed(spark):
        found = work.stage(in_tasks(dealt, _pass_over(width, chunk), _SORTED), "sorted")
    names = [c.strip().split(" ")[0] for c in _PRINT.split(",")]
    waits = found.where(F.col("kind") == WAITS).select("key", "id", "text")
    first = found.where(F.col("kind") == FOLLOWS).groupBy("key").agg(F.min_by("text", "part").alias("after"))
    first = work.stage(first, "followers")
    # at most two rows for each partition, and one for each id of very many rows
    keys = first.select("key", F.lit(True).alias("real")).union(waits.select("key", F.lit(False)).distinct())
    real, order = F.min(F.when(F.col("real"), F.col("key"))), Window.orderBy("key")
    later, least = real.over(order.rangeBetween(1, Window.unboundedFollowing)), real.over(order.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    keys = keys.select("key", "real", F.coalesce(later, least).alias("follower")).where("not real").select("key", "follower")
    joined = waits.join(keys, "key").join(first.withColumnRenamed("key", "follower"), "follower").select("id", "text", "after")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash()
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("id", "text", "after"))))
            while rows:
                n, size = 0, 0
                while n < len(rows) and (n == 0 or size < chunk):
                    size += len(rows[n][1]) + len(rows[n][2])
                    n += 1
                yield _typed(_PRINT, n, _prints(*(list(x) for x in zip(*rows[:n])), width, hasher))
                rows = rows[n:]

    late = work.stage(in_tasks(joined, rest, _PRINT), "late")
    return found.where(F.col("kind") == DONE).select(*names).union(late.select(*names))


class _freed:
    """Shuffle files go when the query that made them ends: what is staged here isn't run again."""

    NAME = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(self.NAME, "false")
        self.conf.set(self.NAME, "true")

    def __exit__(self, *exc):
        self.conf.set(self.NAME, self.before)


def in_runs(df: DataFrame, by: list[str], then: list[str], work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """Each group of rows with equal ``by``, sorted by ``then``, as one table for ``work``; groups are
    read one after another in each task, so many small ones cost little."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in by)))
            a = 0
            while a < len(keys):
                b = a + 1
                while b < len(keys) and keys[b] == keys[a]:
                    b += 1
                if keys[a] != key and held:
                    yield from made(held)
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
                a = b
        if held:
            yield from made(held)

    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = work(pa.Table.from_batches(held).combine_chunks())
        if out is not None and out.num_rows:
            yield from out.to_batches()

    return in_tasks(df.repartition(*by).sortWithinPartitions(*by, *then), stream, schema)


def forest(n: int, left: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Links that join all that is linked among ``n`` rows, fewer than rows. ``linked(i, others)`` says
    which others row i is linked with. Rows before ``left`` are only compared with those after it."""
    root, a, b = np.arange(n), [], []
    for i in range(left or n):
        j = np.arange(max(left, i + 1), n)
        j = j[root[j] != root[i]]
        j = j[linked(i, j)] if len(j) else j
        if len(j):
            _, pick = np.unique(root[j], return_index=True)
            for x in j[pick].tolist():
                a.append(i)
                b.append(x)
                root[root == root[x]] = root[i]
    return a, b


def _links(ids: np.ndarray, a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})


def _left(rows: pa.Table) -> int | None:
    """How many rows are of the lower block, 0 where there is one block only; None if one is missing."""
    lo, hi = rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
    n = int((rows.column("mine").to_numpy() == lo).sum())
    return 0 if lo == hi else n if 0 < n < rows.num_rows else None


def _in_blocks(df: DataFrame, rows: str, block: int) -> DataFrame:
    """Every group in blocks of about ``block`` rows, each pair of blocks (lo, hi) together once."""
    blocks = F.greatest(F.ceil(F.col(rows) / block), F.lit(1)).cast("int")
    df = df.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("blocks", "other", rows)


def shares_in_common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sorted sets without repeats have in common."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    keep = count[at] > 1
    row, at = row[keep], place[at[keep]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out, width = np.zeros((n, n)), 4096
    for a in range(0, int(at[-1]) + 1 if len(at) else 0, width):  # products of 0 and 1, a stretch of values at a time
        lo, hi = np.searchsorted(at, [a, a + width])
        held = np.zeros((n, width), np.float32)
        held[row[lo:hi], at[lo:hi] - a] = 1
        out += held @ held.T
    return out


def exact_links(close: DataFrame, docs: DataFrame, work: Workspace, *, width: int = 5, threshold: float = 0.8, block: int = 512, few: int = 1_000_000, sets: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Links (a, b) that join all documents whose shingle sets have a Jaccard similarity of
    ``threshold`` or more, among those that the candidate links ``close`` (a, b) join.

    Only texts that take part are read into sets, and each set goes to the blocks of its own group.
    An id that several texts share is linked as any of them is; with ``sets`` (id, s1) only the
    named ones count.
    """
    groups = components(close, work, "candidates")
    groups = work.stage(groups.union(groups.select(F.col("component").alias("id"), "component").distinct()), "groups")
    sized = groups.join(groups.groupBy("component").agg(F.count("*").alias("rows")), "component")
    wanted = work.stage(_in_blocks(sized, "rows", block), "wanted")
    ids = groups.select("id")
    ids = F.broadcast(ids) if ids.count() <= few else ids  # 8 bytes a row
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(ids, "id", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash()
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                values, limits = distinct(*shingles(part.column("text"), width, hasher))
                keys = set_keys(values, limits)
                raw = [values[x:y].tobytes() for x, y in zip(limits[:-1].tolist(), limits[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(keys[:, 0]), pa.array(raw, pa.binary())], ["id", "s1", "values"])

    found = in_tasks(texts, read, "id long, s1 long, values binary")
    found = found if sets is None else found.join(sets, ["id", "s1"], "left_semi")
    found = work.stage(found.groupBy("id", "s1").agg(F.first("values").alias("values")), "sets")

    def exact(rows: pa.Table) -> pa.Table | None:
        left = _left(rows)
        if left is None:
            return None
        held = [np.frombuffer(x, U64) for x in rows.column("values").to_pylist()]
        size, common = np.array([len(x) for x in held]), shares_in_common(held)
        linked = lambda i, j: (common[i, j] > 0) & (common[i, j] >= threshold * (size[i] + size[j] - common[i, j]) - 1e-9)
        return _links(rows.column("id").to_numpy(), *forest(len(held), left, linked))

    paired = wanted.join(found.select("id", "values"), "id")
    links = in_runs(paired, ["component", "lo", "hi"], ["mine", "id"], exact, "a long, b long")
    return work.stage(links.where("a != b").distinct(), "links")


def alike(prints: DataFrame, docs: DataFrame, work: Workspace, *, width: int = 5, threshold: float = 0.8, block: int = 512, few: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(s1, s2, component_id) for every shingle set in ``prints`` (see ``fingerprints``, of ``docs``):
    the smallest id that is reached over links of Jaccard similarity ``threshold`` or more.

    1. Documents with the same set are one node. Nodes are dealt to buckets by the keys of ``BANDS``
       bands; 0.998 of the pairs at 0.8 meet in one at least.
    2. In a bucket the fingerprints are compared: pairs whose estimate is no more than 3.4 standard
       errors below the threshold (0.9997 of those at it) are joined to candidate groups.
    3. In a candidate group all pairs are compared exactly, by their shingle sets.

    Buckets and groups of any size are worked on in pairs of blocks of ``block`` rows, which return
    spanning forests: no task holds a whole group, none returns all its pairs. Texts without words
    are one node, linked with no other. Rows without an id are no nodes.
    """
    least = threshold - 3.4 * (threshold * (1 - threshold) / HASHES) ** 0.5
    named = prints.where("id is not null and n_shingles > 0")
    nodes = named.groupBy("s1", "s2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("fingerprint").alias("fp"))
    with _freed(prints.sparkSession):
        nodes = work.stage(nodes, "nodes")
        keys = nodes.select("id", F.explode("bands").alias("key"))
        shared = work.stage(keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "shared-keys")
        met = work.stage(keys.join(shared, "key"), "met")
        met = work.stage(_in_blocks(met, "rows", block).join(nodes.select("id", "fp"), "id"), "met-prints")

        def near(rows: pa.Table) -> pa.Table | None:
            left = _left(rows)
            if left is None:
                return None
            fp = np.stack([np.frombuffer(x, np.uint8) for x in rows.column("fp").to_pylist()])
            return _links(rows.column("id").to_numpy(), *forest(len(fp), left, lambda i, j: likeness(fp[i], fp[j]) >= least))

        close = work.stage(in_runs(met, ["key", "lo", "hi"], ["mine", "id"], near, "a long, b long").distinct(), "close")
        links = exact_links(close, docs, work, width=width, threshold=threshold, block=block, few=few, sets=nodes.select("id", "s1"), id_col=id_col, text_col=text_col)
        found = components(links, work)
        empty = prints.where("id is not null and n_shingles = 0").groupBy("s1", "s2").agg(F.min("id").alias("component_id"))
        out = nodes.select("s1", "s2", "id").join(found, "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component_id"))
        return work.stage(out.union(empty), "alike")


def document_prints(docs: DataFrame, work: Workspace, *, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``fingerprints`` with the ``component_id`` that ``alike`` finds; null for a row without an id."""
    prints = fingerprints(docs, work, width=width, id_col=id_col, text_col=text_col)
    groups = alike(prints, docs, work, width=width, threshold=threshold, id_col=id_col, text_col=text_col)
    out = prints.drop("bands").join(groups, ["s1", "s2"], "left")
    return out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
