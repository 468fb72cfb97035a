"""A trie of conversation prefixes: one double array for each prefix shard, shared nodes merged over all."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelayer.llm.common import in_tasks
from orelayer.session import Workspace

DIGEST = 16  # bytes that stand for a turn in a path
NO_ENDS = hashlib.sha256(b"").hexdigest()
FREE = -2


def turn_rows(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs (turn, digest, n_bytes).

    The digest is the MD5 of role and text, null read as empty, so no text is shuffled. Null turns
    come first; rows that share a turn follow each other by digest. Rows without a conversation's
    id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    row = F.struct(F.col(turn_col).cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), row.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def as_paths(rows: DataFrame, turns: Column) -> DataFrame:
    """(conv_id, path, sizes): the digests end to end, so that paths sort as their prefixes nest."""
    return rows.select(
        "conv_id", F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), "")).alias("path"), F.transform(turns, lambda t: t["n_bytes"]).alias("sizes")
    )


def forked(rows: DataFrame, *, group: int = 5, most: int = 8) -> DataFrame:
    """Conversations rebuilt as forks: the first h turns of conversation c - c % group, then the
    conversation's own turns after its first h, with h = crc32(c as text) % (most + 1)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    first = rows.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    both = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    return as_paths(both, F.concat(head, F.slice("turns", h + 1, F.size("turns"))))


class DoubleArray:
    """A trie over codes: the child of state s by code c is t = base[s] + c where check[t] is s.

    ``parent`` and ``code`` describe the nodes level by level, the root first, the children of a
    node side by side. Codes are dense. A base may be negative; state 0 is the root.
    """

    def __init__(self, parent: np.ndarray, code: np.ndarray):
        n = len(parent)
        self.base, self.check = [0], [-1]
        self.state = np.zeros(n, np.int64)
        edge = np.flatnonzero(np.diff(parent[1:], prepend=-1)) + 1 if n > 1 else np.empty(0, np.int64)
        stop, low = np.append(edge[1:], n), 1
        for a, b in zip(edge.tolist(), stop.tolist()):
            here, kids = int(self.state[parent[a]]), code[a:b]
            while low < len(self.check) and self.check[low] != FREE:
                low += 1
            at = self._place(low, kids)
            self.base[here] = at
            self.state[a:b] = at + kids
            for t in (at + kids).tolist():
                self.check[t] = here
        self.base, self.check = np.array(self.base), np.array(self.check)

    def _place(self, low: int, kids: np.ndarray, tries: int = 64) -> int:
        """A base at which all children find a free state; at the arrays' end there always is one."""
        check, size = self.check, len(self.check)
        first, rest = int(kids.min()), kids.tolist()
        at = low
        while tries and at < size:
            if check[at] == FREE:
                tries -= 1
                if all(at - first + c >= size or check[at - first + c] == FREE for c in rest):
                    break
            at += 1
        else:
            at = size
        grow = at - first + int(kids.max()) + 1 - size
        if grow > 0:
            check.extend([FREE] * grow)
            self.base.extend([0] * grow)
        return at - first

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states that follow; -1 where there is no such child."""
        t = self.base[states] + codes
        ok = (t > 0) & (t < len(self.check))
        ok[ok] = self.check[t[ok]] == states[ok]
        return np.where(ok, t, -1)


class Shard:
    """Sorted paths packed into a double array, and what a walk through it counts."""

    def __init__(self, ids: np.ndarray, paths: list[bytes], sizes: np.ndarray, path_no: int):
        self.ids, self.paths, self.path_no = ids, paths, path_no
        self.length = np.array([len(p) // DIGEST for p in paths], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        digests = np.frombuffer(b"".join(paths), dtype=f"V{DIGEST}")
        found, turn = np.unique(digests, return_inverse=True) if len(digests) else (digests, np.empty(0, np.int64))
        parent, where = self._nodes(turn)
        # dense ids by first use, level by level: the children of a node have codes near each other
        _, first = np.unique(turn[where], return_index=True)
        code = np.empty(len(found), np.int64)
        code[turn[where[np.sort(first)]]] = np.arange(len(found))
        self.codes = code[turn]
        self.trie = DoubleArray(parent, np.concatenate([[0], code[turn[where]]]))
        self._walk(sizes)

    def _nodes(self, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parents level by level, and the place in ``turn`` of each node's turn but the root's."""
        n = len(self.length)
        same = np.zeros(n, np.int64)  # turns that a path shares with the one before it
        alive, d = np.arange(1, n), 0
        while len(alive):
            alive = alive[np.minimum(self.length[alive], self.length[alive - 1]) > d]
            alive = alive[turn[self.start[alive] + d] == turn[self.start[alive - 1] + d]]
            same[alive] += 1
            d += 1
        above, depth, where, stack = [-1], [0], [-1], [0]
        for start, length, k in zip(self.start.tolist(), self.length.tolist(), same.tolist()):
            del stack[k + 1 :]
            for x in range(k, length):
                stack.append(len(above))
                above.append(stack[x])
                depth.append(x + 1)
                where.append(start + x)
        order = np.argsort(depth, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        parent = np.array(above, np.int64)[order]
        parent[1:] = place[parent[1:]]
        return parent, np.array(where, np.int64)[order][1:]

    def _walk(self, sizes: np.ndarray) -> None:
        """Follows every path through the arrays; what is counted is kept by state."""
        size = len(self.trie.check)
        self.n_convs, self.depth, self.text = (np.zeros(size, np.int64) for _ in range(3))
        self.least = np.full(size, np.iinfo(np.int64).max)
        self.border = np.zeros((2, size), bool)  # on the first path, on the last
        alive, state, d = np.arange(len(self.ids)), np.zeros(len(self.ids), np.int64), 0
        while True:
            self.n_convs += np.bincount(state[alive], minlength=size)
            np.minimum.at(self.least, state[alive], self.ids[alive])
            self.border[0, state[alive[alive == 0]]] = True
            self.border[1, state[alive[alive == len(self.ids) - 1]]] = True
            alive = alive[self.length[alive] > d]
            if not len(alive):
                break
            at = self.start[alive] + d
            state[alive] = self.trie.step(state[alive], self.codes[at])
            d += 1
            self.depth[state[alive]] = d
            self.text[state[alive]] = sizes[at]
        self.ends = state

    def rows(self) -> pa.RecordBatch:
        """A row for each node. What lies on the first or last path may go on in another shard: its
        sums are those of the nodes below it that don't."""
        check = self.trie.check
        nodes = np.flatnonzero(self.n_convs)
        shared = self.border.any(0)
        below = nodes[nodes > 0]
        n_children = np.bincount(check[below[~shared[below]]], minlength=len(check))
        every = np.bincount(check[below], minlength=len(check))
        leaves = np.where(shared | (every > 0), 0, 1)
        saved = np.where(shared, 0, (self.n_convs - 1) * self.text)
        levels = below[np.argsort(-self.depth[below], kind="stable")]
        for level in np.split(levels, np.flatnonzero(np.diff(self.depth[levels])) + 1):
            np.add.at(leaves, check[level], leaves[level])
            np.add.at(saved, check[level], saved[level])
        ends, first_end = self._ends(shared)
        keys = self._keys()
        parent = np.maximum(check[nodes], 0)
        part = shared[nodes]
        on = [[self.path_no + k for k in (0, 1) if self.border[k, s]] if p else None for s, p in zip(nodes.tolist(), part.tolist())]
        columns = {
            "part": pa.array(part),
            "key": pa.array([keys.get(s) for s in nodes.tolist()], pa.binary()),
            "parent_key": pa.array([keys.get(s) if s != t else None for s, t in zip(parent.tolist(), nodes.tolist())], pa.binary()),
            "conv_id": pa.array(self.least[nodes]),
            "depth": pa.array(self.depth[nodes]),
            "parent_conv_id": pa.array(self.least[parent], mask=shared[parent]),
            "n_convs": pa.array(self.n_convs[nodes]),
            "n_children": pa.array(np.where(part, n_children[nodes], every[nodes])),
            "n_leaves": pa.array(leaves[nodes]),
            "saved_tokens": pa.array(saved[nodes]),
            "text_bytes": pa.array(self.text[nodes]),
            "ends": pa.array([ends.get(s) for s in nodes.tolist()], pa.string()),
            "first_end": pa.array([first_end.get(s) for s in nodes.tolist()], pa.int64()),
            "paths": pa.array(on, pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_pydict(columns)

    def _ends(self, shared: np.ndarray) -> tuple[dict[int, str], dict[int, int]]:
        """By state: the digest of the ids that end there; for shared nodes the ids and the first one."""
        out, first = {}, {}
        cuts = np.flatnonzero(np.diff(self.ends)) + 1  # equal paths are side by side, ids ascending
        for ids, s in zip(np.split(self.ids, cuts), self.ends[np.concatenate([[0], cuts])].tolist()):
            text = ",".join(map(str, ids.tolist()))
            out[s] = text if shared[s] else hashlib.sha256(text.encode()).hexdigest()
            if shared[s]:
                first[s] = int(ids[0])
        return out, first

    def _keys(self) -> dict[int, bytes]:
        """A key for each node on the first and the last path, the same in every shard."""
        digest = hashlib.md5(b"")
        out = {0: digest.digest()}
        for i in {0, len(self.paths) - 1}:
            digest, state = hashlib.md5(b""), np.zeros(1, np.int64)
            for k in range(int(self.length[i])):
                state = self.trie.step(state, self.codes[self.start[i] + k : self.start[i] + k + 1])
                digest.update(self.paths[i][DIGEST * k : DIGEST * (k + 1)])
                out[int(state[0])] = digest.digest()
        return out


_ROWS = (
    "part boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, text_bytes long, ends string, first_end long, paths array<long>"
)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _packer(most_rows: int, most_turns: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, turns = [], 0

        def shard() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            sizes = rows.column("sizes").combine_chunks()
            sizes = sizes.flatten() if len(sizes) else pa.array([], pa.int64())
            return Shard(rows.column("conv_id").to_numpy(), rows.column("path").to_pylist(), sizes.to_numpy(zero_copy_only=False), number).rows()

        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                held.append(part)
                turns += len(part.column("sizes").flatten())
                if sum(x.num_rows for x in held) >= most_rows or turns >= most_turns:
                    yield shard()
                    held, turns, number = [], 0, number + 2
        if held:
            yield shard()

    return pack


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key from sorted pieces of ids; only the running digest is kept."""
    key, digest = None, None
    done = lambda: pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()])})
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k == key:
                digest.update(b",")
            else:
                if digest:
                    yield done()
                key, digest = k, hashlib.sha256()
            digest.update(ids.encode())
    if digest:
        yield done()


def prefix_nodes(paths: DataFrame, work: Workspace, *, shard_convs: int = 20_000, shard_turns: int = 1_000_000) -> DataFrame:
    """A row for each node of the trie of ``paths`` (conv_id, path, sizes), see ``as_paths``.

    Paths are dealt by range of (path, conv_id) and sorted, so a shard is a stretch of neighbours:
    a first turn or a whole conversation that a third of all share is spread over many shards, and
    only the nodes on a shard's first and last path can lie in another one too. Each shard packs
    its turns' dense ids into a double array and walks its paths through it. Nodes of one shard are
    complete there; the shared ones are added up globally, at most two paths of each shard.

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Every node's subtree includes itself. Paths
    without turns end at the root. No paths, no nodes. A path is one row: 24 bytes a turn; a shard
    holds at most about ``shard_turns`` turns, or the one path that is longer.
    """
    spark = paths.sparkSession
    rows = work.stage(paths, "paths")
    n = rows.count()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // shard_convs), min(wide, n // 2000))
    dealt = rows.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = work.stage(in_tasks(dealt, _packer(shard_convs, shard_turns), _ROWS), "nodes")
    merged = _merge(nodes.where("part"), work)
    none = F.lit(NO_ENDS)
    inner = nodes.where("not part").withColumn("ends_sha256", F.coalesce("ends", none))
    whole = inner.where("parent_key is null").select(*NODE)
    top = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    under = inner.where("parent_key is not null").drop("parent_conv_id").join(top, "parent_key").withColumnRenamed("above", "parent_conv_id")
    shared = merged.join(top, "parent_key", "left").withColumnRenamed("above", "parent_conv_id").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    return whole.union(under.select(*NODE)).union(shared.select(*NODE))


def _merge(parts: DataFrame, work: Workspace) -> DataFrame:
    """The shared nodes: sums over the shards, then over the shared nodes below each.

    Each is at home on one of the paths that hold it. What it counts itself is summed up along that
    path, so that every node above gets it once; no node is paired with all that are above it.
    """
    total = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("text_bytes").alias("text_bytes"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.min(F.array_min("paths")).alias("home"),
    )
    total = work.stage(total, "shared")
    kids = total.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    total = total.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    total = total.withColumn("own_leaf", (F.col("n_children") == 0).cast("long")).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("text_bytes"))
    total = work.stage(total, "owned")
    on = parts.select("key", F.explode("paths").alias("path")).join(total.select("key", "depth", "home", "own_leaf", "own_saved"), "key")
    up = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = lambda c: F.sum(F.when(F.col("home") == F.col("path"), F.col(c)).otherwise(0)).over(up)
    sums = on.select("key", below("own_leaf").alias("leaf"), below("own_saved").alias("saved")).groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    pieces = parts.where("ends is not null").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    digests = in_tasks(pieces.select("key", "ends"), _digest_ends, "key binary, ends_sha256 string")
    out = total.join(sums, "key").join(digests, "key", "left")
    out = out.withColumn("n_leaves", F.col("n_leaves") + F.col("leaf")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("saved"))
    return work.stage(out.select("key", "parent_key", *[c for c in NODE if c != "parent_conv_id"]), "merged")
