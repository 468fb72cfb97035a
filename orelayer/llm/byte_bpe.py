"""Byte-level BPE by prefix dynamic programming, over the ranks of a public vocabulary."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelayer.llm.common import in_tasks


class PrefixEncoder:
    """Encodes byte strings as repeated merging of the lowest-ranked neighbours would.

    A token list is what merging gives if and only if each two neighbours are: merging their bytes
    alone gives just these two. So for each prefix of a text there is exactly one last token, the
    one that follows validly on the last token of what is left of it. ``last`` stores it for every
    prefix; reading it back from the end gives the tokens, an append only extends it, and an edit
    only voids it from there on.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(map(len, ranks))
        self.by_rank: dict[int, bytes] = {r: b for b, r in ranks.items()}
        self.most = max(self.by_rank) + 1
        self.finder = ahocorasick.Automaton()  # all tokens that end at a byte
        for b, r in ranks.items():
            self.finder.add_word(b.decode("latin-1"), (r, len(b)))
        self.finder.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Plain merging, the definition; only for short strings."""
        return [self.ranks[p] for p in self._merge(piece)[-1]]

    def _merge(self, piece: bytes) -> list[list[bytes]]:
        """The parts after each step of merging."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        steps = [parts]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 62:
                break
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
            steps.append(parts)
        return steps

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merging makes the token; () for a byte, None if no merging makes it."""
        if token not in self.halves:
            steps = self._merge(self.by_rank[token])
            whole = len(steps[-1]) == 1
            self.halves[token] = None if not whole else () if len(steps) == 1 else tuple(self.ranks[p] for p in steps[-2])
        return self.halves[token]

    def _follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just the two; with -1 to the left, whether merging
        makes the right one.

        Merging goes by rank. Undo it from the two tokens on, the higher rank first: what touches
        the border at each moment is the last part of the left and the first of the right token.
        If those had merged before the next undone merge, the two tokens would not have come about.
        """
        ok = self._halves(right) is not None
        a, b, before = left, right, 1 << 62
        while ok and left >= 0:
            joined = self.ranks.get(self.by_rank[a] + self.by_rank[b])
            if joined is not None and joined < before:
                ok = False
                break
            of_a, of_b = self._halves(a), self._halves(b)
            if of_a and (a > b or not of_b):
                # of equal ranks the leftmost merges first, so what reaches over the border waits for the left part
                before, a = a, of_a[1]
            elif of_b:
                before, b = b + 1, of_b[0]
            else:
                break
        if len(self.pairs) >= 1_000_000:  # bounded memory; answers are only recomputed
            self.pairs.clear()
        self.pairs[left * self.most + right] = ok
        return ok

    def extend(self, text: bytes, last: list[int]) -> list[int]:
        """Fill ``last`` up to the end of ``text``; what it holds already must belong to a prefix."""
        most, known, follows = self.most, self.pairs.get, self._follows
        for at, (token, size) in self.finder.iter(text.decode("latin-1"), max(0, len(last) + 1 - self.size)):
            if at == len(last):
                left = last[at - size] if at >= size else -1
                ok = known(left * most + token)
                if ok or ok is None and follows(left, token):
                    last.append(token)
        if len(last) < len(text):
            raise ValueError("the vocabulary lacks a byte of the text")
        return last

    def tokens(self, last: list[int]) -> list[int]:
        """The tokens of the text that ``last`` belongs to."""
        out, at = [], len(last)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= len(self.by_rank[token])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """A piece that is in the vocabulary is that token; else the dynamic programme decides."""
        token = self.ranks.get(piece)
        return [token] if token is not None else self.tokens(self.extend(piece, []))

    def append(self, text: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """The text with ``more`` behind it; the stored prefixes stay as they are."""
        return text + more, self.extend(text + more, list(last))

    def edit(self, text: bytes, last: list[int], at: int, gone: int, new: bytes) -> tuple[bytes, list[int]]:
        """The text with ``gone`` bytes at ``at`` replaced. Prefixes before the edit are kept. Behind
        it, the old last tokens are valid again as soon as they have been equal over the longest
        token's length."""
        after = text[:at] + new + text[at + gone :]
        out, shift, same = list(last[:at]), len(new) - gone, 0
        while len(out) < len(after):
            self.extend(after[: len(out) + 1], out)
            old = len(out) - 1 - shift
            same = same + 1 if len(out) > at + len(new) and last[old] == out[-1] else 0
            if same > self.size:
                out += last[old + 1 :]
        return after, out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.by_rank.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file with a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoder(path: str) -> PrefixEncoder:
    """One encoder for each Python worker and file."""
    return PrefixEncoder(read_ranks(path))


#: The classes of the vocabularies' patterns, for all of Unicode and for ASCII alone.
_UNICODE = ((r"\S", r"\P{White_Space}"), (r"[^\s", r"[^\p{White_Space}"), (r"\s", r"\p{White_Space}"))
_ASCII = ((r"\S", r"[^\t-\r ]"), (r"[^\s", r"[^\t-\r "), (r"\s", r"[\t-\r ]"), (r"[^\t-\r \p{L}\p{N}]", "[^\\t-\\r A-Za-z0-9]"), (r"\p{L}", "[A-Za-z]"), (r"\p{N}", "[0-9]"))


def _spelled(pattern: str, classes) -> str:
    for name, chars in classes:
        pattern = pattern.replace(name, chars)
    return pattern


class TextCoder:
    """Splits texts by a pattern and encodes each match; what a match gives is kept up to a bound."""

    def __init__(self, path: str, pattern: str, most: int = 600_000):
        self.split = regex.compile(_spelled(pattern, _UNICODE)).findall
        short = _spelled(pattern, _ASCII)
        # plain texts split faster by the classes' ASCII members, if the pattern has no other classes
        self.split_ascii = re.compile(short).findall if r"\p" not in short else self.split
        self.bpe, self.most = encoder(path), most
        # tokens of a match as their four-byte numbers: less to keep, and nothing for the collector to walk
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # given up as a whole, but for what is met again
        self.decimal = [str(r) for r in range(self.bpe.most)]

    def _learn(self, pieces: list[str]) -> None:
        if len(self.known) >= self.most // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        for piece in pieces:
            if piece not in known:
                known[piece] = older.get(piece) or array("i", self.bpe.encode(piece.encode())).tobytes()

    def ids(self, text: str) -> np.ndarray:
        """The token ids."""
        out = []
        # long texts by stretches of matches, so that what is kept never has to hold a whole text
        pieces = (self.split_ascii if text.isascii() else self.split)(text)
        for a in range(0, len(pieces), 100_000):
            some = pieces[a : a + 100_000]
            parts = list(map(self.known.get, some))
            if None in parts:
                self._learn(some)
                parts = map(self.known.__getitem__, some)
            out.append(b"".join(parts))
        return np.frombuffer(b"".join(out), np.int32)

    def encode(self, text: str) -> tuple[list[int], str]:
        """The token ids, and the same written in decimal with commas."""
        ids = self.ids(text).tolist()
        return ids, ",".join(map(self.decimal.__getitem__, ids))


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> TextCoder:
    return TextCoder(path, pattern)


def encode_texts(docs: DataFrame, path: str, pattern: str, *, ids_col: bool = True, check: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    Each match of ``pattern`` is encoded by itself, without special tokens. ``path`` is the
    vocabulary file, which every executor has at the same place. ``ids`` is left out unless
    ``ids_col``; with ``check`` the ids are decoded again and the bytes hashed.

    Null and empty texts have no token. Rows are independent: repeated rows and ids give equal
    results, extra columns are left out, an empty table gives an empty result. A worker keeps a
    bounded number of matches with their tokens, and works on one text at a time.
    """
    schema = "doc_id long" + ", ids array<int>" * ids_col + ", n_tokens long" + ", ids_sha256 string, decoded_sha256 string" * check

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids, n, one, two = [], [], [], []
                for text in part.column("text"):
                    got, spelled = c.encode(text.as_py() or "")
                    n.append(len(got))
                    if ids_col:
                        ids.append(np.array(got, np.int32))
                    if check:
                        one.append(hashlib.sha256(spelled.encode()).hexdigest())
                        two.append(hashlib.sha256(c.bpe.decode(got)).hexdigest())
                cols = {"doc_id": part.column("doc_id")} | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if ids_col else {}) | {"n_tokens": pa.array(n, pa.int64())}
                cols |= {"ids_sha256": pa.array(one, pa.string()), "decoded_sha256": pa.array(two, pa.string())} if check else {}
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return in_tasks(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, schema)
