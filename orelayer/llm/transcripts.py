"""Roles of transcript turns by a hidden Markov model, and their canonical form."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelayer.llm.common import fold, importable, in_tasks
from orelayer.session import Workspace

ROLES = ("system", "user", "assistant", "tool")
UNKNOWN, BORDER = "?", "^"

#: How transcripts mark speakers, by role.
MARKERS = {
    "system": "system|instructions?|context|sys",
    "user": "user|human|question|q|customer|person|me|prompter|client",
    "assistant": "assistant|ai|bot|answer|a|agent|gpt|model|response|chatbot",
    "tool": "tool|function|observation|output|result",
}
_NAMES = "|".join(MARKERS.values())
#: A line that begins with a speaker: <|user|>, [USER], ### User:, **User:**, User: or user>
MARKER = rf"(?i)^\s*(?:<\|(?:im_start\|>)?\s*(?P<a>{_NAMES})\s*(?:\|>)?|\[(?P<b>{_NAMES})\]:?|#{{1,4}}\s*(?P<c>{_NAMES})\s*:?\s*$|\*\*(?P<d>{_NAMES})\s*:?\*\*:?|(?P<e>{_NAMES})\s*[:>])"
_MARKER = re.compile(MARKER)
_ROLE_OF = {name.rstrip("?"): i for i, role in enumerate(ROLES) for name in MARKERS[role].split("|")} | {"instructions": 0, "instruction": 0}

N_LENGTH, N_ENDS, N_LINES = 12, 4, 4
N_SYMBOLS = len(ROLES) + 1, N_LENGTH, N_ENDS, N_LINES


def split_turns(text: str) -> list[tuple[int, str]]:
    """(marker's role or -1, text) of each stretch of lines that a marker begins. Text before the
    first marker is a stretch without one; a text without markers is one stretch."""
    out: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        m = _MARKER.match(line)
        if m:
            out.append((_ROLE_OF[next(filter(None, m.groups())).lower()], [re.sub(r"^\s*(?:\|>|<\|im_sep\|>)?\s?", "", line[m.end() :])]))
        elif out:
            out[-1][1].append(line)
        else:
            out.append((-1, [line]))
    return [(role, re.sub(r"<\|im_end\|>\s*$", "", "\n".join(lines)).strip("\n")) for role, lines in out]


def observe(marker: int, text: str) -> tuple[int, int, int, int]:
    """What the model sees of a stretch: marker, length, ending, lines."""
    bare = text.rstrip()
    end = 0 if not bare else 1 if bare[-1] == "?" else 2 if bare[-1] in ".!" else 3
    return marker + 1, min(N_LENGTH - 1, len(text).bit_length()), end, min(N_LINES - 1, (text.count("\n") + 1).bit_length() - 1)


@dataclass
class RoleModel:
    """Logarithms of the start, the transitions, and each feature's values given the role."""

    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        """(stretches, roles). Length, ending and lines depend on each other and count half."""
        return self.emit[0][:, seen[:, 0]].T + 0.5 * sum(e[:, seen[:, k + 1]].T for k, e in enumerate(self.emit[1:]))


def fit_roles(turns: DataFrame) -> RoleModel:
    """A model counted from turns with known roles: (role, before, seen).

    All counts are sums over the table; a bounded number of them reaches the driver. Markers carry
    a strong prior, as transcripts with roles seldom have any; every count has a small one.
    """
    k = len(ROLES)
    marker = np.full((k, k + 1), 1.0)
    marker[np.arange(k), np.arange(k) + 1] = 200.0
    marker[:, 0] = 100.0
    emit = [marker, *(np.full((k, n), 0.5) for n in N_SYMBOLS[1:])]
    known = turns.where(F.array_contains(F.lit(list(ROLES)), F.col("role")))
    rows = known.select("role", F.posexplode("seen").alias("feature", "value")).groupBy("role", "feature", "value").count().collect()
    for role, feature, value, n in rows:
        emit[feature][ROLES.index(role), value] += n
    start, step = np.full(k, 0.5), np.full((k, k), 0.5)
    for before, role, n in known.groupBy("before", "role").agg(F.count("*")).collect():
        if before is None:
            start[ROLES.index(role)] += n
        elif before in ROLES:
            step[ROLES.index(before), ROLES.index(role)] += n
    log = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return RoleModel(log(start), log(step), [log(e) for e in emit])


def _runs(conv: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.append(True, conv[1:] != conv[:-1])) if len(conv) else np.zeros(0, int)
    return list(zip(cut.tolist(), [*cut[1:].tolist(), len(conv)]))


def _transfer(model: RoleModel, emit: np.ndarray, first: bool) -> np.ndarray:
    """Best log score from each role before the stretch to each role at its end; with ``first``,
    the stretch begins the conversation and all rows are equal."""
    row = np.tile(model.start, (len(ROLES), 1)) + emit[0] if first else model.step + emit[0]
    for e in emit[1:]:
        row = (row[:, :, None] + model.step[None]).max(1) + e
    return row


def _path(model: RoleModel, emit: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
    """Viterbi from the role before (None: the start) to the given last role (None: the best)."""
    n = len(emit)
    score = (model.start if before is None else model.step[before]) + emit[0]
    back = np.zeros((n, len(ROLES)), np.int8)
    for i in range(1, n):
        ways = score[:, None] + model.step
        back[i] = ways.argmax(0)
        score = ways.max(0) + emit[i]
    out = np.zeros(n, np.int64)
    out[-1] = score.argmax() if last is None else last
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def turn_rows(conversations: DataFrame, work: Workspace, *, chunk: int, conv_col: str, turn_col: str, role_col: str | None, text_col: str) -> DataFrame:
    """Stretches in the order of the whole table, written: (conv_id, turn, part, role, before, seen,
    text, chunk, place). A chunk is up to ``chunk`` stretches in a row; chunks have the order of the
    table. ``before`` is the role of the stretch before in the same conversation, null at its start
    and ``UNKNOWN`` if that one has none; what begins a task's part is ``BORDER``."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        (F.lower(F.col(role_col).cast("string")) if role_col else F.lit(None).cast("string")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("conv_id is not null")
    # the hash stands before role and text, so that rows of one turn number can be split over ranges
    # as well and have the same order however they are split
    order = ["conv_id", "turn", "mix", "role", "text"]
    ranged = rows.withColumn("mix", F.xxhash64("role", "text")).repartitionByRange("conv_id", "turn", "mix").sortWithinPartitions(*order)

    def work_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, last = TaskContext.get().partitionId(), 0, None
        names = ["conv_id", "turn", "part", "role", "before", "seen", "text", "chunk", "place"]
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                for k, (marker, said) in enumerate(split_turns(text)):
                    before = BORDER if last is None else None if last[0] != conv else last[1] or UNKNOWN
                    for col, x in zip(cols, (conv, turn, k, role, before, list(observe(marker, said)), said, (part << 32) + n // chunk, n)):
                        col.append(x)
                    n, last = n + 1, (conv, role)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    schema = "conv_id long, turn long, part int, role string, before string, seen array<int>, text string, chunk long, place long"
    return work.stage(in_tasks(ranged.select("conv_id", "turn", "role", "text"), work_, schema), "turns")


def with_neighbours(turns: DataFrame) -> DataFrame:
    """``turns`` with ``before`` known at the borders as well: it comes from the last row of the part
    before. One row for each part is looked at."""
    task = F.shiftright("chunk", 32)
    last = turns.groupBy(task.alias("task")).agg(F.max_by(F.struct("conv_id", F.coalesce("role", F.lit(UNKNOWN)).alias("role")), "place").alias("l"))
    last = last.select("task", F.lag("l").over(Window.orderBy("task")).alias("l")).select("task", F.col("l.conv_id").alias("last_conv"), F.col("l.role").alias("last_role"))
    border = F.col("before").eqNullSafe(BORDER)
    first = turns.where(border).withColumn("task", task).join(last, "task", "left")
    first = first.withColumn("before", F.when(F.col("last_conv") == F.col("conv_id"), F.col("last_role")))
    return turns.where(~border).unionByName(first.select(*turns.columns))


def recover_roles(conversations: DataFrame, work: Workspace, *, held_fold: int = 0, chunk: int = 2000, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str | None = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, part, held_out, role, given_role, text, rendered) for every stretch.

    A row is cut where a line begins with a speaker's mark; each stretch gets the role of the most
    probable path of its conversation. The model is counted from the rows of all conversations
    whose id's fold is not ``held_fold``; given roles teach it, but are never seen when roles are
    recovered. ``rendered`` is the canonical form: ``<|im_start|>role``, a new line, the text and
    ``<|im_end|>``; a stretch of the same role as the one before goes on in its turn after a new
    line, so the rows of a conversation, put together in order, are the whole transcript. Where a
    conversation goes over the border of a chunk, the turn is closed and one is begun anew.

    Long conversations never meet in one task. The table is dealt out in its order, in chunks of
    ``chunk`` stretches; for the part of a conversation in a chunk, a 4 x 4 table of best scores
    goes on, and only these are put together, one for each ``chunk`` stretches; then each chunk
    finds its own path between known ends.

    Null texts are empty stretches. Rows without a conversation id are left out, those without a
    turn come first. Equal turn numbers are ordered by a hash of role and text, and repeated rows are
    turns of their own. Roles depend neither on ``chunk`` nor on how the table is dealt to tasks. Without any known role the priors decide. An empty table gives an empty result;
    extra columns are left out.
    """
    importable(conversations.sparkSession)
    turns = turn_rows(conversations, work, chunk=chunk, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    held = fold(F.col("conv_id")) == held_fold
    model = fit_roles(with_neighbours(turns).where(~held))

    # 1: for each chunk, the best scores over the conversation that runs into it and out of it
    def transfers(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", ignore_index=True)
        emit = model.emissions(np.stack(pdf["seen"].to_numpy()))
        conv = pdf["conv_id"].to_numpy()
        runs = _runs(conv)
        out = []
        for a, b in {runs[0], runs[-1]}:
            out.append((int(conv[a]), int(pdf["chunk"].iat[0]), _transfer(model, emit[a:b], False).ravel().tolist(), _transfer(model, emit[a:b], True).ravel().tolist()))
        return pd.DataFrame(out, columns=["conv_id", "chunk", "on", "anew"])

    edges = turns.groupBy("chunk").applyInPandas(transfers, "conv_id long, chunk long, on array<double>, anew array<double>")

    # 2: for each conversation over several chunks, the roles at the borders
    def borders(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk", ignore_index=True)
        k, n = len(ROLES), len(pdf)
        if n == 1:
            return pd.DataFrame({"conv_id": pdf["conv_id"], "chunk": pdf["chunk"], "enter": [-1], "leave": [-1]})
        score = np.array(pdf["anew"].iat[0]).reshape(k, k)[0]
        back = []
        for x in pdf["on"].iloc[1:]:
            ways = score[:, None] + np.array(x).reshape(k, k)
            back.append(ways.argmax(0))
            score = ways.max(0)
        leave = [int(score.argmax())]
        for b in reversed(back):
            leave.append(int(b[leave[-1]]))
        leave.reverse()
        return pd.DataFrame({"conv_id": pdf["conv_id"], "chunk": pdf["chunk"], "enter": [-1, *leave[:-1]], "leave": leave})

    ends = work.stage(edges.groupBy("conv_id").applyInPandas(borders, "conv_id long, chunk long, enter int, leave int").where("leave >= 0"), "ends")

    # 3: each chunk's own paths between its ends
    def paths(rows: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c: [] for c in ("conv_id", "turn", "part", "role", "given_role", "text", "rendered")})
        rows = rows.sort_values("place", ignore_index=True)
        emit = model.emissions(np.stack(rows["seen"].to_numpy()))
        conv = rows["conv_id"].to_numpy()
        known = {c: (e, leave) for c, e, leave in zip(ends["conv_id"], ends["enter"], ends["leave"])}
        role, before, after = (np.full(len(rows), -1) for _ in range(3))
        for a, b in _runs(conv):
            enter, leave = known.get(conv[a], (-1, -1))
            role[a:b] = _path(model, emit[a:b], None if enter < 0 else int(enter), None if leave < 0 else int(leave))
            before[a:b] = np.append(enter, role[a : b - 1])
            after[a : b - 1] = role[a + 1 : b]
        # the last stretch of a chunk closes its turn itself; one that goes on beyond begins anew
        names = np.array(ROLES)[role]
        opened = (before != role) | np.append(True, np.zeros(len(rows) - 1, bool))
        closed = (after != role) | np.append(np.zeros(len(rows) - 1, bool), True)
        text = rows["text"]
        rendered = [f"<|im_start|>{r}\n{t}" if o else "\n" + t for r, t, o in zip(names, text, opened)]
        rendered = [x + "<|im_end|>\n" if c else x for x, c in zip(rendered, closed)]
        return pd.DataFrame({"conv_id": conv, "turn": rows["turn"].astype("Int64"), "part": rows["part"], "role": names, "given_role": rows["role"], "text": text, "rendered": rendered})

    schema = "conv_id long, turn long, part int, role string, given_role string, text string, rendered string"
    again = conversations.sparkSession.read.schema(turns.schema).parquet(work.path("turns"))
    out = again.groupBy("chunk").cogroup(ends.groupBy("chunk")).applyInPandas(paths, schema)
    return out.withColumn("held_out", held)

