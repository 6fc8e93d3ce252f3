"""Conversations put in order by the cheapest edits: roles ``(s?(ua)+)?``, no blank, repeated or cut-off turn for free.

Each row is kept (0), gets another role (1) or is deleted (2; blank and repeated rows must be); empty turns are inserted
for 5 each, anywhere; a row whose text is cut off costs 5 more unless it is deleted. Of the cheapest edits those with
the ASCII-least initials (D, I, K, R) are taken.

A conversation in order is a walk over four states (nothing yet, after the system, the user, the assistant turn).
Going backwards, the cost to go from every state before a row follows from the costs behind it. The least
initials come from walking forward over tight edits, which needs those costs in the other direction. Not
all are stored: a checkpoint is kept after blocks of 1, 2, 3, ... rows from the end, some sqrt(2 n) of n, which needs no n
beforehand; the walk recomputes one block at a time from the checkpoint behind it. So a conversation needs memory in
the order of the root of its length, besides its own output.

In Spark, rows are sorted by conversation and order and read as a stream. Conversations of more than ``in_memory``
rows get their checkpoints from a first stream in descending order, which carries no texts; they are merged into the
second stream in front of the rows. Shorter ones are held by the second stream and need no first. What a row repeats is found
by a grouping, not in the stream. A digest runs over its conversation in order, so one conversation is read by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.functions.skew import lookup, rows_by_membership
from veriframe.llm.common import col

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
IN_MEMORY = 1024

START, SYSTEM, USER, ANSWERED = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ANSWERED, (ANSWERED, "u"): USER}
#: The state after the one role that an inserted turn, or a row given another role, can have; and that role.
OWN = (USER, USER, ANSWERED, USER)
OWN_ROLE = ("user", "user", "assistant", "user")
LEGAL_PAIRS = {"su", "ua", "au"}
NEVER = 1 << 60

Costs = tuple[int, int, int, int]
Code = tuple[str, bool, bool]  # initial of the role; must go; is cut off


def _with_inserts(start: int, system: int, user: int, answered: int) -> Costs:
    """Costs to go when turns may be inserted first; two inserts in a row only lead back."""
    u = min(user, INSERT + answered)
    return min(start, INSERT + u), min(system, INSERT + u), u, min(answered, INSERT + user)


TERMINAL = _with_inserts(0, NEVER, NEVER, 0)


def costs_before(code: Code, behind: Costs) -> Costs:
    """Cost to go from each state before a row, given those behind it."""
    initial, must_go, cut = code
    gone = [DELETE + c for c in behind]
    if not must_go:
        more = CUT_OFF if cut else 0
        for state in range(4):
            kept = NEXT.get((state, initial))
            if kept is not None:
                gone[state] = min(gone[state], more + behind[kept])
            gone[state] = min(gone[state], more + REROLE + behind[OWN[state]])
    return _with_inserts(*gone)


class Checkpoints:
    """Cost vectors kept while the rows are read from the last to the first: (rows behind, costs)."""

    def __init__(self):
        self.n, self.costs, self.kept = 0, TERMINAL, [(0, TERMINAL)]
        self._size = self._left = 1

    def read(self, code: Code) -> tuple[int, Costs] | None:
        """Take the row in front; returns the checkpoint if this is the place of one."""
        self.n, self.costs = self.n + 1, costs_before(code, self.costs)
        self._left -= 1
        if self._left:
            return None
        self._size += 1
        self._left = self._size
        self.kept.append((self.n, self.costs))
        return self.kept[-1]


def walk(block: list[Code], behind: Costs, state: int) -> tuple[list[tuple[str, int, str]], int]:
    """The ASCII-least tight edits of a block, given the costs behind it and the state before it.

    Returns (initial, index of the row or -1, role given or "") per edit, and the state reached.
    """
    costs = [behind]
    for code in reversed(block):
        costs.append(costs_before(code, costs[-1]))
    costs.reverse()
    edits = []
    for i, (initial, must_go, cut) in enumerate(block):
        here, after = costs[i], costs[i + 1]
        while True:
            to_go = here[state]
            if to_go == DELETE + after[state]:
                edits.append(("D", i, ""))
                break
            if to_go == INSERT + here[OWN[state]]:
                edits.append(("I", -1, OWN_ROLE[state]))
                state = OWN[state]
                continue
            more = CUT_OFF if cut else 0
            kept = NEXT.get((state, initial))
            if kept is not None and to_go == more + after[kept]:
                edits.append(("K", i, ""))
                state = kept
            else:
                edits.append(("R", i, OWN_ROLE[state]))
                state = OWN[state]
            break
    return edits, state


def closing(state: int) -> Iterator[str]:
    """Roles of the turns to insert behind the last row."""
    while TERMINAL[state]:
        yield OWN_ROLE[state]
        state = OWN[state]


class Edit(NamedTuple):
    initial: str
    role: str | None  # None: deleted
    text: str


class Conversation:
    """Faults and edits of one conversation whose rows are added in order."""

    def __init__(self, key: object, value: object):
        self.key, self.value = key, value
        self.kept: list[tuple[int, Costs]] = []
        self.n: int | None = None
        self.cost = TERMINAL[START]
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.lowest = self.highest = None
        self._state, self._walked = START, 0
        self._block: list[tuple[Code, str, str]] = []
        self._before: tuple | None = None

    def checkpoint(self, behind: int, costs: Costs) -> None:
        """Checkpoints come before the rows, that of the most rows last: it stands before the first row."""
        self.kept.append((behind, costs))
        self.n, self.cost = behind, costs[START]

    def add(self, turn: int | None, role: str, text: str, digest: str, repeats: bool, blank: bool, cut: bool) -> Iterator[Edit]:
        repeats = repeats or (turn, role, digest) == self._before
        self.blank += blank
        self.duplicate += repeats and not blank
        self.truncated += cut and not blank and not repeats
        if self._block or self._walked:
            self.illegal += self._initial + role[:1] not in LEGAL_PAIRS
        self._initial = role[:1]
        if turn is not None:
            self.distinct += turn != self.highest
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
        self._before = (turn, role, digest)
        self._block.append(((role[:1], blank or repeats, cut), role, text))
        if self.n is not None and len(self._block) == self._wanted():
            yield from self._walk()

    def _wanted(self) -> int:
        """Rows up to the next checkpoint."""
        left = self.n - self._walked
        while self.kept[-1][0] >= left:
            self.kept.pop()
        return left - self.kept[-1][0]

    def _walk(self) -> Iterator[Edit]:
        rows = self._wanted()
        block, self._block = self._block[:rows], self._block[rows:]
        edits, self._state = walk([code for code, _, _ in block], self.kept[-1][1], self._state)
        self._walked += rows
        for initial, i, role in edits:
            if initial == "D":
                yield Edit("D", None, "")
            elif initial == "I":
                yield Edit("I", role, "")
            else:
                yield Edit(initial, role or block[i][1], block[i][2])

    def end(self) -> Iterator[Edit]:
        """What is left to edit once all rows are there."""
        if self.n is None:
            checkpoints = Checkpoints()
            for code, _, _ in reversed(self._block):
                checkpoints.read(code)
            self.kept, self.n, self.cost = checkpoints.kept, checkpoints.n, checkpoints.costs[START]
        while self._block:
            yield from self._walk()
        for role in closing(self._state):
            yield Edit("I", role, "")

    @property
    def gaps(self) -> int:
        return 0 if self.lowest is None else self.highest - self.lowest + 1 - self.distinct


def turns(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """The columns the repair reads, with the faults that a row shows by itself; null roles and texts are one space.

    Where ``present`` is false there is no such row, but its conversation is reported.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(" "))
    role = F.coalesce(col(role_col).cast("string"), F.lit(" "))
    body = F.rtrim(text, F.lit(BLANKS))
    name = col(id_col).cast("string")
    return df.select(
        col(id_col).alias("_id"), F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("_g"),
        (F.lit(True) if present is None else present).alias("_present"), col(turn_col).cast("bigint").alias("_turn"),
        role.alias("_role"), text.alias("_text"), F.sha2(F.concat(role, F.lit("\n"), text), 256).alias("_h"),
        (body == "").alias("_blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("_cut"),
    )


def _earlier(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_repeats``: whether an earlier turn of the conversation has the same role and text."""
    place = F.struct(F.col("_turn").isNotNull(), F.col("_turn"))
    groups = rows.filter("_present").groupBy("_g", "_h").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    joined = lookup(rows, ["_g", "_h"], groups.filter("_n > 1").drop("_n"), ["_g", "_h"])
    return joined.withColumn("_repeats", F.coalesce(place > F.col("_first"), F.lit(False))).drop("_first")


_ORDER = ["_turn", "_role", "_h"]


def _checkpointed(rows: DataFrame, in_memory: int) -> DataFrame:
    """Checkpoints of the conversations of more than ``in_memory`` rows: ``_id``, ``_g``, ``_behind``, ``_costs``."""
    there = rows.filter("_present")
    long = there.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > in_memory).select("_g")
    narrow = there.select("_id", "_g", "_turn", F.substring("_role", 1, 1).alias("_initial"), "_role", "_h", "_repeats", "_blank", "_cut")
    dealt = rows_by_membership(narrow, ["_g"], long, ["_g"], present=True).repartition("_g")
    ordered = dealt.sortWithinPartitions("_g", F.desc_nulls_last("_turn"), F.desc("_role"), F.desc("_h"))
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "_g", "_behind", "_costs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state: Checkpoints | None = None
        waiting: tuple | None = None  # a row is read once it is known whether the one in front of it is the same

        def read(repeats: bool) -> None:
            found = state.read((waiting[3], waiting[6] or repeats or waiting[7], waiting[8]))
            if found:
                out.append((waiting[0], waiting[1], *found))
                state.kept.clear()

        def finish() -> None:
            if waiting is not None:
                read(False)
                if not out or out[-1][1:3] != (waiting[1], state.n):
                    out.append((waiting[0], waiting[1], state.n, state.costs))

        ids = None
        for batch in batches:
            ids = batch.column(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if waiting is None or row[1] != waiting[1]:
                    finish()
                    state = Checkpoints()
                    out.append((row[0], row[1], 0, TERMINAL))
                else:
                    read((row[2], row[4], row[5]) == (waiting[2], waiting[4], waiting[5]))
                waiting = row
            yield _batch(out, names, [ids, pa.string(), pa.int64(), pa.list_(pa.int64())])
            out.clear()
        finish()
        if out:
            yield _batch(out, names, [ids, pa.string(), pa.int64(), pa.list_(pa.int64())])

    return ordered.mapInArrow(run, f"_id {kind}, _g string, _behind bigint, _costs array<bigint>")


def _batch(rows: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


def _stream(rows: DataFrame, in_memory: int) -> DataFrame:
    """Checkpoints and rows of all conversations, dealt by conversation and in order."""
    known = _earlier(rows)
    marks = _checkpointed(known, in_memory).withColumn("_kind", F.lit(0))
    both = known.withColumn("_kind", F.when(F.col("_present"), 2).otherwise(1)).unionByName(marks, allowMissingColumns=True)
    names = ["_id", "_g", "_kind", "_turn", "_role", "_text", "_h", "_repeats", "_blank", "_cut", "_behind", "_costs"]
    # Only conversations in which every row is dropped need the dropped rows; they carry no text.
    slim = both.select(*[F.when(F.col("_kind") != 1, F.col(c)).alias(c) if c in ("_role", "_text", "_h") else F.col(c) for c in names])
    return slim.repartition("_g").sortWithinPartitions("_g", "_kind", "_behind", *_ORDER)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation | None, Edit | None]]:
    """Edits of one conversation after the other: (conversation, edit), (conversation, None) at its end.

    (None, None) stands for the end of a batch.
    """
    now: Conversation | None = None
    for batch in batches:
        for key, g, kind, turn, role, text, digest, repeats, blank, cut, behind, costs in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or g != now.key:
                if now is not None:
                    for edit in now.end():
                        yield now, edit
                    yield now, None
                now = Conversation(g, key)
            if kind == 0:
                now.checkpoint(behind, tuple(costs))
            elif kind == 2:
                for edit in now.add(turn, role, text, digest, repeats, blank, cut):
                    yield now, edit
        yield None, None
    if now is not None:
        for edit in now.end():
            yield now, edit
        yield now, None


def repaired(rows: DataFrame, id_col: str = "conv_id", in_memory: int = IN_MEMORY) -> DataFrame:
    """The repaired conversations of ``rows`` (see :func:`turns`): the id, ``position`` from 0, ``edit``, ``role``, ``text``.

    Deleted rows are left out. Rows as in :func:`audit`.
    """
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "position", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        ids, position = None, 0

        def watched(source):
            nonlocal ids
            for batch in source:
                ids = batch.column(0).type
                yield batch

        def flush() -> pa.RecordBatch:
            made = _batch(out, names, [ids, pa.int64(), pa.string(), pa.string(), pa.string()])
            out.clear()
            return made

        for conversation, edit in _conversations(watched(batches)):
            if conversation is None:
                yield flush()
            elif edit is None:
                position = 0
            elif edit.role is not None:
                out.append((conversation.value, position, edit.initial, edit.role, edit.text))
                position += 1
        if out:
            yield flush()

    fields = f"_id {kind}, position bigint, edit string, role string, text string"
    return _stream(rows, in_memory).mapInArrow(run, fields).withColumnRenamed("_id", id_col)


def audit(rows: DataFrame, id_col: str = "conv_id", in_memory: int = IN_MEMORY) -> DataFrame:
    """Per conversation of ``rows`` (see :func:`turns`): its faults, the cost and initials of its edits, and a digest of the result.

    ``gaps`` counts turn numbers missing between the lowest and the highest; ``blank``, ``duplicate`` and ``truncated`` count rows by their
    first fault; ``illegal`` counts neighbouring roles other than su, ua and au; ``repaired_sha256`` hashes ``role:text`` per repaired
    turn, joined by newlines.

    Rows come by turn (nulls first, and not counted in gaps; a turn that is no number counts as null); ties by role, then by a digest of
    role and text, so equal rows stand together. Null ids form one conversation. A role that starts with none of s, u and a cannot
    be kept. A conversation without rows has zeros, no edits and the digest of an empty string; no conversations give none.
    Other columns are not read.
    """
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        ids = None

        def watched(source):
            nonlocal ids
            for batch in source:
                ids = batch.column(0).type
                yield batch

        def flush() -> pa.RecordBatch:
            made = _batch(out, names, [ids, *[pa.int64()] * 6, pa.string(), pa.string()])
            out.clear()
            return made

        initials, digest, turned = [], hashlib.sha256(), False
        for c, edit in _conversations(watched(batches)):
            if c is None:
                yield flush()
            elif edit is None:
                out.append((c.value, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.cost, "".join(initials), digest.hexdigest()))
                initials, digest, turned = [], hashlib.sha256(), False
            else:
                initials.append(edit.initial)
                if edit.role is not None:
                    digest.update(f"{chr(10) if turned else ''}{edit.role}:{edit.text}".encode())
                    turned = True
        if out:
            yield flush()

    fields = f"_id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:7]) + ", audit string, repaired_sha256 string"
    return _stream(rows, in_memory).mapInArrow(run, fields).withColumnRenamed("_id", id_col)


def damaged(df: DataFrame) -> DataFrame:
    """:func:`turns` of ``conversations`` with faults drawn by a checksum of conversation and turn."""
    key = [F.coalesce(col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    drawn = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    role, text = (F.coalesce(col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    copies = F.when(F.col("drawn") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), drawn.alias("drawn"))
    hurt = rows.select(
        "conv_id", "turn", "drawn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies),
    )
    return turns(hurt, present=F.col("drawn") != 0)
