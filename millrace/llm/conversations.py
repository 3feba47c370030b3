"""Repair of the structure of conversations by secondary-sorted streaming.

Rows are dealt by conversation and sorted by turn within a task, which then reads them as a stream: a
conversation may be far larger than memory or than an Arrow batch. A dynamic program runs along the rows. Its
four states are what a legal conversation can have come to (nothing, a system turn, a user's turn, an assistant's), and for
each it carries the least cost and the order of the cheapest edits so far. Two lists of edits of
the same rows are never each other's beginning, as each ends with an edit of the last row, so their order decides
ties once and for all and the lists themselves need not be held. What one row does to the four states
depends on little; such steps are remembered.

Each row leaves four bytes of backpointers and its text in files that stay in memory while small and
spill to unnamed files of the task when a conversation is giant. At its end the backpointers are followed once
backward, and the texts are read once more.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
#: What keeping a truncated row costs besides.
TRUNCATED = 3
#: Bytes of a conversation's texts, and of its backpointers, held in memory; rows of backpointers read at a time.
HELD, BLOCK = 8 << 20, 1 << 16
#: Rows of a frame that a task gives out, at most.
FRAME = 4096

SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
TURNS = "conv_id long, position long, edit string, role string, text string"

# States: nothing yet, a system turn, a user's turn, an assistant's turn.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER_INSERT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: b"user", _ASSISTANT: b"assistant"}
_EDITS = "DKR"
_NONE = 0xFF
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
_LENGTHS = struct.Struct("<II")


def _kept(state: int, initial: str) -> int | None:
    """The state after a row of that role is kept; None where it cannot be."""
    if initial == "s":
        return _SYSTEM if state == _EMPTY else None
    if initial == "u":
        return _USER if state != _USER else None
    return _ASSISTANT if initial == "a" and state == _USER else None


class Steps(dict):
    """``(states, row kind) -> (states, cost, backpointers)``, found as they are met.

    ``states`` has for each state the cost above the least one (None: not reachable) and the place of its
    edits in order. A row kind is the role's initial, whether the row must go, and whether it is truncated. A backpointer
    holds the state before, how many rows were inserted before the edit, and the edit.
    """

    START = ((0, 0), None, None, None)

    def __missing__(self, key: tuple) -> tuple:
        states, (initial, must_go, truncated) = key
        best: list[tuple | None] = [None] * 4
        for before, value in enumerate(states):
            if value is None:
                continue
            state = before
            for inserts in range(3):
                cost = value[0] + inserts * INSERT
                extra = TRUNCATED if truncated else 0
                ways = [(state, DELETE, "D")]
                if not must_go:
                    ways += [(_kept(state, initial), KEEP + extra, "K"), (_AFTER_INSERT[state], REROLE + extra, "R")]
                for after, price, edit in ways:
                    if after is None:
                        continue
                    found = (cost + price, value[1], "I" * inserts + edit, before)
                    if best[after] is None or found < best[after]:
                        best[after] = found
                state = _AFTER_INSERT[state]
        least = min(b[0] for b in best if b)
        order = sorted(b[1:3] for b in best if b)
        after = tuple((b[0] - least, order.index(b[1:3])) if b else None for b in best)
        pointers = bytes(b[3] | (len(b[2]) - 1) << 2 | _EDITS.index(b[2][-1]) << 4 if b else _NONE for b in best)
        self[key] = found = (after, least, pointers)
        return found


class Conversation:
    """One conversation's rows in order, then its counts, its cheapest edits and its repaired turns."""

    def __init__(self, steps: Steps):
        self.steps = steps
        self.states, self.cost, self.rows = Steps.START, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.distinct = 0
        self.before: str | None = None
        self.pointers, self.texts = SpooledTemporaryFile(HELD), SpooledTemporaryFile(HELD)

    def add(self, turn: int | None, role: bytes, text: bytes, again: bool) -> None:
        initial = role[:1].decode("latin-1")
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        end = text.rstrip(_BLANKS)
        blank = not end
        again = again and not blank
        cut = not blank and not again and end[-1:] not in (b".", b"!", b"?")
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        kind = (initial if initial in ("s", "u", "a") else "", blank or again, cut)
        self.states, cost, pointers = self.steps[self.states, kind]
        self.cost += cost
        self.rows += 1
        self.pointers.write(pointers)
        self.texts.write(_LENGTHS.pack(len(role), len(text)))
        self.texts.write(role)
        self.texts.write(text)

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.distinct

    def edits(self) -> bytes:
        """The cheapest edits; their cost is then whole."""
        closing = {_EMPTY: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}
        ends = [(v[0] + INSERT * len(closing[s]), v[1], s) for s, v in enumerate(self.states) if v]
        extra, _, state = min(ends)
        self.cost += extra
        out = bytearray(closing[state].encode())
        for low in range((self.rows - 1) // BLOCK * BLOCK, -1, -BLOCK) if self.rows else ():
            self.pointers.seek(4 * low)
            block = self.pointers.read(4 * min(BLOCK, self.rows - low))
            for k in range(len(block) - 4, -4, -4):
                pointer = block[k + state]
                out += _EDITS[pointer >> 4].encode()
                out += b"I" * (pointer >> 2 & 3)
                state = pointer & 3
        return bytes(out[::-1])

    def turns(self, edits: bytes) -> Iterator[tuple[str, bytes, bytes]]:
        """``edit, role, text`` of the repaired turns."""
        self.texts.seek(0)
        state = _EMPTY
        for edit in edits.decode():
            role = text = b""
            if edit != "I":
                sizes = _LENGTHS.unpack(self.texts.read(_LENGTHS.size))
                role, text = (self.texts.read(n) for n in sizes)
            if edit == "D":
                continue
            if edit == "K":
                state = _kept(state, role[:1].decode("latin-1"))
            else:
                state = _AFTER_INSERT[state]
                role = _NAMES[state]
            yield edit, role, text

    def close(self) -> None:
        self.pointers.close()
        self.texts.close()


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted; ``again`` marks those whose role and text came before.

    One shuffle: numbering equal rows and sorting by turn both work within the tasks that it makes. Sorts spill.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = F.col("turn").asc_nulls_first()
    dealt = rows.repartition(n, "conv_id")
    alike = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(turn)
    marked = dealt.withColumn("again", F.row_number().over(alike) > 1)
    marked = marked.sortWithinPartitions("conv_id", turn, "role", "text", "again")
    zero = F.lit(0).cast("long")
    return marked.select(
        F.coalesce("conv_id", zero).alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce("turn", zero).alias("turn"), F.col("turn").isNull().alias("no_turn"),
        F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "gone", "again",
    )


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(*(frame[c].tolist() for c in frame.columns))


def _given(rows: DataFrame, gone: Column) -> DataFrame:
    """The columns that count, nulls of role and text as one blank; a row that is gone only tells that its conversation exists."""
    blank = F.lit(" ")
    return rows.select(
        rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"), gone.alias("gone"),
        F.when(~gone, F.coalesce(rows["role"].cast("string"), blank)).otherwise("").alias("role"),
        F.when(~gone, F.coalesce(rows["text"].cast("string"), blank)).otherwise("").alias("text"),
    )


def _conversations(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, Conversation]]:
    steps = Steps()
    for (no_conv, conv), group in groupby(_stream(frames), key=itemgetter(1, 0)):
        found = Conversation(steps)
        for _, _, turn, no_turn, role, text, gone, again in group:
            if not gone:
                found.add(None if no_turn else turn, bytes(role), bytes(text), again)
        yield None if no_conv else conv, found
        found.close()


def repair(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row for each ``conv_id``: the faults of its rows, and the cheapest edits that make it legal.

    Legal are the roles' initials ``(s?(ua)+)?``. Of each row the first fault counts: ``blank`` (nothing but ASCII
    blanks), ``duplicate`` (role and text came before), ``truncated`` (the last character that is no blank is none of
    ``.!?``). ``gaps`` are the turns missing between the least and the greatest, ``illegal`` the neighbours whose initials are
    not ``su``, ``ua`` or ``au``. ``audit`` has the initials of the edits Keep, Rerole, Delete and Insert that cost
    least, of equal ones the least in ASCII order. ``repaired_sha256`` is the hash of the repaired ``role:text`` lines; it is
    found as they stream by, since a giant conversation's text fits no cell. :func:`repaired_turns` has the texts.

    Null turns come first; rows of one turn are ordered by role and text. A null role or text is one blank. A role without
    initial, or of another than s, u and a, cannot be kept. Rows of a null ``conv_id`` are one conversation. A conversation
    whose rows are all ``gone`` has zeros, no edits and the hash of the empty text. An empty table gives no rows. Columns other than
    ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
    """

    def run(conv: int | None, found: Conversation) -> Iterator[tuple]:
        edits = found.edits()
        digest = hashlib.sha256()
        for k, (_, role, text) in enumerate(found.turns(edits)):
            digest.update(b"\n" if k else b"")
            digest.update(role + b":")
            digest.update(text)
        faults = (found.gaps, found.blank, found.duplicate, found.truncated, found.illegal)
        yield conv, *faults, found.cost, edits.decode(), digest.hexdigest()

    return _streamed(rows, gone, run, SUMMARY)


def repaired_turns(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """``conv_id, position, edit, role, text``: the turns after the cheapest edits (see :func:`repair`), deleted ones left out."""

    def run(conv: int | None, found: Conversation) -> Iterator[tuple]:
        for k, (edit, role, text) in enumerate(found.turns(found.edits())):
            yield conv, k, edit, role.decode("utf-8", "replace"), text.decode("utf-8", "replace")

    return _streamed(rows, gone, run, TURNS)


def _streamed(
    rows: DataFrame, gone: Column | None, report: Callable[[int | None, Conversation], Iterator[tuple]], schema: str
) -> DataFrame:
    """What ``report`` says of every conversation, a bounded number of rows and letters in a frame."""
    importable(rows.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def frame(held: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(dict(zip(names, zip(*held))))
        return out.assign(conv_id=pd.array(out["conv_id"].tolist(), "Int64")) if len(out) else out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for conv, found in _conversations(frames):
            for row in report(conv, found):
                held.append(row)
                size += len(row[3]) + len(row[-1]) if schema is TURNS else len(row[-2])
                if len(held) >= FRAME or size >= HELD:
                    yield frame(held)
                    held, size = [], 0
        if held:
            yield frame(held)

    return _sorted_rows(_given(rows, F.lit(False) if gone is None else gone)).mapInPandas(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by ``crc32("conv_id:turn") % 20``; ``dropped`` marks those that count no more.

    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's. Nulls are one blank.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(rows["conv_id"].cast("string"), blank), F.lit(":"), F.coalesce(rows["turn"].cast("string"), blank))
    text = F.coalesce(rows["text"].cast("string"), blank)
    code = F.col("code")
    return rows.select(
        rows["conv_id"], rows["turn"], F.coalesce(rows["role"].cast("string"), blank).alias("role"), text.alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("code"),
    ).select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (code == 0).alias("dropped"), F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
