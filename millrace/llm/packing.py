"""Packing of token sequences: patterns of lengths fitted to the histogram of lengths.

What is packed are pieces of at most ``capacity`` tokens, and only their
lengths matter. A *pattern* is a few lengths that fill a sequence exactly. How
often each pattern is to be used is a non-negative least squares problem with
one row for each length, so it is solved over the histogram and its size
depends on the capacity alone, not on the corpus. Patterns with a long piece are
enumerated and fitted first. What they leave, such as a histogram of short lengths
only, is fitted to patterns of any number of pieces drawn from it, exact ones
first, then ones short of a few tokens. Fitted counts are rounded by largest
remainder; the lengths left over are packed best fit, again by counts. Where best
fit alone does better on what the first fit leaves, that is taken. The
result is a table that maps the k-th piece of a length to its sequence and
place, and the pieces read their places from it in one pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_columns, slices, stored, texts_of
from .tokenizing import encoder

#: Patterns that are fitted at most; beyond that, only every n-th shortest length starts a pattern of three.
PATTERNS = 150_000
#: Updates of a fit.
ROUNDS = 300
#: Patterns of any number of pieces that are drawn for a fit, and their pieces, at most; tokens that they may leave free, one fit after another.
DRAWN, DRAWN_PIECES, SLACK = 1 << 16, 1 << 20, (0, 1, 2, 4)


def pieces(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (unsigned 32-bit, little-endian), and ``part, nth``.

    Every document gets ``end_id`` at its end. Longer ones are cut so that all pieces but the first are full.
    ``nth`` counts the pieces of a length within the task ``part``.
    """

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        encode, seen, part = encoder(path).encode, defaultdict(int), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        for batch in slices(batches):
            out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids", "part", "nth")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([np.frombuffer(encode(text), "<u2").astype("<u4"), end])
                first = len(ids) % capacity or min(capacity, len(ids))
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    for name, value in zip(out, (doc_id, piece, a, b - a, ids[a:b].tobytes(), part, seen[b - a])):
                        out[name].append(value)
                    seen[b - a] += 1
            yield out

    kind = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
    return map_columns(texts_of(docs, id_col, text_col), cut, kind)


def patterns(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of two or three lengths (0: none) that occur and fill ``capacity``, one of them at least half of it.

    Long pieces are what is hard to place; short ones fill the gaps of the rest.
    """
    there = counts > 0
    there[capacity:] = False
    lengths = np.flatnonzero(there)
    pairs = lengths[(2 * lengths <= capacity)]
    pairs = pairs[there[capacity - pairs]]
    rows = [np.stack([pairs, capacity - pairs, np.zeros_like(pairs)], 1)]
    step = max(1, -(-len(lengths) * capacity // 6 // PATTERNS))
    for a in lengths[::step]:
        b = lengths[(lengths >= a) & (2 * lengths <= capacity - a)]
        b = b[there[capacity - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, capacity - a - b], 1))
    found = np.concatenate(rows)
    return found[2 * found.max(1) >= capacity]


def fills(counts: np.ndarray, capacity: int, slack: int, seed: int = 5) -> np.ndarray:
    """Rows of lengths (0: none) that fill ``capacity`` but for ``slack``, drawn by the counts; the last piece is the longest that fits."""
    lengths = np.flatnonzero(counts[:capacity])
    if not len(lengths):
        return np.zeros((0, 1), np.int64)
    low = int(lengths[0])
    rng, share = np.random.default_rng(seed), np.cumsum(counts[lengths])
    longest = np.zeros(capacity + 1, np.int64)  # that fits a space
    longest[lengths] = lengths
    longest = np.maximum.accumulate(longest)
    space, columns = np.full(max(1, min(DRAWN, DRAWN_PIECES // (capacity // low))), capacity), []
    while space.max() >= low:
        piece = lengths[np.searchsorted(share, rng.integers(0, share[-1], len(space)), "right")]
        piece = np.where((piece > space - low) | (longest[space] == space), longest[space], piece)
        columns.append(piece)
        space = space - piece
    rows = np.sort(np.stack(columns, 1)[space <= slack], axis=1)[:, ::-1]
    return np.unique(rows, axis=0)


def fit(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeats x >= 0 of the patterns with least |A x - counts|², by multiplicative updates."""
    size = len(counts)
    target = counts.astype(float)
    target[0] = 0
    x = np.maximum(target[rows].max(1) / len(rows), 1e-9)
    goal = target[rows].sum(1)
    for _ in range(ROUNDS):
        used = sum(np.bincount(rows[:, j], x, size) for j in range(rows.shape[1]))
        used[0] = 0
        x *= goal / np.maximum(used[rows].sum(1), 1e-12)
    return x


class Plan:
    """Runs of sequences: the pieces ``base .. base + times`` of a length lie at ``offset`` of ``sequence + 0, 1, …``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            left[length] = n
        self.taken = np.zeros(capacity + 1, np.int64)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int]] = []
        self._use((capacity,), int(left[capacity]), left)
        self._fitted(patterns(left.copy(), capacity), left)
        start = left, self.taken, self.sequences, self.runs
        ends = []
        for slacks in ((), SLACK):  # short pieces may be better spent in the gaps of long ones
            left, self.taken, self.sequences, self.runs = start[0].copy(), start[1].copy(), start[2], list(start[3])
            for slack in slacks:
                self._fitted(fills(left, capacity, slack), left)
            self._residuals(left, capacity)
            ends.append((self.sequences, self.taken, self.runs))
        self.sequences, self.taken, self.runs = min(ends, key=lambda end: end[0])
        self.runs.sort()

    def _fitted(self, rows: np.ndarray, left: np.ndarray) -> None:
        """Uses the patterns as often as fits ``left``, rounded by largest remainder."""
        if not len(rows):
            return
        x = fit(rows, left)
        whole = x.astype(np.int64)
        for i in np.argsort(-x, kind="stable"):
            if whole[i] < 1:
                break
            row = tuple(int(v) for v in rows[i] if v)
            self._use(row, min(int(whole[i]), self._most(row, left)), left)
        more = round(float((x - whole).sum()))
        for i in np.argsort(whole - x, kind="stable"):
            if more < 1:
                break
            row = tuple(int(v) for v in rows[i] if v)
            if self._most(row, left) > 0:
                self._use(row, 1, left)
                more -= 1

    @staticmethod
    def _most(row: tuple[int, ...], left: np.ndarray) -> int:
        return min(int(left[v]) // row.count(v) for v in set(row))

    def _use(self, row: tuple[int, ...], times: int, left: np.ndarray) -> None:
        if times < 1:
            return
        offset = 0
        for length in row:
            self.runs.append((length, int(self.taken[length]), self.sequences, offset))
            self.taken[length] += times
            left[length] -= times
            offset += length
        self.sequences += times

    def _residuals(self, left: np.ndarray, capacity: int) -> None:
        """Longest first, each space filled with the longest length that fits; a filling repeats while its lengths last."""
        there = bytearray(int(n > 0) for n in left)
        while (longest := there.rfind(1)) > 0:
            row, space, used = [longest], capacity - longest, {longest: 1}
            limit = space
            while space > 0 and (best := there.rfind(1, 0, min(limit, space) + 1)) > 0:
                if used.get(best, 0) < left[best]:
                    row.append(best)
                    used[best] = used.get(best, 0) + 1
                    space -= best
                else:
                    limit = best - 1
            self._use(tuple(row), self._most(tuple(row), left), left)
            for length in used:
                there[length] = int(left[length] > 0)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys (length and first piece), sequences and offsets, by key."""
        runs = np.array(self.runs, np.int64).reshape(-1, 4)
        return (runs[:, 0] << 48) + runs[:, 1], runs[:, 2], runs[:, 3]


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    keep: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of all documents with their ``sequence_id`` and ``offset``.

    ``keep`` names columns made of those of :func:`pieces`; without it the token ``ids`` are kept.
    A null or empty text is a piece of the end id alone. Null and repeated ids
    are packed like others, row by row. An empty table gives no rows. No other
    column is read.

    The pieces are stored once. Their histogram has at most ``capacity`` rows, the
    only thing that the driver sees; the broadcast table has one entry for each piece of a
    used pattern, and the patterns of a fit are at most ``PATTERNS`` or ``DRAWN``.
    """
    keep = {"ids": F.col("ids")} if keep is None else keep
    names = ["doc_id", "piece", "start", "length"]
    cut = pieces(docs, path, capacity, end_id, id_col, text_col)
    cut = stored(cut.select(*names, *[c.alias(n) for n, c in keep.items()], "part", "nth"), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, capacity).table()
    runs = docs.sparkSession.sparkContext.broadcast(plan)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "part"]).select(
        *names, *keep, F.shiftleft(F.col("length"), 48).alias("_length"), (F.col("base") + F.col("nth")).alias("_rank")
    )

    def place(batches: Iterator[dict]) -> Iterator[dict]:
        keys, sequences, offsets = runs.value
        for batch in batches:
            key = np.array(batch.pop("_length"), np.int64) + np.array(batch.pop("_rank"), np.int64)
            at = np.searchsorted(keys, key, "right") - 1
            yield batch | {"sequence_id": sequences[at] + key - keys[at], "offset": offsets[at]}

    kind = ranked.drop("_length", "_rank").schema.add("sequence_id", "long").add("offset", "long")
    return map_columns(ranked, place, kind)
