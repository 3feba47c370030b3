"""Suffix sorting by induction, with common-prefix lengths, through disk-backed queues.

A suffix is of type S if it is smaller than the next one, else of type L. Leftmost S
suffixes (LMS) are sorted first: induction sorts the substrings between them,
equal substrings get one name, and the string of names, at most half as long, is
suffix-sorted in turn. From the sorted LMS suffixes the L suffixes follow in one ascending
scan and from those the S suffixes in one descending scan: whatever is scanned
puts the suffix one position before it into the queue of that suffix's first
symbol, and a queue gives out what it got, in order.

Queue entries carry a position and the common prefix with the entry before it: one
symbol more than the least common prefix between the two suffixes that put them there. Where an L
and an S suffix of a bucket meet, it is the shorter of their runs of the first symbol.

Queues are lists of arrays that go to an unnamed temporary file when they outgrow
``MEMORY_BYTES``; they are written and read in order. Scans take whole queues at a
time, as arrays.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

#: Bytes of queues held in memory by one sorting; beyond it they go to disk.
MEMORY_BYTES = 64 << 20
#: Strings of names up to this length are sorted by doubling, in memory; longer ones by induction again.
DIRECT = 1 << 21

Consume = Callable[[np.ndarray, np.ndarray], None]


class Spool:
    """Arrays set aside, in memory or on disk."""

    def __init__(self):
        self.held, self.file = 0, None

    def put(self, array: np.ndarray):
        if self.held + array.nbytes <= MEMORY_BYTES:
            self.held += array.nbytes
            return array
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        at = self.file.tell()
        array.tofile(self.file)
        return at, array.shape, array.dtype

    def take(self, kept) -> np.ndarray:
        if isinstance(kept, np.ndarray):
            self.held -= kept.nbytes
            return kept
        at, shape, kind = kept
        self.file.flush()
        self.file.seek(at)
        return np.fromfile(self.file, kind, shape[0] * shape[1]).reshape(shape)


class Queues:
    """A first-in-first-out queue for each symbol, of pairs (position, common prefix with the one before)."""

    def __init__(self, spool: Spool):
        self.spool, self.lists = spool, {}
        self.least: dict[int, int] = {}  # common prefix of all scanned since a symbol's last entry

    def scan(self, symbols: np.ndarray, entries: np.ndarray, common: np.ndarray, chosen: np.ndarray) -> None:
        """Takes the scanned suffixes, in order: those ``chosen`` put ``entries`` into the queues of ``symbols``."""
        if not len(common):
            return
        whole = int(common.min())
        at = np.flatnonzero(chosen)
        order = at[np.argsort(symbols[at], kind="stable")]
        edges = np.flatnonzero(np.diff(symbols[order], prepend=-1, append=-1)) if len(order) else []
        fresh = {}
        for low, high in zip(edges, edges[1:]):
            own = order[low:high]
            symbol = int(symbols[own[0]])
            since = np.concatenate([[0], own[:-1] + 1])
            least = np.minimum.reduceat(common[: own[-1] + 1], since)
            before = self.least.get(symbol)
            least[0] = 0 if before is None else min(before, int(least[0])) + 1
            least[1:] += 1
            self.lists.setdefault(symbol, []).append(self.spool.put(np.stack([entries[own], least])))
            rest = common[own[-1] + 1 :]
            fresh[symbol] = int(rest.min()) if len(rest) else _MANY
        for symbol in self.least:
            if self.least[symbol] > whole:
                self.least[symbol] = whole
        self.least.update(fresh)

    def drain(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is in the queue, and what is put there meanwhile."""
        while parts := self.lists.pop(symbol, None):
            both = np.concatenate([self.spool.take(p) for p in parts], axis=1)
            yield both[0], both[1]


_MANY = 1 << 40


class Text:
    """A string whose last symbol is its least and occurs once, with types and runs."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.symbols = symbols
        rise = np.sign(symbols[1:].astype(np.int64) - symbols[:-1])
        turn = np.where(rise != 0, np.arange(n - 1), n)
        turn = np.minimum.accumulate(turn[::-1])[::-1]  # where a run of equal symbols ends
        self.small = np.ones(n, bool)  # type S
        self.small[:-1] = rise[np.minimum(turn, n - 2)] > 0
        self.run = np.ones(n, np.int64)
        self.run[:-1] = turn - np.arange(n - 1) + 1
        lms = self.small.copy()
        lms[1:] &= ~self.small[:-1]
        lms[0] = False
        self.lms = np.flatnonzero(lms)

    def induce(self, sorted_lms: np.ndarray, common: np.ndarray, consume: Consume) -> None:
        """Gives ``consume`` all suffixes from the last to the first, each with its common prefix with the one given before."""
        symbols, small, run = self.symbols, self.small, self.run
        spool = Spool()
        seeds = _by_symbol(symbols, sorted_lms)
        queues, larger = Queues(spool), {}
        alphabet = np.unique(symbols).tolist()
        for c in alphabet:
            last = None
            for position, shared in queues.drain(c):
                before = np.maximum(position - 1, 0)
                larger.setdefault(c, []).append(spool.put(np.stack([position, shared])))
                queues.scan(symbols[before], before, shared, (position > 0) & ~small[before])
                last = int(position[-1])
            low, high = seeds.get(c, (0, 0))
            if high > low:
                position, shared = sorted_lms[low:high], common[low:high].copy()
                shared[0] = 0 if last is None else min(int(run[last]), int(run[position[0]]))
                before = np.maximum(position - 1, 0)
                queues.scan(symbols[before], before, shared, position > 0)
        queues = Queues(spool)
        for c in reversed(alphabet):
            last = None
            for position, shared in queues.drain(c):
                before = np.maximum(position - 1, 0)
                consume(position, shared)
                queues.scan(symbols[before], before, shared, (position > 0) & small[before])
                last = int(position[-1])
            carry = 0 if last is None else -1
            for part in reversed(larger.pop(c, [])):
                position, shared = (a[::-1] for a in spool.take(part))
                first = min(int(run[last]), int(run[position[0]])) if carry < 0 else carry
                carry = int(shared[-1])
                shared = np.concatenate([[first], shared[:-1]])
                before = np.maximum(position - 1, 0)
                consume(position, shared)
                queues.scan(symbols[before], before, shared, (position > 0) & small[before] & (symbols[before] < c))
        consume(np.array([len(symbols) - 1]), np.zeros(1, np.int64))

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS suffixes in order, each with its common prefix with the one before."""
        lms, symbols = self.lms, self.symbols
        if len(lms) < 2:
            return lms, np.zeros(len(lms), np.int64)
        number = np.full(len(symbols), -1, np.int64)
        number[lms] = np.arange(len(lms))
        found: list[np.ndarray] = []

        def keep(position: np.ndarray, _: np.ndarray) -> None:
            own = number[position]
            found.append(own[own >= 0])

        start = lms[np.argsort(symbols[lms], kind="stable")]
        self.induce(start, np.zeros(len(lms), np.int64), keep)
        order = np.concatenate(found)[::-1]
        ends = np.append(lms[1:], len(symbols) - 1)
        length = ends - lms + 1
        a, b = order[:-1], order[1:]
        same = length[a] == length[b]
        check = np.flatnonzero(same)
        equal = self.common(lms[a[check]], lms[b[check]], length[a[check]])
        same[check] = equal == length[a[check]]
        names = np.empty(len(lms), np.int64)
        names[order] = np.concatenate([[0], np.cumsum(~same)])
        by_name, shared = sort_names(names)
        # Names in common stand for the symbols between their first positions; then the texts are compared.
        i, j, k = by_name[:-1], by_name[1:], shared[1:]
        edge = np.append(lms, len(symbols))
        done = edge[np.minimum(i + k, len(lms))] - lms[i]
        rest = self.common(lms[i] + done, lms[j] + done, np.full(len(i), _MANY))
        return lms[by_name], np.concatenate([[0], done + rest])

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of suffixes, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        open_, n, k = np.arange(len(a)), len(self.symbols), 0
        while len(open_):
            x, y = a[open_] + k, b[open_] + k
            inside = (np.maximum(x, y) < n) & (k < most[open_])
            open_, x, y = open_[inside], x[inside], y[inside]
            equal = self.symbols[x] == self.symbols[y]
            open_ = open_[equal]
            k += 1
            out[open_] = k
        return out


def _by_symbol(symbols: np.ndarray, positions: np.ndarray) -> dict[int, tuple[int, int]]:
    own = symbols[positions]
    edges = np.flatnonzero(np.diff(own.astype(np.int64), prepend=-1, append=-1))
    return {int(own[a]): (int(a), int(b)) for a, b in zip(edges, edges[1:])}


def sort_names(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a string of names in order, with common prefixes in names. The last name is the least and occurs once."""
    n = len(names)
    if n > DIRECT:
        positions, shared = [], []
        text = Text(names)
        text.induce(*text.sorted_lms(), lambda p, s: (positions.append(p), shared.append(s)))
        order, common = np.concatenate(positions)[::-1], np.concatenate(shared)
        return order, np.concatenate([[0], common[::-1][:-1]])
    # A rank is the place of the first suffix of a group of so far equal ones; only groups of several are sorted on.
    order = np.argsort(names, kind="stable")
    ranks, width, levels = np.empty(n, np.int64), 1, []
    slots, new = np.arange(n), np.append(True, names[order[1:]] != names[order[:-1]])
    own = order
    while True:
        heads = slots[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        ranks[own] = heads
        order[slots] = own
        levels.append(ranks.astype(np.int32))
        several = np.zeros(len(own), bool)
        several[1:] |= ~new[1:]
        several[:-1] |= ~new[1:]
        own, slots, heads = own[several], slots[several], heads[several]
        if not len(own):
            break
        beyond = own + width >= n
        after = np.where(beyond, -1, ranks[np.where(beyond, 0, own + width)])
        by = np.lexsort((after, heads))
        own, after = own[by], after[by]
        new = np.append(True, (heads[1:] != heads[:-1]) | (after[1:] != after[:-1]))
        width *= 2
    a, b, shared = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for k in reversed(range(len(levels))):
        inside = np.maximum(a, b) < n
        equal = inside.copy()
        equal[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = equal.astype(np.int64) << k
        a, b, shared = a + step, b + step, shared + step
    return order, np.concatenate([[0], shared])


def repeated(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, whether its bytes from each position on, ``length`` of them, are found at any other place of the texts."""
    symbols = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.uint16) + 2, 1) for t in texts] + [[0]]).astype(np.uint16)
    text = Text(symbols)
    marked = np.zeros(len(symbols), bool)
    last = -1

    def mark(position: np.ndarray, shared: np.ndarray) -> None:
        nonlocal last
        long = shared >= length
        marked[position[long]] = True
        marked[np.concatenate([[last], position[:-1]])[long]] = True
        last = int(position[-1])

    text.induce(*text.sorted_lms(), mark)
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    return [marked[a : a + max(0, len(t) - length + 1)] for a, t in zip(starts, texts)]
