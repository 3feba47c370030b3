"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are windows of ``window`` consecutive words of the benchmark items; an
item of fewer words is a pattern of its own length. For the patterns of a length
L, a table over hashed blocks of two words says how far the search may move on
when a block ends at the current word: as far as that block lies from the end
of any pattern, or past it. Where it may not move, the block is the
end of some pattern; the bucket of that block lists them, and the words are
compared directly.

Texts are searched in many stretches side by side, each with its own position.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, map_columns, slices, stored, texts_of

#: Bytes of benchmark text that are on the driver and broadcast at a time; a larger benchmark is searched in several passes.
BENCHMARK_BYTES = 8 << 20
#: Positions that one stretch of a text covers.
STRETCH = 512

# Bytes that are part of words stay (A-Z in lower case), all others part words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


class Patterns:
    """The patterns of one length with their shift table and buckets."""

    def __init__(self, rows: np.ndarray, pattern_of: np.ndarray, items: np.ndarray):
        """``items`` has the numbers of the items, and ``pattern_of``, in order, the pattern each of them has."""
        self.rows, self.items = rows, items
        self.count, self.length = rows.shape
        self.first_item = np.searchsorted(pattern_of, np.arange(self.count + 1))
        self.block = min(2, self.length)
        # Windows overlap, so they have about as many different blocks as there are windows.
        self.mask = (1 << max(16, int(16 * len(rows)).bit_length())) - 1
        # A block that is in no pattern lets the search move past it.
        self.shift = np.full(self.mask + 1, self.length - self.block + 1, np.int32)
        for end in range(self.block - 1, self.length):
            np.minimum.at(self.shift, self.hash(rows, end), self.length - 1 - end)
        suffix = self.hash(rows, self.length - 1)
        self.order = np.argsort(suffix, kind="stable")
        self.bucket = np.zeros(self.mask + 2, np.int32)
        np.cumsum(np.bincount(suffix, minlength=self.mask + 1), out=self.bucket[1:])

    def hash(self, rows: np.ndarray, end: int) -> np.ndarray:
        return self._hash(rows[:, end - 1] if self.block > 1 else 0, rows[:, end])

    def _hash(self, before, word) -> np.ndarray:
        return (np.multiply(before, 0x9E3779B1, dtype=np.int64) + np.multiply(word, 0x85EBCA6B, dtype=np.int64) >> 7) & self.mask

    def search(self, words: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and pattern numbers of all occurrences in texts ``words[first:end]``."""
        at, stop = _stretches(firsts + self.length - 1, ends)
        found_at, found = [], []
        while len(at):
            code = self._hash(words[at - 1] if self.block > 1 else 0, words[at])
            move = self.shift[code]
            if len(stand := np.flatnonzero(move == 0)):
                low, high = self.bucket[code[stand]], self.bucket[code[stand] + 1]
                which = np.repeat(np.arange(len(stand)), high - low)
                pattern = self.order[np.arange(len(which)) - np.repeat(np.cumsum(high - low) - high, high - low)]
                start = at[stand][which] - self.length + 1
                same = words[start] == self.rows[pattern, 0]  # the first word, then all
                start, pattern = start[same], pattern[same]
                same = (words[start[:, None] + np.arange(self.length)] == self.rows[pattern]).all(1)
                found_at.append(start[same])
                found.append(pattern[same])
            at = at + np.maximum(move, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


def _stretches(firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of positions cut into stretches of at most ``STRETCH``."""
    firsts, ends = firsts[firsts < ends], ends[firsts < ends]
    n = -(-(ends - firsts) // STRETCH)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(firsts, n) + k * STRETCH
    return at, np.minimum(at + STRETCH, np.repeat(ends, n))


class Benchmark:
    """All patterns of a block of items, by length, and the numbers of their words (0: any other word)."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.words: dict[bytes, int] = {}
        rows: dict[int, list[np.ndarray]] = defaultdict(list)
        owners: dict[int, list[np.ndarray]] = defaultdict(list)
        for name, text in items:
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)], np.int32)
            if length := min(window, len(ids)):
                rows[length].append(sliding_window_view(ids, length))
                owners[length].append(np.full(len(ids) - length + 1, number[name], np.int64))
        self.by_length = []
        for length in sorted(rows):
            distinct, pattern = np.unique(np.concatenate(rows.pop(length)), axis=0, return_inverse=True)
            pairs = np.unique(pattern.ravel() * len(self.names) + np.concatenate(owners.pop(length)))
            self.by_length.append(Patterns(distinct, pairs // len(self.names), pairs % len(self.names)))

    def search(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """For each text its hit words as spans, and the items with occurring windows."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        firsts = ends - sizes
        number = self.words.get
        words = np.concatenate([np.fromiter(map(number, t, repeat(0)), np.int64, len(t)) for t in texts])
        spans: dict[int, list] = defaultdict(list)
        names: dict[int, set] = defaultdict(set)
        for patterns in self.by_length:
            starts, found = patterns.search(words, firsts, ends)
            texts_hit = np.searchsorted(ends, starts, "right")
            for text, start, pattern in zip(texts_hit.tolist(), (starts - firsts[texts_hit]).tolist(), found.tolist()):
                spans[text].append((start, start + patterns.length))
                own = patterns.items[patterns.first_item[pattern] : patterns.first_item[pattern + 1]]
                names[text].update(self.names[i] for i in own)
        return [(merge_spans(spans[i]) if i in spans else [], names[i] if i in names else set()) for i in range(len(texts))]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


_WORKER: dict[str, Benchmark] = {}


def _benchmark(key: str, items: list[tuple[str, bytes]], window: int) -> Benchmark:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Benchmark(items, window)
    return _WORKER[key]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, starts, ends`` of every row of ``docs``.

    ``items`` are the ids, as strings in order, of the items with a window in the text;
    ``starts`` and ``ends`` are the hit stretches, in words. A null text has no words and
    no hits, nor has an item whose text is null or has no words. Items of one id
    count as one; an item with a null id is named by the empty string. Repeated rows
    stay rows; an empty benchmark hits nothing. Only the named columns are read.

    Documents are searched once for each part of ``BENCHMARK_BYTES`` of the benchmark, of which one at a time is on the driver and
    broadcast. A benchmark of one part shuffles no document; of more, what each part finds is stored by the text's
    hash, and only numbers of words and hashes are joined with it.
    """
    parts = _benchmark_parts(benchmark, item_col, item_text_col)
    texts = texts_of(docs, id_col, text_col)
    if len(parts) == 1:
        found = map_columns(texts, _search(_shared(parts[0]), window, ("doc_id",)), f"doc_id long, n_words long, {_FOUND}")
    else:

        def count(batches: Iterator[dict]) -> Iterator[dict]:
            for batch in slices(batches):
                yield {"doc_id": batch["doc_id"], "n_words": [len(words_of(t)) for t in batch["text"]], **{k: batch[k] for k in _KEYS}}

        keyed = texts.select("doc_id", "text", *_text_keys(F.col("text")))
        counts = map_columns(keyed, count, "doc_id long, n_words long, __text_a long, __text_b long")
        found = counts.join(_by_text(keyed.select(*_KEYS, "text"), parts, window), list(_KEYS), "left")
        nothing = [F.coalesce(F.col(n), F.array().cast(kind)).alias(n) for n, kind in (("items", "array<string>"), ("starts", "array<int>"), ("ends", "array<int>"))]
        found = found.select("doc_id", "n_words", *nothing)
    n_hit = F.aggregate(
        F.zip_with("starts", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda n, x: n + x
    )
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "starts", "ends")


_FOUND = "items array<string>, starts array<int>, ends array<int>"
_KEYS = ("__text_a", "__text_b")


def _text_keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text; what is found in a text depends on nothing else."""
    whole = F.coalesce(text.cast("string").cast("binary"), F.lit(b""))
    return [F.xxhash64(F.lit(seed), whole).alias(name) for seed, name in enumerate(_KEYS)]


def _by_text(keyed: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """``items, starts, ends`` of each text in which any part of a benchmark occurs, by its hashes."""
    found = None
    for part in parts:
        shared = _shared(part)
        hits = map_columns(keyed, _search(shared, window, _KEYS, hits_only=True), f"__text_a long, __text_b long, n_words long, {_FOUND}")
        hits = stored(hits.groupBy(*_KEYS).agg(F.first(F.struct("items", "starts", "ends")).alias("hit")), "leaks")
        shared.destroy()
        found = hits if found is None else found.union(hits)

    def merge(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            spans = [merge_spans([s for hit in hits for s in zip(hit["starts"], hit["ends"])]) for hits in batch["hits"]]
            yield {
                **{k: batch[k] for k in _KEYS},
                "items": [sorted({i for hit in hits for i in hit["items"]}) for hits in batch["hits"]],
                "starts": [[a for a, _ in s] for s in spans],
                "ends": [[b for _, b in s] for s in spans],
            }

    # A list has one entry for a part at most.
    merged = found.groupBy(*_KEYS).agg(F.collect_list("hit").alias("hits"))
    return map_columns(merged, merge, f"__text_a long, __text_b long, {_FOUND}")


def _benchmark_parts(benchmark: DataFrame, item_col: str, item_text_col: str) -> list[DataFrame]:
    """The items in parts of about ``BENCHMARK_BYTES`` each; all items of an id are in one."""
    items = benchmark.select(
        F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("name"),
        F.coalesce(benchmark[item_text_col].cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    passes = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BENCHMARK_BYTES))
    return [items.where(F.pmod(F.xxhash64("name"), F.lit(passes)) == k) for k in range(passes)] if passes > 1 else [items]


def _shared(part: DataFrame):
    return part.sparkSession.sparkContext.broadcast([(r["name"], bytes(r["text"])) for r in part.collect()])


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = 10,
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text has no window of any item, all columns as they are. A null text has none.

    Repeated rows stay rows; an empty benchmark or table is no trouble. With a benchmark of several parts documents are shuffled once.
    """
    parts = _benchmark_parts(benchmark, item_col, item_text_col)
    if len(parts) == 1:
        return keep_rows(docs, _clean(_shared(parts[0]), window), text_col)
    text = docs[text_col].cast("string").cast("binary")
    leaked = _by_text(docs.select(text.alias("text"), *_text_keys(docs[text_col])), parts, window).select(*_KEYS)
    own = docs.select(F.struct("*").alias("row"), *_text_keys(docs[text_col]))
    return own.join(leaked, list(_KEYS), "left_anti").select("row.*")


def _clean(shared, window: int):
    key = uuid.uuid4().hex

    def decide(texts: list[bytes | None]) -> list[bool]:
        return [not spans for spans, _ in _benchmark(key, shared.value, window).search([words_of(t) for t in texts])]

    return decide


def _search(shared, window: int, carried: tuple[str, ...], hits_only: bool = False):
    key = uuid.uuid4().hex

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        patterns = _benchmark(key, shared.value, window)
        for batch in slices(batches):
            texts = [words_of(t) for t in batch["text"]]
            found = patterns.search(texts)
            rows = [i for i, (spans, _) in enumerate(found) if spans or not hits_only]
            yield {
                **{n: [batch[n][i] for i in rows] for n in carried},
                "n_words": [len(texts[i]) for i in rows],
                "items": [sorted(found[i][1]) for i in rows],
                "starts": [[a for a, _ in found[i][0]] for i in rows],
                "ends": [[b for _, b in found[i][0]] for i in rows],
            }

    return run
