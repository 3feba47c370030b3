"""Substring de-duplication by recompression.

Texts are compressed in rounds. A round first gives every run of equal symbols one
name, then every pair of a left symbol followed by a right one, where a symbol's own
name says which of the two it is. A name is a 64-bit hash of what it stands for,
so all tasks give equal things equal names and no table of names is needed.
What becomes of a symbol depends on it and its neighbours alone. So equal
stretches of words are compressed alike but for their ends, and every symbol knows
its *reach*: the words that decided what became of it.

A window of words is represented by a symbol whose reach lies within it (that of
the least hash, so that neighbouring windows share theirs). Windows that share
a symbol are a *segment*. Equal windows have equal symbols; what Spark shuffles are segments,
about one for seven words:

1. Segments whose symbol is found nowhere else are dropped as they stream by.
2. Of equal segments all but the earliest are repeats.
3. Where different segments share a symbol, the windows of the earliest
   of each are compared with each other, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from .common import map_columns, slices, stored

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
#: Seeds of the two hashes of a window.
SEEDS = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: What a null id becomes: it comes before all others.
NULL_ID = -(1 << 63)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A hash of two 64-bit values, in order."""
    x = (a ^ (a >> np.uint64(32))) * _MIX + b
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def hash_ranges(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A hash of each range of ``values``."""
    out = np.full(len(starts), seed, np.uint64)
    order = np.argsort(-lengths, kind="stable")
    starts, left = starts[order], -np.sort(-lengths)
    found = out[order]
    n = len(starts)
    for k in range(int(left[0]) if n else 0):
        n = int(np.searchsorted(-left, -k, "left"))  # ranges longer than k
        found[:n] = mix(found[:n], values[starts[:n] + k])
    out[order] = mix(found, lengths[order].astype(np.uint64))
    return out


class Symbols:
    """The symbols of texts laid end to end, with the words each spans and the words that decided it."""

    def __init__(self, names: np.ndarray, firsts: np.ndarray, ends: np.ndarray):
        at = np.arange(len(names))
        self.names, self.text = names, np.repeat(np.arange(len(firsts)), ends - firsts)
        self.low, self.high, self.reach_low, self.reach_high = at, at + 1, at, at + 1

    def _join(self, heads: np.ndarray, names: np.ndarray) -> None:
        """Symbols from each head to the next become one."""
        tails = np.append(heads[1:], len(self.names)) - 1
        same_left = np.zeros(len(heads), bool)
        same_left[1:] = self.text[heads[1:]] == self.text[heads[1:] - 1]
        same_right = np.append(same_left[1:], False)
        # The neighbours had a say; where a text ends, what would stand beyond would have had.
        low = np.where(same_left, self.reach_low[heads - 1], self.low[heads] - 1)
        high = np.where(same_right, self.reach_high[(tails + 1) % max(1, len(self.names))], self.high[tails] + 1)
        self.low, self.high, self.text = self.low[heads], self.high[tails], self.text[heads]
        self.names, self.reach_low, self.reach_high = names, low, high

    def round(self) -> None:
        """One round: runs, then pairs. The side of a run is that of its symbol, so a round looks one symbol to either side."""
        names, text = self.names, self.text
        if not len(names):
            return
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        runs = np.flatnonzero(new)
        count = np.diff(np.append(runs, len(names))).astype(np.uint64)
        base = names[runs]
        named = np.where(count > 1, mix(base, count), base)
        right = (mix(base, _MIX2) & np.uint64(1)).astype(bool)
        second = np.zeros(len(runs), bool)
        second[1:] = ~right[:-1] & right[1:] & (text[runs[1:]] == text[runs[:-1]])
        first = np.append(second[1:], False)
        named[first] = mix(named[first], named[np.flatnonzero(first) + 1])
        self._join(runs[~second], named[~second])


def rounds_for(window: int) -> int:
    """Rounds after which a symbol without runs reaches over at most half a window: 3 * 2**r - 2 words."""
    r = 1
    while 3 * 2 ** (r + 1) - 2 <= (window + 1) // 2:
        r += 1
    return r


def segments(hashes: np.ndarray, firsts: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """``symbol, content, text, start, n`` of the segments of all texts: n windows from the word ``start`` of the whole array on."""
    symbols = Symbols(hashes, firsts, ends)
    for _ in range(rounds_for(window)):
        symbols.round()
    fits = symbols.reach_high - symbols.reach_low <= window
    low, high = symbols.reach_low[fits], symbols.reach_high[fits]
    key = hash_ranges(hashes, np.maximum(low, 0), np.minimum(high, len(hashes)) - np.maximum(low, 0), SEEDS[0])
    sizes = np.maximum(0, ends - firsts - window + 1)
    text = np.repeat(np.arange(len(firsts)), sizes)
    start = np.arange(len(text)) + np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes)
    # Reaches move on with their symbols, so those within a window are a range of symbols.
    first = np.searchsorted(low, start, "left")
    last = np.searchsorted(high, start + window, "right")
    anchor = _least(key, first, last)
    alone = np.flatnonzero(anchor < 0)  # no symbol within: the window stands for itself
    anchor[alone] = len(key) + alone
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    n = np.diff(np.append(heads, len(start)))
    begins, anchor = start[heads], anchor[heads]
    content = hash_ranges(hashes, begins, n + window - 1, SEEDS[1])
    inside = anchor < len(key)
    symbol = np.empty(len(heads), np.uint64)
    symbol[inside] = key[anchor[inside]]
    symbol[~inside] = hash_ranges(hashes, begins[~inside], np.full((~inside).sum(), window), SEEDS[0] ^ _MIX)
    # Where the symbol lies in the segment is part of what the segment is.
    content[inside] = mix(content[inside], (low[anchor[inside]] - begins[inside]).astype(np.uint64))
    return symbol, content, text[heads], begins, n


def _least(key: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The leftmost position of the least key in each range; -1 if the range is empty."""
    out = np.full(len(first), -1)
    some = last > first
    if not some.any():
        return out
    a, b = first[some], last[some]
    level = np.frexp((b - a).astype(float))[1] - 1
    table, best = np.arange(len(key)), np.empty(len(a), np.int64)
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        x, y = table[a[at]], table[b[at] - (1 << k)]
        best[at] = np.where(key[x] <= key[y], x, y)
        shifted = table[np.minimum(np.arange(len(table)) + (1 << k), len(table) - 1)]
        table = np.where(key[table] <= key[shifted], table, shifted)
    out[some] = best
    return out


def _laid_out(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts end to end, and where each text begins and ends."""
    words = [(t or b"").split() for t in texts]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    hashes = [np.fromiter(map(xxh64_intdigest, w), np.uint64, len(w)) for w in words]
    return np.concatenate([*hashes, np.zeros(0, np.uint64)]), ends - np.array([len(w) for w in words], np.int64), ends


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """``doc, tie, text``: where an id has several rows, a hash of the text keeps different texts apart."""
    repeated = docs.groupBy(docs[id_col]).count().where("count > 1").limit(1).count()
    text = docs[text_col].cast("string").cast("binary")
    tie = F.coalesce(F.xxhash64(text), F.lit(0)) if repeated else F.lit(0).cast("long")
    doc = F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID))
    return docs.select(doc.alias("doc"), tie.alias("tie"), text.alias("text"), *more)


SEGMENT = "kind int, symbol long, content long, doc long, tie long, start int, n int"
#: Kinds of rows: a segment to be looked for elsewhere; one that shares its symbol; words that are known to repeat.
LOOK, KNOWN, REPEAT = 0, 1, 2


def _emit(window: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            hashes, firsts, ends = _laid_out(batch["text"])
            symbol, content, text, start, n = segments(hashes, firsts, ends, window)
            doc, tie = np.array(batch["doc"], np.int64)[text], np.array(batch["tie"], np.int64)[text]
            yield sort_out(symbol, content, doc, tie, start - firsts[text], n, window, spare_first=True)

    return run


def sort_out(
    symbol: np.ndarray, content: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray,
    window: int, spare_first: bool,
) -> dict[str, np.ndarray]:
    """The segments of a slice as rows: equal ones are one row, and what they cover is known to repeat (but in the first place, if that is spared)."""
    order = np.lexsort((start, tie, doc, content, symbol))
    symbol, content, doc, tie, start, n = (c[order] for c in (symbol, content, doc, tie, start, n))
    equal = np.zeros(len(symbol), bool)
    equal[1:] = (symbol[1:] == symbol[:-1]) & (content[1:] == content[:-1])
    head = np.flatnonzero(~equal)[np.cumsum(~equal) - 1] if len(equal) else np.zeros(0, int)
    repeat = equal & ~((doc == doc[head]) & (tie == tie[head]) & (start == start[head]))
    if not spare_first:
        repeat[head[repeat]] = True
    spans = _merged(doc[repeat], tie[repeat], start[repeat], start[repeat] + n[repeat] + window - 1)
    kept = ~equal
    symbol, content, doc, tie, start, n = (c[kept] for c in (symbol, content, doc, tie, start, n))
    # Where a symbol has several segments here, that it repeats is known; one row more lets others be found.
    same = symbol[1:] == symbol[:-1]
    several = np.zeros(len(symbol), bool)
    several[1:] |= same
    several[:-1] |= same
    witness = several.copy()
    witness[1:] &= ~same
    zeros = np.zeros(len(spans[0]), np.int64)
    columns = {"symbol": symbol.view(np.int64), "content": content.view(np.int64), "doc": doc, "tie": tie, "start": start, "n": n}
    more = {"doc": spans[0], "tie": spans[1], "start": spans[2], "n": spans[3] - spans[2]}
    kind = np.concatenate([np.where(several, KNOWN, LOOK), np.full(witness.sum(), LOOK), zeros + REPEAT])
    return {"kind": kind} | {c: np.concatenate([v, v[witness], more.get(c, zeros)]) for c, v in columns.items()}


def _merged(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of words, those that touch made one."""
    order = np.lexsort((end, start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    if not len(doc):
        return doc, tie, start, end
    text = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]))
    top = int(end.max()) + 2
    reached = np.maximum.accumulate(end + text * top)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + text[1:] * top > reached[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc)) - 1
    return doc[heads], tie[heads], start[heads], reached[tails] - text[tails] * top


def _drop_unique(batches: Iterator[dict]) -> Iterator[dict]:
    """Rows sorted by symbol: what is looked for and stands alone goes."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        rows = {c: np.array(v, np.int64) for c, v in batch.items()}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
        last = len(rows["symbol"]) - 1  # the last row waits for the next batch, the one before tells whether it repeats
        yield _repeated(rows, last)
        held = {c: v[max(0, last - 1) :] for c, v in rows.items()}
        held["kind"] = held["kind"].copy()
        if last > 0:
            held["kind"][0] |= 4  # given out already
    if held is not None:
        yield _repeated(held, len(held["symbol"]))


def _repeated(rows: dict[str, np.ndarray], upto: int) -> dict[str, np.ndarray]:
    look, symbol = rows["kind"] & 3 == LOOK, rows["symbol"]
    equal = (symbol[1:] == symbol[:-1]) & look[1:] & look[:-1]
    keep = ~look
    keep[1:] |= equal
    keep[:-1] |= equal
    keep &= rows["kind"] & 4 == 0
    return {c: v[:upto][keep[:upto]] for c, v in rows.items()}


def shared_segments(found: DataFrame, label: str) -> DataFrame:
    """The rows of :func:`sort_out` without the segments whose symbol is found nowhere else, stored."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Only one row of a symbol and slice is bound to the symbol's partition; all others are spread.
    spread = F.when(F.col("kind") == LOOK, F.lit(0)).otherwise(F.xxhash64("doc", "start"))
    dealt = found.withColumn("spread", spread).repartition(n, "symbol", "spread").sortWithinPartitions("symbol", "kind")
    return stored(map_columns(dealt.drop("spread"), _drop_unique, SEGMENT), label)


def repeats(keyed: DataFrame, window: int) -> DataFrame:
    """``doc, tie, start, end``: words covered by windows that also start earlier."""
    rows = shared_segments(map_columns(keyed, _emit(window), SEGMENT), "segments")
    here = F.struct("doc", "tie", "start")
    segs = rows.where(F.col("kind") != REPEAT)
    firsts = segs.groupBy("symbol", "content").agg(F.min(F.struct("doc", "tie", "start", "n")).alias("first"))
    later = segs.join(firsts, ["symbol", "content"]).where(
        here != F.struct("first.doc", "first.tie", "first.start")
    ).select("doc", "tie", "start", (F.col("start") + F.col("n") + (window - 1)).alias("end"))
    known = rows.where(F.col("kind") == REPEAT).select("doc", "tie", "start", (F.col("start") + F.col("n")).alias("end"))
    # Stored, so that the join meets both sides as they were shuffled and can split a symbol with very many segments.
    shared = stored(firsts.groupBy("symbol").count().where("count > 1").select("symbol"), "shared-symbols")
    unsure = firsts.join(shared, "symbol").select("first.*").groupBy("doc", "tie").agg(
        F.collect_list(F.struct("start", "n")).alias("places")
    )
    windows = stored(
        map_columns(keyed.join(unsure, ["doc", "tie"]), _windows(window), "doc long, tie long, start int, h1 long, h2 long"),
        "windows",
    )
    earliest = windows.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("count")).where("count > 1")
    single = windows.join(earliest.drop("count"), ["h1", "h2"]).where(here != F.col("first")).select(
        "doc", "tie", "start", (F.col("start") + window).alias("end")
    )
    return known.union(later).union(single)


def _windows(window: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            hashes, firsts, _ = _laid_out(batch["text"])
            text, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, places in enumerate(batch["places"]):
                own = np.unique(np.concatenate([np.arange(p["start"], p["start"] + p["n"]) for p in places]))
                text.append(np.full(len(own), i))
                start.append(own)
            text, start = np.concatenate(text), np.concatenate(start)
            lengths = np.full(len(start), window)
            h1, h2 = (hash_ranges(hashes, start + firsts[text], lengths, seed) for seed in SEEDS)
            yield {
                "doc": np.array(batch["doc"], np.int64)[text], "tie": np.array(batch["tie"], np.int64)[text], "start": start,
                "h1": h1.view(np.int64), "h2": h2.view(np.int64),
            }

    return run


def _without(text: bytes | None, spans: list[dict] | None) -> tuple[list[bytes], list[bytes]]:
    """All words of a text, and those outside the spans."""
    words = (text or b"").split()
    if not spans:
        return words, words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["end"] for s in spans], -1)
    return words, [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def _gone(keyed: DataFrame, window: int) -> DataFrame:
    return repeats(keyed, window).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("gone"))


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row.

    Words are what ASCII white space parts. A word goes if it lies in a window of ``window``
    words whose sequence also starts earlier: in a document of smaller id, or
    earlier in its own. ``kept`` are the other words joined by one blank. Windows
    are judged on the input. A null text has no words and an empty ``kept``. A null id
    comes before all others. Rows of one id and text are one document and get
    the same result; different texts of one id are told apart. An empty
    table gives no rows. Only the two named columns are read.
    """
    keyed = _keyed(docs, id_col, text_col)

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            both = [_without(t, spans) for t, spans in zip(batch["text"], batch["gone"])]
            yield {
                "doc": batch["doc"], "n_words": [len(w) for w, _ in both],
                "n_removed": [len(w) - len(k) for w, k in both], "kept": [b" ".join(k) for _, k in both],
            }

    joined = keyed.join(_gone(keyed, window), ["doc", "tie"], "left").drop("tie")
    done = map_columns(joined, cut, "doc long, n_words long, n_removed long, kept binary")
    doc_id = F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id")
    return done.select(doc_id, "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))


def replace_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeats of :func:`remove_repeats` cut from the text; texts without any, and all other columns, stay as they are."""
    keyed = _keyed(docs, id_col, text_col)
    others = F.struct(*[docs[c] for c in docs.columns if c != text_col], F.lit(0).alias("__")).alias("row")
    carried = _keyed(docs, id_col, text_col, others)
    joined = carried.join(_gone(keyed, window), ["doc", "tie"], "left").select("text", "gone", "row")
    schema = StructType([joined.schema["text"], joined.schema["row"]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
            kept = [b" ".join(_without(t, spans)[1]) if spans else t for t, spans in zip(texts, gone)]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), batch.column("row")], ["text", "row"])

    done = joined.mapInArrow(cut, schema)
    text = F.col("text").cast(docs.schema[text_col].dataType)
    return done.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
