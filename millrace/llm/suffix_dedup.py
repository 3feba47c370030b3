"""Removal of repeated byte strings with suffix arrays sorted by induction.

Suffix-sorting a whole corpus at once would move every byte many times. So strings that
cannot repeat are set aside first: every window of ``length`` bytes is
represented by the short string of least hash in it, neighbouring windows with the
same one in the same place are a *segment*, and equal windows have equal representatives.
Segments whose representative is found nowhere else hold no repeat. Segments that are
equal as a whole repeat as a whole. What is left, one of each kind of segment, is
dealt into shards by representative, and each shard is suffix-sorted (see
:mod:`induced_sorting`): a window repeats if it shares ``length`` bytes with a neighbour in
suffix order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns, slices, stored
from .induced_sorting import repeated
from .recompression import KNOWN, LOOK, NULL_ID, REPEAT, SEGMENT, _keyed, mix, shared_segments, sort_out

#: Bytes of text that are cut into segments at a time; bytes of a shard, at least; segments of one representative dealt together.
SLICE, SHARD, CHUNK = 1 << 20, 2 << 20, 1 << 11

_LETTERS = mix(np.arange(256, dtype=np.uint64), np.uint64(0x452821E638D01377))
_BASE = 0xD1342543DE82EF95
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base², … modulo 2**64."""
    if len(_POWERS.get(base, ())) < n:
        factors = np.full(max(n, SLICE), base, np.uint64)
        factors[0] = 1
        _POWERS[base] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[base]


def byte_segments(data: np.ndarray, firsts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``symbol, content, text, start, n`` of the segments of texts laid end to end: n windows from byte ``start`` on."""
    sizes = np.maximum(0, ends - firsts - length + 1)
    if not sizes.sum():
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    gram, hashes = 1, _LETTERS[data]
    while gram * 4 <= length:  # long strings seldom repeat by chance
        hashes = mix(hashes[:-gram], hashes[gram:])
        gram *= 2
    # The place of a short string stands in its lowest bits: of equal ones the leftmost is the least.
    bits = np.uint64(len(hashes).bit_length())
    least, width, grams = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64), 1, length - gram + 1
    while width * 2 <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(data) - length + 1], least[grams - width :][: len(data) - length + 1])
    text = np.repeat(np.arange(len(firsts)), sizes)
    start = np.arange(len(text)) + np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes)
    place = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    n = np.diff(np.append(heads, len(start)))
    begins = start[heads]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(hashes))[: len(hashes)], dtype=np.uint64)])
    back = _powers(pow(_BASE, -1, 1 << 64), len(hashes) + 1)
    content = mix((sums[begins + n + grams - 1] - sums[begins]) * back[begins], n.astype(np.uint64))
    return hashes[place[heads]], content, text[heads], begins, n


def _emit(length: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches, limit=SLICE):
            texts = [t or b"" for t in batch["text"]]
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            firsts = ends - np.array([len(t) for t in texts], np.int64)
            symbol, content, text, start, n = byte_segments(np.frombuffer(b"".join(texts), np.uint8), firsts, ends, length)
            doc, tie = np.array(batch["doc"], np.int64)[text], np.array(batch["tie"], np.int64)[text]
            yield sort_out(symbol, content, doc, tie, start - firsts[text], n, length, spare_first=False)

    return run


def _cut_out(length: int):
    """The bytes of the segments of each text."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for doc, tie, text, places in zip(*(batch[c] for c in ("doc", "tie", "text", "places"))):
                out = {c: [p[c] for p in places] for c in ("symbol", "i", "j", "start", "n", "once")}
                yield out | {
                    "doc": [doc] * len(places), "tie": [tie] * len(places),
                    "data": [text[p["start"] : p["start"] + p["n"] + length - 1] for p in places],
                }

    return run


def _sort_shards(length: int):
    """Suffix-sorts the segments of whole groups, ``SHARD`` bytes or more at a time."""

    def spans(rows: list[tuple]) -> dict[str, list]:
        rows = list({r[:3]: r for r in rows}.values())  # chunks of a group meet in pairs; a place must not meet itself
        out: dict[str, list] = {"doc": [], "tie": [], "start": [], "end": []}
        for (doc, tie, start, once, *_), marks in zip(rows, repeated([r[-1] for r in rows], length)):
            if not once:
                continue
            edges = np.flatnonzero(np.diff(marks.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            out["doc"] += [doc] * len(edges)
            out["tie"] += [tie] * len(edges)
            out["start"] += (edges[:, 0] + start).tolist()
            out["end"] += (edges[:, 1] + start + length - 1).tolist()
        return out

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch[c] for c in ("doc", "tie", "start", "once", "symbol", "i", "j", "data"))):
                if size >= SHARD and row[4:7] != last:
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
                last = row[4:7]
        if held:
            yield spans(held)

    return run


def repeats(keyed: DataFrame, length: int) -> DataFrame:
    """``doc, tie, start, end``: bytes covered by strings of ``length`` bytes that also start elsewhere."""
    rows = shared_segments(map_columns(keyed, _emit(length), SEGMENT), "byte-segments")
    known = rows.where(F.col("kind") == REPEAT).select("doc", "tie", "start", (F.col("start") + F.col("n")).alias("end"))
    segs = rows.where(F.col("kind").isin(LOOK, KNOWN))
    here = F.struct("doc", "tie", "start")
    kinds = segs.groupBy("symbol", "content").agg(
        F.min(F.struct("doc", "tie", "start", "n")).alias("first"), F.min(here).alias("low"), F.max(here).alias("high")
    ).select("symbol", "content", "first", (F.col("low") == F.col("high")).alias("once"))
    copied = segs.join(kinds.where(~F.col("once")), ["symbol", "content"]).select(
        "doc", "tie", "start", (F.col("start") + F.col("n") + (length - 1)).alias("end")
    )
    # Stored, so that the join meets both sides as they were shuffled and can split a symbol with very many segments.
    groups = stored(kinds.groupBy("symbol").agg(F.count("*").alias("count")).where("count > 1"), "shared-symbols")
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("content"), F.col("chunks")).cast("int")
    place = F.struct("symbol", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "start", "n", "once")
    unsure = (
        kinds.join(groups, "symbol")
        .select("symbol", "content", "first.*", "once", chunks.alias("chunks"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .groupBy("doc", "tie")
        .agg(F.collect_list(place).alias("places"))
    )
    kind = "symbol long, i int, j int, start int, n int, once boolean, doc long, tie long, data binary"
    dealt = map_columns(keyed.join(unsure, ["doc", "tie"]), _cut_out(length), kind)
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["symbol", "i", "j"]
    dealt = dealt.repartition(n, *group).sortWithinPartitions(*group)
    single = map_columns(dealt, _sort_shards(length), "doc long, tie long, start int, end int")
    return known.union(copied).union(single)


def remove_repeated_bytes(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row.

    A byte of a text (as UTF-8) goes if it is covered by a string of ``length`` bytes
    that starts at any other place of any text, the same one included. ``kept`` are the other
    bytes, as binary, since a cut may fall within a character. Strings are judged on the
    input. A null text is empty. Rows of one id and text are one document and get
    the same result, as do null ids; different texts of one id are told apart.
    An empty table gives no rows. Only the two named columns are read.
    """
    keyed = _keyed(docs, id_col, text_col)
    gone = repeats(keyed, length).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("gone"))

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            out: dict[str, list] = {"doc": batch["doc"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for text, spans in zip(batch["text"], batch["gone"]):
                text, edges, kept = text or b"", np.zeros((0, 2), np.int64), text or b""
                if spans:
                    depth = np.zeros(len(text) + 1, np.int64)
                    np.add.at(depth, [s["start"] for s in spans], 1)
                    np.add.at(depth, [s["end"] for s in spans], -1)
                    covered = np.cumsum(depth[:-1]) > 0
                    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                    kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(kept))
                out["n_spans"].append(len(edges))
                out["kept"].append(kept)
            yield out

    joined = keyed.join(gone, ["doc", "tie"], "left").drop("tie")
    done = map_columns(joined, cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    doc_id = F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id")
    return done.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept")
