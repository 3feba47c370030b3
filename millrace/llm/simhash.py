"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64-bit sign sums of shingle hashes. Their bits are cut into blocks,
a few more than the ``budget`` of differing bits: two fingerprints within it agree
on all bits of some choice of blocks, so a fingerprint goes to one bucket for
each choice. The fingerprints of a bucket form a binary trie. The trie is joined with
itself: pairs of nodes go down together, a step to unlike children costs one bit,
and a pair that has spent its budget goes only to like children or ends.

Equal fingerprints are one entry. A bucket with many entries is split into
chunks by hash, and its pairs of chunks go to different tasks. A task
returns links that connect what it found connected, not all its pairs.

Optionally a link must also hold in the texts: each entry then carries a small MinHash
sketch of its shingles, by which the trie join proposes links, and the whole sets of shingles decide.
As similar texts may differ in more bits than the budget, a prefix-filter join of the sets
finds the links that are still missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .common import map_columns, passing, slices, stored, texts_of
from .graph import Union, components
from .shingles import all_pairs, bits_of, hashes_of, missing_links, node_of, parities_of, shingle_set, verified

#: Shingles whose bits are counted at a time; entries of a bucket's chunk; node pairs held at a time.
SHINGLES_HELD, CHUNK, PAIRS_HELD = 1 << 16, 1 << 14, 1 << 19
#: Entries joined at a time, at least; a group is never parted.
BATCH = 1 << 16
#: Tables of buckets dealt at a time.
TABLES = 8
#: Bins of a sketch.
SKETCH = 128


def fingerprint(text: bytes | None, shingle: int = 3, distinct: bool = False, seed: int = 42) -> int:
    """The unsigned fingerprint of a text; 0 if it has no words. ``distinct`` counts equal shingles once."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    counts, total = np.zeros(64, np.int64), 0
    if distinct:
        parts = [np.unique(hashes_of(words, shingle, seed))]
    else:
        parts = (hashes_of(words[at : min(at + SHINGLES_HELD, last) + shingle - 1], shingle, seed) for at in range(0, last, SHINGLES_HELD))
    for hashes in parts:
        for at in range(0, len(hashes), SHINGLES_HELD):
            bits = np.unpackbits(hashes[at : at + SHINGLES_HELD].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            whole = len(bits) // 255 * 255  # sums of 255 bits fit a byte
            counts += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
            counts += bits[whole:].sum(0, dtype=np.int64)
            total += len(bits)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def sketch(text: bytes | None, shingle: int) -> bytes:
    """One-permutation MinHash of the shingles: for each of ``SKETCH`` bins a number from 1 to 255, 0 if it is empty."""
    words = (text or b"").lower().split()
    if not words:
        return bytes(SKETCH)
    hashes = hashes_of(words, shingle, 17)
    least = np.full(SKETCH, 1 << 57, np.uint64)
    np.minimum.at(least, (hashes >> np.uint64(57)).astype(np.int64), hashes & np.uint64((1 << 57) - 1))
    return np.where(least >> np.uint64(57), 0, 1 + least % np.uint64(255)).astype(np.uint8).tobytes()


def similar(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether rows of two arrays of sketches stand for sets whose Jaccard similarity is estimated at ``least`` or more."""
    some = ((a > 0) | (b > 0)).sum(1)
    equal = ((a == b) & (a > 0)).sum(1)
    chance = 1 / 255
    return (some == 0) | ((equal / np.maximum(some, 1) - chance) / (1 - chance) >= least)


def fingerprints(
    docs: DataFrame, shingle: int = 3, distinct: bool = False, verify: tuple[int, float] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint`` (a long with the same bits), ``node`` of every row, and with ``verify`` its ``sketch``, ``bits``, ``size`` and ``parity``.

    ``bits`` are a second fingerprint, of the shingles that decide; the last two are their number and parities.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, shingle, distinct) for t in batch["text"]], np.uint64)
            sketches = [sketch(t, verify[0]) if verify else None for t in batch["text"]]
            found = found.view(np.int64)
            sets = [shingle_set(t, verify[0]) for t in batch["text"]] if verify else []
            nodes = [node_of(s) for s in sets] if verify else found
            bits = [bits_of(s) for s in sets] if verify else found
            out = {"doc_id": batch["doc_id"], "fingerprint": found, "sketch": sketches, "bits": bits, "node": nodes}
            none = [None] * len(found)
            yield out | {"size": [len(s) for s in sets] or none, "parity": [parities_of(s) for s in sets] or none}

    kind = "doc_id long, fingerprint long, sketch binary, bits long, node long, size int, parity binary"
    return map_columns(texts_of(docs, id_col, text_col), run, kind)


def trie_join(keys: np.ndarray, starts: np.ndarray, budget: int, link: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Calls ``link`` with all pairs of entries of each two ranges ``(a, a end, b, b end)`` that differ in at most ``budget`` bits.

    Entries of a range are sorted. A range is a trie node: the entries that share the bits
    above. ``(a, a end, a, a end)`` joins a node with itself.
    """
    stack = [(64, np.column_stack([starts, np.zeros(len(starts), np.int64)]))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        depth, pairs = stack.pop()
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        few = (sizes <= 4) | (depth == 0)
        for x, y in all_pairs(pairs[few], sizes[few]):
            near = np.bitwise_count(keys[x] ^ keys[y]) <= budget
            link(x[near], y[near])
        pairs = pairs[~few]
        if not len(pairs):
            continue
        depth -= 1
        if depth not in zeros:
            zeros[depth] = np.concatenate([[0], np.cumsum((keys >> np.uint64(depth)) & np.uint64(1) == 0)])
        a, a_end, b, b_end, spent = pairs.T
        z = zeros[depth]
        a_mid, b_mid = a + z[a_end] - z[a], b + z[b_end] - z[b]
        down = [
            np.column_stack([a, a_mid, b, b_mid, spent]),
            np.column_stack([a_mid, a_end, b_mid, b_end, spent]),
            np.column_stack([a, a_mid, b_mid, b_end, spent + 1]),
            np.column_stack([a_mid, a_end, b, b_mid, spent + 1])[a != b],
        ]
        found = np.concatenate(down)
        found = found[(found[:, 4] <= budget) & (found[:, 1] > found[:, 0]) & (found[:, 3] > found[:, 2])]
        for at in range(0, len(found), PAIRS_HELD):
            stack.append((depth, found[at : at + PAIRS_HELD]))


def block_choices(budget: int, entries: int) -> list[int]:
    """Masks of the bits to agree on, one for each bucket table.

    Any number of blocks above the budget finds all pairs; more blocks make more tables with smaller buckets.
    """
    best = None
    for blocks in range(budget + 1, budget + 5):
        tables, bits = comb(blocks, budget), 64 * (blocks - budget) / blocks
        cost = tables * (1 + entries / 2**bits / 512)
        if best is None or cost < best[0]:
            best = (cost, blocks)
    edges = [64 * i // best[1] for i in range(best[1] + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, best[1] - budget)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(entries: DataFrame, budget: int = 3, least: float | None = None) -> DataFrame:
    """``a, b``: links between the ``node`` s of ``entries`` that connect them as all pairs within ``budget`` bits of ``fingerprint`` would.

    ``entries`` has distinct nodes. With ``least`` only pairs whose ``sketch`` es are that similar count.

    A table has all entries with their sketches. So a few tables at a time are dealt and their links stored: more entries
    make more tables, but what lies on disk at once is a fixed number of times the entries.
    """
    masks = block_choices(budget, entries.count())
    passes = [range(len(masks))[at : at + TABLES] for at in range(0, len(masks), TABLES)]
    return reduce(DataFrame.union, [stored(_links_in(tables, entries, masks, budget, least), "trie-links") for tables in passes])


def _links_in(tables: range, entries: DataFrame, masks: list[int], budget: int, least: float | None) -> DataFrame:
    """The links of some tables, by their numbers."""
    keys = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(_signed(masks[t]))) for t in tables])
    keyed = entries.select("node", "fingerprint", "sketch", F.posexplode(keys).alias("place", "key"))
    keyed = keyed.withColumn("table", (F.col("place") + tables[0]).cast("int"))
    # Only buckets of several chunks need their size known, and there are few: the entries are shuffled once, not for a join too.
    large = keyed.groupBy("table", "key").count().where(F.col("count") > CHUNK)
    chunks = F.coalesce(F.ceil(F.col("count") / CHUNK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = (
        keyed.join(F.broadcast(large), ["table", "key"], "left")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
    )
    group = ["table", "key", "i", "j"]
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, *group).sortWithinPartitions(*group, "own")

    def join(batches: Iterator[dict]) -> Iterator[dict]:
        for rows, sketches in _whole_groups(batches):
            yield _join_groups(rows, sketches, masks, budget, least)

    return map_columns(dealt.select(*group, "own", "fingerprint", "node", "sketch"), join, "a long, b long")


def _whole_groups(batches: Iterator[dict]) -> Iterator[tuple[np.ndarray, list]]:
    """Rows (table, key, i, j, own, fingerprint, node) and sketches in runs of whole groups."""
    rows, sketches, wait = np.zeros((0, 7), np.int64), [], BATCH
    for batch in batches:
        sketches = sketches + batch.pop("sketch")
        rows = np.concatenate([rows, np.column_stack([np.array(c, np.int64) for c in batch.values()])])
        if len(rows) < wait:
            continue
        new = np.flatnonzero((np.diff(rows[:, :4], axis=0) != 0).any(1)) + 1
        wait = len(rows) + BATCH
        if len(new):
            yield rows[: new[-1]], sketches[: new[-1]]
            rows, sketches, wait = rows[new[-1] :], sketches[new[-1] :], BATCH
    if len(rows):
        yield rows, sketches


def _join_groups(rows: np.ndarray, sketches: list, masks: list[int], budget: int, least: float | None) -> dict:
    prints = rows[:, 5].copy().view(np.uint64)
    order = np.lexsort((prints, *rows[:, 4::-1].T))
    rows, prints, table = rows[order], prints[order], rows[order, 0]
    data = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(rows), -1)[order] if least is not None else None
    sides = np.concatenate([[0], np.flatnonzero((np.diff(rows[:, :5], axis=0) != 0).any(1)) + 1, [len(rows)]])
    a, a_end = sides[:-1], sides[1:]
    alone = rows[a, 2] == rows[a, 3]  # a chunk with itself; of two chunks the first meets the one that follows
    follows = np.zeros(len(a), bool)
    follows[:-1] = (rows[a[:-1], :4] == rows[a[1:], :4]).all(1)
    pair = np.flatnonzero(~alone & follows)
    starts = np.concatenate([
        np.column_stack([a[alone], a_end[alone], a[alone], a_end[alone]]),
        np.column_stack([a[pair], a_end[pair], a[pair + 1], a_end[pair + 1]]),
    ])
    union = Union(len(rows))

    def link(x: np.ndarray, y: np.ndarray) -> None:
        open_ = union.parent[x] != union.parent[y]
        x, y = x[open_], y[open_]
        differ = prints[x] ^ prints[y]
        first = np.ones(len(x), bool)  # a pair that agrees in several tables is the first one's
        for k, mask in enumerate(masks[:-1]):
            first &= (table[x] <= k) | (differ & np.uint64(mask) != 0)
        x, y = x[first], y[first]
        if data is not None:
            for at in range(0, len(x), 1 << 15):
                own = slice(at, at + (1 << 15))
                good = similar(data[x[own]], data[y[own]], least)
                union.add(x[own][good], y[own][good])
        else:
            union.add(x, y)

    trie_join(prints, starts, budget, link)
    linked = np.flatnonzero(union.parent != np.arange(len(rows)))
    return {"a": rows[linked, 6], "b": rows[union.parent[linked], 6]}


def near_duplicates(
    docs: DataFrame, shingle: int = 3, budget: int = 3, distinct: bool = False, verify: tuple[int, float] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    ``fingerprint`` is written in 16 hexadecimal digits; ``component_id`` is the
    smallest id that can be reached over links, the row's own included. Texts
    without words (null, empty, blank) have fingerprint zero and are linked like
    others. Null ids count in no minimum: a component of null ids alone has a null id.
    Repeated rows stay rows. An empty table gives no rows. Only the two named
    columns are read.

    ``distinct`` counts equal shingles once. With ``verify = (words, least)`` the links are all pairs of
    texts whose distinct shingles of so many words have a Jaccard similarity of ``least``, whatever their fingerprints;
    ids must then be unique and not null.
    """
    prints = stored(fingerprints(docs, shingle, distinct, verify, id_col, text_col), "fingerprints")
    entries = prints.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.first("fingerprint").alias("fingerprint"), F.first("sketch").alias("sketch"),
        F.first("bits").alias("bits"), F.first("size").alias("size"), F.first("parity").alias("parity"),
    )
    entries = stored(entries, "fingerprint-classes")
    if not verify:
        found = links(entries, budget)
    else:
        # Proposals that are likely to hold, so that the forest of them stays whole when the sets have decided.
        likely = min(verify[1] + 0.03, 1.0)
        by_bits = entries.withColumn("fingerprint", F.col("bits"))
        found = links(entries, budget, likely).union(links(by_bits, budget, likely))
        found = verified(found.distinct(), docs, entries, *verify, id_col, text_col)
        found = missing_links(found, docs, entries, *verify, id_col, text_col)
    rooted = entries.select("node", "first").join(components(found, "a", "b"), "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_node = rooted.select("node", "root").join(least, "root").select("node", "component_id")
    written = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(by_node, "node").select("doc_id", written.alias("fingerprint"), "component_id")


def without_near_duplicates(
    docs: DataFrame, shingle: int = 1, budget: int = 7, distinct: bool = True, verify: tuple[int, float] | None = (5, 0.8),
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row of each component of near-duplicates, all columns as they are: that of the smallest id (nulls last).

    The defaults look for texts whose 5-word shingles are 80 % alike: fingerprints over
    the distinct words bring most such texts within 7 bits, a join of the shingles finds the others, and whole sets decide.

    Rows are told apart by a hash of all their columns, so repeated and null ids are no trouble, and it does not matter in
    what order or how parted they are read again. Of rows equal in all columns one counts.
    """
    columns = [f.name for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    place = F.xxhash64(F.lit(7), *[docs[c] for c in columns])
    placed = docs.select(place.alias("__place"), F.struct("*").alias("row"))
    id_of, text_of = F.col("row")[id_col], F.col("row")[text_col]
    with passing(docs.sparkSession):
        found = near_duplicates(
            placed.select("__place", text_of.alias("text")), shingle, budget, distinct, verify, id_col="__place", text_col="text"
        )
        found = found.groupBy(F.col("doc_id").alias("__place")).agg(
            F.first("component_id").alias("component_id"), F.count("*").alias("n")
        )
        ids = placed.groupBy("__place").agg(F.first(id_of).alias("id"))
        order = F.struct(F.col("id").isNull().alias("n"), "id", "__place")
        best = ids.join(found, "__place").groupBy("component_id").agg(
            F.min(F.struct(order.alias("order"), "n")).alias("best")
        )
        chosen = stored(best.select("best.order.__place", "best.n"), "kept-places")
    once = placed.join(chosen.where("n = 1"), "__place", "left_semi").select("row.*")
    again = placed.join(chosen.where("n > 1"), "__place", "left_semi").groupBy("__place").agg(F.first("row").alias("row"))
    return once.union(again.select("row.*"))
