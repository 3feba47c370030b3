"""Exact similarity of shingle sets: links checked in the texts, and a prefix-filter join that misses no pair.

All shingles have one order: those that a sample of texts finds frequent come last, by how frequent
they are, the others by their hash. Of two sets with a Jaccard similarity of ``least`` or more the first few common
shingles lie in the prefixes of both, as a prefix is a little longer than what a set may lack. So texts
that share enough of their prefixes are candidates, and their whole sets decide. The sample changes what
that costs, never which pairs are found.

Pairs are written out only where a shingle is in few unconnected sets. The sets of a crowded shingle are
compared where they meet, by parities: each set has some hundred bits, a bit says whether an odd number of its shingles fall on
it, and two sets differ in at least as many shingles as their bits differ. In a few rounds each task proposes one tree of its likeliest
pairs; those that hold connect most of a crowd. Then all pairs that are still unconnected and that the bits don't rule out
are written out, each where the least crowded shingle of both is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import importable, map_columns, passing, slices, stored, texts_of
from .graph import Union, components

#: Texts sampled for frequent shingles, at least, and their least share; texts a frequent shingle is in, about, and frequent shingles held.
SAMPLED, SAMPLED_SHARE, FREQUENT, FREQUENT_HELD = 1 << 15, 1 / 32, 64, 1 << 18
#: Common shingles that two prefixes must have; sets of a chunk of a frequent shingle; pairs and rows held at a time.
COMMON, CHUNK, PAIRS_HELD, ROWS_HELD = 4, 1 << 12, 1 << 16, 1 << 16
#: Pairs that are written out for each set of a shingle, at most; beyond that it is crowded.
PAIRS_EACH = 4
#: Least and most bytes of a set's parities; rounds of trees; what likely pairs have above the least similarity.
PARITY, PARITY_MOST, ROUNDS, LIKELY = 64, 256, 3, 0.03
#: Crowded shingles of a set, the least ones, by which a pair knows whether it has met elsewhere; pairs whose bits are compared at a time.
LOWEST, COMPARED = 32, 1 << 13


def hashes_of(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """Hashes of all shingles; fewer words are one shingle."""
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct hashes in order; none of a text without words."""
    words = (text or b"").lower().split()
    return np.unique(hashes_of(words, shingle, 17)) if words else np.zeros(0, np.uint64)


def node_of(found: np.ndarray) -> int:
    """A number for equal sets, as a long."""
    value = xxh64_intdigest(found.tobytes(), 5)
    return value - (1 << 64) if value >> 63 else value


def bits_of(found: np.ndarray) -> int:
    """64 bits of a set, as a long: one bit of the least hash in each of 64 bins. Two sets differ in half the share of bins
    that their similarity leaves; empty bins agree."""
    least = np.full(64, (1 << 58) - 2, np.uint64)
    np.minimum.at(least, (found >> np.uint64(58)).astype(np.int64), found & np.uint64((1 << 58) - 1))
    value = int.from_bytes(np.packbits((least & np.uint64(1)).astype(bool)).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


def _least_common(size: np.ndarray | int, least: float):
    """Shingles that a set of this size shares with any set as similar as ``least``."""
    return np.ceil(least * np.asarray(size) - 1e-9).astype(np.int64)


def all_pairs(pairs: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of entries of each two ranges, a bounded number at a time; of a range with itself each pair once."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(pairs):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_HELD, "right")))
        part, n = pairs[at:upto], sizes[at:upto]
        at = upto
        for low in range(0, int(n.sum()), PAIRS_HELD):  # a single pair of ranges may be larger
            k = np.arange(low, min(low + PAIRS_HELD, int(n.sum())))
            row = np.searchsorted(np.cumsum(n), k, "right")
            k = k - (np.cumsum(n) - n)[row]
            width = part[row, 3] - part[row, 2]
            x, y = part[row, 0] + k // width, part[row, 2] + k % width
            once = (part[row, 0] != part[row, 2]) | (x < y)
            yield x[once], y[once]


def frequent(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (in order) that many texts have, by a sample, and about how many."""
    scale = 1 << 20
    share = min(1.0, max(SAMPLED / max(texts.count(), 1), SAMPLED_SHARE))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(scale)) < int(scale * share))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            yield {"shingle": np.concatenate([shingle_set(t, shingle) for t in batch["text"]]).view(np.int64)}

    counts = map_columns(sample.select("text"), run, "shingle long").groupBy("shingle").count()
    often = counts.where(F.col("count") >= max(4, FREQUENT * share)).orderBy(F.desc("count"), "shingle").limit(FREQUENT_HELD)
    often = stored(often, "frequent-shingles").collect()  # the sample's shuffle files go
    found = np.array([r[0] for r in often], np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], (np.array([r[1] for r in often], np.int64)[order] / share).astype(np.int64)


def _counts_of(shingles: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """About how many texts have each shingle; 0 if it is not frequent."""
    known, counts = often
    if not len(known):
        return np.zeros(len(shingles), np.int64)
    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    return np.where(known[at] == shingles, counts[at], 0)


def parities_of(found: np.ndarray) -> bytes:
    """Which bits an odd number of shingles fall on; a set of many shingles has more bits."""
    size = PARITY
    while size < PARITY_MOST and len(found) > 8 * size:
        size *= 2
    bits = np.bincount((found & np.uint64(8 * size - 1)).astype(np.int64), minlength=8 * size) & 1
    return np.packbits(bits.astype(bool), bitorder="little").tobytes()


def meetings(docs: DataFrame, roots: DataFrame, shingle: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """``a, b, least``: pairs of different sets that share a shingle of their prefixes, once for each, and how many they must share; and,
    with 0 for ``least``, a set ``a`` for each crowded shingle ``b`` of its prefix.

    ``roots`` has a ``root`` for some ``node`` s, others are their own; sets of one root don't meet.
    """
    texts = texts_of(docs, id_col, text_col)
    often = docs.sparkSession.sparkContext.broadcast(frequent(texts, shingle))

    def prefixes(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            out: dict[str, list] = {"node": [], "size": [], "prefix": []}
            for text in batch["text"]:
                found = shingle_set(text, shingle)
                least_common = int(_least_common(len(found), least))
                order = np.argsort(_counts_of(found, often.value), kind="stable")
                prefix = found[order[: len(found) - least_common + min(COMMON, least_common)]]
                for name, value in zip(out, (node_of(found), len(found), prefix.tobytes())):
                    out[name].append(value)
            yield out

    sets = map_columns(texts, prefixes, "node long, size int, prefix binary")
    sets = sets.groupBy("node").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    sets = sets.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "size", "prefix")

    def deal(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches, "prefix"):
            shingles = np.frombuffer(b"".join(batch["prefix"]), np.uint64)
            row = np.repeat(np.arange(len(batch["node"])), [len(p) // 8 for p in batch["prefix"]])
            node, root, size = (np.array(batch[n], np.int64) for n in ("node", "root", "size"))
            chunks = -(-_counts_of(shingles, often.value) // CHUNK)
            own = (node[row].view(np.uint64) % np.maximum(chunks, 1).astype(np.uint64)).astype(np.int64)
            chunk = np.where(chunks > 1, own + 1, 0)  # parts of a shingle that is crowded anyway
            yield {"shingle": shingles.view(np.int64), "chunk": chunk, "root": root[row], "node": node[row], "size": size[row]}

    dealt = map_columns(sets, deal, "shingle long, chunk int, root long, node long, size int")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "shingle", "chunk").sortWithinPartitions("shingle", "chunk", "root")
    dealt = dealt.select("shingle", "chunk", F.col("chunk").alias("j"), F.col("chunk").alias("own"), "root", "node", "size")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, *_ in _whole_groups(batches):
            crowded = _crowded(rows)
            yield _pairs_batch(rows[crowded, 5], rows[crowded, 0], 0)
            rows = rows[~crowded]
            for x, y in _met(rows, least):
                fewer = np.minimum(rows[x, 6], rows[y, 6])
                yield _pairs_batch(*_ordered(rows[x, 5], rows[y, 5]), np.minimum(_least_common(fewer, least), COMMON))

    importable(docs.sparkSession)
    return dealt.mapInArrow(meet, "a long, b long, least int")


def missing_links(
    found: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, least: float, id_col: str, text_col: str
) -> DataFrame:
    """``found`` and further ``a, b`` whose similarity is ``least`` or more, so that all such pairs are connected.

    ``nodes`` has ``node, first, size, parity`` of each set; the links found so far must hold.
    """
    how = (docs, nodes, shingle, least, id_col, text_col)
    roots = components(found, "a", "b")
    met = stored(meetings(docs, roots, shingle, least, id_col, text_col), "meetings")
    crowds = met.where("least = 0").select(F.col("a").alias("node"), F.col("b").alias("shingle"))
    for turn in range(ROUNDS):
        tree = stored(unconnected(crowds, nodes, roots, least, turn).distinct(), "crowd-trees")
        sure = verified(tree, *how)
        if sure.isEmpty():
            break
        found = stored(found.union(sure), "links-so-far")
        roots = components(found, "a", "b")
    few = met.where("least > 0").groupBy("a", "b").agg(F.count("*").alias("n"), F.min("least").alias("least"))
    few = few.where("n >= least").select("a", "b")
    for side in ("a", "b"):
        few = few.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    few = few.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    rest = stored(few.union(unconnected(crowds, nodes, roots, least)).distinct(), "candidates")
    return found.union(verified(rest, *how))


def unconnected(crowds: DataFrame, nodes: DataFrame, roots: DataFrame, least: float, turn: int | None = None) -> DataFrame:
    """``a, b``: pairs of sets that share a crowded shingle, have different roots, and may be as similar as ``least``: all of them, or, with
    ``turn``, of those that meet in a task a tree of likely ones. Pairs may repeat, of all pairs but few do.
    """
    known = nodes.select("node", "size", "parity")
    if turn is None:
        lowest = crowds.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("shingle")), 1, LOWEST).alias("lowest"))
    else:
        lowest = crowds.select("node").distinct().withColumn("lowest", F.array().cast("array<long>"))
    members = crowds.join(known.join(lowest, "node"), "node").join(roots, "node", "left")
    members = members.select("shingle", F.coalesce("root", "node").alias("root"), "node", "size", "parity", "lowest")
    sizes = members.groupBy("shingle").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = sizes.where("low < high").select("shingle", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    dealt = members.join(sizes, "shingle").withColumn("own", F.pmod(F.xxhash64("node", F.lit(turn or 0)), F.col("chunks")).cast("int"))
    if turn is None:  # a chunk meets itself and every other
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    else:
        dealt = dealt.withColumn("other", F.col("own"))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    n = int(crowds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "own", "root")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parity, lowest in _whole_groups(batches):
            parities = Parities(parity, rows[:, 6], least)
            union, root = Union(len(rows)), np.unique(rows[:, 4], return_inverse=True)[1]
            for x, y in _met(rows, least):
                open_ = union.parent[root[x]] != union.parent[root[y]]
                x, y = parities.possible(x[open_], y[open_])
                if turn is None:
                    met = met_before(lowest, x, y, rows[x, 0])
                    x, y = x[~met], y[~met]
                a, b = _ordered(rows[x, 5], rows[y, 5])
                if turn is None:
                    chosen = np.unique(np.column_stack([a, b]), axis=0, return_index=True)[1]
                else:
                    x, y, order = parities.likely(x, y, a ^ b, turn)
                    a, b = a[order], b[order]
                    chosen = union.tree(root[x], root[y])
                yield _pairs_batch(a[chosen], b[chosen], None)

    importable(crowds.sparkSession)
    columns = ("shingle", "i", "j", "own", "root", "node", "size", "parity", "lowest")
    return dealt.select(*columns).mapInArrow(meet, "a long, b long")


def met_before(lowest: np.ndarray, x: np.ndarray, y: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    """Whether a pair has a lesser shingle in common, of those listed for both: it meets there too, as all sets of a shingle do."""
    met = np.zeros(len(x), bool)
    for at in range(0, len(x), COMPARED):
        own = slice(at, at + COMPARED)
        of_x, of_y = lowest[x[own]], lowest[y[own]]
        for k in range(of_x.shape[1]):
            one = of_x[:, k]
            met[own] |= (one < shingle[own]) & (of_y == one[:, None]).any(1)
    return met


class Parities:
    """Parities of sets, folded to the sizes that two sets have in common."""

    def __init__(self, parity: np.ndarray, sizes: np.ndarray, least: float):
        self.sizes, self.least = sizes, least
        self.folded = {PARITY_MOST: parity}  # shorter ones end in zeros, which fold to themselves
        width = PARITY_MOST
        while width > PARITY:
            half = self.folded[width]
            width //= 2
            self.folded[width] = half[:, : width // 8] ^ half[:, width // 8 :]
        self.width = np.full(len(sizes), PARITY)
        while (more := (self.width < PARITY_MOST) & (sizes > 8 * self.width)).any():
            self.width[more] *= 2

    def _differing(self, x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
        bits, out = self.folded[width], np.empty(len(x), np.int64)
        for at in range(0, len(x), COMPARED):
            own = slice(at, at + COMPARED)
            out[own] = np.bitwise_count(bits[x[own]] ^ bits[y[own]]).sum(1, dtype=np.int64)
        return out

    def possible(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose parities do not show that they differ in too many shingles."""
        for width in sorted(self.folded):
            common = np.minimum(self.width[x], self.width[y]) >= width
            far = np.zeros(len(x), bool)
            far[common] = self._differing(x[common], y[common], width) > self._allowed(x[common], y[common], self.least) + 1e-6
            x, y = x[~far], y[~far]
        return x, y

    def _allowed(self, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
        """Shingles that are in one of two sets only, at most."""
        return (self.sizes[x] + self.sizes[y]) * (1 - similarity) / (1 + similarity)

    def likely(self, x: np.ndarray, y: np.ndarray, pair: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that are probably similar, likeliest first (in later turns with some chance), and their places."""
        common = np.minimum(self.width[x], self.width[y])
        differ, expected = np.zeros(len(x)), np.zeros(len(x))
        for width in self.folded:
            own, bits = common == width, 8 * width
            differ[own] = self._differing(x[own], y[own], width)
            most = self._allowed(x[own], y[own], min(1.0, self.least + LIKELY))
            expected[own] = bits / 2 * (1 - (1 - 2 / bits) ** most)
        share = differ / np.maximum(expected, 1e-9)
        chance = ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn)) >> np.uint64(40)) / (1 << 24)
        order = np.lexsort((pair, share + 0.3 * min(turn, 1) * chance))
        order = order[share[order] <= 1]
        return x[order], y[order], order


def _ordered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum(a, b), np.maximum(a, b)


def _pairs_batch(a: np.ndarray, b: np.ndarray, least: np.ndarray | int | None) -> pa.RecordBatch:
    columns = {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
    if least is not None:
        columns["least"] = pa.array(np.broadcast_to(np.asarray(least, np.int32), len(a)), pa.int32())
    return pa.RecordBatch.from_pydict(columns)


def _met(rows: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group that have different roots and sizes near enough."""
    if not len(rows):
        return
    ranges = _ranges(rows)
    size = rows[:, 6]
    for x, y in all_pairs(ranges, (ranges[:, 1] - ranges[:, 0]) * (ranges[:, 3] - ranges[:, 2])):
        near = np.minimum(size[x], size[y]) >= _least_common(np.maximum(size[x], size[y]), least)
        yield x[near], y[near]


def _crowded(rows: np.ndarray) -> np.ndarray:
    """Rows of shingles dealt in chunks, or that have more than ``PAIRS_EACH`` pairs of different roots for each row."""
    runs = np.concatenate([[0], np.flatnonzero((np.diff(rows[:, :5], axis=0) != 0).any(1)) + 1])
    groups = np.concatenate([[0], np.flatnonzero((np.diff(rows[:, :3], axis=0) != 0).any(1)) + 1])
    n = np.diff(np.append(groups, len(rows)))
    alike = np.add.reduceat(np.diff(np.append(runs, len(rows))) ** 2, np.searchsorted(runs, groups))
    return np.repeat((rows[groups, 1] > 0) | (n * n - alike > 2 * PAIRS_EACH * n), n)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (shingle, i, j, own, root, node, size) in runs of whole groups, their parities and lowest shingles, if there are any."""
    parts, held, wait = [], 0, ROWS_HELD
    for batch in batches:
        parities = [p.ljust(PARITY_MOST, b"\0") for c in batch.columns[7:8] for p in c.to_pylist()]
        parts.append((
            np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:7]]),
            np.frombuffer(b"".join(parities), np.uint64).reshape(-1, PARITY_MOST // 8),
            _listed(batch.columns[8]) if batch.num_columns > 8 else np.zeros((0, 0), np.int64),
        ))
        held += batch.num_rows
        if held < wait:
            continue
        rows, *more = (np.concatenate(p) for p in zip(*parts))
        new = np.flatnonzero((np.diff(rows[:, :3], axis=0) != 0).any(1)) + 1
        if len(new):
            yield rows[: new[-1]], *(m[: new[-1]] for m in more)
            rows, *more = (m[new[-1] :] for m in (rows, *more))
        parts, held = [(rows, *more)], len(rows)
        wait = held + ROWS_HELD
    if held:
        yield tuple(np.concatenate(p) for p in zip(*parts))


def _listed(column: pa.Array) -> np.ndarray:
    """Lists of at most ``LOWEST`` longs as rows, filled up with the greatest."""
    n = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), LOWEST), np.iinfo(np.int64).max)
    out[np.arange(LOWEST) < n[:, None]] = column.flatten().to_numpy()
    return out


def _ranges(rows: np.ndarray) -> np.ndarray:
    """Two ranges of rows each (start, end, start, end), for all pairs of rows of a group with different roots that are to meet."""

    def starts(upto: int) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero((np.diff(rows[:, :upto], axis=0) != 0).any(1)) + 1, [len(rows)]])

    groups, sides, runs = starts(3), starts(4), starts(5)
    group_end = groups[np.searchsorted(groups, runs[:-1], "right")]
    own = rows[runs[:-1], 1] == rows[runs[:-1], 2]  # a run meets what follows
    out = [np.column_stack([runs[:-1], runs[1:], runs[1:], group_end])[own]]
    for a, mid in zip(sides[:-2], sides[1:-1]):
        if rows[a, 1] == rows[a, 2] or (rows[a, :3] != rows[mid, :3]).any():
            continue
        end = int(sides[np.searchsorted(sides, mid, "right")])
        mine = runs[(runs >= a) & (runs < mid)]  # runs of one chunk meet the other but for their root
        ends = np.append(mine[1:], mid)
        low = mid + np.searchsorted(rows[mid:end, 4], rows[mine, 4], "left")
        high = mid + np.searchsorted(rows[mid:end, 4], rows[mine, 4], "right")
        out += [np.column_stack([mine, ends, np.full_like(mine, mid), low]), np.column_stack([mine, ends, high, np.full_like(mine, end)])]
    found = np.concatenate(out)
    return found[found[:, 3] > found[:, 2]]


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """The ``a, b`` whose sets of shingles have a Jaccard similarity of ``least`` or more, stored; the sets are not kept.

    ``nodes`` has the id of one text, ``first``, for each ``node``; rows of one id have one text.
    """
    with passing(docs.sparkSession):
        return stored(_verified(pairs, docs, nodes, shingle, least, id_col, text_col), "sure-links")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, least: float, id_col: str, text_col: str) -> DataFrame:
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "first"), "node")
    texts = texts_of(docs, id_col, text_col).join(wanted.select("node", F.col("first").alias("doc_id")), "doc_id")

    def sets_of(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            yield {"node": batch["node"], "shingles": [shingle_set(t, shingle).tobytes() for t in batch["text"]]}

    sets = map_columns(texts.select("node", "text"), sets_of, "node long, shingles binary")
    sets = stored(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingle-sets")  # ids may repeat with their text
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b").select("a", "b", "of_a", "of_b")

    def decide(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            good = [_alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), least) for a, b in zip(batch["of_a"], batch["of_b"])]
            yield {n: np.array(batch[n], np.int64)[good] for n in ("a", "b")}

    return map_columns(both, decide, "a long, b long")


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return common >= ceil(least * (len(both) - common) - 1e-9)
