"""Exact top-k search by inner product over M-trees.

Vectors get one more component that brings all of them to the same length, so
a larger inner product is a smaller Euclidean distance and the triangle inequality holds.
The table is dealt into shards; each shard is an M-tree of pages. A page is a
node: its pivot, its covering radius, and for each entry the distance to the
pivot. A query visits the pages of a shard best first. The stored distances
bound an entry's distance before it is computed; where even the bound can't
reach the best k so far, the entry is passed over.

Queries and shards are dealt in parts and groups; a part meets a group in one task, which holds the part's queries and one
tree at a time, and returns k rows a query. The rows of both sides are united and shuffled, not joined: a join of exploded
blocks looks small enough to broadcast by the size of its files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import importable, stored

#: Vectors of a shard, about; queries of a block; entries of a page; children of an inner node.
SHARD, BLOCK, PAGE, FANOUT = 16_384, 1_024, 128, 8
#: Blocks of a part and shards of a group, about, at most.
BLOCKS, SHARDS = 16, 8
#: Slack on bounds for rounding; scores themselves are whole numbers and exact.
SLACK = 1e-6


def quantize(vectors: DataFrame, scale: float = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, q`` with q = floor(scale * x) as longs; vectors that are null, or hold null or non-finite components, go."""
    parts = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = parts.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
    return kept.select("vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("q"))


class Tree:
    """Pages of vectors: ``pivots``, ``radii``, ``parents`` (distance to the parent page's pivot) and children or entries."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, top: float, seed: int = 5):
        self.vectors, self.ids = vectors, ids
        self.lifted = lift(vectors, top)
        self.pivots: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[np.ndarray, np.ndarray]] = []  # of inner pages: page numbers, distances to the pivot
        self.entries: list[tuple[np.ndarray, np.ndarray] | None] = []  # of leaves: rows, distances to the pivot
        self.rng = np.random.default_rng(seed)
        self.root = self._page(np.arange(len(ids)), self.lifted.mean(0))

    def _page(self, rows: np.ndarray, pivot: np.ndarray) -> int:
        number = len(self.pivots)
        distance = _distances(self.lifted[rows], pivot)
        self.pivots.append(pivot)
        self.radii.append(float(distance.max(initial=0)))
        self.children.append((np.zeros(0, int), np.zeros(0)))
        self.entries.append(None)
        groups = self._split(rows) if len(rows) > PAGE else []
        if not groups:  # few entries, or equal ones that no pivot parts
            self.entries[number] = (rows, distance)
            return number
        pages = np.array([self._page(own, self.lifted[own].mean(0)) for own in groups])
        self.children[number] = (pages, _distances(np.array([self.pivots[p] for p in pages]), pivot))
        return number

    def _split(self, rows: np.ndarray) -> list[np.ndarray]:
        """The rows by the nearest of a few of them; cut in halves where that leaves nearly all together."""
        data = self.lifted[rows]
        seeds = data[self.rng.choice(len(rows), min(FANOUT, len(rows)), replace=False)]
        for _ in range(2):
            nearest = ((data**2).sum(1)[:, None] - 2 * data @ seeds.T + (seeds**2).sum(1)).argmin(1)
            seeds = np.array([data[nearest == g].mean(0) if (nearest == g).any() else seeds[g] for g in range(len(seeds))])
        groups = [rows[nearest == g] for g in range(len(seeds)) if (nearest == g).any()]
        if max(map(len, groups)) > 0.9 * len(rows):
            groups = np.array_split(rows, 2)
        return groups

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, top: float, best: tuple[np.ndarray, ...] | None = None
    ) -> tuple[np.ndarray, ...]:
        """Query number, score and id of each query's k best; ties go to smaller ids. ``own`` are ids that take no part.

        ``best`` are those of other trees, in the same form; the result is then the best of all.

        All queries search together, in rounds. In each a query takes the best of its
        open pages, one in the first round and twice as many in each that follows, and
        queries that take the same page share its reading.
        """
        lifted = np.column_stack([queries, np.zeros(len(queries))])
        norms = (queries**2).sum(1)
        worst = np.full(len(queries), -np.inf)  # the k-th best score so far
        best = best or tuple(np.zeros(0, np.int64) for _ in range(3))
        last = np.arange(len(best[0])) - np.searchsorted(best[0], best[0]) == k - 1
        worst[best[0][last]] = best[1][last]
        start = _distances(lifted, self.pivots[self.root])
        # Open pages: query, page, least distance of anything in it, distance to its pivot.
        open_ = (np.arange(len(queries)), np.full(len(queries), self.root), np.maximum(0, start - self.radii[self.root]), start)
        take = 1
        while len(open_[0]):
            limit = np.sqrt(np.maximum(0, norms + top - 2 * worst)) * (1 + SLACK) + SLACK
            open_ = _rows(open_, open_[2] <= limit[open_[0]])
            order = np.lexsort((open_[2], open_[0]))
            open_ = _rows(open_, order)
            place = np.arange(len(order)) - np.searchsorted(open_[0], open_[0])
            now, open_ = _rows(open_, place < take), _rows(open_, place >= take)
            now = _rows(now, np.argsort(now[1], kind="stable"))
            edges = np.flatnonzero(np.diff(now[1], prepend=-1, append=-1))
            opened, found = [open_], [best]
            for low, high in zip(edges, edges[1:]):
                query, page, to_pivot = now[0][low:high], int(now[1][low]), now[3][low:high]
                if self.entries[page] is None:
                    opened.append(self._children(page, query, to_pivot, lifted, limit))
                else:
                    found.append(self._entries(page, query, to_pivot, queries, own, worst, limit))
            open_ = tuple(np.concatenate(c) for c in zip(*opened))
            query, score, ids = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((ids, -score, query))
            query, score, ids = query[order], score[order], ids[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            best = query[place < k], score[place < k], ids[place < k]
            last = place == k - 1
            worst[query[last]] = score[last]
            take *= 2
        return best

    def _children(self, page: int, query, to_pivot, lifted, limit) -> tuple[np.ndarray, ...]:
        """The open pages below an inner page: first by the stored distances alone, then by their own."""
        pages, to_parent = self.children[page]
        radii = np.array([self.radii[p] for p in pages])
        near = np.abs(to_pivot[:, None] - to_parent) - radii <= limit[query][:, None]
        row, child = np.nonzero(near[:, near.any(0)])
        pages, radii = pages[near.any(0)], radii[near.any(0)]
        pivots = np.array([self.pivots[p] for p in pages]).reshape(-1, lifted.shape[1])
        points = lifted[query]
        squares = (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
        distance = np.sqrt(np.maximum(0, squares[row, child]))
        return query[row], pages[child], np.maximum(0, distance * (1 - SLACK) - radii[child] - SLACK), distance

    def _entries(self, page: int, query, to_pivot, queries, own, worst, limit) -> tuple[np.ndarray, ...]:
        """Query, score and id of a leaf's entries that may be among the best."""
        rows, to_parent = self.entries[page]
        near = np.abs(to_pivot[:, None] - to_parent) <= limit[query][:, None]
        some = near.any(0)
        rows, near = rows[some], near[:, some]
        scores = queries[query] @ self.vectors[rows].T
        near &= scores >= worst[query][:, None]
        near &= self.ids[rows] != own[query][:, None]
        at, entry = np.nonzero(near)
        return query[at], scores[at, entry].astype(np.int64), self.ids[rows[entry]]


def _rows(columns: tuple[np.ndarray, ...], chosen: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(c[chosen] for c in columns)


def lift(vectors: np.ndarray, top: float) -> np.ndarray:
    """One more component, so that the squared length of each is ``top``."""
    return np.column_stack([vectors, np.sqrt(np.maximum(0.0, top - (vectors**2).sum(1)))])


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(1))


class Meeting:
    """A part of the queries and what a group of shards has found for it."""

    def __init__(self, k: int, width: int, top: float):
        self.k, self.width, self.top = k, width, top
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # numbers, ids, components
        self.best: list[tuple[np.ndarray, ...] | None] = []

    def ask(self, number: np.ndarray, ids: np.ndarray, q: np.ndarray) -> None:
        for at in range(0, len(ids), BLOCK):
            own = slice(at, at + BLOCK)
            self.blocks.append((number[own], ids[own], q[own].astype("<f8")))
            self.best.append(None)

    def meet(self, ids: np.ndarray, q: np.ndarray) -> None:
        tree = Tree(q.astype("<f8"), ids, self.top)
        for i, (_, own, queries) in enumerate(self.blocks):
            self.best[i] = tree.search(queries, own, self.k, self.top, self.best[i])

    def found(self) -> Iterator[dict[str, np.ndarray]]:
        for (number, own, _), best in zip(self.blocks, self.best):
            if best is not None:
                query, score, ids = best
                yield {"query": number[query], "query_id": own[query], "vec_id": ids, "score": score}


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple[int, int, int], np.ndarray, np.ndarray, np.ndarray]]:
    """``(part, group, shard), query, vec_id, q`` of rows that follow each other, at most twice ``SHARD`` of them."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("part", "group", "shard")])
        ids = [batch.column(c).to_numpy() for c in ("query", "vec_id")]
        q = batch.column("q").flatten().to_numpy().reshape(-1, width)
        edges = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1), len(keys)]
        for low, high in zip(edges, edges[1:]):
            now = tuple(keys[low].tolist())
            if held and (now != key or sum(len(h[0]) for h in held) + high - low > 2 * SHARD):
                yield key, *(np.concatenate(c) for c in zip(*held))
                held = []
            key = now
            held.append([c[low:high] for c in (*ids, q)])
    if held:
        yield key, *(np.concatenate(c) for c in zip(*held))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its k rows of ``vectors`` with the largest inner product.

    Both have ``vec_id`` and ``q`` as :func:`quantize` gives them. A query's own id takes no
    part. Ties go to the smaller id; fewer than k others give fewer rows. Repeated ids
    are vectors of their own, also as queries. Vectors whose number of components is not the most common
    one raise an error. Empty tables give no rows.

    Scores are exact while they stay below 2**53, which is checked. A shard's, a block's and a part's size
    is fixed, so a task's memory does not grow with the table.
    """
    spark = vectors.sparkSession
    squares = F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    facts = vectors.agg(
        F.count("*").alias("n"), F.min(F.size("q")).alias("least"), F.max(F.size("q")).alias("most"), F.max(squares).alias("top")
    ).first()
    kind = "query_id long, rank int, vec_id long, score long"
    if not facts["n"]:
        return spark.createDataFrame([], kind)
    if facts["least"] != facts["most"]:
        raise ValueError("vectors of different lengths")
    if facts["top"] >= 2.0**52:
        raise ValueError("inner products may exceed 53 bits")
    top, width = float(facts["top"]), facts["most"]
    # The number tells repeated ids apart in every group, so it is given once and stored.
    asked = stored(queries.select(F.monotonically_increasing_id().alias("query"), "vec_id", "q"), "queries")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_queries, longest = asked.agg(F.count("*"), F.max(squares)).first()
    shards, blocks = -(-facts["n"] // SHARD), max(1, -(-n_queries // BLOCK))
    parts = max(-(-blocks // BLOCKS), min(blocks, -(-n // shards)))
    groups = max(-(-shards // SHARDS), min(shards, -(-n // parts)))

    def dealt(column, into: int):
        return F.pmod(F.xxhash64(column, F.lit(9)), F.lit(into)).cast("int")

    def all_of(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = asked.select(dealt("query", parts).alias("part"), all_of(groups).alias("group"), F.lit(-1).alias("shard"), "query", "vec_id", "q")
    met = vectors.select(dealt("vec_id", shards).alias("shard"), "vec_id", "q")
    met = met.select(all_of(parts).alias("part"), F.pmod("shard", F.lit(groups)).alias("group"), "shard", F.lit(-1).cast("long").alias("query"), "vec_id", "q")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, meeting = None, None
        for (*place, shard), number, ids, q in _runs(batches, width):
            if place != last:
                if meeting:
                    yield from map(batch_of, meeting.found())
                last, meeting = place, Meeting(k, width, top)
            if shard < 0:
                meeting.ask(number, ids, q)
            else:
                meeting.meet(ids, q)
        if meeting:
            yield from map(batch_of, meeting.found())

    out = StructType.fromDDL("query long, query_id long, vec_id long, score long")
    arrow = to_arrow_schema(out)

    def batch_of(found: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in arrow], schema=arrow)

    importable(spark)
    longest = max(top, longest or 0)  # no component is longer than its vector
    component = "byte" if longest < 127**2 else "short" if longest < 32767**2 else "long"
    both = asked.union(met).withColumn("q", F.col("q").cast(f"array<{component}>"))
    # More partitions than tasks, as places are dealt by hash.
    both = both.repartition(max(n, 2 * parts * groups), "part", "group").sortWithinPartitions("part", "group", "shard")
    found = both.mapInArrow(search, out)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
