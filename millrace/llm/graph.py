"""Connected components of links between 64-bit nodes, by alternating star operations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import passing, stored


class Union:
    """Disjoint sets over 0 .. n-1; the least member stands for its set."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = self.parent
        while len(a):
            a, b = parent[a], parent[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]

    def tree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Adds pairs, first ones first, and gives the places of those that joined two sets."""
        chosen, place = [], np.arange(len(a))
        while True:
            own = np.column_stack([self.parent[a[place]], self.parent[b[place]]])
            place, own = place[own[:, 0] != own[:, 1]], own[own[:, 0] != own[:, 1]]
            if not len(place):
                return np.sort(np.concatenate([*chosen, place]))
            best = np.unique(np.unique(own.ravel(), return_index=True)[1] // 2)  # each set's first pair
            chosen.append(place[best])
            self.add(a[place[best]], b[place[best]])


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v`` with ``m``, the least of u and its neighbours v. A node of many neighbours is only hot on the side that can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _with_least(down)
    to_least = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return to_least.where("u != v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is the least node of its component.

    Each round is stored in the shared folder, so lineage stays short and nothing but
    three numbers comes to the driver. Links may repeat and point either way.
    """
    with passing(links.sparkSession):
        edges = _starred(links, a, b)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _starred(links: DataFrame, a: str, b: str) -> DataFrame:
    """``u, v``: every node but the least of its component, and that one."""
    edges = stored(
        links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u != v").distinct(), "links"
    )
    before = None
    while True:
        n, *sums = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if not n or (n, *sums) == before:
            return edges
        before = (n, *sums)
        edges = stored(_small_star(_large_star(edges).distinct()), "links")
