"""Connected components of links, on Spark.

Alternates two steps until the links form stars: every node hands its smallest
neighbour to its larger ones, then to its smaller ones.  The smallest neighbour
comes from a partially aggregated ``groupBy`` and is joined back, so a hub is
never gathered in one group.  Each round is checkpointed into the folder that
all executors share.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventide.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node reachable from every node that
    has a link to another.  Links with a null end or equal ends are left out;
    no links give no rows."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL").where("u > v").distinct())
    edges, before = _round_end(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        edges, after = _round_end(small)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _round_end(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = cut_lineage(edges)
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return edges, tuple(row)


class Forest:
    """Components among the numbers ``0 .. size - 1`` inside a task."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        lab = self.label
        while len(i):
            x, y = lab[i], lab[j]
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(lab, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = lab[lab]
                if (up == lab).all():
                    break
                lab[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A link from every non-root to its root: as many as nodes at most."""
        i = np.flatnonzero(self.label != np.arange(len(self.label)))
        return i, self.label[i]
