"""Connected components of links, by alternating stars, and the small helpers that link finders share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon.llm.common import settle


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Large: each node ties its larger neighbours to the least of its neighbours and itself. Small: its
    smaller neighbours and itself."""
    up = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    both = up.union(up.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else up
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("m", "a").alias("m"))
    tied = both.join(least, both["a"] == least["n"])
    if large:
        tied = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return tied.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of the links (a, b) the least node that it reaches. Nodes without links are absent.

    Each round is written to the shared folder. It ends when a round changes nothing: then all links lead to a root.
    The least neighbour of a node is an aggregate, and the join of a node with very many links can be split, so a star
    of any size is no single task.
    """
    now, before = settle(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links"), None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            break
        before = mark
        now = settle(_stars(_stars(now, True), False), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n items with links i-j the number of an item that stands for each one's component."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all() and (root[i] == root[j]).all():
            break
    return root
