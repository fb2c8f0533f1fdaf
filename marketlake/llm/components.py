"""Connected components of an edge table by alternating star joins.

Large-star links every larger neighbour of a node to its smallest neighbour,
small-star links a node and its smaller neighbours to the smallest of them;
repeated, every component becomes a star around its smallest node in a number
of rounds logarithmic in its size. Smallest neighbours are partial aggregates,
so a hub is never gathered in one task; each round ends in a written table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("b"), F.col("m").alias("a")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
            .union(least.select(F.col("u").alias("b"), F.col("m").alias("a"))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the
    smallest node reachable. Self links and repeated links are allowed."""
    current = staged(edges.select("a", "b").filter("a != b").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        step = _small_star(_large_star(current)).filter("a != b").distinct()
        current = staged(step.select("a", "b"), "stars")
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                           ).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def spanning(link: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Pairs (i, j) that connect what ``link`` (rows a, columns b, nodes
    0..n-1) connects: each node with the smallest it reaches."""
    label = np.arange(n)
    while link.size:
        low = label.copy()
        near = np.where(link, label[b][None], n).min(1)
        low[a] = np.minimum(low[a], near)
        near = np.where(link, low[a][:, None], n).min(0)
        low[b] = np.minimum(low[b], near)
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(n))
    return np.stack([moved, label[moved]], 1)
