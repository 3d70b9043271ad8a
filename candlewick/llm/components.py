"""Connected components over an edge table, by alternating star contractions.

Each round is two aggregations and two joins; lineage is cut after each, so a lost
executor costs one round at most.  Minima are written before they are joined, so the
join's inputs are plain exchanges that AQE may split when one node has most edges.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.shared import cut


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link nodes to the least node of their neighbourhood.

    ``edges`` has (u, v) with u > v.  Both ways (large star), neighbours above a node
    move to the least node around it; one way (small star), neighbours below it do.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = cut(least).select(F.col("u").alias("c"), "m")
    if both_ways:
        moved = near.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.join(least, F.col("u") == F.col("c")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge; root is the least node reachable.

    ``edges`` holds two long columns, in any order, direction and multiplicity.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    now = cut(now)
    seen = _state(now)
    while True:
        now = cut(_star(cut(_star(now, True)), False))
        state = _state(now)
        if state == seen:
            break
        seen = state
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def local_forest(n: int, i, j):
    """Root of each of ``n`` local nodes, linked by the index pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if np.array_equal(before, root):
            return root
