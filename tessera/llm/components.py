"""Connected components of a graph given as rows of edges.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every round replaces the edges of
a node by edges to the smallest neighbour, so the edge count never grows, and
a logarithmic number of rounds leaves one star per component.  Nothing is
collected but two counts a round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation over edges (u, v); the result is distinct, with u > v."""
    near = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that both sides of the join come from an exchange and a hub's rows can be split.
    least = materialise(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    joined = near.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the integer edges (a, b): root is the component's smallest node.

    Self-links, repeated and reversed links are allowed; links with a null end are ignored.
    """
    e = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct(), "components-edges")
    seen = None
    while True:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if not state["n"] or (seen is not None and state == seen):
            break
        seen = state
        e = materialise(_star(materialise(_star(e, True), "components-large"), False), "components-small")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
