"""Connected components of a link table, by alternating stars on distributed edges.

Every round points the two ends of each link at the smallest node either of them knows; the smallest is a map-side
combined minimum, so a hub with a third of all links costs one row per task. Links never reach the driver: only their
number and the number of changes do.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.shared import stored

#: Rounds after which the job is given up; each round at least halves the longest path.
MAX_ROUNDS = 60


def local_forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of a small set of links: (node, smallest node of its component), smallest left out."""
    nodes, inverse = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = inverse[: len(left)], inverse[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(nodes))
    return nodes[apart], nodes[label[apart]]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component``: every node that has a link, and the smallest node it can reach."""
    edges = links.select(F.greatest(left, right).alias("v"), F.least(left, right).alias("u")).where("u < v").distinct()
    edges = stored(edges, "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        # large star: larger neighbours, and the node itself, go to the smallest neighbour
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select("v", F.col("m").alias("u")).where("u < v").distinct()
        # small star: each node's smaller neighbours, and the node itself, go to the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v")
        edges = stored(small.unionByName(least.select("v", F.col("m").alias("u"))).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)), F.coalesce(F.sum("u"), F.lit(0))).first()
        if tuple(state) == seen:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
            )
        seen = tuple(state)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
