"""Category trees as adjacency tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.scale import pinned


def ancestors(
    edges: DataFrame, code: str, parent: str, start: DataFrame | None = None, rounds: list[int] | None = None
) -> DataFrame:
    """(code, ancestor, distance) pairs of all nodes, or of the ``start`` codes only, by pointer doubling.

    A table of jumps leads from each node over 2^k parents; joined with itself it gives the jumps over 2^(k+1). A round
    adds the pairs that lie one such jump further, so a tree of depth d takes about log2(d) rounds, each of two equi-joins
    with unique keys on the jump side. Rounds end when no node has a jump left, at any depth. Without a cycle every round
    leaves fewer nodes with a jump (one that stands just 2^k deep has no longer one), so a round that leaves as many is
    refused. Every round is pinned by a reliable checkpoint. ``rounds`` receives the number of those nodes per round.
    """
    jump = edges.where(F.col(parent).isNotNull()).select(F.col(code).alias("_c"), F.col(parent).alias("_p")).distinct()
    jump = pinned(jump)
    seeds = (jump.select(F.col("_c").alias(code)) if start is None else start.select(code)).distinct()
    reached = seeds.select(code, F.col(code).alias("ancestor"), F.lit(0).alias("distance"))
    span, before = 1, None
    while left := jump.agg(F.count_distinct("_c").alias("n")).first()["n"]:
        if left == before:
            raise ValueError("the tree has a cycle")
        if rounds is not None:
            rounds.append(left)
        further = reached.join(jump, reached["ancestor"] == jump["_c"]).select(
            reached[code], F.col("_p").alias("ancestor"), (F.col("distance") + span).cast("int").alias("distance"))
        reached = pinned(reached.unionByName(further))
        after = jump.select(F.col("_c").alias("_m"), F.col("_p").alias("_q"))
        jump = pinned(jump.join(after, jump["_p"] == after["_m"]).select("_c", F.col("_q").alias("_p")))
        span, before = span * 2, left
    return reached.where("distance > 0")


def missing_with_ancestors(desired: DataFrame, reference: DataFrame, code: str, parent: str) -> DataFrame:
    """Nodes absent from the reference, together with their absent ancestors."""
    have = reference.select(code).distinct()
    absent = pinned(desired.select(code).distinct().join(have, code, "left_anti"))
    parents = ancestors(desired, code, parent, start=absent).select(F.col("ancestor").alias(code)).distinct()
    needed = parents.join(have, code, "left_anti")
    keys = absent.unionByName(needed).distinct()
    return desired.join(keys, code, "left_semi")


def broken_parents(nodes: DataFrame, code: str, parent: str) -> DataFrame:
    """Nodes whose parent is not a node, or that are their own parent."""
    have = nodes.select(F.col(code).alias("_h")).distinct()
    lost = nodes.where(F.col(parent).isNotNull()).join(have, F.col(parent) == F.col("_h"), "left_anti").select(
        code, F.lit("missing-parent").alias("problem"))
    return lost.unionByName(nodes.where(F.col(code) == F.col(parent)).select(code, F.lit("own-parent").alias("problem")))
