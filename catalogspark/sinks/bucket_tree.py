"""Snapshots with a tree of bucket digests: two of them are compared from the root, and only differing buckets are read.

Rows lie in folders by hash bucket of their key. A leaf is the set digest of a bucket; a node is the digest of its
``FAN`` children in order. The tree is a small table (level, node, sha256); a comparison joins one level after the other,
and of each only the children of nodes that differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions.canon import key_bucket, row_digest, set_digest
from catalogspark.operators.diff import structural_diff

#: Children of a node.
FAN = 16


@dataclass
class Comparison:
    """``rows``: bucket, columns, added, removed. ``buckets``: those that differ. ``levels``: nodes looked at per level."""

    rows: DataFrame
    buckets: list[int]
    levels: list[int]


def write_tree(df: DataFrame, root: str, key: str, depth: int = 2) -> None:
    """Data in FAN^depth buckets, then the tree over what is stored; a snapshot without a tree does not count."""
    spark, buckets = df.sparkSession, FAN**depth
    placed = df.withColumn("bucket", key_bucket(F.col(key).cast("string"), buckets).cast("int"))
    # hashed unique keys: even buckets; the number is given, so that few tasks are never made to write them all
    placed.repartition(buckets, "bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{root}/data")
    stored = spark.read.parquet(f"{root}/data")
    digested = stored.withColumn("_h", row_digest(stored, df.columns))
    nodes = set_digest(digested, "_h", by=["bucket"]).select(F.lit(depth).alias("level"), F.col("bucket").cast("int").alias("node"), F.col("set_sha256").alias("sha256"))
    tree = nodes
    for level in range(depth - 1, -1, -1):
        child = F.sort_array(F.collect_list(F.struct("node", "sha256")))  # at most FAN
        text = F.array_join(F.transform(child, lambda c: F.concat_ws(":", c["node"].cast("string"), c["sha256"])), "\n")
        nodes = nodes.groupBy(F.floor(F.col("node") / FAN).cast("int").alias("parent")).agg(F.sha2(text, 256).alias("sha256"))
        nodes = nodes.select(F.lit(level).alias("level"), F.col("parent").alias("node"), "sha256")
        tree = tree.unionByName(nodes)
    tree.coalesce(1).write.mode("errorifexists").partitionBy("level").parquet(f"{root}/tree")


def _level(spark: SparkSession, root: str, level: int) -> DataFrame:
    return spark.read.schema("node int, sha256 string").parquet(f"{root}/tree/level={level}")


def compare_trees(spark: SparkSession, old: str, new: str, columns: Sequence[str], depth: int = 2) -> Comparison:
    """The rows in which two snapshots of the same depth differ; equal subtrees are never entered."""
    differ, looked = [0], []
    for level in range(depth + 1):
        a = _level(spark, old, level).where(F.col("node").isin(differ)).withColumnRenamed("sha256", "o")
        b = _level(spark, new, level).where(F.col("node").isin(differ)).withColumnRenamed("sha256", "n")
        nodes = a.join(b, "node", "full_outer").select("node", F.col("o").eqNullSafe(F.col("n")).alias("same")).collect()  # children of differing nodes
        looked.append(len(nodes))
        bad = sorted(r["node"] for r in nodes if not r["same"])
        if not bad or level == depth:
            break
        differ = [child for n in bad for child in range(n * FAN, (n + 1) * FAN)]
    else:
        bad = []
    buckets = bad if level == depth else []

    def read(root: str) -> DataFrame:
        return spark.read.parquet(f"{root}/data").where(F.col("bucket").isin(buckets)).select("bucket", *columns)

    rows = structural_diff(read(new), read(old), ["bucket", *columns])
    return Comparison(rows, buckets, looked)
