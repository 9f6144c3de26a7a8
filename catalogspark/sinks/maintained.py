"""Digests and counts of a live table that are kept up by difference: a batch's old rows go out, its new rows come in.

The state is one row per group: how many rows, and the limb sums of their digests. Both can be added and subtracted, so
the state after a batch follows from the state before it and the batch alone; the table itself is not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions.canon import limb_digest, limb_sums, row_digest
from catalogspark.scale import path_exists, same_keys

_LIMBS = [f"_limb{i}" for i in range(4)]


def group_sums(rows: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by…, row_count, limbs`` of some rows."""
    return rows.withColumn("_h", row_digest(rows, list(columns))).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *limb_sums("_h"))


def start(spark: SparkSession, root: str, rows: DataFrame, columns: Sequence[str], by: Sequence[str]) -> None:
    """The first state, from the whole table: the only time that it is read."""
    group_sums(rows, columns, by).write.mode("errorifexists").parquet(f"{root}/version=0")


def update(spark: SparkSession, root: str, version: int, removed: DataFrame, added: DataFrame, columns: Sequence[str], by: Sequence[str]) -> None:
    """State ``version`` from the one before it, without the rows ``removed`` and with those ``added``.

    The batch is aggregated first; the old state has a row per group. A version that is written again is the same.
    """
    before = spark.read.parquet(f"{root}/version={version - 1}")
    minus = group_sums(removed, columns, by).select(*by, (-F.col("row_count")).alias("row_count"), *[(-F.col(c)).alias(c) for c in _LIMBS])
    parts = before.unionByName(minus).unionByName(group_sums(added, columns, by))
    sums = parts.groupBy(*by).agg(F.sum("row_count").alias("row_count"), *[F.sum(c).cast("decimal(30,0)").alias(c) for c in _LIMBS])
    lost = sums.where("row_count < 0").limit(1).count()
    if lost:
        raise ValueError("more rows were removed than a group holds")
    sums.where("row_count > 0").write.mode("overwrite").parquet(f"{root}/version={version}")


def current(spark: SparkSession, root: str, version: int, by: Sequence[str]) -> DataFrame:
    """``by…, row_count, set_sha256``: the digests of a version, as :func:`~catalogspark.functions.canon.set_digest` gives them."""
    state = spark.read.parquet(f"{root}/version={version}")
    return state.select(*by, "row_count", limb_digest("row_count").alias("set_sha256"))


def drift(spark: SparkSession, root: str, version: int, rows: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Groups whose kept state is not that of the rows: an audit that reads the table."""
    if not path_exists(spark, f"{root}/version={version}"):
        raise ValueError(f"no version {version} below {root}")
    kept = current(spark, root, version, by)
    found = group_sums(rows, columns, by).select(*[F.col(c).alias(f"_f_{c}") for c in by], F.col("row_count").alias("found_rows"), limb_digest("row_count").alias("found_sha256"))
    found_as = found.withColumnsRenamed({f"_f_{c}": c for c in by})
    both = kept.join(found_as, same_keys(kept, found_as, by), "full_outer")
    names = [F.coalesce(kept[c], found_as[c]).alias(c) for c in by]
    return both.where(~F.col("set_sha256").eqNullSafe(F.col("found_sha256"))).select(*names, "row_count", "found_rows")
