"""Image variants: the one original per path, duplicates by content, order and cover, re-use of earlier work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.scale import number_rows


def canonical_path(url: Column) -> Column:
    """Address without query and fragment, lower-cased host."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    host = F.regexp_extract(bare, r"^([a-zA-Z]+://[^/]+)", 1)
    return F.concat(F.lower(host), F.substring(bare, F.length(host) + 1, F.lit(1 << 30)))


def original_per_path(images: DataFrame, keys: Sequence[str], original: Column, pick: str) -> DataFrame:
    """Per group of variants: its original when there is exactly one, else a problem. Counts and minima only."""
    grouped = images.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("variants"), F.count_if(original).alias("originals"), F.min(F.when(original, F.col(pick))).alias("_pick"))
    one = F.col("originals") == 1
    return grouped.select(
        *keys, "variants", F.when(one, F.col("_pick")).alias(pick),
        F.when(F.col("originals") == 0, "no-original").when(~one, "several-originals").alias("problem"))


def ordered_media(images: DataFrame, owner: str, sha: str, order: Sequence[str], cover: Column | None = None) -> DataFrame:
    """One row per (owner, content) in order, numbered; the chosen cover leads, its copy in the gallery is dropped."""
    lead = F.lit(0) if cover is None else F.when(F.coalesce(cover, F.lit(False)), 0).otherwise(1)
    best = images.groupBy(owner, sha).agg(F.min(F.struct(lead.alias("_lead"), *order)).alias("_b"), F.count(F.lit(1)).alias("copies"))
    flat = best.select(owner, sha, "copies", "_b.*")
    numbered = number_rows(flat, [owner], ["_lead", *order, sha], "media_order")
    return numbered.select(owner, sha, *order, "copies", "media_order", (F.col("media_order") == 1).alias("is_cover"))


def media_summary(images: DataFrame, owner: str, sha: str, size: str) -> DataFrame:
    """One row: unique contents and their bytes, owner links, copies left out."""
    pairs = images.groupBy(owner, sha).agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("b"))
    blobs = pairs.groupBy(sha).agg(F.max("b").alias("b"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("links"))
    return blobs.agg(
        F.count(F.lit(1)).alias("blobs"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("links"), F.coalesce(F.sum(F.col("n") - F.col("links")), F.lit(0)).alias("copies_omitted"))


def reuse_split(wanted: DataFrame, prior: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Work already done in an earlier manifest, and what is left to do."""
    keys = wanted.select(key).distinct()
    return prior.join(keys, key, "left_semi"), keys.join(prior.select(key).distinct(), key, "left_anti")
