"""Overlay of generated rows on a baseline: who wins the value, who wins the position, what must survive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.operators.diff import missing_keys
from catalogspark.scale import number_rows, pinned


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], position: str, values: Sequence[str]) -> DataFrame:
    """Last value wins, at the first position: an aggregate, so any number of copies per key combines map-side."""
    return df.groupBy(*keys).agg(
        F.min(position).alias(position), F.max_by(F.struct(*values), position).alias("_v")
    ).select(*keys, position, *[F.col(f"_v.{v}").alias(v) for v in values])


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], position: str, values: Sequence[str]) -> DataFrame:
    """First value wins."""
    return df.groupBy(*keys).agg(
        F.min(position).alias(position), F.min_by(F.struct(*values), position).alias("_v")
    ).select(*keys, position, *[F.col(f"_v.{v}").alias(v) for v in values])


def merge_keyed(
    baseline: DataFrame, generated: DataFrame, parent: str, keys: Sequence[str], position: str, values: Sequence[str]
) -> DataFrame:
    """Union by key: the generated value wins, the baseline position wins, new rows follow after the last one.

    Both sides are de-duplicated and merged in one aggregate; only rows that are new to the baseline are
    numbered, skew-safely.
    """
    ids = [parent, *keys]
    b = dedupe_keep_last(baseline, ids, position, values).select(
        *ids, F.struct(*values).alias("b"), F.lit(None).cast(_struct_of(generated, values)).alias("g"),
        F.col(position).cast("long").alias("bp"), F.lit(None).cast("long").alias("gp"))
    g = dedupe_keep_last(generated, ids, position, values).select(
        *ids, F.lit(None).cast(_struct_of(baseline, values)).alias("b"), F.struct(*values).alias("g"),
        F.lit(None).cast("long").alias("bp"), F.col(position).cast("long").alias("gp"))
    merged = b.unionByName(g).groupBy(*ids).agg(
        F.max("b").alias("b"), F.max("g").alias("g"), F.max("bp").alias("bp"), F.max("gp").alias("gp"))
    value = F.coalesce("g", "b")
    origin = F.when(F.col("b").isNull(), "generated").when(F.col("g").isNull(), "baseline").otherwise("both")
    shaped = merged.select(*ids, "bp", "gp", *[value[v].alias(v) for v in values], origin.alias("origin"))
    return append_positions(shaped, parent, keys, position)


def _struct_of(df: DataFrame, values: Sequence[str]):
    return df.select(F.struct(*values).alias("s")).schema["s"].dataType


def append_positions(merged: DataFrame, parent: str, keys: Sequence[str], position: str) -> DataFrame:
    """Rows with a baseline position ``bp`` keep it; the others get max(bp) + 1, 2, … in order of ``gp``.

    The merged rows are used three times, so they are pinned once instead of being merged again.
    """
    merged = pinned(merged)
    last = merged.groupBy(F.col(parent).alias("_p")).agg(F.coalesce(F.max("bp"), F.lit(0)).alias("_last"))
    fresh = number_rows(merged.where("bp is null"), [parent], ["gp", *keys], "_n")
    placed = fresh.join(last, F.col(parent) == F.col("_p"), "left").withColumn(position, F.col("_last") + F.col("_n"))
    kept = merged.where("bp is not null").withColumn(position, F.col("bp"))
    drop = ["bp", "gp", "_n", "_p", "_last"]
    return kept.drop(*drop).unionByName(placed.drop(*drop))


def merge_relations(baseline: DataFrame, generated: DataFrame, parent: str, keys: Sequence[str], position: str) -> DataFrame:
    """Baseline relations stay as they are; generated ones that are not there yet follow in their own order."""
    ids = [parent, *keys]
    b = baseline.groupBy(*ids).agg(F.min(position).cast("long").alias("bp")).withColumn("gp", F.lit(None).cast("long"))
    g = generated.groupBy(*ids).agg(F.min(position).cast("long").alias("gp")).withColumn("bp", F.lit(None).cast("long"))
    merged = b.unionByName(g).groupBy(*ids).agg(F.max("bp").alias("bp"), F.max("gp").alias("gp"))
    return append_positions(merged, parent, keys, position)


def merge_managed(
    baseline: DataFrame, generated: DataFrame, parent: str, key: str, values: Sequence[str], managed: Column
) -> DataFrame:
    """Managed codes are replaced in place or appended; manual ones are kept; unmanaged generated ones are ignored.

    A parent without any baseline row takes all generated rows.
    """
    has_base = baseline.select(F.col(parent).alias("_bp")).distinct()
    b = baseline.select(parent, key, F.struct(*values).alias("b"))
    g = generated.select(F.col(parent).alias("g_parent"), F.col(key).alias("g_key"), F.struct(*values).alias("g"), managed.alias("g_managed"))
    joined = b.join(g, (F.col(parent) == F.col("g_parent")) & (F.col(key) == F.col("g_key")), "full_outer")
    owner = F.coalesce(F.col(parent), F.col("g_parent"))
    joined = joined.withColumn("_owner", owner).join(has_base, F.col("_owner") == F.col("_bp"), "left")
    use_generated = F.col("g").isNotNull() & (F.col("g_managed") | F.col("_bp").isNull())
    keep = F.col("b").isNotNull() | use_generated
    value = F.when(use_generated, F.col("g")).otherwise(F.col("b"))
    return joined.where(keep).select(
        F.col("_owner").alias(parent), F.coalesce(F.col(key), F.col("g_key")).alias(key),
        *[value[v].alias(v) for v in values],
        F.when(F.col("b").isNull(), "added").when(use_generated, "replaced").otherwise("kept").alias("origin"),
    )


def overlay_specifications(baseline: DataFrame, generated: DataFrame, parent: str, attribute: str, managed: Column) -> tuple[DataFrame, DataFrame]:
    """Unmanaged baseline rows plus all generated rows, and the attributes that then occur twice."""
    merged = baseline.where(~managed).unionByName(generated.select(*baseline.columns))
    clash = merged.groupBy(parent, F.upper(F.trim(F.col(attribute))).alias(attribute)).agg(F.count(F.lit(1)).alias("copies"))
    return merged, clash.where("copies > 1")


def overlay_header(baseline: DataFrame, generated: DataFrame, key: str, generated_wins: Sequence[str], baseline_wins: Sequence[str]) -> DataFrame:
    """Scalar overlay of generated products: new ones as they are, existing ones by the policy per column."""
    b = baseline.select(F.col(key).alias("_bk"), *[F.col(c).alias(f"b_{c}") for c in baseline_wins])
    joined = generated.join(b, F.upper(F.trim(F.col(key))) == F.upper(F.trim(F.col("_bk"))), "left")
    known = F.col("_bk").isNotNull()
    return joined.select(
        key, *generated_wins, *[F.when(known, F.col(f"b_{c}")).otherwise(F.col(c)).alias(c) for c in baseline_wins],
        F.when(known, "overlay").otherwise("new").alias("origin"),
    )


def lost_rows(baseline: DataFrame, generated: DataFrame, parent: str, keys: Sequence[str], collection: str) -> DataFrame:
    """Baseline associations that a generated product (one that has the parent) would remove."""
    covered = baseline.join(generated.select(parent).distinct(), parent, "left_semi")
    return missing_keys(covered, generated, [parent, *keys]).select(
        parent, F.lit(collection).alias("collection"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"))


def merge_latest(sources: Sequence[DataFrame], key: str, fields: Sequence[str]) -> DataFrame:
    """Merge by code; for every field the last source that has a value wins."""
    stacked = None
    for rank, df in enumerate(sources):
        one = df.select(key, *[F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields], F.lit(rank).alias("_r"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked.groupBy(key).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), F.col("_r"))).alias(f) for f in fields])
