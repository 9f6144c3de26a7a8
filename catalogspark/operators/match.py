"""Entity matching by tiers, duplicate groups, one-to-one coverage. Counts decide; pairs are never formed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tier(catalog: DataFrame, keys: Sequence[str], code: str, tag: str) -> DataFrame:
    """Catalog reduced to one row per key: how many entities share it, and one of them."""
    return catalog.groupBy(*[F.col(k).alias(f"{tag}_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias(f"{tag}_n"), F.min(code).alias(f"{tag}_code"))


def cascade_match(observed: DataFrame, catalog: DataFrame, key: str, code: str, first: str, second: str, third: str) -> DataFrame:
    """Match on the first key; if it is shared, also on the second; if still shared, on the third; else ambiguous.

    Each tier is a dictionary with one row per key, so an observed row meets at most one row per tier, however
    many catalog entities share the key.
    """
    tiers = [("a", [first]), ("b", [first, second]), ("c", [first, second, third]), ("d", [first, third])]
    out = observed
    for tag, keys in tiers:
        side = _tier(catalog, keys, code, tag)
        cond = F.lit(True)
        for k in keys:
            cond = cond & (out[k] == side[f"{tag}_{k}"])
        out = out.join(side, cond, "left").drop(*[f"{tag}_{k}" for k in keys])
    n = {tag: F.coalesce(F.col(f"{tag}_n"), F.lit(0)) for tag, _ in tiers}
    last_n = F.when(n["b"] > 1, n["c"]).otherwise(n["d"])
    last_code = F.when(n["b"] > 1, F.col("c_code")).otherwise(F.col("d_code"))
    method = (
        F.when(n["a"] == 0, "none").when(n["a"] == 1, "first").when(n["b"] == 1, "first+second")
        .when(last_n == 1, "first+third").otherwise("ambiguous"))
    found = F.when(n["a"] == 1, F.col("a_code")).when(n["a"] == 0, None).when(n["b"] == 1, F.col("b_code")).when(last_n == 1, last_code)
    return out.select(key, method.alias("method"), found.alias("matched"))


def claimed_twice(matches: DataFrame, matched: str = "matched") -> DataFrame:
    """Entities that more than one observed row was matched to."""
    return matches.where(F.col(matched).isNotNull()).groupBy(matched).agg(F.count(F.lit(1)).alias("claims")).where("claims > 1")


def duplicate_groups(df: DataFrame, group_key, label: str) -> DataFrame:
    """Groups of entities with the same key: size, and its first and last label (no list of members)."""
    return df.groupBy(group_key.alias("group_key")).agg(
        F.count(F.lit(1)).alias("members"), F.min(label).alias("first_member"), F.max(label).alias("last_member")
    ).where("members > 1")


def coverage_violations(mappings: DataFrame, items: DataFrame, patches: DataFrame, key: str, status: str) -> DataFrame:
    """Mappings and items must be one-to-one; updates and drafts need a patch, a noop must not have one.

    Three tagged inputs, one aggregate per key.
    """
    def tagged(df: DataFrame, m: int, i: int, p: int, st) -> DataFrame:
        return df.select(F.col(key), F.lit(m).alias("m"), F.lit(i).alias("i"), F.lit(p).alias("p"), st.cast("string").alias("st"))

    none = F.lit(None)
    stacked = tagged(mappings, 1, 0, 0, F.col(status)).unionByName(tagged(items, 0, 1, 0, none)).unionByName(tagged(patches, 0, 0, 1, none))
    k = stacked.groupBy(key).agg(F.sum("m").alias("m"), F.sum("i").alias("i"), F.sum("p").alias("p"), F.max("st").alias("st"))
    wants = F.col("st").isin("matched-update", "missing-create-draft")
    problem = (
        F.when(F.col("m") == 0, "unmapped").when(F.col("i") == 0, "unknown-item").when((F.col("m") > 1) | (F.col("i") > 1), "not-unique")
        .when(wants & (F.col("p") == 0), "patch-missing").when(~wants & (F.col("p") > 0), "patch-unexpected"))
    return k.select(key, problem.alias("problem")).where("problem is not null")
