"""Category placement: bindings, coverage, usage, reference availability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.scale import number_rows, with_scalars


def bind_products(categories: DataFrame, assignments: DataFrame, category: str, product: str, order: Sequence[str]) -> DataFrame:
    """Bridge rows (category, product, position); a category without products keeps one row with NULLs.

    The list of a category stays rows (numbered skew-safely), never one array: a category may be very large.
    """
    extra = [o for o in order if o not in (category, product)]
    distinct = assignments.select(category, product, *extra).distinct()
    placed = number_rows(distinct, [category], [*order, product], "position")
    return categories.select(category).distinct().join(placed.select(category, product, "position"), category, "left")


def placement_summary(products: DataFrame, assignments: DataFrame, product: str, category: str) -> DataFrame:
    """One row: pairs bound, products assigned and not assigned. Both sides meet on the distinct product."""
    pairs = assignments.select(product, category).distinct()
    per = pairs.groupBy(product).agg(F.count(F.lit(1)).alias("_n"))
    joined = products.select(product).distinct().join(per, product, "left")
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("bound_pairs"), F.count_if(F.col("_n").isNotNull()).alias("assigned"),
        F.count_if(F.col("_n").isNull()).alias("unassigned"))


def coverage_histogram(products: DataFrame, assignments: DataFrame, product: str, category: str) -> DataFrame:
    """Products by their number of distinct categories, zero included."""
    per = assignments.groupBy(product).agg(F.count_distinct(category).alias("categories"))
    counts = products.select(product).distinct().join(per, product, "left").select(F.coalesce("categories", F.lit(0)).alias("categories"))
    return counts.groupBy("categories").agg(F.count(F.lit(1)).alias("products"))


def coverage_summary(assignments: DataFrame, product: str, category: str, prefixes: Sequence[str]) -> DataFrame:
    """One row: distinct categories, assignments, min/max per product, pairs per code prefix."""
    pairs = assignments.select(product, category).distinct()
    per = pairs.groupBy(product).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(category).startswith(p)).alias(f"n_{i}") for i, p in enumerate(prefixes)])
    totals = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("assignments"), F.min("n").alias("fewest"), F.max("n").alias("most"),
        *[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"prefix_{p.strip('-').lower()}") for i, p in enumerate(prefixes)])
    distinct = pairs.agg(F.count_distinct(category).alias("categories"))
    return with_scalars(totals, distinct)


def category_usage(assignments: DataFrame, category: str, product: str) -> DataFrame:
    """Distinct products per category."""
    return assignments.groupBy(category).agg(F.count_distinct(product).alias("products"))


def missing_categories(assignments: DataFrame, reference: DataFrame, category: str) -> DataFrame:
    """Used categories that the reference lacks, with the number of their products."""
    used = assignments.groupBy(category).agg(F.count(F.lit(1)).alias("uses"))
    return used.join(reference.select(category).distinct(), category, "left_anti")


def unavailable_codes(rows: DataFrame, key: str, codes: Mapping[str, str], dictionaries: DataFrame) -> DataFrame:
    """Codes used in named columns that their dictionary lacks. ``dictionaries`` is ``(dictionary, code)``."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dictionary"), F.upper(F.trim(F.col(c).cast("string"))).alias("code")) for c, d in codes.items()])
    used = rows.select(F.explode(pairs).alias("u")).select("u.*").where("code is not null")
    counted = used.groupBy("dictionary", "code").agg(F.count(F.lit(1)).alias("uses"))
    return counted.join(dictionaries.select("dictionary", F.upper(F.trim(F.col("code"))).alias("code")).distinct(), ["dictionary", "code"], "left_anti")


def assignment_problems(assignments: DataFrame, product: str, catalog: str, category: str, allowed: Sequence[str]) -> DataFrame:
    """Blank codes, foreign catalogs and repeated pairs, one row per (product, catalog, category)."""
    blank: Column = (F.coalesce(F.trim(F.col(catalog)), F.lit("")) == "") | (F.coalesce(F.trim(F.col(category)), F.lit("")) == "")
    grouped = assignments.groupBy(product, catalog, category).agg(F.count(F.lit(1)).alias("copies"))
    problem = (
        F.when(blank, "blank-code").when(~F.upper(F.trim(F.col(catalog))).isin(*[a.upper() for a in allowed]), "foreign-catalog")
        .when(F.col("copies") > 1, "duplicate-pair"))
    return grouped.select(product, catalog, category, problem.alias("problem")).where("problem is not null")


def binding_parity(assignments: DataFrame, bound: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(product, category) pairs that only the products or only the bindings have."""
    from catalogspark.operators.diff import set_equality

    return set_equality(assignments, bound.where(F.col(keys[0]).isNotNull()), list(keys))
