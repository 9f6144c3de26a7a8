"""Order-dependent checks without global windows: row ids, pages, adjacent rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import limb_digest, limb_sums
from catalogspark.scale import explode_rows, neighbours, with_scalars


def not_increasing(df: DataFrame, keys: Sequence[str], position: str, value: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows whose value is not greater than that of the row before.

    ``position`` counts the rows of a key without gaps (a file's row index, or a number from ``number_rows``); ids with
    gaps are no positions.
    """
    seen = neighbours(df.select(*keys, position, value, *carry), keys, position, [value])
    return seen.where(F.col(value) <= F.col(f"_prev.{value}")).select(*keys, position, value, *carry, F.col(f"_prev.{value}").alias("previous"))


def file_positions(df: DataFrame) -> DataFrame:
    """Adds the dense row position inside each file of a Parquet scan, with the file it comes from."""
    return df.withColumn("file", F.col("_metadata.file_path")).withColumn("position", F.col("_metadata.row_index"))


def pair_adjacent(df: DataFrame, key: str, position: str, role: str, text: str, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """(first, second) pairs of directly following rows, and every first or second row that found no partner."""
    seen = neighbours(df.select(key, position, role, text), [key], position, [role, text])
    is_pair = (F.col(role) == first) & (F.col(f"_next.{role}") == second)
    pairs = seen.where(is_pair).select(
        key, position, F.col(text).alias("question"), F.col(f"_next.{text}").alias("answer"))
    problem = (
        F.when((F.col(role) == first) & F.col("_next").isNull(), "unanswered")
        .when((F.col(role) == first) & (F.col(f"_next.{role}") != second), "not-followed-by-answer")
        .when((F.col(role) == second) & ~F.coalesce(F.col(f"_prev.{role}") == first, F.lit(False)), "answer-without-question"))
    return pairs, seen.select(key, position, role, problem.alias("problem")).where("problem is not null")


def page_facts(items: DataFrame, page: str, slot: str, item: str) -> DataFrame:
    """Per page: items, distinct items, digest over (slot, item). Constant state per page, even for an over-full one."""
    hashed = items.withColumn("_h", F.sha2(F.concat_ws(":", F.col(slot).cast("string"), F.col(item).cast("string")), 256))
    facts = hashed.groupBy(page).agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct(item).alias("distinct_items"), *limb_sums("_h"))
    return facts.select(page, "items", "distinct_items", limb_digest("items").alias("page_sha256"))


def page_problems(facts: DataFrame, page: str, page_size: int) -> DataFrame:
    """Gaps, short pages before the last, over-full pages, repeats inside a page, pages with the same digest."""
    last = facts.agg(F.max(page).alias("_last"))
    following = facts.select((F.col(page) - 1).alias(page), F.lit(True).alias("_has_next"))
    same = facts.groupBy("page_sha256").agg(F.count(F.lit(1)).alias("_same"), F.min(page).alias("_first"))
    joined = with_scalars(facts.join(following, page, "left").join(same, "page_sha256", "left"), last)
    inner = F.col(page) < F.col("_last")
    checks = [
        ("next-page-missing", inner & F.col("_has_next").isNull()), ("short-page", inner & (F.col("items") < page_size)),
        ("over-full", F.col("items") > page_size), ("repeat-in-page", F.col("distinct_items") < F.col("items")),
        ("repeated-page", (F.col("_same") > 1) & (F.col(page) > F.col("_first"))),
    ]
    hits = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks]))
    return explode_rows(joined, [page], hits, "problem")


def cross_page_duplicates(items: DataFrame, page: str, item: str) -> DataFrame:
    """Items listed on more than one page."""
    return items.groupBy(item).agg(F.count_distinct(page).alias("pages"), F.min(page).alias("first_page")).where("pages > 1")


def terminal_probe(facts: DataFrame, page: str, probed: DataFrame) -> DataFrame:
    """The page after the last one must be empty: one row with the verdict."""
    last = facts.agg(F.max(page).alias("last_page"))
    return with_scalars(last, probed.agg(F.count(F.lit(1)).alias("probe_items"))).withColumn("complete", F.col("probe_items") == 0)
