"""Locale fallback, coverage, re-mapping and merging of translations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.text import alias_locale, canonical_locale
from catalogspark.scale import explode_rows, literal_table

#: Fallback order after the locale itself and its aliases.
FALLBACKS = ("en", "ru", "zh")


def locale_candidates(target: str, aliases: Mapping[str, str], fallbacks: Sequence[str] = FALLBACKS) -> list[str]:
    """Languages to try for a target: itself, the codes that alias to it, then the fallbacks."""
    own = [source for source, to in aliases.items() if to.lower() == target.lower()]
    return list(dict.fromkeys([target, *own, *fallbacks]))


def names_by_language(rows: DataFrame, key: str, lang: str, name: str, order: str) -> DataFrame:
    """First non-empty name per (key, language) in row order."""
    filled = rows.where((F.trim(F.col(lang)) != "") & (F.trim(F.col(name)) != ""))
    return filled.groupBy(key, F.trim(F.col(lang)).alias(lang)).agg(F.min_by(F.trim(F.col(name)), order).alias(name))


def names_map(names: DataFrame, key: str, lang: str, name: str) -> DataFrame:
    """``map<language, name>`` per key; at most one entry per language, so the map stays small."""
    entries = F.collect_list(F.struct(F.col(lang), F.col(name)))
    return names.groupBy(key).agg(F.map_from_entries(entries).alias("names"))


def localized_names(
    names: DataFrame, key: str, lang: str, name: str, locales: Sequence[str],
    aliases: Mapping[str, str], fallbacks: Sequence[str] = FALLBACKS,
) -> DataFrame:
    """One row per (key, locale) with the best name: exact, alias, fallbacks, else the key itself.

    Languages are folded into one small map per key first (one shuffle); the locales are then a literal
    array that is exploded, not a cross join.
    """
    by_lang = names_map(names, key, lang, name)

    def pick(target: str) -> Column:
        tried = [F.struct(F.col("names")[c].alias("name"), F.lit(c).alias("used")) for c in locale_candidates(target, aliases, fallbacks)]
        found = F.get(F.filter(F.array(*tried), lambda t: t["name"].isNotNull()), F.lit(0))
        return F.struct(F.lit(target).alias("locale"), found["name"].alias("name"), found["used"].alias("used"))

    rows = by_lang.select(key, F.explode(F.array(*[pick(t) for t in locales])).alias("p"))
    return rows.select(
        key, "p.locale", F.coalesce("p.name", F.col(key).cast("string")).alias("name"),
        F.coalesce("p.used", F.lit("key")).alias("used_locale"),
    )


def missing_locales(df: DataFrame, key: str, lang: str, required: Sequence[str]) -> DataFrame:
    """Required locales a key lacks, one row each. The set per key is bounded by the number of locales."""
    wanted = F.array(*[F.lit(r.lower()) for r in required])
    have = df.groupBy(key).agg(F.collect_set(F.lower(F.trim(F.col(lang)))).alias("_have"))
    return explode_rows(have, [key], F.array_except(wanted, "_have"), "locale")


def duplicate_locales(df: DataFrame, key: str, lang: str) -> DataFrame:
    """(key, locale) pairs that occur more than once after lower-casing."""
    pairs = df.groupBy(key, F.lower(F.trim(F.col(lang))).alias("locale")).agg(F.count(F.lit(1)).alias("copies"))
    return pairs.where("copies > 1")


def locale_coverage(df: DataFrame, key: str, lang: str, expected: Sequence[str] = ()) -> DataFrame:
    """Distinct keys per locale, with expected locales that have none, and unexpected ones marked."""
    pairs = df.select(key, F.lower(F.trim(F.col(lang))).alias("locale")).distinct()
    counts = pairs.groupBy("locale").agg(F.count(F.lit(1)).alias("entities"))
    if not expected:
        return counts
    wanted = F.broadcast(literal_table(df.sparkSession, ["locale", "expected"], [(e.lower(), True) for e in expected]))
    joined = counts.join(wanted, "locale", "full_outer")
    return joined.select("locale", F.coalesce("entities", F.lit(0)).alias("entities"), F.coalesce("expected", F.lit(False)).alias("expected"))


def coverage_matrix(df: DataFrame, key: str, lang: str, locales: Sequence[str]) -> DataFrame:
    """Every (key, locale) pair with a presence flag."""
    have = df.groupBy(key).agg(F.collect_set(F.lower(F.trim(F.col(lang)))).alias("_have"))
    targets = F.array(*[F.lit(x.lower()) for x in locales])
    return have.select(key, "_have", F.explode(targets).alias("locale")).select(
        key, "locale", F.array_contains(F.col("_have"), F.col("locale")).alias("present")
    )


def partial_fields(df: DataFrame, keys: Sequence[str], lang: str, locales: int) -> DataFrame:
    """Attributes that exist in some locales only."""
    seen = df.groupBy(*keys).agg(F.count_distinct(F.lower(F.trim(F.col(lang)))).alias("locales"))
    return seen.where(F.col("locales") < locales)


def remap_locales(df: DataFrame, key: str, lang: str, aliases: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows under their target locale, and the collisions where two source locales meet in one target."""
    moved = df.withColumn("_source", F.col(lang)).withColumn(lang, alias_locale(lang, aliases))
    clashes = (
        moved.groupBy(key, lang).agg(F.count(F.lit(1)).alias("sources"), F.min("_source").alias("first_source"), F.max("_source").alias("last_source"))
        .where("sources > 1")
    )
    return moved.drop("_source"), clashes


def merge_translations(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows replace base rows with the same keys; all other base rows stay."""
    kept = base.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(incoming.select(*base.columns))


def localized_text_map(value: Column | str, pattern: str = r"^[a-z]{2,3}(-[A-Za-z0-9]{2,8})*$") -> Column:
    """Only the entries of a map whose key is a locale, with trimmed non-empty text."""
    col = F.col(value) if isinstance(value, str) else value
    kept = F.map_filter(col, lambda k, v: k.rlike(pattern) & (F.trim(v) != ""))
    return F.transform_keys(F.transform_values(kept, lambda k, v: F.trim(v)), lambda k, v: canonical_locale(k))


def label(df: DataFrame, code: str, lang: str, dictionary: DataFrame, fallback: Column) -> DataFrame:
    """Curated label for (code, lang), else the fallback; ``label_source`` tells which.

    The dictionary must be unique per (code, lang); it is joined by shuffle or broadcast as AQE sees fit.
    """
    d = dictionary.select(F.col(code), F.col(lang), F.col("label").alias("_label"))
    return df.join(d, [code, lang], "left").select(
        *df.columns, F.coalesce("_label", fallback).alias("label"),
        F.when(F.col("_label").isNull(), "fallback").otherwise("curated").alias("label_source"),
    )


def label_conflicts(dictionary: DataFrame, code: str, lang: str, fallback: DataFrame) -> DataFrame:
    """Codes whose curated English label differs from the label observed in the data."""
    english = dictionary.where(F.lower(F.col(lang)).isin("en", "en-us")).select(code, F.col("label").alias("curated"))
    return english.join(fallback, code, "inner").where(F.col("curated") != F.col("observed"))


def catalog_policy(assignments: DataFrame, catalog: str, mode: str, target: str) -> DataFrame:
    """``preserve`` keeps every assignment, ``target-only`` those of one catalog."""
    if mode == "preserve":
        return assignments
    if mode != "target-only":
        raise ValueError(f"unknown assignment mode {mode!r}")
    return assignments.where(F.upper(F.trim(F.col(catalog))) == target.upper())


def localized_content(
    texts: DataFrame, key: str, lang: str, text: str, locales: Sequence[str], fallbacks: Sequence[str] = ("en",)
) -> tuple[DataFrame, DataFrame]:
    """Content per (key, locale) with fallback, and one loss event for every pair that had to fall back."""
    picked = localized_names(names_by_language(texts, key, lang, text, text), key, lang, text, locales, {}, fallbacks)
    content = picked.where(F.col("used_locale") != "key")
    events = picked.where(F.col("used_locale") != F.col("locale")).select(
        key, "locale", F.when(F.col("used_locale") == "key", "no-content").otherwise("fallback").alias("event"),
        F.nullif(F.col("used_locale"), F.lit("key")).alias("source_locale"),
    )
    return content, events
