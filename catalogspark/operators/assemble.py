"""Dumps and attribute values to entities: overlay of details, star assembly, packs, relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.functions.canon import key_bucket, row_digest, set_digest


def prune(df: DataFrame, excluded: Sequence[str] = (), row_id: str = "__rowid__") -> DataFrame:
    """Dump rows without the row id and the named columns (the scan then reads only what is left)."""
    return df.drop(row_id, *excluded)


def allow_list(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Only the allowed columns, and only scalar ones."""
    nested = ("ArrayType", "MapType", "StructType", "VariantType")
    bad = [f.name for f in df.schema.fields if f.name in allowed and type(f.dataType).__name__ in nested]
    if bad:
        raise ValueError(f"not scalar: {', '.join(bad)}")
    return df.select(*[a for a in allowed if a in df.columns])


def unpivot_fields(df: DataFrame, key: str, section: str, fields: Mapping[str, Column]) -> DataFrame:
    """Wide columns as attribute-value rows ``(key, section, field, value)``; absent values give no row."""
    rows = F.array(*[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value")) for n, c in fields.items()])
    return (
        df.select(key, F.lit(section).alias("section"), F.explode(rows).alias("r"))
        .select(key, "section", "r.field", "r.value").where("value is not null")
    )


def overlay_fields(card: DataFrame, details: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Detail values override card values where the detail *has* the value, even if it is NULL.

    ``details`` carries ``has_<value>`` flags next to each value, so presence and NULL stay apart. Keys are
    unique on both sides; one full outer join.
    """
    c = card.select(*[F.col(k).alias(f"c_{k}") for k in keys], *[F.col(v).alias(f"c_{v}") for v in values], F.lit(True).alias("_card"))
    d = details.select(*[F.col(k).alias(f"d_{k}") for k in keys], *[F.col(v).alias(f"d_{v}") for v in values],
                       *[F.col(f"has_{v}") for v in values], F.lit(True).alias("_detail"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"c_{k}") == F.col(f"d_{k}"))
    joined = c.join(d, cond, "full_outer")
    chosen = [F.when(F.coalesce(F.col(f"has_{v}"), F.lit(False)), F.col(f"d_{v}")).otherwise(F.col(f"c_{v}")).alias(v) for v in values]
    origin = F.when(F.col("_card").isNull(), "detail").when(F.col("_detail").isNull(), "card").otherwise("both")
    return joined.select(*[F.coalesce(f"c_{k}", f"d_{k}").alias(k) for k in keys], *chosen, origin.alias("origin"))


def assemble_cards(
    entities: DataFrame, key: str, locales: Sequence[str], children: Mapping[str, DataFrame]
) -> DataFrame:
    """Header per (entity, locale) with the number of rows in every child table.

    Children stay long tables next to the header and are only counted here: an entity with very many child
    rows is one pre-aggregated row before the join. Locales are a literal array, exploded last.
    """
    out = entities
    for name, child in children.items():
        counts = child.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        out = out.join(counts, key, "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0)))
    return out.withColumn("locale", F.explode(F.array(*[F.lit(x) for x in locales])))


def pack_layout(fields: DataFrame, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    """Attribute rows with their bucket, range-partitioned and sorted so that a key's rows lie together.

    The range uses all keys, so even one very large key is spread over several files.
    """
    bucketed = fields.withColumn("bucket", key_bucket(F.col(keys[0]).cast("string"), buckets).cast("int"))
    return bucketed.repartitionByRange("bucket", *keys).sortWithinPartitions("bucket", *keys)


def pack_counts(fields: DataFrame, key: str, lang: str) -> DataFrame:
    """Fields and content digest per (key, locale)."""
    hashed = fields.withColumn("_h", row_digest(fields, [c for c in fields.columns if c != "bucket"]))
    return set_digest(hashed, "_h", by=[key, lang])


def pack_mismatches(counts: DataFrame, manifest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted packs against a manifest ``(keys…, expected_rows)``: differing, missing and unexpected ones."""
    joined = counts.join(manifest, list(keys), "full_outer")
    verdict = (
        F.when(F.col("expected_rows").isNull(), "unexpected").when(F.col("row_count").isNull(), "missing")
        .when(F.col("row_count") != F.col("expected_rows"), "count")
    )
    return joined.select(*keys, "row_count", "expected_rows", verdict.alias("verdict")).where("verdict is not null")


def relation_candidates(sources: Sequence[tuple[str, DataFrame]], key: str, other: str, order: str) -> DataFrame:
    """Candidates of all sources, first occurrence kept by (source rank, order); self relations marked."""
    stacked = None
    for rank, (name, df) in enumerate(sources):
        one = df.select(F.col(key), F.lower(F.trim(F.col(other))).alias(other), F.lit(rank).alias("source_rank"),
                        F.lit(name).alias("source"), F.col(order).cast("long").alias("source_order"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return _first_candidates(stacked, key, other)


def split_candidates(df: DataFrame, key: str, other: str, order: str, sources: Sequence[tuple[str, Column]]) -> DataFrame:
    """The same from one table that is read once: ``sources`` are (name, condition), a row goes to the first that holds."""
    rank = name = F.lit(None)
    for i, (label, holds) in reversed(list(enumerate(sources))):
        rank, name = F.when(holds, i).otherwise(rank), F.when(holds, label).otherwise(name)
    stacked = df.select(F.col(key), F.lower(F.trim(F.col(other))).alias(other), rank.cast("int").alias("source_rank"), name.cast("string").alias("source"), F.col(order).cast("long").alias("source_order"))
    return _first_candidates(stacked.where("source_rank is not null"), key, other)


def _first_candidates(stacked: DataFrame, key: str, other: str) -> DataFrame:
    first = stacked.where(F.col(other) != "").groupBy(key, other).agg(
        F.min(F.struct("source_rank", "source_order", "source")).alias("_f"))
    return first.select(
        key, other, "_f.source_rank", "_f.source_order", "_f.source",
        (F.col(other) == F.lower(F.trim(F.col(key).cast("string")))).alias("is_self"),
    )


def resolve_relations(candidates: DataFrame, codes: DataFrame, key: str, other: str, keep: int = 12) -> DataFrame:
    """Resolved candidates numbered 1..keep per key. ``codes`` is ``(other, code)`` with unique ``other``.

    ``row_number() <= keep`` lets Spark keep only ``keep`` rows per key in every map task before the shuffle.
    """
    known = candidates.where(~F.col("is_self")).join(codes, other, "inner")
    window = Window.partitionBy(key).orderBy("source_rank", "source_order", other)
    return known.withColumn("position", F.row_number().over(window)).where(F.col("position") <= keep).select(
        key, "code", "source", "position")


def unresolved_relations(candidates: DataFrame, codes: DataFrame, key: str, other: str) -> DataFrame:
    """A warning per candidate without a code, and per relation to itself."""
    dangling = candidates.where(~F.col("is_self")).join(codes.select(other).distinct(), other, "left_anti").select(
        key, other, F.lit("unresolved").alias("warning"))
    return dangling.unionByName(candidates.where("is_self").select(key, other, F.lit("self").alias("warning")))


def route_fields(
    fields: DataFrame, section: str, field: str, value: str, long_text: int, owned: Sequence[str] = (),
    synthetic_section: str | None = None, synthetic_field: str | None = None,
) -> DataFrame:
    """Per (section, field): does it go to content? Long, synthetic or owned elsewhere in any row sends it there.

    The length and the patterns of synthetic names belong to a source, so the caller gives them.
    """
    name = F.concat_ws(".", section, field)
    synthetic = F.lit(False)
    for column, pattern in ((section, synthetic_section), (field, synthetic_field)):
        synthetic = synthetic | F.col(column).rlike(pattern) if pattern else synthetic
    filled = F.trim(F.coalesce(F.col(value), F.lit(""))) != ""
    routed = synthetic | (filled & (name.isin(*owned) if owned else F.lit(False))) | (F.length(F.trim(F.col(value))) > long_text)
    return fields.groupBy(section, field).agg(
        F.bool_or(F.coalesce(routed, F.lit(False))).alias("routed"), F.bool_or(filled).alias("has_content"))


def split_routed(fields: DataFrame, routing: DataFrame, section: str, field: str) -> tuple[DataFrame, DataFrame]:
    """Attribute rows split into content and specifications. The routing table has one row per attribute."""
    routed = routing.where("routed").select(section, field)
    return fields.join(routed, [section, field], "left_semi"), fields.join(routed, [section, field], "left_anti")
