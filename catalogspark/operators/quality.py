"""Rules as violation rows, roll-ups and gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.functions.text import IDEOGRAPHS, name_key
from catalogspark.functions.typed import decimal_places
from catalogspark.scale import explode_rows


@dataclass
class RowRule:
    """A rule on one row: when ``broken`` is true the row has a finding."""

    name: str
    field: str
    broken: Column
    message: Column | str = ""
    locale: Column | None = None


def findings(df: DataFrame, key: str, rules: Sequence[RowRule], blocking: Column | None = None) -> DataFrame:
    """All row rules of a table in one pass: ``(key, rule, field, locale, blocking, message)``."""
    def one(r: RowRule) -> Column:
        return F.when(F.coalesce(r.broken, F.lit(False)), F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"),
            (F.lit(None) if r.locale is None else r.locale).cast("string").alias("locale"),
            (F.lit(r.message) if isinstance(r.message, str) else r.message).alias("message")))

    block = F.lit(False) if blocking is None else F.coalesce(blocking, F.lit(False))
    broken = F.array_compact(F.array(*[one(r) for r in rules]))
    hits = explode_rows(df, [F.col(key).cast("string").alias("entity"), block.alias("blocking")], broken, "f")
    return hits.select("entity", "f.rule", "f.field", "f.locale", "blocking", "f.message")


def as_findings(df: DataFrame, key: str, rule: str, field: str, message: Column | str = "", locale: Column | None = None) -> DataFrame:
    """Rows that are violations already, in the common shape."""
    return df.select(
        F.col(key).cast("string").alias("entity"), F.lit(rule).alias("rule"), F.lit(field).alias("field"),
        (F.lit(None) if locale is None else locale).cast("string").alias("locale"), F.lit(False).alias("blocking"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"))


def union_findings(parts: Sequence[DataFrame]) -> DataFrame:
    """The findings of all rules of an artifact."""
    return reduce(DataFrame.unionByName, parts)


def rollup(found: DataFrame) -> DataFrame:
    """Per rule: findings, blockers, warnings, affected entities."""
    return found.groupBy("rule").agg(
        F.count(F.lit(1)).alias("findings"), F.count_if("blocking").alias("blockers"),
        F.count_if(~F.col("blocking")).alias("warnings"), F.count_distinct("entity").alias("entities"))


def head(found: DataFrame, limit: int = 50) -> DataFrame:
    """First findings in report order (a report feature; the full set stays a table)."""
    return found.orderBy(F.col("blocking").desc(), "rule", "entity", "field", "locale", "message").limit(limit)


def gate(found: DataFrame, shown: int = 20) -> None:
    """Raise when anything blocks; the message carries the first findings only."""
    first = found.where("blocking").limit(shown).collect()
    if first:
        raise ValueError("blocked: " + "; ".join(f"{r.entity} {r.rule} {r.field}" for r in first))


def locale_text_rules(name: str, description: str, lang: str, fallback_patterns: dict[str, str]) -> list[RowRule]:
    """Title and description must be there and must not carry interface left-overs."""
    text = F.concat_ws("\n", name, description)
    rules = [
        RowRule("required-title", name, F.trim(F.coalesce(F.col(name), F.lit(""))) == "", locale=F.col(lang)),
        RowRule("required-description", description, F.trim(F.coalesce(F.col(description), F.lit(""))) == "", locale=F.col(lang)),
    ]
    for label, pattern in fallback_patterns.items():
        rules.append(RowRule("forbidden-fallback", label, text.rlike(pattern), locale=F.col(lang)))
    return rules


def number_rules(text: str, unit: str, allowed: Sequence[str], limits: dict[str, tuple[float, float]], places: int = 4) -> list[RowRule]:
    """Unit contract, precision and range of a number kept as source text."""
    value = F.col(text).try_cast("double")
    outside = F.lit(False)
    for name, (low, high) in limits.items():
        outside = outside | ((F.col(unit) == name) & ~value.between(low, high))
    return [
        RowRule("unit", unit, (F.trim(F.col(unit)) != "") & ~F.col(unit).isin(*allowed)),
        RowRule("precision", text, value.isNotNull() & (decimal_places(text) > places)),
        RowRule("range", text, outside),
    ]


def origin_rules(country: str, place: str, low: str, high: str, lat: str, lng: str) -> list[RowRule]:
    """Country code, mapped place or coordinates, altitude order and range, coordinate range."""
    placed = (F.trim(F.coalesce(F.col(place), F.lit(""))) != "") | (F.col(lat).isNotNull() & F.col(lng).isNotNull())
    return [
        RowRule("origin-country", country, ~F.coalesce(F.col(country).rlike("^[A-Z]{2}$"), F.lit(False))),
        RowRule("origin-place", place, ~placed),
        RowRule("altitude-order", low, F.col(low) > F.col(high)),
        RowRule("altitude-range", low, ~F.col(low).between(-500, 10000) | ~F.col(high).between(-500, 10000)),
        RowRule("coordinate-range", lat, ~F.col(lat).between(-90, 90) | ~F.col(lng).between(-180, 180)),
    ]


def naming_rules(name: str, transcription: str) -> list[RowRule]:
    """Composite names, native script in a transcription, editorial delimiters."""
    return [
        RowRule("composite-name", name, F.col(name).rlike(rf"[（(][^()（）]*{IDEOGRAPHS}[^()（）]*[)）]")),
        RowRule("native-transcription", transcription, F.col(transcription).rlike(IDEOGRAPHS)),
        RowRule("editorial-delimiter", name, F.col(name).rlike("——|：")),
    ]


def duplicate_names(df: DataFrame, name: str, key: str) -> DataFrame:
    """Names that are the same after case, punctuation and spacing are dropped."""
    keyed = df.groupBy(name_key(name).alias("name_key")).agg(F.count(F.lit(1)).alias("members"), F.min(key).alias("first_member"))
    return keyed.where("members > 1")


def package_rules_per_parent(packages: DataFrame, parent: str, code: str, default: str, known: Sequence[str]) -> DataFrame:
    """Exactly one default per parent; unknown codes counted. One aggregate per parent."""
    per = packages.groupBy(parent).agg(
        F.count_if(F.col(default)).alias("defaults"), F.count_if(~F.col(code).isin(*known)).alias("unknown_codes"))
    return per.where((F.col("defaults") != 1) | (F.col("unknown_codes") > 0))


def relation_problems(relations: DataFrame, parent: str, target: str, position: str, known: DataFrame) -> DataFrame:
    """Self relations, unknown targets, repeated targets and repeated positions of a parent."""
    per_target = relations.groupBy(parent, target).agg(F.count(F.lit(1)).alias("n"))
    have = known.select(F.col(known.columns[0]).alias("_t")).distinct().withColumn("_known", F.lit(True))
    joined = per_target.join(have, F.col(target) == F.col("_t"), "left")
    problem = F.when(F.col(parent) == F.col(target), "self").when(F.col("_known").isNull(), "unknown-target").when(F.col("n") > 1, "repeated-target")
    targets = joined.select(parent, F.col(target).cast("string").alias("subject"), problem.alias("problem")).where("problem is not null")
    positions = relations.groupBy(parent, position).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        parent, F.col(position).cast("string").alias("subject"), F.lit("repeated-position").alias("problem"))
    return targets.unionByName(positions)


def content_count_mismatches(content: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Content rows and loss events must agree per key."""
    tagged = content.select(*keys, F.lit(1).alias("c"), F.lit(0).alias("e")).unionByName(events.select(*keys, F.lit(0).alias("c"), F.lit(1).alias("e")))
    counts = tagged.groupBy(*keys).agg(F.sum("c").alias("content_rows"), F.sum("e").alias("event_rows"))
    return counts.where("content_rows <> event_rows")


def one_article_per_entity(articles: DataFrame, entity: str, slug: str) -> DataFrame:
    """Entities with several articles or several slugs."""
    per = articles.groupBy(entity).agg(F.count(F.lit(1)).alias("articles"), F.count_distinct(slug).alias("slugs"))
    return per.where("articles > 1 or slugs > 1")


def seed_readiness(df: DataFrame, published: Column, thresholds: dict[str, int], category: str, locale: str) -> DataFrame:
    """One row: counts against thresholds and the verdict."""
    counts = df.agg(
        F.count(F.lit(1)).alias("products"), F.count_if(published).alias("published"),
        F.count_distinct(category).alias("categories"), F.count_distinct(locale).alias("locales"))
    short = F.array_compact(F.array(*[F.when(F.col(k) < v, F.lit(k)) for k, v in thresholds.items()]))
    return counts.withColumn("too_few", F.array_join(short, ",")).withColumn("ready", F.col("too_few") == "")


def count_drift(counts: DataFrame, order: str, count: str, max_drop: float = 0.25, max_growth: float = 2.0, by: Sequence[str] = ()) -> DataFrame:
    """Each period of a series (``by``) against the last accepted one: refused when it drops or grows too much; the first is accepted.

    Empty periods and refused ones are passed over, so neither hides a drop. Whether a period is accepted depends on
    the one before, so the counts of a series, already aggregated to one short row per period, are read once in order;
    only the last accepted count is held.
    """
    frame = counts.select(*by, order, count)
    dealt = frame.repartition(*by) if by else frame.repartition(1)
    keys = len(by)

    def judge(batches):
        import pyarrow as pa

        series, last = None, None
        for batch in batches:
            numbers = batch.column(keys + 1).to_pylist()
            heads = list(zip(*[batch.column(i).to_pylist() for i in range(keys)])) if keys else [()] * len(numbers)
            previous, drifted = [], []
            for head, n in zip(heads, numbers):
                if head != series:
                    series, last = head, None
                drift = n is not None and last is not None and (float(last - n) > float(last) * max_drop or float(n) > float(last) * max_growth)
                previous.append(last)
                drifted.append(drift)
                last = last if drift else n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(previous, batch.column(keys + 1).type), pa.array(drifted, pa.bool_())], [*batch.schema.names, "previous", "drifted"])

    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in frame.schema], T.StructField("previous", frame.schema[count].dataType), T.StructField("drifted", T.BooleanType())])
    return dealt.sortWithinPartitions(*by, order, count).mapInArrow(judge, schema)


def reference_contract(df: DataFrame, id_col: str, code: str, collections: Sequence[str]) -> DataFrame:
    """Ids must be UUIDs, codes present, collections not NULL: findings for the rows that break it."""
    rules = [
        RowRule("id-format", id_col, ~F.coalesce(F.col(id_col).rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit(False))),
        RowRule("code-missing", code, F.trim(F.coalesce(F.col(code), F.lit(""))) == ""),
        *[RowRule("collection-missing", c, F.col(c).isNull()) for c in collections],
    ]
    return findings(df, code, rules)


def component_problems(components: Column) -> Column:
    """Problems of a chain of components: gaps in the ordinals, repeated transitions."""
    ordinals = F.transform(components, lambda c: c["ordinal"])
    moves = F.transform(components, lambda c: F.concat_ws(">", c["contained"], c["container"]))
    return F.array_join(F.array_compact(F.array(
        F.when(~ordinals.eqNullSafe(F.when(F.size(components) > 0, F.sequence(F.lit(1), F.size(components))).otherwise(ordinals)), "ordinal-gap"),
        F.when(F.size(F.array_distinct(moves)) < F.size(moves), "repeated-transition"))), ",")


def price_row_rules(order: str, index: str, label: str, quantity: str, price: str, sized: str) -> list[RowRule]:
    """Row contract of a price base: order equals index, label trimmed, positive decimals, sized or not."""
    positive = lambda c: F.coalesce(F.col(c).rlike(r"^\d+(\.\d+)?$") & (F.col(c).try_cast("decimal(38,8)") > 0), F.lit(False))
    return [
        RowRule("row-order", order, F.col(order) != F.col(index)),
        RowRule("label", label, (F.trim(F.col(label)) != F.col(label)) | (F.trim(F.col(label)) == "")),
        RowRule("price", price, ~positive(price)),
        RowRule("quantity", quantity, (F.col(sized) & ~positive(quantity)) | (~F.col(sized) & F.col(quantity).isNotNull())),
    ]
