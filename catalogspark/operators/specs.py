"""Typed specifications and their definitions: building, merging with conflict checks, agreement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import as_col, row_digest
from catalogspark.functions.text import bounded_code
from catalogspark.functions.typed import duration_seconds, list_json, range_problem, safe_boolean, value_problem
from catalogspark.scale import explode_rows

#: Types whose attributes can be filtered and compared by default.
FILTERABLE = ("Option", "Number", "Range", "Boolean", "List")


def _spec(attribute: str, kind: str, order: int, value: Column | None = None, option: Column | None = None,
          low: Column | None = None, high: Column | None = None, unit: str | None = None, present: Column | None = None) -> Column:
    none = F.lit(None)
    row = F.struct(
        F.lit(attribute).alias("attribute"), F.lit(kind).alias("type"), F.lit(order).alias("order"),
        (none if option is None else option).cast("string").alias("option"),
        (none if value is None else value).cast("string").alias("value"),
        (none if low is None else low).cast("double").alias("value_min"),
        (none if high is None else high).cast("double").alias("value_max"),
        F.lit(unit).cast("string").alias("unit"),
    )
    return F.when(present, row)


def number_spec(attribute: str, value: Column, order: int, unit: str | None = None) -> Column:
    """A number, or nothing when it is absent or not a number."""
    return _spec(attribute, "Number", order, value=value, unit=unit, present=value.cast("string").try_cast("double").isNotNull())


def text_spec(attribute: str, value: Column, order: int) -> Column:
    return _spec(attribute, "CustomText", order, value=value, present=F.trim(value) != "")


def option_spec(attribute: str, value: Column, order: int) -> Column:
    """An option gets a bounded code made of attribute and value."""
    return _spec(attribute, "Option", order, option=bounded_code("opt", attribute, value), present=value != "")


def range_spec(attribute: str, low: Column, high: Column, order: int, unit: str | None = None) -> Column:
    """A one-sided range becomes a point range."""
    return _spec(attribute, "Range", order, low=F.coalesce(low, high), high=F.coalesce(high, low), unit=unit,
                 present=low.isNotNull() | high.isNotNull())


def list_spec(attribute: str, values: Column, order: int) -> Column:
    encoded = list_json(values)
    return _spec(attribute, "List", order, value=encoded, present=encoded.isNotNull())


def duration_spec(attribute: str, value: Column, order: int) -> Column:
    seconds = duration_seconds(value)
    return _spec(attribute, "Duration", order, value=seconds, unit="s", present=seconds.isNotNull())


def boolean_spec(attribute: str, value: Column, order: int) -> Column:
    flag = safe_boolean(value)
    return _spec(attribute, "Boolean", order, value=flag, present=flag.isNotNull())


def build_specs(df: DataFrame, key: str, specs: Sequence[Column]) -> DataFrame:
    """All specifications of a row, one row each, in one pass over the table."""
    return explode_rows(df, [key], F.array_compact(F.array(*specs)), "s").select(key, "s.*")


def merge_definitions(observations: DataFrame, code: str, invariants: Sequence[str], order: str) -> DataFrame:
    """One definition per code; an invariant with two values is a conflict. Only min, max and count: all map-side."""
    aggs = [F.min(order).alias(order), F.count(F.lit(1)).alias("observations")]
    for i in invariants:
        aggs += [F.min(i).alias(i), F.max(i).alias(f"_max_{i}")]
    merged = observations.groupBy(code).agg(*aggs)
    clash = F.array_compact(F.array(*[F.when(F.col(i) != F.col(f"_max_{i}"), F.lit(i)) for i in invariants]))
    return merged.withColumn("conflicts", F.array_join(clash, ",")).drop(*[f"_max_{i}" for i in invariants])


def normalize_specs(specs: DataFrame, parent: str, attribute: str, values: Sequence[str], order: str) -> DataFrame:
    """One row per (parent, attribute): copies must carry equal values, the lowest order wins."""
    signed = specs.withColumn("_sig", row_digest(specs, list(values)))
    merged = signed.groupBy(parent, F.upper(F.trim(F.col(attribute))).alias(attribute)).agg(
        F.min_by(F.struct(*values), F.struct(order, "_sig")).alias("_v"), F.min(order).alias(order),
        F.min("_sig").alias("_a"), F.max("_sig").alias("_b"), F.count(F.lit(1)).alias("copies"),
    )
    return merged.select(parent, attribute, *[F.col(f"_v.{v}").alias(v) for v in values], order, "copies",
                         (F.col("_a") != F.col("_b")).alias("conflict"))


def repeated_objects(df: DataFrame, parent: str, key: str, payload: Sequence[str]) -> DataFrame:
    """(parent, key) whose repeated entries are not identical."""
    hashed = df.select(parent, key, row_digest(df, list(payload)).alias("_h"))
    seen = hashed.groupBy(parent, key).agg(F.count(F.lit(1)).alias("copies"), F.min("_h").alias("a"), F.max("_h").alias("b"))
    return seen.where("a <> b").select(parent, key, "copies")


def definition_flags(kind: Column | str, code: Column | str, source_prefix: str, detail_prefix: str) -> Column:
    """``struct(filterable, comparable)``: by type, never for source or detail attributes."""
    plain = ~(as_col(code).startswith(source_prefix) | as_col(code).startswith(detail_prefix))
    return F.struct(
        (as_col(kind).isin(*FILTERABLE) & plain).alias("filterable"),
        (as_col(kind).isin(*FILTERABLE, "Duration", "Date") & plain).alias("comparable"))


def referenced_definitions(definitions: DataFrame, specs: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Definitions that are used, and used codes without a definition."""
    used = specs.select(code).where(F.col(code).isNotNull()).distinct()
    return definitions.join(used, code, "left_semi"), used.join(definitions.select(code).distinct(), code, "left_anti")


def orphan_definitions(definitions: DataFrame, specs: DataFrame, code: str) -> DataFrame:
    """Definitions nobody uses."""
    return definitions.join(specs.select(code).distinct(), code, "left_anti")


def dangling_parents(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent does not exist (group ← attribute ← option)."""
    have = parents.select(F.col(parent_key).alias("_p")).distinct()
    return children.join(have, F.col(child_key) == F.col("_p"), "left_anti")


def code_problems(df: DataFrame, code: str, pattern: str = r"^[A-Z0-9][A-Z0-9_-]*$") -> DataFrame:
    """Codes with a bad format, and codes that occur more than once, one row per code."""
    counts = df.groupBy(F.col(code)).agg(F.count(F.lit(1)).alias("copies"))
    problem = F.when(~F.coalesce(F.col(code).rlike(pattern), F.lit(False)), "format").when(F.col("copies") > 1, "duplicate")
    return counts.select(code, "copies", problem.alias("problem")).where("problem is not null")


def typed_value_violations(specs: DataFrame, key: str) -> DataFrame:
    """Values that do not fit their declared type. Ranges are judged on their two ends."""
    problem = F.when(F.col("type") == "Range", range_problem(F.col("value_min"), F.col("value_max"))).when(
        F.col("type") == "Option", F.when(F.coalesce(F.trim("option"), F.lit("")) == "", "missing-option")
    ).otherwise(value_problem("type", "value"))
    return specs.select(key, "attribute", "type", problem.alias("problem")).where("problem is not null")


def definition_mismatches(specs: DataFrame, definitions: DataFrame, key: str, code: str, fields: Mapping[str, str]) -> DataFrame:
    """Specifications that disagree with their definition on group, type or unit, or that have none."""
    d = definitions.select(F.col(code).alias("_code"), *[F.col(theirs).alias(f"_d_{theirs}") for theirs in fields.values()])
    joined = specs.join(d, F.col(code) == F.col("_code"), "left")
    wrong = [F.when(~F.col(mine).eqNullSafe(F.col(f"_d_{theirs}")), F.lit(mine)) for mine, theirs in fields.items()]
    problems = F.when(F.col("_code").isNull(), "undefined").otherwise(F.array_join(F.array_compact(F.array(*wrong)), ","))
    return joined.select(key, code, problems.alias("problems")).where("problems <> ''")
