"""The whole artifact: all validations as one set of findings, the report, and the pre-import gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.operators import bindings, quality, specs
from catalogspark.operators.localize import missing_locales
from catalogspark.scale import with_scalars


def validate_artifact(
    products: DataFrame, translations: DataFrame, specifications: DataFrame, definitions: DataFrame,
    assignments: DataFrame, relations: DataFrame, locales: Sequence[str], catalogs: Sequence[str],
) -> DataFrame:
    """Findings of every rule family over the tables of an artifact, keyed by product ``code``.

    ``products(code)``, ``translations(code, lang)``, ``specifications(code, attribute, type, value, …)``,
    ``definitions(attribute, type)``, ``assignments(code, catalog, category)``, ``relations(code, target, position)``.
    """
    as_f = quality.as_findings
    typed = specs.typed_value_violations(specifications, "code")
    wrong = specs.definition_mismatches(specifications, definitions, "code", "attribute", {"type": "type"})
    unused = specs.orphan_definitions(definitions, specifications, "attribute")
    placed = bindings.assignment_problems(assignments, "code", "catalog", "category", list(catalogs))
    unplaced = products.select("code").join(assignments.select("code").distinct(), "code", "left_anti")
    related = quality.relation_problems(relations, "code", "target", "position", products.select("code"))
    codes = specs.code_problems(products.select("code"), "code")
    return quality.union_findings([
        as_f(codes, "code", "code", "code", F.col("problem")),
        as_f(missing_locales(translations, "code", "lang", locales), "code", "required-locale", "translations", locale=F.col("locale")),
        as_f(typed, "code", "typed-value", "specifications", F.concat_ws(" ", "attribute", "problem")),
        as_f(wrong, "code", "definition-mismatch", "specifications", F.concat_ws(" ", "attribute", "problems")),
        as_f(unused, "attribute", "orphan-definition", "definitions"),
        as_f(placed, "code", "assignment", "catalogs", F.concat_ws(" ", "catalog", "category", "problem")),
        as_f(unplaced, "code", "no-assignment", "catalogs"),
        as_f(related, "code", "relation", "related", F.concat_ws(" ", "subject", "problem")),
    ])


def run_report(counts: Mapping[str, DataFrame], found: DataFrame) -> DataFrame:
    """Measures of a run as rows (measure, value): rows per table, findings per rule, affected entities."""
    out = quality.rollup(found).select(
        F.explode(F.array(
            F.struct(F.concat(F.lit("findings:"), "rule").alias("measure"), F.col("findings").alias("value")),
            F.struct(F.concat(F.lit("entities:"), "rule").alias("measure"), F.col("entities").alias("value")))).alias("r")).select("r.*")
    for name, df in counts.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(f"rows:{name}").alias("measure"), "value"))
    return out


def preflight(found: DataFrame, plan_gate: DataFrame) -> DataFrame:
    """One row: may this be imported? Blocking findings and the verdict of the plan."""
    blockers = found.agg(F.count(F.lit(1)).alias("findings"), F.count_if("blocking").alias("blockers"))
    return with_scalars(plan_gate, blockers).withColumn("importable", F.col("eligible") & (F.col("blockers") == 0))
