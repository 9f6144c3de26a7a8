"""Package text to a chain of units, and walking that chain. One row's chain is a short array."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogspark.functions.canon import as_col
from catalogspark.functions.typed import plain_number_text

#: Unit words and their codes.
UNIT_WORDS = {
    "千克": "kg", "克": "g", "片": "cake", "饼": "cake", "砖": "brick", "沱": "tuo", "袋": "bag", "盒": "box", "提": "bundle", "件": "case",
}
MASS = ("g", "kg")


def unit_code(word: Column | str, units: Mapping[str, str] = UNIT_WORDS) -> Column:
    """Code of a unit word, NULL when unknown."""
    pairs = [F.lit(x) for kv in units.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.trim(as_col(word)))


def _component(units: Mapping[str, str], group: str) -> str:
    """One ``quantity unit / unit`` component; ``group`` opens its three groups, ``(`` or ``(?:``."""
    words = sorted(units, key=len, reverse=True)
    inner = "|".join(w for w in words if units[w] != "case")
    outer = "|".join(w for w in words if units[w] not in MASS)
    return rf"\s*{group}\d+(?:\.\d+)?)\s*{group}{inner})\s*/\s*{group}{outer})\s*"


def parse_package(value: Column | str, units: Mapping[str, str] = UNIT_WORDS) -> Column:
    """``struct(raw_text, components, is_exact, diagnostic)`` of text such as ``357g/cake 7cake/bundle``.

    The longest prefix of well-formed components is taken; a zero quantity inside it, text after it, a
    container that is not the next contained unit, and a unit that returns, are told apart.
    """
    one, flat = _component(units, "("), _component(units, "(?:")
    raw = F.trim(F.coalesce(as_col(value), F.lit("")))
    prefix = F.regexp_extract(raw, rf"^(?:{flat})*", 0)
    group = lambda i: F.regexp_extract_all(prefix, F.lit(one), F.lit(i))
    parts = F.transform(
        F.arrays_zip(group(1).alias("q"), group(2).alias("c"), group(3).alias("k")),
        lambda z: F.struct(
            plain_number_text(z["q"]).alias("quantity"), unit_code(z["c"], units).alias("contained"),
            unit_code(z["k"], units).alias("container")),
    )
    return F.transform(F.array(F.struct(raw.alias("raw"), prefix.alias("prefix"), parts.alias("parts"))), _judge)[0]


def _judge(p: Column) -> Column:
    parts, raw = p["parts"], p["raw"]
    n = F.size(parts)
    zero = F.array_position(F.transform(parts, lambda c: c["quantity"]), "0").cast("int")
    pairs = F.arrays_zip(F.slice(parts, 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice(parts, 2, F.greatest(n - 1, F.lit(0))).alias("b"))
    broken = F.exists(pairs, lambda z: z["a"]["container"] != z["b"]["contained"])
    path = F.concat(F.transform(F.slice(parts, 1, 1), lambda c: c["contained"]), F.transform(parts, lambda c: c["container"]))
    diagnostic = (
        F.when(raw == "", "missing").when(zero > 0, "quantity-invalid").when(p["prefix"] != raw, "grammar-unsupported")
        .when(broken, "chain-inconsistent").when(F.size(F.array_distinct(path)) < F.size(path), "chain-cyclic")
    )
    kept = F.when(zero > 0, F.slice(parts, F.lit(1), F.greatest(zero - 1, F.lit(0)))).otherwise(parts)
    return F.struct(raw.alias("raw_text"), kept.alias("components"), diagnostic.isNull().alias("is_exact"), diagnostic.alias("diagnostic"))


def price_steps(components: Column, basis: Column) -> Column:
    """Units below the basis with the cumulative divisor, outermost first, stopping before mass units.

    ``components`` is an exact chain (consistent, acyclic), so there is at most one way down.
    """
    down = F.reverse(F.filter(components, lambda c: ~c["contained"].isin(*MASS)))
    start = F.struct(
        basis.alias("unit"), F.lit("1").cast("decimal(38,0)").alias("divisor"),
        F.array().cast("array<struct<unit:string,divisor:decimal(38,0)>>").alias("steps"))

    def step(acc: Column, c: Column) -> Column:
        divisor = (acc["divisor"] * c["quantity"].cast("decimal(18,0)")).cast("decimal(38,0)")
        found = c["container"] == acc["unit"]
        return F.when(found, F.struct(
            c["contained"].alias("unit"), divisor.alias("divisor"),
            F.concat(acc["steps"], F.array(F.struct(c["contained"].alias("unit"), divisor.alias("divisor")))).alias("steps"),
        )).otherwise(acc)

    return F.aggregate(down, start, step, lambda acc: acc["steps"])


def basis_in_package(components: Column, basis: Column) -> Column:
    """Does the price basis occur anywhere in the chain?"""
    return F.exists(components, lambda c: (c["contained"] == basis) | (c["container"] == basis))


def unit_weight(components: Column) -> Column:
    """Grams in the innermost unit, six decimals; kilograms are converted."""
    mass = F.get(F.filter(components, lambda c: c["contained"].isin(*MASS)), F.lit(0))
    grams = mass["quantity"].cast("decimal(28,6)") * F.when(mass["contained"] == "kg", 1000).otherwise(1)
    return grams.cast("decimal(38,6)").cast("string")
