"""Canonical text, content digests and keys. All JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: sha256 hex is cut into four limbs of 15 digits (60 bits); sums of limbs do not depend on row order.
LIMBS = (1, 16, 31, 46)


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _without_zeros(text: Column) -> Column:
    """Decimal text without trailing zeros after the point."""
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def number_text(value: Column | str, kind: T.DataType) -> Column:
    """Number as text that tells different numbers apart: nothing is rounded.

    Decimals keep their own scale and lose trailing zeros only. Floats that eight places hold exactly are written
    plainly; all others as the shortest text that reads back as the same number.
    """
    col = as_col(value)
    if isinstance(kind, T.DecimalType):
        return _without_zeros(col.cast("string"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        eight = col.try_cast("decimal(38,8)")
        return F.when(eight.cast(kind) == col, _without_zeros(eight.cast("string"))).otherwise(col.cast("string"))
    return col.cast("string")


def canonical_field(df: DataFrame, name: str) -> Column:
    """One column in the form that is hashed: numbers as lossless text, maps key-sorted."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return number_text(F.col(name), kind)
    if isinstance(kind, T.MapType):
        return sorted_map(name)
    return F.col(name)


def sorted_map(value: Column | str) -> Column:
    """A map with its keys in order, so that its JSON is canonical."""
    return F.map_from_entries(F.array_sort(F.map_entries(as_col(value))))


def canonical_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """JSON of the columns in name order; NULL fields are left out, like absent keys."""
    return F.to_json(F.struct(*[canonical_field(df, c).alias(c) for c in sorted(columns)]))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """sha256 of the canonical JSON; volatile columns are excluded by not naming them."""
    return F.sha2(canonical_json(df, columns or df.columns), 256)


def limb_sums(digest: Column | str) -> list[Column]:
    """Commutative sums over row digests: constant state, combined map-side, any row order."""
    return [_wide_sum(F.conv(F.substring(as_col(digest), at, 15), 16, 10).cast("long")).alias(f"_limb{i}") for i, at in enumerate(LIMBS)]


def _wide_sum(limb: Column) -> Column:
    """The sum of 60-bit numbers, added up in three pieces of 20 bits: no decimal per row, and room for 2^43 rows."""
    low = F.lit((1 << 20) - 1).cast("long")
    pieces = [limb.bitwiseAND(low), F.shiftright(limb, 20).bitwiseAND(low), F.shiftright(limb, 40)]
    wide = [F.sum(piece).cast("decimal(20,0)") * F.lit(1 << 20 * i).cast("decimal(13,0)") for i, piece in enumerate(pieces)]
    return (wide[0] + wide[1] + wide[2]).cast("decimal(30,0)")


def set_digest(df: DataFrame, digest: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Order-insensitive multiset digest per group: ``(by…, row_count, set_sha256)``.

    Instead of sorting all row hashes into one string, the limbs of the hashes are added up, so that a
    group of any size needs four numbers and no row is moved whole.
    """
    sums = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *limb_sums(digest))
    return sums.select(*by, "row_count", limb_digest("row_count").alias("set_sha256"))


def limb_digest(count: Column | str) -> Column:
    """sha256 over the row count and the limb sums of :func:`limb_sums`."""
    parts = [F.coalesce(F.col(f"_limb{i}"), F.lit(0)).cast(T.DecimalType(38, 0)).cast("string") for i in range(4)]
    return F.sha2(F.concat_ws(":", as_col(count).cast("string"), *parts), 256)


def reference_code(value: Column | str) -> Column:
    """Codes compare trimmed and upper-cased."""
    return F.upper(F.trim(as_col(value)))


def reference_code_of(df: DataFrame, name: str) -> Column:
    """``{code: X}`` equals ``X``: takes a string column or a struct column with a ``code`` field."""
    kind = df.schema[name].dataType
    return reference_code(F.col(f"{name}.code") if isinstance(kind, T.StructType) else F.col(name))


def plain_number(value: Column | str) -> Column:
    """Decimal text of any length in one spelling: no plus, no outer zeros, a digit before the point, no minus zero."""
    text = F.trim(as_col(value))
    whole = F.regexp_replace(F.regexp_extract(text, r"^[+-]?(\d*)", 1), r"^0+(?=\d)", "")
    whole = F.when(whole == "", "0").otherwise(whole)
    part = F.regexp_replace(F.regexp_extract(text, r"\.(\d*)$", 1), r"0+$", "")
    size = F.when(part == "", whole).otherwise(F.concat(whole, F.lit("."), part))
    return F.when(text.startswith("-") & (size != "0"), F.concat(F.lit("-"), size)).otherwise(size)


def typed_value(kind: Column | str, value: Column | str) -> Column:
    """Value text in comparable form for its declared type; text that does not parse stays as it is."""
    kind, value = F.lower(as_col(kind)), as_col(value)
    number = F.when(value.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"), plain_number(value))
    flag = F.when(F.lower(value).isin("true", "1"), "true").when(F.lower(value).isin("false", "0"), "false")
    items = F.to_json(F.from_json(value, "array<string>"))
    return (
        F.when(kind.isin("number", "duration"), F.coalesce(number, value))
        .when(kind == "boolean", F.coalesce(flag, value))
        .when((kind == "list") & value.rlike(r"^\s*\["), F.coalesce(items, value))
        .otherwise(value)
    )


def observation_key(prefix: str, *parts: Column | str, length: int = 32) -> Column:
    """Deterministic key: the same facts give the same key on every run."""
    text = F.concat_ws("|", *[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def short_code(prefix: str, label: Column | str) -> Column:
    """Stable short code of a label."""
    return F.concat(F.lit(f"{prefix}-"), F.upper(F.substring(F.sha2(as_col(label), 256), 1, 12)))


def key_bucket(key: Column | str, buckets: int) -> Column:
    """Hash bucket of a key from the first 32 bits of its sha256."""
    return F.conv(F.substring(F.sha2(as_col(key), 256), 1, 8), 16, 10).cast("long") % buckets
