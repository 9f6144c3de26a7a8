"""Typed values: numbers, dates, lists, flags, exact decimals and fractions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.functions.canon import as_col

WHOLE = "decimal(38,0)"


def timestamp_of(value: Column | str) -> Column:
    """Epoch milliseconds or ISO text → UTC timestamp; anything else is NULL."""
    text = F.trim(as_col(value))
    return F.when(text.rlike(r"^\d{1,16}$"), F.timestamp_millis(text.try_cast("bigint"))).otherwise(F.try_to_timestamp(text))


def utc_text(value: Column | str) -> Column:
    """Instant as UTC text, whatever the session time zone is."""
    return F.date_format(F.to_utc_timestamp(as_col(value), F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def timestamp_problem(value: Column | str) -> Column:
    """Diagnostic for a value that is present but is no timestamp."""
    return F.when(as_col(value).isNotNull() & timestamp_of(value).isNull(), "timestamp-invalid")


def plausible_year(value: Column | str, low: int = 1800, high: int = 2200) -> Column:
    """First four-digit number of the text when it is a plausible year."""
    year = F.regexp_extract(as_col(value), r"(?:^|\D)(\d{4})(?:\D|$)", 1).try_cast("int")
    return F.when(year.between(low, high), year)


def rounded_int(value: Column | str) -> Column:
    """Text with thousands commas → whole number, halves toward +∞, NULL outside int32."""
    number = F.regexp_replace(as_col(value), ",", "").try_cast("decimal(38,8)")
    return F.floor(number + F.lit("0.5").cast("decimal(2,1)")).try_cast("int")


def decimal_places(value: Column | str) -> Column:
    """Digits after the point in the source text, trailing zeros included."""
    return F.length(F.regexp_extract(as_col(value), r"^[+-]?\d*\.(\d+)$", 1))


def plain_number_text(value: Column | str) -> Column:
    """Unsigned plain decimal text without leading or trailing zeros; NULL when it is not one."""
    text = F.trim(as_col(value))
    whole = F.regexp_replace(F.regexp_extract(text, r"^(\d+)", 1), r"^0+(?=\d)", "")
    part = F.regexp_replace(F.regexp_extract(text, r"\.(\d+)$", 1), r"0+$", "")
    return F.when(text.rlike(r"^\d+(\.\d+)?$"), F.when(part == "", whole).otherwise(F.concat(whole, F.lit("."), part)))


def wire_decimal(value: Column | str) -> Column:
    """``struct(units, nanos)`` of a decimal with at most nine places."""
    number = as_col(value).cast("decimal(28,9)")
    units = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("bigint")
    return F.struct(units.alias("units"), ((number - units) * 1_000_000_000).cast("int").alias("nanos"))


def scaled(value: Column | str, scale: int) -> Column:
    """Decimal as a whole number of 10^-scale."""
    return (as_col(value).cast(f"decimal(28,{scale})") * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast(WHOLE)


def divide_half_up(amount: Column | str, divisor: Column | str, scale: int = 8) -> Column:
    """Exact quotient rounded once, half up, in whole numbers (no intermediate rounding of a decimal division)."""
    top, bottom = scaled(amount, scale), scaled(divisor, scale)
    twice = (top * F.lit(2 * 10**scale).cast("decimal(12,0)")).cast(WHOLE) + bottom
    double = (bottom * 2).cast(WHOLE)
    whole = (twice.cast(WHOLE) - (twice.cast(WHOLE) % double)).cast(WHOLE)
    quotient = (whole / double).cast(WHOLE)
    unit = F.lit(f"0.{'0' * (scale - 1)}1").cast(f"decimal({scale},{scale})")
    return (quotient.cast("decimal(28,0)") * unit).cast(f"decimal(28,{scale})")


@F.pandas_udf(T.LongType())
def _gcd(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(np.gcd(a.to_numpy(np.int64), b.to_numpy(np.int64)))


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor, a batch at a time (Spark has none; a JVM-side Euclid needs a lambda per step).

    NULLs never reach the batch: one of them would turn all its numbers into floats.
    """
    zero = F.lit(0).cast("bigint")
    return F.when(a.isNotNull() & b.isNotNull(), _gcd(F.coalesce(a, zero), F.coalesce(b, zero)))


def reduced_fraction(amount: Column | str, divisor: Column | str, scale: int = 4) -> Column:
    """``struct(numerator, denominator)`` in lowest terms; operands have at most ``scale`` places."""
    top, bottom = scaled(amount, scale).cast("bigint"), scaled(divisor, scale).cast("bigint")
    shared = gcd(top, bottom)
    part = lambda v: F.call_function("div", v, shared)
    return F.struct(part(top).alias("numerator"), part(bottom).alias("denominator"))


def fixed_six(value: Column | str) -> Column:
    """Six-decimal text."""
    return as_col(value).cast("decimal(38,6)").cast("string")


def thousands_repair(low: Column, high: Column, narrative: Column, factor: int = 1000, below: float = 10) -> Column:
    """``struct(low, high, scaled)``: ends of a range that were given in units of ``factor`` (0.1-0.8 for 100-800) are repaired.

    An end may be repaired if it lies strictly between 0 and ``below`` in size. What speaks for it is one of: the other
    end may be repaired as well; for the high end, that the range is in the wrong order as it stands; for an end that
    stands alone, that the narrative names the repaired number with its thousands separator.
    """
    size = {"low": F.abs(low), "high": F.abs(high)}
    may = {n: F.coalesce(v.between(0, below) & (v > 0) & (v < below), F.lit(False)) for n, v in size.items()}
    named = lambda v: F.coalesce(F.contains(narrative, F.format_number(F.round(v * factor), 0)), F.lit(False))
    pair = may["low"] & may["high"]
    wrong_order = F.coalesce(low > high, F.lit(False))
    repair = {
        "low": may["low"] & (pair | (high.isNull() & named(low))),
        "high": may["high"] & (pair | wrong_order | (low.isNull() & named(high))),
    }
    ends = {"low": low, "high": high}
    return F.struct(*[F.when(repair[n], ends[n] * factor).otherwise(ends[n]).alias(n) for n in ends], (repair["low"] | repair["high"]).alias("scaled"))


def scalar_list(values: Column | str) -> Column:
    """Trimmed, non-empty, distinct values in first-seen order."""
    return F.array_distinct(F.filter(F.transform(as_col(values), lambda v: F.trim(v)), lambda v: v != ""))


def list_json(values: Column | str) -> Column:
    """The scalar list as JSON text; NULL when nothing is left."""
    items = scalar_list(values)
    return F.when(F.size(items) > 0, F.to_json(items))


def safe_boolean(value: Column | str) -> Column:
    """Accepts the usual spellings of yes and no; anything else is NULL."""
    text = F.lower(F.trim(as_col(value).cast("string")))
    return F.when(text.isin("true", "1", "yes", "y"), F.lit(True)).when(text.isin("false", "0", "no", "n"), F.lit(False))


def duration_seconds(value: Column | str) -> Column:
    """Non-negative whole seconds, else NULL."""
    text = F.trim(as_col(value))
    return F.when(text.rlike(r"^\d+$"), text.try_cast("bigint"))


# The value types of the specification contract.
VALUE_TYPES = ("Option", "CustomText", "CustomHtmlText", "CustomMarkdownText", "Hyperlink", "Number", "Range", "List", "Boolean", "Date", "Duration")


def value_problem(kind: Column | str, value: Column | str) -> Column:
    """Why a value does not fit its type, or NULL."""
    kind, value = as_col(kind), as_col(value)
    checks: Sequence[tuple[str, Column]] = (
        ("Number", value.rlike(r"^[+-]?\d+(\.\d+)?$")),
        ("Boolean", value.isin("true", "false")),
        ("Date", value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()),
        ("Duration", value.rlike(r"^\d+$") & value.try_cast("bigint").isNotNull()),
        ("Hyperlink", value.rlike(r"^https?://[^\s/]+")),
        ("List", value.startswith("[") & F.try_parse_json(value).isNotNull()),
    )
    problem = F.when(~kind.isin(*VALUE_TYPES), "unknown-type").when(F.coalesce(F.trim(value), F.lit("")) == "", "missing-value")
    for name, ok in checks:
        problem = problem.when((kind == name) & ~F.coalesce(ok, F.lit(False)), f"bad-{name.lower()}")
    return problem


def range_problem(low: Column, high: Column) -> Column:
    """A range needs both ends, in order."""
    return F.when(low.isNull() | high.isNull(), "missing-end").when(low > high, "reversed")

