"""Price observations with lineage, recomputation of derived prices, offers, market facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import observation_key
from catalogspark.functions.typed import divide_half_up, plain_number_text
from catalogspark.functions.units import basis_in_package, price_steps
from catalogspark.scale import explode_rows


def price_observations(items: DataFrame, key: str) -> DataFrame:
    """Source and derived observations of items ``(key, amount, currency, basis, hidden, package)``.

    ``package`` is the struct of :func:`parse_package`. Hidden, unpriced and basis-less items give no
    observation (see :func:`price_diagnostics`).
    """
    priced = items.where(~F.col("hidden") & (F.col("amount") > 0) & F.col("basis").isNotNull())
    exact = F.col("package.is_exact")
    steps = F.when(exact, price_steps(F.col("package.components"), F.col("basis")))
    source = F.struct(F.col("basis").alias("unit"), F.lit(1).cast("decimal(38,0)").alias("divisor"))
    rows = explode_rows(priced, ["*"], F.concat(F.array(source), F.coalesce(steps, F.array())), "_o")
    derived = F.col("_o.unit") != F.col("basis")
    amount = F.when(derived, divide_half_up(F.col("amount"), F.col("_o.divisor"))).otherwise(F.col("amount").cast("decimal(28,8)"))
    return rows.select(
        key, "currency", F.col("basis").alias("source_basis"), F.col("_o.unit").alias("basis"),
        F.when(derived, "derived").otherwise("source").alias("kind"),
        F.col("amount").cast("decimal(28,8)").alias("source_amount"), F.col("_o.divisor").cast("bigint").alias("divisor"),
        amount.alias("amount"),
        observation_key("obs-", F.col(key), "currency", F.col("_o.unit"), F.when(derived, "derived").otherwise("source")).alias("observation_key"),
    )


def price_diagnostics(items: DataFrame, key: str) -> DataFrame:
    """Why an item has no or only a source price."""
    priced = F.col("amount") > 0
    reason = (
        F.when(F.col("hidden") & priced, "price-hidden").when(F.col("hidden") | ~priced | F.col("amount").isNull(), None)
        .when(F.col("basis").isNull(), "basis-unknown")
        .when(F.col("package.is_exact") & ~basis_in_package(F.col("package.components"), F.col("basis")), "basis-not-in-package")
    )
    return items.select(key, reason.alias("diagnostic")).where("diagnostic is not null")


def lineage_violations(observations: DataFrame, key: str) -> DataFrame:
    """Derived prices without their source, with another source amount, or not equal to source ÷ divisor.

    Sources are unique per (item, currency, basis), and a source has a handful of derived prices (the units of a package),
    so both are brought together by one aggregate: the observations are read once.
    """
    is_source = F.col("kind") == "source"
    told = observations.where("kind in ('source', 'derived')").select(
        key, "currency", F.when(is_source, F.col("basis")).otherwise(F.col("source_basis")).alias("_from"), F.when(is_source, F.col("amount")).alias("_amount"),
        F.when(~is_source, F.struct("basis", "amount", "source_amount", "divisor")).alias("_d"))
    both = told.groupBy(key, "currency", "_from").agg(F.max("_amount").alias("_amount"), F.collect_list("_d").alias("_d"))
    joined = both.select(key, F.when(F.col("_from").isNotNull() & F.col("currency").isNotNull(), F.col("_amount")).alias("_amount"), F.explode("_d").alias("_d")).select(key, "_amount", "_d.*")
    problem = (
        F.when(F.col("_amount").isNull(), "source-missing").when(F.col("_amount") != F.col("source_amount"), "source-amount")
        .when(F.col("amount") != divide_half_up(F.col("source_amount"), F.col("divisor")), "quotient")
    )
    return joined.select(key, "basis", problem.alias("problem")).where("problem is not null")


def basis_sets(observations: DataFrame, key: str) -> DataFrame:
    """Distinct, sorted, comma-joined price bases per item (a handful of units each)."""
    return observations.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("basis")), ",").alias("bases"))


def offer_groups(rows: DataFrame, grade: str, quantity: str, unit: str, price: str) -> DataFrame:
    """Sized rows grouped to offers: observations, price span, duplicate flag. No list is gathered."""
    sized = rows.where(F.col(quantity).isNotNull())
    return sized.groupBy(grade, quantity, unit).agg(
        F.count(F.lit(1)).alias("observations"), F.min(price).alias("lowest"), F.max(price).alias("highest"),
    ).withColumn("duplicate", F.col("observations") > 1)


def offer_summary(rows: DataFrame, grade: str, quantity: str, unit: str) -> DataFrame:
    """The counts a price base is checked against: rows, grades, sized, unique, duplicate keys, unsized."""
    keys = rows.groupBy(grade, quantity, unit).agg(F.count(F.lit(1)).alias("n"))
    sized = F.col(quantity).isNotNull()
    return keys.agg(
        F.sum("n").alias("row_count"), F.count_distinct(grade).alias("grades"),
        F.coalesce(F.sum(F.when(sized, F.col("n"))), F.lit(0)).alias("sized_rows"), F.count_if(sized).alias("offers"),
        F.count_if(sized & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(~sized, F.col("n"))), F.lit(0)).alias("unsized_rows"),
    )


def previous_price(current: Column, change: Column, stated: Column) -> Column:
    """``struct(previous, derivation, mismatch)``: the stated previous value, else current − change if positive."""
    derived = current - change
    usable = F.when(derived > 0, derived)
    return F.struct(
        F.coalesce(stated, usable).alias("previous"),
        F.when(stated.isNotNull(), "stated").when(usable.isNotNull(), "current-minus-change").alias("derivation"),
        F.coalesce(stated.isNotNull() & usable.isNotNull() & (stated != usable), F.lit(False)).alias("mismatch"),
    )


def market_range(low: Column, high: Column) -> Column:
    """``struct(low, high, problem)``: both ends positive and in order, or a problem; nothing when both are absent."""
    present = low.isNotNull() | high.isNotNull()
    ok = (low > 0) & (high > 0) & (high >= low)
    good = F.coalesce(ok, F.lit(False))
    return F.struct(
        F.when(good, low).alias("low"), F.when(good, high).alias("high"), F.when(present & ~good, "range-invalid").alias("problem"))


def count_or_problem(value: Column | str) -> Column:
    """``struct(value, problem)`` of a non-negative whole number; blank is absent, not wrong."""
    text = F.trim(F.col(value) if isinstance(value, str) else value)
    number = F.when(text.rlike(r"^\d+$"), text.try_cast("bigint"))
    return F.struct(number.alias("value"), F.when((text != "") & number.isNull(), "count-invalid").alias("problem"))


def release_fact(price: Column, quantity: Column, basis: Column) -> Column:
    """Release price with its quantity and the reasons why a part is unusable."""
    amount, count = plain_number_text(price), plain_number_text(quantity)
    positive = lambda t: F.when(t.cast("decimal(38,8)") > 0, t)
    given = F.coalesce(quantity, F.lit("")) != ""
    return F.when(positive(amount).isNotNull(), F.struct(
        positive(amount).alias("amount"), positive(count).alias("quantity"), basis.alias("basis"),
        F.array_compact(F.array(
            F.when(given & positive(count).isNull(), "quantity-invalid"), F.when(basis.isNull(), "basis-unknown"))).alias("problems")))


def expected_counts(summary: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Golden counts that differ."""
    rows: Sequence[Column] = [
        F.struct(F.lit(k).alias("measure"), F.col(k).cast("bigint").alias("found"), F.lit(v).cast("bigint").alias("expected"))
        for k, v in expected.items()
    ]
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("found <> expected")
