"""Raw observed products (all text) to typed items with diagnostics, in one pass per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.safety import safe_text, url_policy
from catalogspark.functions.text import squeeze
from catalogspark.functions.typed import plausible_year, timestamp_of, timestamp_problem
from catalogspark.functions.units import UNIT_WORDS, parse_package, unit_code
from catalogspark.operators.prices import count_or_problem, market_range, previous_price, release_fact
from catalogspark.scale import explode_rows

MONEY = "decimal(20,8)"


def positive(value: Column) -> Column:
    """Positive plain decimal text as a decimal, else NULL."""
    number = F.when(F.trim(value).rlike(r"^\d+(\.\d{1,8})?$"), F.trim(value).try_cast(MONEY))
    return F.when(number > 0, number)


def normalize_items(raw: DataFrame, key: str, currency: str, units: Mapping[str, str] = UNIT_WORDS, hosts: tuple[str, ...] = ()) -> DataFrame:
    """Typed item per raw row. Wrong values become NULL plus a diagnostic; nothing is guessed.

    Expects text columns ``name, description, year, brand, specification, image, price, unit, updated,
    price_status, rise, last_price, min_price, max_price, release_price, release_count, buy_count, sell_count``.
    """
    hidden = F.coalesce(F.trim("price_status"), F.lit("1")) != "1"
    price = positive(F.col("price"))
    staged = raw.select(
        key, squeeze("name").alias("name"), F.trim("brand").alias("brand"), F.col("description").alias("_description"),
        safe_text(squeeze("description")).alias("description"), F.col("year").alias("_year"), plausible_year("year").alias("year"),
        F.nullif(F.trim("image"), F.lit("")).alias("image"), url_policy("image", hosts=hosts).alias("_image_rule"),
        parse_package("specification", units).alias("package"), unit_code("unit", units).alias("basis"),
        timestamp_of("updated").alias("updated_at"), timestamp_problem("updated").alias("_updated"),
        price.alias("amount"), hidden.alias("hidden"), F.lit(currency).alias("currency"),
        previous_price(price, F.col("rise").try_cast(MONEY), positive(F.col("last_price"))).alias("_previous"),
        market_range(positive(F.col("min_price")), positive(F.col("max_price"))).alias("_range"),
        release_fact(F.col("release_price"), F.col("release_count"), unit_code("unit", units)).alias("release"),
        count_or_problem("buy_count").alias("_buy"), count_or_problem("sell_count").alias("_sell"),
    )
    flag = lambda cond, code: F.when(F.coalesce(cond, F.lit(False)), F.lit(code))
    diagnostics = F.array_compact(F.array(
        flag((F.trim("_description") != "") & F.col("description").isNull(), "description-unsafe"),
        flag((F.trim("_year") != "") & F.col("year").isNull(), "year-implausible"),
        flag(F.col("image").isNotNull() & F.col("_image_rule").isNotNull(), "image-address"),
        F.when(F.col("package.diagnostic").isNotNull(), F.concat(F.lit("package-"), F.col("package.diagnostic"))),
        F.col("_updated"), flag(F.col("hidden") & F.col("amount").isNotNull(), "price-hidden"),
        flag(~F.col("hidden") & F.col("amount").isNotNull() & F.col("basis").isNull(), "price-basis-unknown"),
        flag(F.col("_previous.mismatch"), "previous-price-mismatch"), F.col("_range.problem"), F.col("_buy.problem"), F.col("_sell.problem"),
    ))
    items = staged.withColumn("diagnostics", F.array_sort(F.array_distinct(F.concat(diagnostics, F.coalesce(F.col("release.problems"), F.array().cast("array<string>"))))))
    shown = ~F.col("hidden")
    return items.select(
        key, "name", "brand", "description", "year", F.when(F.col("_image_rule").isNull(), F.col("image")).alias("image"),
        "package", "basis", "updated_at", "amount", "hidden", "currency",
        F.when(shown, F.col("_previous.previous")).alias("previous_amount"), F.when(shown, F.col("_range.low")).alias("range_low"),
        F.when(shown, F.col("_range.high")).alias("range_high"), F.col("release.amount").alias("release_amount"),
        F.col("_buy.value").alias("demand"), F.col("_sell.value").alias("supply"), "diagnostics",
    )


def diagnostic_report(items: DataFrame, diagnostics: str = "diagnostics") -> DataFrame:
    """Items per diagnostic."""
    return explode_rows(items, [], diagnostics, "code").groupBy("code").agg(F.count(F.lit(1)).alias("items"))


def build_origins(cards: DataFrame, key: str, cities: DataFrame) -> DataFrame:
    """Origin per card: country, state, city only if it is unique in its state, repaired altitude, place text.

    Names are compared folded, without punctuation and case. The state is found first: a city of an unknown state is not
    looked for. ``cards`` has ``country, state, city, altitude_min, altitude_max, narrative``; ``cities`` has ``state, city_name``.
    """
    from catalogspark.functions.text import fold, name_key, place_text
    from catalogspark.functions.typed import thousands_repair
    from catalogspark.operators.rules import unique_lookup

    place = lambda c: name_key(fold(c))
    lookup = cities.select(place("state").alias("_state"), place("city_name").alias("_city"), F.col("city_name").alias("matched_city"))
    states = lookup.select("_state").distinct().withColumn("_known", F.lit(True))
    keyed = cards.withColumn("_state", place("state")).withColumn("_city", place("city")).join(states, "_state", "left")
    found = unique_lookup(keyed, ["_state", "_city"], lookup, "matched_city")
    found = found.withColumn("warning", F.when(F.col("_known").isNull(), "state-not-found").otherwise(F.col("warning")))
    altitude = thousands_repair(F.col("altitude_min"), F.col("altitude_max"), F.col("narrative"))
    return found.withColumn("_a", altitude).select(
        key, F.upper(F.coalesce("country", F.lit("CN"))).alias("country"), "state", F.col("matched_city").alias("city"),
        F.when(F.coalesce(F.trim("city"), F.lit("")) != "", F.col("warning")).alias("warning"),
        F.col("_a.low").alias("altitude_min"), F.col("_a.high").alias("altitude_max"), F.col("_a.scaled").alias("altitude_scaled"),
        place_text("narrative", F.col("city"), F.col("state"), F.col("country")).alias("place"))
