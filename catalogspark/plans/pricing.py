"""Packages, exact unit prices, lineage, offers and market facts, over parts and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import typed as T
from catalogspark.functions import units as U
from catalogspark.operators import prices as P
from catalogspark.plans.derived import table
from catalogspark.plans.registry import query

WORDS = {"g": "g", "cake": "cake", "bundle": "bundle", "case": "case", "box": "box"}
PACK_SQL = """case p_type when 'PROMO' then '' when 'STANDARD' then p_size || 'g/cake 0' || (p_size - p_size % 5) || 'cake/bundle 6bundle/case'
 when 'SMALL' then p_size || 'g/cake 7box/case' when 'LARGE' then p_size || 'g/cake 7cake/bundle junk' else p_size || '.50g/cake 7cake/bundle ' || (p_size + 1) || 'bundle/case' end"""


def _pack():
    s = F.col("p_size").cast("string")
    fives = (F.col("p_size") - F.col("p_size") % 5).cast("string")
    return (
        F.when(F.col("p_type") == "PROMO", "")
        .when(F.col("p_type") == "STANDARD", F.concat(s, F.lit("g/cake 0"), fives, F.lit("cake/bundle 6bundle/case")))
        .when(F.col("p_type") == "SMALL", F.concat(s, F.lit("g/cake 7box/case")))
        .when(F.col("p_type") == "LARGE", F.concat(s, F.lit("g/cake 7cake/bundle junk")))
        .otherwise(F.concat(s, F.lit(".50g/cake 7cake/bundle "), (F.col("p_size") + 1).cast("string"), F.lit("bundle/case")))
    )


def _items(spark, sf):
    """Parts as priced items: the pack text follows the type, the price basis follows the brand."""
    basis = F.when(F.col("p_brand") == "Brand#1", F.lit(None).cast("string")).when(F.col("p_size") > 20, "case").when(F.col("p_size") > 10, "bundle").otherwise("pallet")
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(20,2)").alias("amount"), F.lit("CNY").alias("currency"), basis.alias("basis"),
        (F.col("p_brand") == "Brand#2").alias("hidden"), U.parse_package(_pack(), WORDS).alias("package"))


@query("F21 M12", f"""with p as (select p_partkey, p_type t, p_size, {PACK_SQL} raw from part)
select p_partkey, raw as raw_text, t not in ('PROMO','SMALL','LARGE') and not (t = 'STANDARD' and p_size < 5) as is_exact,
 case when t = 'PROMO' then 'missing' when t = 'SMALL' then 'chain-inconsistent' when t = 'LARGE' then 'grammar-unsupported'
  when t = 'STANDARD' and p_size < 5 then 'quantity-invalid' end as diagnostic,
 case when t = 'PROMO' then 0 when t in ('SMALL','LARGE') then 2 when t = 'STANDARD' and p_size < 5 then 1 else 3 end as components,
 case when t = 'PROMO' then null when t in ('STANDARD','SMALL','LARGE') then p_size || '.000000' else p_size || '.500000' end as unit_weight from p""")
def package_chains(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", U.parse_package(_pack(), WORDS).alias("p"))
    return p.select("p_partkey", "p.raw_text", "p.is_exact", "p.diagnostic", F.size("p.components").alias("components"),
                    U.unit_weight(F.col("p.components")).alias("unit_weight"))


ITEMS_SQL = f"""items as (select p_partkey, p_type t, cast(p_retailprice as decimal(20,2)) amount, (cast(p_retailprice as decimal(20,2)) * 100)::bigint cents,
 case when p_brand = 'Brand#1' then null when p_size > 20 then 'case' when p_size > 10 then 'bundle' else 'pallet' end basis, p_brand = 'Brand#2' hidden,
 p_type not in ('PROMO','SMALL','LARGE') and not (p_type = 'STANDARD' and p_size < 5) exact,
 case when p_type = 'STANDARD' then p_size - p_size % 5 else 7 end per_bundle, case when p_type = 'STANDARD' then 6 else p_size + 1 end per_case from part),
obs as (select p_partkey, basis source_basis, basis, 'source' kind, cents, 1 divisor from items where not hidden and basis is not null
 union all select p_partkey, basis, 'bundle', 'derived', cents, per_case from items where not hidden and exact and basis = 'case'
 union all select p_partkey, basis, 'cake', 'derived', cents, per_bundle * case when basis = 'case' then per_case else 1 end from items where not hidden and exact and basis in ('case','bundle'))"""
QUOTIENT_SQL = "((cents::hugeint * 1000000 * 2 + divisor) // (2 * divisor))::bigint"


@query("J18 F19 F34 M13", f"""with {ITEMS_SQL} select p_partkey, source_basis, basis, kind, divisor::bigint as divisor, {QUOTIENT_SQL} as amount_e8 from obs""")
def unit_chain_prices(spark, sf):
    o = P.price_observations(_items(spark, sf), "p_partkey")
    return o.select("p_partkey", "source_basis", "basis", "kind", "divisor", (F.col("amount") * 100000000).cast("bigint").alias("amount_e8"))


@query("F27", f"""with {ITEMS_SQL} select p_partkey, basis, 'obs-' || substr(sha256(p_partkey || '|CNY|' || basis || '|' || kind), 1, 32) as observation_key from obs""")
def observation_keys(spark, sf):
    return P.price_observations(_items(spark, sf), "p_partkey").select("p_partkey", "basis", "observation_key")


@query("F34 J18", f"""with {ITEMS_SQL} select p_partkey, case when hidden then 'price-hidden' when basis is null then 'basis-unknown' else 'basis-not-in-package' end as diagnostic
from items where hidden or basis is null or (exact and basis = 'pallet')""")
def price_diagnostics(spark, sf):
    return P.price_diagnostics(_items(spark, sf), "p_partkey")


@query("J17", f"""with {ITEMS_SQL} select p_partkey, basis, case when kind = 'derived' and source_basis = 'bundle' then 'source-amount' else 'quotient' end as problem
from obs where kind = 'derived' and (source_basis = 'bundle' or (basis = 'cake' and p_partkey in (select p_partkey from part where p_size > 40)))""")
def price_lineage_violations(spark, sf):
    """Seeded errors are found again: bundle-based sources are changed, and cakes of big sizes are off by one unit."""
    o = P.price_observations(_items(spark, sf), "p_partkey")
    big = table(spark, sf, "part").where("p_size > 40").select("p_partkey", F.lit(True).alias("big"))
    seeded = o.join(big, "p_partkey", "left").withColumn(
        "amount", F.when((F.col("kind") == "source") & (F.col("basis") == "bundle"), F.col("amount") + 1)
        .when(F.col("big") & (F.col("kind") == "derived") & (F.col("basis") == "cake"), F.col("amount") + F.lit("0.00000001").cast("decimal(28,8)"))
        .otherwise(F.col("amount")).cast("decimal(28,8)"))
    return P.lineage_violations(seeded.drop("big"), "p_partkey")


@query("A25", f"with {ITEMS_SQL} select p_partkey, string_agg(distinct basis, ',' order by basis) as bases from obs group by 1")
def price_basis_sets(spark, sf):
    return P.basis_sets(P.price_observations(_items(spark, sf), "p_partkey"), "p_partkey")


@query("F19", """select l_orderkey, l_linenumber, ((cast(l_extendedprice as decimal(20,2)) * 100)::hugeint * 1000000 * 2 + l_quantity::bigint) // (2 * l_quantity::bigint) as unit_e8,
 ((cast(l_extendedprice as decimal(20,2)) * 100)::bigint // gcd((cast(l_extendedprice as decimal(20,2)) * 100)::bigint, l_quantity::bigint * 100)) as numerator,
 (l_quantity::bigint * 100) // gcd((cast(l_extendedprice as decimal(20,2)) * 100)::bigint, l_quantity::bigint * 100) as denominator from lineitem""".replace(
    "as unit_e8", "::bigint as unit_e8").replace("((cast(l_extendedprice as decimal(20,2)) * 100)::hugeint * 1000000 * 2 + l_quantity::bigint) // (2 * l_quantity::bigint) ::",
    "(((cast(l_extendedprice as decimal(20,2)) * 100)::hugeint * 1000000 * 2 + l_quantity::bigint) // (2 * l_quantity::bigint))::"))
def exact_unit_prices(spark, sf):
    price, n = F.col("l_extendedprice").cast("decimal(20,2)"), F.col("l_quantity").cast("decimal(10,0)")
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (T.divide_half_up(price, n) * 100000000).cast("bigint").alias("unit_e8"),
        T.reduced_fraction(price, n, 2).alias("f"))
    return li.select("l_orderkey", "l_linenumber", "unit_e8", "f.numerator", "f.denominator")


@query("A21", """select l_partkey, l_quantity::int as quantity, l_returnflag as unit, count(*) as observations, min(cast(l_extendedprice as decimal(20,2)))::varchar as lowest,
 max(cast(l_extendedprice as decimal(20,2)))::varchar as highest, count(*) > 1 as duplicate from lineitem where l_returnflag <> 'N' group by 1, 2, 3""")
def offer_groups(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_partkey", F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("l_returnflag").alias("unit"), F.col("l_extendedprice").cast("decimal(20,2)").alias("price"))
    g = P.offer_groups(li, "l_partkey", "quantity", "unit", "price")
    return g.withColumn("lowest", F.col("lowest").cast("string")).withColumn("highest", F.col("highest").cast("string"))


@query("A21 V22", """with k as (select l_partkey, case when l_returnflag <> 'N' then l_quantity end q, l_returnflag u, count(*) n from lineitem group by 1, 2, 3)
select sum(n)::bigint row_count, count(distinct l_partkey) grades, coalesce(sum(n) filter (where q is not null), 0)::bigint sized_rows, count(*) filter (where q is not null) offers,
 count(*) filter (where q is not null and n > 1) duplicate_keys, coalesce(sum(n) filter (where q is null), 0)::bigint unsized_rows from k""")
def offer_counts(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_partkey", F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("q"), F.col("l_returnflag").alias("u"))
    return P.offer_summary(li, "l_partkey", "q", "u")


@query("W9 F34", """with e as (select event_id, cast(value as decimal(12,2)) cur, cast(value - 20 as decimal(12,2)) chg, case when event_type = 'click' then cast(20 as decimal(12,2)) when event_type = 'error' then cast(value as decimal(12,2)) end stated from events)
select event_id, coalesce(stated, case when cur - chg > 0 then cur - chg end)::varchar as previous,
 case when stated is not null then 'stated' when cur - chg > 0 then 'current-minus-change' end as derivation,
 coalesce(stated is not null and cur - chg > 0 and stated <> cur - chg, false) as mismatch from e""")
def previous_value(spark, sf):
    money = "decimal(12,2)"
    stated = F.when(F.col("event_type") == "click", F.lit(20).cast(money)).when(F.col("event_type") == "error", F.col("value").cast(money))
    p = P.previous_price(F.col("value").cast(money), (F.col("value") - 20).cast(money), stated)
    e = table(spark, sf, "events").select("event_id", p.alias("p"))
    return e.select("event_id", F.col("p.previous").cast(money).cast("string").alias("previous"), "p.derivation", "p.mismatch")


@query("F34", """with p as (select p_partkey, case when p_type <> 'PROMO' then cast(p_size as decimal(12,2)) end low, case when p_type <> 'ECONOMY' then cast(p_retailprice - 880 as decimal(12,2)) end high from part)
select p_partkey, case when low > 0 and high >= low then low end::varchar low, case when low > 0 and high >= low then high end::varchar high,
 case when (low is not null or high is not null) and not coalesce(low > 0 and high > 0 and high >= low, false) then 'range-invalid' end as problem from p""")
def market_ranges(spark, sf):
    money = "decimal(12,2)"
    low = F.when(F.col("p_type") != "PROMO", F.col("p_size").cast(money))
    high = F.when(F.col("p_type") != "ECONOMY", (F.col("p_retailprice") - 880).cast(money))
    p = table(spark, sf, "part").select("p_partkey", P.market_range(low, high).alias("r"))
    return p.select("p_partkey", F.col("r.low").cast("string").alias("low"), F.col("r.high").cast("string").alias("high"), "r.problem")


@query("F34 F25", """with e as (select event_id, case event_type when 'click' then props ->> '$.k' when 'error' then '-3' when 'view' then '' end raw from events)
select event_id, case when regexp_matches(raw, '^[0-9]+$') then raw::bigint end as value, case when raw <> '' and not regexp_matches(raw, '^[0-9]+$') then 'count-invalid' end as problem from e""")
def market_counts(spark, sf):
    raw = (F.when(F.col("event_type") == "click", F.get_json_object("props", "$.k")).when(F.col("event_type") == "error", "-3")
           .when(F.col("event_type") == "view", ""))
    return table(spark, sf, "events").select("event_id", P.count_or_problem(raw).alias("c")).select("event_id", "c.*")


@query("F17", """select p_partkey,
 (case when p_size < 10 and p_type in ('PROMO') then p_size * 1000 when p_type = 'SMALL' then 5 else p_size end)::int as low,
 (case when p_type = 'PROMO' and p_size < 10 then 9000 when p_type = 'PROMO' and p_size > 9 then 9000 when p_type = 'SMALL' then null else 2000 end)::int as high,
 (p_type = 'PROMO') as scaled from part where p_type <> 'ECONOMY'
union all select p_partkey, null, case when p_size between 1 and 9 then p_size * 1000 else p_size end, p_size between 1 and 9 from part where p_type = 'ECONOMY'""")
def thousands_repair(spark, sf):
    size, kind = F.col("p_size").cast("double"), F.col("p_type")
    low = F.when(kind == "ECONOMY", None).when(kind == "SMALL", 5.0).otherwise(size)
    high = F.when(kind == "PROMO", 9.0).when(kind == "SMALL", None).when(kind == "ECONOMY", size).otherwise(2000.0)
    story = F.when(kind == "ECONOMY", F.concat(F.lit("up to "), F.format_number(size * 1000, 0), F.lit(" m"))).otherwise("at 5000 m")
    p = table(spark, sf, "part").select("p_partkey", T.thousands_repair(low, high, story).alias("r"))
    return p.select("p_partkey", F.col("r.low").cast("int").alias("low"), F.col("r.high").cast("int").alias("high"), "r.scaled")


@query("F18 F20 F38", """select o_orderkey, floor(cast(o_totalprice as decimal(20,2)) + 0.5)::int as rounded, 2 as places,
 cast(cast(o_totalprice as decimal(20,2)) as decimal(38,6))::varchar as six,
 floor(cast(o_totalprice as decimal(20,2)))::bigint as units, ((cast(o_totalprice as decimal(20,2)) - floor(cast(o_totalprice as decimal(20,2)))) * 1000000000)::int as nanos from orders""")
def number_forms(spark, sf):
    total = F.col("o_totalprice").cast("decimal(20,2)")
    with_commas = F.format_number(total, 2)
    o = table(spark, sf, "orders").select(
        "o_orderkey", T.rounded_int(with_commas).alias("rounded"), T.decimal_places(total.cast("string")).alias("places"),
        T.fixed_six(total).alias("six"), T.wire_decimal(total).alias("w"))
    return o.select("o_orderkey", "rounded", "places", "six", "w.units", "w.nanos")


@query("F22 F23", """select o_orderkey, case o_orderstatus when 'P' then null else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as at,
 case o_orderstatus when 'P' then 'timestamp-invalid' end as problem, case when o_orderpriority = '5-LOW' then null else year(o_orderdate)::int end as year from orders""")
def dates_from_text(spark, sf):
    iso = F.concat(F.regexp_replace(F.col("o_orderdate").cast("string"), " ", "T"), F.lit("Z"))
    raw = (F.when(F.col("o_orderstatus") == "F", F.unix_millis(F.to_timestamp(iso)).cast("string"))
           .when(F.col("o_orderstatus") == "O", iso).otherwise("soon"))
    label = F.concat(F.lit("vintage "), F.when(F.col("o_orderpriority") == "5-LOW", "1234").otherwise(F.year("o_orderdate").cast("string")), F.lit("年"))
    return table(spark, sf, "orders").select(
        "o_orderkey", T.utc_text(T.timestamp_of(raw)).alias("at"), T.timestamp_problem(raw).alias("problem"),
        T.plausible_year(label).alias("year"))
