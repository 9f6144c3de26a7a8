"""Whole flows: raw items to observations, cards to a validated artifact, and what is handed on."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions.text import excerpt, first_heading
from catalogspark.functions.typed import utc_text
from catalogspark.operators import artifact as A
from catalogspark.operators import audit as U
from catalogspark.operators import diff as D
from catalogspark.operators import items as I
from catalogspark.operators.bindings import bind_products
from catalogspark.operators.media import ordered_media
from catalogspark.plans.derived import PART_SQL, part_baseline, part_desired, table, texts
from catalogspark.plans.registry import query
from catalogspark.scale import number_rows, spread, work_dir
from catalogspark.sinks import handoff as H
from catalogspark.sinks import manifest as K
from catalogspark.sources import readers as R

UNITS = {"g": "g", "cake": "cake", "bundle": "bundle", "case": "case"}


def _raw(spark, sf):
    """Raw observed products, all text, with the usual defects by type and size."""
    s, kind = F.col("p_size"), F.col("p_type")
    text = lambda c: c.cast("string")
    return spread(table(spark, sf, "part")).select(  # small rows, much work each
        "p_partkey", F.concat(F.lit("  "), F.translate("p_name", " ", "\t")).alias("name"),
        F.when(kind == "PROMO", "see https://shop").otherwise(F.concat(F.lit("a "), "p_name")).alias("description"),
        F.when(s > 45, "year 1234").otherwise(F.concat(text(s + 1980), F.lit("年"))).alias("year"), F.col("p_brand").alias("brand"),
        F.when(kind == "SMALL", "lots").otherwise(F.concat(text(s), F.lit("g/cake 7cake/bundle 6bundle/case"))).alias("specification"),
        F.when(s > 40, "http://img.example.com/a.png").otherwise(F.concat(F.lit("https://img.example.com/"), text(F.col("p_partkey")), F.lit(".png"))).alias("image"),
        text(F.col("p_retailprice").cast("decimal(20,2)")).alias("price"), F.when(kind == "LARGE", "crate").otherwise("case").alias("unit"),
        F.when(s < 5, "soon").otherwise("1700000000000").alias("updated"), F.when(s == 7, "0").otherwise("1").alias("price_status"),
        F.when(s > 30, "10").alias("rise"), F.when(s > 35, "500").alias("last_price"),
        F.lit("5").alias("min_price"), F.when(kind == "ECONOMY", "4").otherwise("6").alias("max_price"),
        F.when(s > 20, "88.50").alias("release_price"), F.when(s > 25, "0").otherwise("100").alias("release_count"),
        text(s).alias("buy_count"), F.when(s > 48, "many").otherwise("").alias("sell_count"))


ITEM_SQL = """i as (select *, p_size s, p_type k, cast(p_retailprice as decimal(20,2)) price, list_sort(list_filter([
 case when p_type = 'PROMO' then 'description-unsafe' end, case when p_size > 45 then 'year-implausible' end, case when p_size > 40 then 'image-address' end,
 case when p_type = 'SMALL' then 'package-grammar-unsupported' end, case when p_size < 5 then 'timestamp-invalid' end, case when p_size = 7 then 'price-hidden' end,
 case when p_size <> 7 and p_type = 'LARGE' then 'price-basis-unknown' end, case when p_size > 35 and cast(p_retailprice as decimal(20,2)) - 10 <> 500 then 'previous-price-mismatch' end,
 case when p_type = 'ECONOMY' then 'range-invalid' end, case when p_size > 48 then 'count-invalid' end,
 case when p_size > 25 then 'quantity-invalid' end, case when p_size > 20 and p_type = 'LARGE' then 'basis-unknown' end], lambda x: x is not null)) dg from part)"""


@query("F35 M11 F9", f"""with {ITEM_SQL} select p_partkey, p_name as name, p_brand as brand, case when k <> 'PROMO' then 'a ' || p_name end as description, case when s <= 45 then s + 1980 end as year,
 case when s <= 40 then 'https://img.example.com/' || p_partkey || '.png' end as image, case when k <> 'LARGE' then 'case' end as basis, case when s >= 5 then '2023-11-14 22:13:20' end as updated_at,
 cast(price as decimal(20,8))::varchar as amount, case when s <> 7 then case when s > 35 then '500.00000000' when s > 30 then cast(price - 10 as decimal(20,8))::varchar end end as previous_amount,
 case when s <> 7 and k <> 'ECONOMY' then '6.00000000' end as range_high, case when s > 20 then '88.5' end as release_amount, s::bigint as demand, null::bigint as supply, array_to_string(dg, ',') as diagnostics from i""")
def item_observations(spark, sf):
    items = I.normalize_items(_raw(spark, sf), "p_partkey", "CNY", UNITS, hosts=("img.example.com",))
    return items.select(
        "p_partkey", "name", "brand", "description", "year", "image", "basis", utc_text("updated_at").alias("updated_at"),
        F.col("amount").cast("string").alias("amount"), F.col("previous_amount").cast("decimal(20,8)").cast("string").alias("previous_amount"),
        F.col("range_high").cast("decimal(20,8)").cast("string").alias("range_high"), "release_amount", "demand", "supply",
        F.array_join("diagnostics", ",").alias("diagnostics"))


@query("K4 A9", f"with {ITEM_SQL} select code, count(*) as items from (select unnest(dg) code from i) group by 1")
def projection_report(spark, sf):
    return I.diagnostic_report(I.normalize_items(_raw(spark, sf), "p_partkey", "CNY", UNITS, hosts=("img.example.com",)))


@query("F37 J16 F17", """with c as (select c_custkey, 'N' || c_nationkey state, case when c_acctbal > 3000 then 'Sùpplier – ' || lpad((c_custkey)::varchar, 9, '0') when c_acctbal > 0 then 'twin' else '' end city,
 case when c_acctbal > 3000 then 'supplier#' || lpad((c_custkey)::varchar, 9, '0') when c_acctbal > 0 then 'twin' else '' end ckey, c_acctbal from customer),
g as (select 'N' || s_nationkey state, lower(s_name) city, count(*) n, min(s_name) nm from supplier group by 1, 2 union all select 'N' || n_nationkey, 'twin', 2, 'Twin' from nation where n_regionkey < 3)
select c_custkey, 'CN' as country, c.state, case when n = 1 then nm end as city, case when c.city <> '' then case when c.state not in (select state from g) then 'state-not-found' when n is null then 'not-found' when n > 1 then 'ambiguous' end end as warning,
 (case when c_acctbal > 5000 then 800 else 2 end)::int as altitude_min, (case when c_acctbal > 5000 then 1200 else 3000 end)::int as altitude_max, c_acctbal > 5000 as altitude_scaled,
 case when c_acctbal > 7000 then 'High slopes' else case when c.city <> '' then c.city || ', ' else '' end || c.state || ', cn' end as place
from c left join g on c.state = g.state and c.ckey = g.city""")
def origin_rows(spark, sf):
    bal = F.col("c_acctbal")
    state = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    city = F.when(bal > 3000, F.concat(F.lit("Sùpplier – "), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))).when(bal > 0, "twin").otherwise("")
    cards = table(spark, sf, "customer").select(
        "c_custkey", F.lit("cn").alias("country"), state.alias("state"), city.alias("city"),
        F.when(bal > 5000, 0.8).otherwise(2.0).alias("altitude_min"), F.when(bal > 5000, 1.2).otherwise(3000.0).alias("altitude_max"),
        F.when(bal > 7000, "High slopes. More").otherwise("").alias("narrative"))
    sellers = table(spark, sf, "supplier").select(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("state"), F.col("s_name").alias("city_name"))
    twins = table(spark, sf, "nation").where("n_regionkey < 3").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state"), F.explode(F.array(F.lit("Twin"), F.lit("TWIN"))).alias("city_name"))
    o = I.build_origins(cards, "c_custkey", sellers.unionByName(twins))
    return o.withColumn("altitude_min", F.col("altitude_min").cast("int")).withColumn("altitude_max", F.col("altitude_max").cast("int"))


def _artifact(spark, sf):
    code = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    part = table(spark, sf, "part").select(code.alias("code"), "p_partkey", "p_name", "p_size", "p_type", "p_brand")
    line = table(spark, sf, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("code"), "l_suppkey", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber")
    translations = part.select("code", F.explode(F.when(F.col("p_type") == "PROMO", F.array(F.lit("en"))).otherwise(F.array(F.lit("en"), F.lit("DE")))).alias("lang"))
    none = F.lit(None)
    specs = part.select("code", F.when(F.col("p_size") > 0, "SIZE").otherwise("NONE").alias("attribute"), F.when(F.col("p_brand") == "Brand#4", "Date").otherwise("Number").alias("type"),
                        F.col("p_size").cast("string").alias("value"), none.cast("string").alias("option"), none.cast("double").alias("value_min"), none.cast("double").alias("value_max"))
    definitions = specs.select("attribute", F.lit("Number").alias("type")).distinct().unionByName(
        table(spark, sf, "region").agg(F.max("r_regionkey")).select(F.lit("UNUSED").alias("attribute"), F.lit("List").alias("type")))
    assignments = line.where("l_returnflag <> 'N'").select("code", F.col("l_returnflag").alias("catalog"), F.col("l_linestatus").alias("category")).distinct()
    relations = line.where("l_linenumber = 1").groupBy("code").agg(F.max("l_orderkey").alias("o"), F.max("l_suppkey").alias("t")).select(
        "code", F.concat(F.lit("P"), (F.col("t") * 30).cast("string")).alias("target"), F.lit(1).alias("position"))
    return part, dict(products=part, translations=translations, specifications=specs, definitions=definitions, assignments=assignments, relations=relations)


ARTIFACT_SQL = """p as (select 'P' || p_partkey code, * from part), l as (select 'P' || l_partkey code, * from lineitem),
a as (select distinct code, l_returnflag c, l_linestatus k from l where l_returnflag <> 'N'),
r as (select code, 'P' || (max(l_suppkey) * 30) target from l where l_linenumber = 1 group by 1),
f as (select code entity, 'required-locale' rule from p where p_type = 'PROMO' union all select code, 'typed-value' from p where p_brand = 'Brand#4'
 union all select code, 'definition-mismatch' from p where p_brand = 'Brand#4' union all select 'UNUSED', 'orphan-definition'
 union all select code, 'assignment' from a where c <> 'A' union all select code, 'no-assignment' from p where code not in (select code from a)
 union all select code, 'relation' from r where target = code or target not in (select code from p))"""


@query("V1 V2 V5 V6 V9 V10 A7", f"""with {ARTIFACT_SQL} select rule, count(*) as findings, 0::bigint as blockers, count(*) as warnings, count(distinct entity) as entities from f group by 1""")
def artifact_validation(spark, sf):
    from catalogspark.operators.quality import rollup

    return rollup(A.validate_artifact(**_artifact(spark, sf)[1], locales=["en", "de"], catalogs=["A"]))


@query("K8", f"""with {ARTIFACT_SQL} select 'findings:' || rule as measure, count(*) as value from f group by 1 union all select 'entities:' || rule, count(distinct entity) from f group by 1
union all select 'rows:products', count(*) from part union all select 'rows:assignments', count(*) from a""")
def run_report(spark, sf):
    _, parts = _artifact(spark, sf)
    found = A.validate_artifact(**parts, locales=["en", "de"], catalogs=["A"])
    return A.run_report({"products": parts["products"], "assignments": parts["assignments"]}, found)


@query("V19 V18 M16", f"""with {PART_SQL}, {ARTIFACT_SQL}, x as (select d.*, b.code bc, b.id bi, d.name <> b.name cn, d.name <> b.name or d.price <> b.price ch from desired d left join baseline b using (code))
select count(*) filter (where bc is null) create_rows, count(*) filter (where bc is not null and id = bi and ch) update_rows, count(*) filter (where bc is not null and id = bi and not ch) noop_rows,
 count(*) filter (where bc is not null and id <> bi) conflict_rows, 0::bigint as scope_errors, false as eligible, (select count(*) from f) as findings, 0::bigint as blockers, false as importable from x""")
def preflight(spark, sf):
    _, parts = _artifact(spark, sf)
    found = A.validate_artifact(**parts, locales=["en", "de"], catalogs=["A"])
    diff = D.diff_rows(part_desired(spark, sf), part_baseline(spark, sf), "code", ["name", "brand", "price", "size"], identity="id")
    return A.preflight(found, D.diff_gate(diff))


LIMBS = ", ".join(f"sum(('0x' || substr(h,{a},15))::bigint)::varchar" for a in (1, 16, 31, 46))


@query("K10 V20 S18", f"""with {PART_SQL}, a as (select distinct 'P' || l_partkey code, l_returnflag "catalog", l_linestatus category from lineitem where l_returnflag <> 'N'),
m as (select 'P' || l_partkey code, md5(l_suppkey::varchar) sha, min(l_orderkey) o from lineitem group by 1, 2),
h as (select 'definitions' part, sha256(cast(json_object('attribute', attribute, 'type', 'Number') as varchar)) h from (select distinct case when p_size > 0 then 'SIZE' else 'NONE' end attribute from part)
 union all select 'bindings', sha256(cast(json_object('category', category, 'code', code, 'position', row_number() over (partition by category order by code)) as varchar)) from (select distinct category, code from a)
 union all select 'media', sha256(cast(json_object('code', code, 'media_order', row_number() over (partition by code order by o, sha), 'sha', sha) as varchar)) from m
 union all select 'patches', sha256(cast(json_object('action', action, 'code', code) as varchar)) from (select d.code, case when b.code is null then 'create' when b.id <> d.id then 'conflict' when d.name <> b.name or d.price <> b.price then 'update' else 'noop' end action from desired d left join baseline b using (code)) where action <> 'noop'
 union all select 'assignments', sha256(cast(json_object('catalog', "catalog", 'category', category, 'code', code) as varchar)) h from a
 union all select 'products', sha256(cast(json_object('code', 'P' || p_partkey, 'p_name', p_name) as varchar)) from part),
b as (select part, count(*) row_count, sha256(concat_ws(':', count(*)::varchar, {LIMBS})) set_sha256 from h group by 1)
select *, (select sha256(string_agg(part || '=' || set_sha256, chr(10) order by part)) from b) as identity from b""")
def console_artifact(spark, sf):
    """Products with everything an import needs beside them: patches, the definitions in use, bindings and ordered media."""
    part, parts = _artifact(spark, sf)
    plan = D.diff_rows(part_desired(spark, sf), part_baseline(spark, sf), "code", ["name", "brand", "price", "size"], identity="id")
    used = parts["definitions"].join(parts["specifications"].select("attribute").distinct(), "attribute", "left_semi")
    bound = bind_products(parts["assignments"], parts["assignments"], "category", "code", [])
    images = table(spark, sf, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("code"), F.md5(F.col("l_suppkey").cast("string")).alias("sha"), "l_orderkey")
    return K.write_console_artifact({
        "products": part.select("code", "p_name"), "assignments": parts["assignments"], "patches": plan.where("action <> 'noop'").select("code", "action"),
        "definitions": used, "bindings": bound, "media": ordered_media(images, "code", "sha", ["l_orderkey"]).select("code", "sha", "media_order"),
    }, work_dir(spark, "console"))


@query("K15 K5", """with d as (select 'P' || p_partkey code, p_name, p_brand, p_size, p_type from part),
s as (select 'P' || l_partkey code, count(*) n, max(l_orderkey) last from lineitem group by 1)
select d.code, sha256('## Facts' || chr(10) || '- name: ' || p_name || chr(10) || '- brand: ' || p_brand || case when p_size > 25 then chr(10) || '- size: ' || p_size else '' end || chr(10) || '## Kind' || chr(10) || '- type: ' || p_type) as content_sha256,
 (4 + case when p_size > 25 then 2 else 1 end)::bigint as lines,
 sha256(case when s.code is null then '{}' else cast(json_object('last_order', last, 'orders', n) as varchar) end) as context_sha256, (select count(*) from d) as package_sheets, true as intact
from d left join s using (code)""")
def fact_sheet_package(spark, sf):
    """A stored package of fact sheets, each with digests of its text and of the context it was made from, and a manifest."""
    d = table(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"), "p_name", "p_brand", "p_size", "p_type")
    sold = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("code")).agg(F.count(F.lit(1)).alias("orders"), F.max("l_orderkey").alias("last_order"))
    lines = H.fact_lines(d, "code", {
        "Facts": [("name", F.col("p_name")), ("brand", F.col("p_brand")), ("size", F.when(F.col("p_size") > 25, F.col("p_size")))], "Kind": [("type", F.col("p_type"))]})
    root = work_dir(spark, "sheets")
    H.write_sheets(lines, d.select("code").join(sold, "code", "left"), "code", root)
    return H.read_sheets(spark, root, "code").select("code", "content_sha256", "lines", "context_sha256", "package_sheets", "intact")


@query("M18 W2 K12 W6", """with c as (select conv_id, turn, role, text, lead(role) over w nr, lead(turn) over w nt, lead(text) over w nx from conversations window w as (partition by conv_id order by turn))
select conv_id, row_number() over (partition by conv_id order by turn) as "position", sha256(text) as question_sha, sha256(nx) as answer_sha from c where role = 'user' and nr = 'assistant' and nt = turn + 1""")
def faq_entries(spark, sf):
    """Question and answer pairs of a conversation, numbered 1..n."""
    pairs, _ = U.pair_adjacent(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text", "user", "assistant")
    hashed = pairs.select("conv_id", "turn", F.sha2("question", 256).alias("question_sha"), F.sha2("answer", 256).alias("answer_sha"))
    return number_rows(hashed, ["conv_id"], ["turn"], "position").drop("turn")


@query("K12 M18", """with t as (select doc_id, lang, source, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(list_filter(regexp_split_to_array(text, chr(10) || '\\s*' || chr(10)), lambda b: trim(b) <> '' and not regexp_matches(trim(b), '^#|^[-*]\\s|^`'))[1], ''),
 '(?m)^(#{1,6}|>)\\s+', '', 'g'), '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g'), '[*_`]', '', 'g'), '\\s+', ' ', 'g')) p from documents)
select doc_id, lang as locale, source as title, case when length(p) > 500 then rtrim(substr(p,1,497)) || '...' else nullif(p, '') end as excerpt from t""")
def article_rows(spark, sf):
    d = texts(spark, sf)
    return d.select("doc_id", F.col("lang").alias("locale"), first_heading("text", F.col("source")).alias("title"), excerpt("text").alias("excerpt"))


@query("S2 S4", "select lang, source as slug, count(*) as docs, min(doc_id) as first_doc from documents group by 1, 2")
def document_tree(spark, sf):
    """Documents written as a tree of folders; language and key come back from the path alone."""
    path = work_dir(spark, "tree")
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    d.repartitionByRange("lang", "source", "doc_id").write.partitionBy("lang", "source").json(path)
    docs = R.read_documents(spark, path, "doc_id long", pattern=r"lang=([^/]+)/source=([^/]+)/[^/]+\.json$", multiline=False)
    return docs.groupBy("lang", "slug").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))
