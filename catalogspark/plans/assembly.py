"""Entities from dumps, locale fallback and coverage, overlays on a baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import assemble as A
from catalogspark.operators import localize as L
from catalogspark.operators import overlay as O
from catalogspark.plans.derived import table
from catalogspark.plans.registry import query

LOCALES = ["en", "nb", "de", "fr"]
ALIASES = {"no": "nb"}
LANG_SQL = "case o_orderpriority when '1-URGENT' then 'en' when '2-HIGH' then 'ru' when '3-MEDIUM' then 'zh' when '5-LOW' then 'de' else 'no' end"
NAMES_SQL = f"""rows as (select o_custkey, o_orderkey, {LANG_SQL} lang, o_orderstatus || o_orderkey as name from orders),
names as (select o_custkey, lang, arg_min(name, o_orderkey) as name from rows group by 1, 2)"""


def _name_rows(spark, sf):
    """Customers as entities; each order names its customer in the language of its priority."""
    lang = (F.when(F.col("o_orderpriority") == "1-URGENT", "en").when(F.col("o_orderpriority") == "2-HIGH", "ru")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "zh").when(F.col("o_orderpriority") == "5-LOW", "de").otherwise("no"))
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", lang.alias("lang"), F.concat("o_orderstatus", F.col("o_orderkey").cast("string")).alias("name"),
        "o_orderstatus")


def _names(spark, sf):
    return L.names_by_language(_name_rows(spark, sf), "o_custkey", "lang", "name", "o_orderkey")


@query("A1 M1 P1", f"with {NAMES_SQL} select o_custkey, lang, name from names")
def names_by_language(spark, sf):
    return _names(spark, sf)


@query("J3", f"""with {NAMES_SQL},
c(locale, lang, prio) as (values ('en','en',0),('en','ru',1),('en','zh',2),('nb','nb',0),('nb','no',1),('nb','en',2),('nb','ru',3),('nb','zh',4),
 ('de','de',0),('de','en',1),('de','ru',2),('de','zh',3),('fr','fr',0),('fr','en',1),('fr','ru',2),('fr','zh',3)),
l as (select distinct locale from c), e as (select distinct o_custkey from orders),
p as (select o_custkey, locale, arg_min(name, prio) as name, arg_min(lang, prio) lang from names join c using (lang) group by 1, 2)
select o_custkey, locale, coalesce(p.name, o_custkey::varchar) as name, coalesce(p.lang, 'key') used_locale
from (select * from e cross join l) x left join p using (o_custkey, locale)""")
def locale_fallback(spark, sf):
    return L.localized_names(_names(spark, sf), "o_custkey", "lang", "name", LOCALES, ALIASES)


@query("V5 P16 U5", f"""with {NAMES_SQL}, r(locale) as (values ('en'),('zh'),('de'))
select o_custkey, locale from (select distinct o_custkey from orders) cross join r
except select o_custkey, lang from names""")
def missing_locales(spark, sf):
    return L.missing_locales(_names(spark, sf), "o_custkey", "lang", ["en", "ZH", "de"])


@query("A18 J2", f"""with {NAMES_SQL}, r(locale) as (values ('en'),('no'),('fr'))
select e.o_custkey, r.locale, n.name is not null as present from (select distinct o_custkey from orders) e cross join r
left join names n on n.o_custkey = e.o_custkey and n.lang = r.locale""")
def entity_locale_matrix(spark, sf):
    return L.coverage_matrix(_names(spark, sf), "o_custkey", "lang", ["en", "no", "fr"])


@query("A3", f"""with {NAMES_SQL}, w(locale) as (values ('en'),('fr'),('de')), c as (select lang locale, count(*) entities from names group by 1)
select coalesce(c.locale, w.locale) as locale, coalesce(entities, 0) as entities, w.locale is not null as expected from c full join w on c.locale = w.locale""")
def locale_coverage(spark, sf):
    return L.locale_coverage(_name_rows(spark, sf), "o_custkey", "lang", ["en", "fr", "de"])


@query("A17", f"with {NAMES_SQL} select o_custkey, count(*) as locales from names group by 1 having count(*) < 5")
def partial_locale_fields(spark, sf):
    return L.partial_fields(_name_rows(spark, sf), ["o_custkey"], "lang", 5)


@query("V5", "select source, lang as locale, count(*) as copies from documents group by 1, 2 having count(*) > 1")
def duplicate_locales(spark, sf):
    d = table(spark, sf, "documents").withColumn("lang", F.upper("lang"))
    return L.duplicate_locales(d, "source", "lang")


@query("J28 F8", f"""with {NAMES_SQL}, m as (select o_custkey, case when lang in ('ru','zh') then 'en-US' when lang = 'no' then 'nb' else lang end lang, lang source from names)
select o_custkey, lang, count(*) as sources, min(source) as first_source, max(source) as last_source from m group by 1, 2 having count(*) > 1""")
def locale_remap_collisions(spark, sf):
    return L.remap_locales(_names(spark, sf), "o_custkey", "lang", {"ru": "en-US", "zh": "en-US", "no": "nb"})[1]


@query("J25", """with b as (select doc_id, lang, sha256(text) h from documents), i as (select doc_id, lang, sha256(upper(source)) h from documents where source = 'src2' or lang = 'de')
select doc_id, lang, h from i union all select doc_id, lang, h from b where (doc_id, lang) not in (select doc_id, lang from i)""")
def translation_merge(spark, sf):
    d = table(spark, sf, "documents")
    base = d.select("doc_id", "lang", F.sha2("text", 256).alias("h"))
    incoming = d.where("source = 'src2' or lang = 'de'").select("doc_id", "lang", F.sha2(F.upper("source"), 256).alias("h"))
    return L.merge_translations(base, incoming, ["doc_id", "lang"])


@query("F31 A11", """with d as (select n_nationkey code, 'en' lang, n_name label from nation where n_regionkey < 3)
select s_suppkey, s_nationkey as code, 'en' as lang, coalesce(label, 'Nation ' || s_nationkey) as label,
 case when label is null then 'fallback' else 'curated' end as label_source from supplier left join d on code = s_nationkey""")
def label_fallback(spark, sf):
    d = table(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("code"), F.lit("en").alias("lang"), F.col("n_name").alias("label"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("code"), F.lit("en").alias("lang"))
    return L.label(s, "code", "lang", d, F.concat(F.lit("Nation "), F.col("code").cast("string")))


@query("F31", """with o as (select s_nationkey code, min(s_name) observed from supplier group by 1)
select code, n_name as curated, observed from nation join o on code = n_nationkey where n_name <> observed""")
def label_conflicts(spark, sf):
    d = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.lit("en-US").alias("lang"), F.col("n_name").alias("label"))
    o = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("code")).agg(F.min("s_name").alias("observed"))
    return L.label_conflicts(d, "code", "lang", o)


@query("F32 F33", f"""with {NAMES_SQL}, f as (select o_custkey, lang, min(name) as name from rows group by 1, 2), l(locale) as (values ('en'),('de'),('fr')),
x as (select o_custkey, locale, n.name nn, e.name en from (select distinct o_custkey from orders) cross join l
 left join f n using (o_custkey) left join f e using (o_custkey))
select k.o_custkey, k.locale, case when e.name is null then 'no-content' else 'fallback' end as event, case when e.name is not null then 'en' end as source_locale
from (select o_custkey, locale from (select distinct o_custkey from orders) cross join l) k
left join f n on n.o_custkey = k.o_custkey and n.lang = k.locale left join f e on e.o_custkey = k.o_custkey and e.lang = 'en' where n.name is null""")
def content_loss_events(spark, sf):
    return L.localized_content(_name_rows(spark, sf), "o_custkey", "lang", "name", ["en", "de", "fr"])[1]


@query("P14", "select o_orderkey, o_orderstatus as catalog from orders where o_orderstatus = 'F'")
def target_only_assignments(spark, sf):
    a = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("catalog"))
    return L.catalog_policy(a, "catalog", "target-only", "f")


@query("F26", """select event_id, max(case when k = 'k' then v end) as k_value, count(*) filter (where regexp_matches(k, '^[a-z]{2,3}$')) as locale_keys
from (select event_id, unnest(json_keys(props)) k, props ->> ('$.' || k) v from events) group by 1""")
def localized_map_entries(spark, sf):
    m = F.from_json("props", "map<string,string>")
    with_locales = F.map_filter(L.localized_text_map(m), lambda k, v: F.length(k) > 1)
    return table(spark, sf, "events").select(
        "event_id", F.element_at(m, "k").alias("k_value"), F.size(with_locales).cast("long").alias("locale_keys"))


CARD_SQL = """card as (select p_partkey, 'main' section, unnest(['name','brand','size']) field, unnest([p_name, p_brand, p_size::varchar]) value from part),
det as (select p_partkey, 'main' section, unnest(case when p_type = 'PROMO' then ['size','colour'] else ['brand'] end) field,
 unnest(case when p_type = 'PROMO' then [null, 'red'] else [upper(p_brand)] end) value,
 unnest(case when p_type = 'PROMO' then [true, true] else [p_size > 25] end) has_value from part)"""


def _card_and_details(spark, sf):
    p = table(spark, sf, "part")
    card = A.unpivot_fields(p, "p_partkey", "main", {"name": F.col("p_name"), "brand": F.col("p_brand"), "size": F.col("p_size")})
    promo = F.col("p_type") == "PROMO"
    row = lambda f, v, h: F.struct(F.lit(f).alias("field"), v.alias("value"), h.alias("has_value"))
    none = F.lit(None).cast("string")
    details = p.select("p_partkey", F.lit("main").alias("section"), F.explode(
        F.when(promo, F.array(row("size", none, F.lit(True)), row("colour", F.lit("red"), F.lit(True))))
        .otherwise(F.array(row("brand", F.upper("p_brand"), F.col("p_size") > 25)))).alias("r")).select("p_partkey", "section", "r.*")
    return card, details


@query("J1 S4 M2", f"""with {CARD_SQL} select coalesce(c.p_partkey, d.p_partkey) p_partkey, 'main' as section, coalesce(c.field, d.field) field,
 case when coalesce(has_value, false) then d.value else c.value end as value,
 case when c.field is null then 'detail' when d.field is null then 'card' else 'both' end as origin
from card c full join det d on c.p_partkey = d.p_partkey and c.field = d.field""")
def eav_unpivot_overlay(spark, sf):
    return A.overlay_fields(*_card_and_details(spark, sf), ["p_partkey", "section", "field"], ["value"])


@query("J2 M4", """with li as (select l_partkey p_partkey, count(*) n from lineitem group by 1), s as (select l_partkey p_partkey, count(distinct l_suppkey) n from lineitem group by 1)
select p_partkey, p_name, coalesce(li.n,0) n_lines, coalesce(s.n,0) n_sellers, unnest(['en','de','zh']) as locale from part left join li using (p_partkey) left join s using (p_partkey)""")
def star_assembly(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return A.assemble_cards(part, "p_partkey", ["en", "de", "zh"], {"lines": li, "sellers": li.distinct()})


@query("A2 M3 F28", """with f as (select source, lang, doc_id, text from documents)
select source, lang, count(*) as row_count, ('0x' || substr(sha256(source),1,8))::bigint % 64 as bucket from f group by 1, 2, 4""")
def pack_counts(spark, sf):
    f = table(spark, sf, "documents").select("source", "lang", "doc_id", "text")
    packed = A.pack_counts(A.pack_layout(f, ["source", "lang", "doc_id"]).drop("bucket"), "source", "lang")
    from catalogspark.functions.canon import key_bucket
    return packed.select("source", "lang", "row_count", key_bucket("source", 64).alias("bucket"))


@query("A17 A16", """with c as (select source, lang, count(*) n from documents group by 1, 2),
m as (select source, lang, count(*) n from documents where length(text) > 100 group by 1, 2)
select c.source, c.lang, c.n as row_count, m.n as expected_rows, case when m.n is null then 'unexpected' else 'count' end as verdict from c left join m using (source, lang) where c.n is distinct from m.n""")
def pack_mismatches(spark, sf):
    d = table(spark, sf, "documents")
    counts = A.pack_counts(d.select("source", "lang", "doc_id", "text"), "source", "lang").drop("set_sha256")
    manifest = d.where(F.length("text") > 100).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("expected_rows"))
    return A.pack_mismatches(counts, manifest, ["source", "lang"])


RELATED_SQL = """src as (select l_partkey k, 's' || l_suppkey o, 0 sr, 'returned' src, l_orderkey * 10 + l_linenumber ord from lineitem where l_returnflag = 'R'
 union all select l_partkey, 's' || l_suppkey, 1, 'other', l_orderkey * 10 + l_linenumber from lineitem where l_returnflag <> 'R'),
cand as (select k, o, min((sr, ord, src)) f from src group by 1, 2),
codes as (select 's' || s_suppkey o, s_name code from supplier where s_acctbal > 0)"""


def _related(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("k"), F.concat(F.lit(" S"), F.col("l_suppkey").cast("string")).alias("o"), "l_returnflag",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    cand = A.split_candidates(li, "k", "o", "ord", [("returned", F.col("l_returnflag") == "R"), ("other", F.col("l_returnflag") != "R")])
    codes = table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("o"), F.col("s_name").alias("code"))
    return cand, codes


@query("J4 W3 W11", f"""with {RELATED_SQL}, r as (select k, code, f[3] src, row_number() over (partition by k order by f[1], f[2], o) pos from cand join codes using (o))
select k, code, src as source, pos::int as position from r where pos <= 12""")
def top_k_related(spark, sf):
    return A.resolve_relations(*_related(spark, sf), "k", "o", 12)


@query("J4", f"with {RELATED_SQL} select k, o, 'unresolved' as warning from cand where o not in (select o from codes)")
def unresolved_relations(spark, sf):
    return A.unresolved_relations(*_related(spark, sf), "k", "o")


@query("W7 S3 M5", """with r as (select o_custkey, o_orderkey, o_orderpriority, case o_orderpriority when '3-MEDIUM' then 0 when '1-URGENT' then 1 else 2 end p from orders)
select o_custkey, arg_min(o_orderkey, (p, o_orderpriority, o_orderkey)) as o_orderkey, min((p, o_orderpriority, o_orderkey))[2] as chosen, min(p) > 0 as fell_back from r group by 1""")
def first_by_priority(spark, sf):
    rank = F.when(F.col("o_orderpriority") == "3-MEDIUM", 0).when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(2)
    o = table(spark, sf, "orders").withColumn("p", rank)
    best = o.groupBy("o_custkey").agg(F.min(F.struct("p", "o_orderpriority", "o_orderkey")).alias("b"))
    return best.select("o_custkey", "b.o_orderkey", F.col("b.o_orderpriority").alias("chosen"), (F.col("b.p") > 0).alias("fell_back"))


@query("P15", """select source as section, lang as field, bool_or(length(trim(text)) > 300 or (source = 'src3' and trim(text) <> '')) as routed, bool_or(trim(text) <> '') as has_content from documents group by 1, 2""")
def field_routing(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("section"), F.col("lang").alias("field"), "text")
    return A.route_fields(d, "section", "field", "text", long_text=300, owned=[f"src3.{x}" for x in ("en", "fr", "de", "es")])


@query("W1", """select o_custkey, o_orderpriority, min(o_orderkey) as position, arg_max(o_orderstatus, o_orderkey) as status_last, arg_min(o_orderstatus, o_orderkey) as status_first from orders group by 1, 2""")
def keyed_dedupe(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.col("o_orderkey").alias("position"), F.col("o_orderstatus").alias("status"))
    keys = ["o_custkey", "o_orderpriority"]
    last = O.dedupe_keep_last(o, keys, "position", ["status"]).withColumnRenamed("status", "status_last")
    first = O.dedupe_keep_first(o, keys, "position", ["status"]).drop("position").withColumnRenamed("status", "status_first")
    return last.join(first, keys)


SIDES_SQL = """b0 as (select o_custkey p, o_orderpriority k, o_orderkey pos, o_orderstatus v from orders where o_orderdate < timestamp '1997-06-01'),
g0 as (select o_custkey p, o_orderpriority k, o_orderkey pos, o_orderstatus v from orders where o_orderdate >= timestamp '1997-01-01'),
b as (select p, k, min(pos) pos, arg_max(v, pos) v from b0 group by 1, 2), g as (select p, k, min(pos) pos, arg_max(v, pos) v from g0 group by 1, 2)"""


def _sides(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("p"), F.col("o_orderpriority").alias("k"),
                                          F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("v"), "o_orderdate")
    return o.where("o_orderdate < timestamp_ntz'1997-06-01'").drop("o_orderdate"), o.where("o_orderdate >= timestamp_ntz'1997-01-01'").drop("o_orderdate")


@query("J5 U4 M6", f"""with {SIDES_SQL}, m as (select coalesce(b.p,g.p) p, coalesce(b.k,g.k) k, b.pos bp, g.pos gp, coalesce(g.v,b.v) v,
 case when b.p is null then 'generated' when g.p is null then 'baseline' else 'both' end origin from b full join g on b.p = g.p and b.k = g.k)
select p, k, v, origin, coalesce(bp, coalesce(max(bp) over (partition by p), 0) + row_number() over (partition by p, bp is null order by gp, k)) as pos from m""")
def overlay_baseline(spark, sf):
    return O.merge_keyed(*_sides(spark, sf), "p", ["k"], "pos", ["v"])


@query("W2 J5", f"""with {SIDES_SQL}, m as (select coalesce(b.p,g.p) p, coalesce(b.k,g.k) k, b.pos bp, g.pos gp from b full join g on b.p = g.p and b.k = g.k)
select p, k, coalesce(bp, coalesce(max(bp) over (partition by p), 0) + row_number() over (partition by p, bp is null order by gp, k)) as pos from m""")
def overlay_relations_resequence(spark, sf):
    return O.merge_relations(*_sides(spark, sf), "p", ["k"], "pos")


@query("J6", f"""with {SIDES_SQL}, m as (select coalesce(b.p,g.p) p, coalesce(b.k,g.k) k, b.v bv, g.v gv, g.k in ('1-URGENT','5-LOW') mg, exists (select 1 from b x where x.p = coalesce(b.p,g.p)) hb
 from b full join g on b.p = g.p and b.k = g.k)
select p, k, case when gv is not null and (mg or not hb) then gv else bv end as v,
 case when bv is null then 'added' when gv is not null and (mg or not hb) then 'replaced' else 'kept' end as origin from m where bv is not null or mg or not hb""")
def managed_package_merge(spark, sf):
    base, gen = (O.dedupe_keep_last(s, ["p", "k"], "pos", ["v"]) for s in _sides(spark, sf))
    return O.merge_managed(base, gen, "p", "k", ["v"], F.col("k").isin("1-URGENT", "5-LOW"))


@query("A15 V11", f"""with {SIDES_SQL} select b.p, 'priorities' as collection, b.k as "key" from b where b.p in (select p from g) and (b.p, b.k) not in (select p, k from g)""")
def lost_associations(spark, sf):
    return O.lost_rows(*_sides(spark, sf), "p", ["k"], "priorities")


@query("F30 A10", """with m as (select p_type t, upper(p_brand) a from part where p_size <= 10 union all select p_type, upper(p_brand) from part where p_size > 40)
select t, a, count(*) as copies from m group by 1, 2 having count(*) > 1""")
def overlay_specification_clashes(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("t"), F.col("p_brand").alias("a"), "p_size")
    return O.overlay_specifications(p.where("p_size <= 25"), p.where("p_size > 40"), "t", "a", F.col("p_size") > 10)[1]


@query("J5 F35", """with b as (select c_custkey code, c_mktsegment seg, c_acctbal > 0 published from customer where c_nationkey < 15)
select c.c_custkey as code, c.c_name as name, coalesce(b.seg, 'NEW') as seg, coalesce(b.published, false) as published, case when b.code is null then 'new' else 'overlay' end as origin
from customer c left join b on b.code = c.c_custkey""")
def overlay_header(spark, sf):
    c = table(spark, sf, "customer")
    code = F.col("c_custkey").cast("string").alias("code")
    base = c.where("c_nationkey < 15").select(code, F.col("c_mktsegment").alias("seg"), (F.col("c_acctbal") > 0).alias("published"))
    gen = c.select(code, F.col("c_name").alias("name"), F.lit("NEW").alias("seg"), F.lit(False).alias("published"))
    return O.overlay_header(base, gen, "code", ["name"], ["seg", "published"]).withColumn("code", F.col("code").cast("long"))


@query("U4", """with a as (select c_custkey k, c_mktsegment x, null y from customer), b as (select o_custkey k, null x, max(o_orderstatus) y from orders group by 1),
c as (select o_custkey k, min(o_orderpriority) x, null y from orders where o_totalprice > 400000 group by 1)
select coalesce(a.k,b.k,c.k) k, coalesce(c.x, a.x) x, b.y from a full join b on a.k = b.k full join c on coalesce(a.k,b.k) = c.k""")
def merge_latest_fields(spark, sf):
    o = table(spark, sf, "orders")
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("x"))
    b = o.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderstatus").alias("y"))
    c = o.where("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderpriority").alias("x"))
    return O.merge_latest([a, b, c], "k", ["x", "y"])
