"""Quality findings, roll-ups, gates and order-dependent audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import audit as U
from catalogspark.operators import quality as Q
from catalogspark.plans.derived import table, texts
from catalogspark.plans.registry import query
from catalogspark.scale import number_rows

FALLBACKS = {"placeholder": "(?:lorem|todo|n/a)", "markup": "<[a-zA-Z]"}
DOC_SQL = f"""docs as (select d.doc_id::varchar entity, case when d.lang = 'es' then '' else d.source end title, d.text body, d.lang, coalesce(l.quality = 1, false) pub from documents d left join labels l using (doc_id)),
f as (select entity, 'required-title' rule, 'title' field, lang locale, pub blocking from docs where title = '' union all
 select entity, 'required-description', 'body', lang, pub from docs where trim(body) = '' union all
 select entity, 'forbidden-fallback', 'placeholder', lang, pub from docs where regexp_matches(concat_ws(chr(10), title, body), '{FALLBACKS["placeholder"]}') union all
 select entity, 'forbidden-fallback', 'markup', lang, pub from docs where regexp_matches(concat_ws(chr(10), title, body), '{FALLBACKS["markup"]}') union all
 select p_partkey::varchar, 'unit', 'unit', null, false from part where p_type = 'PROMO' union all
 select p_partkey::varchar, 'precision', 'size', null, false from part where p_type = 'ECONOMY' union all
 select p_partkey::varchar, 'range', 'size', null, false from part where p_size > 30 and p_type <> 'PROMO' union all
 select s_suppkey::varchar, 'origin-country', 'country', null, s_acctbal > 0 from supplier where s_nationkey < 5 union all
 select s_suppkey::varchar, 'origin-place', 'place', null, s_acctbal > 0 from supplier where s_nationkey > 20 union all
 select s_suppkey::varchar, 'altitude-order', 'low', null, s_acctbal > 0 from supplier where s_acctbal > 5000 union all
 select s_suppkey::varchar, 'altitude-range', 'low', null, s_acctbal > 0 from supplier where s_acctbal < -500 union all
 select s_suppkey::varchar, 'coordinate-range', 'lat', null, s_acctbal > 0 from supplier where s_suppkey > 90 and s_nationkey <= 20)"""


def _findings(spark, sf):
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = texts(spark, sf).join(labels, "doc_id", "left").withColumn("title", F.when(F.col("lang") == "es", "").otherwise(F.col("source")))
    doc_rules = Q.locale_text_rules("title", "text", "lang", FALLBACKS)
    for r in doc_rules:
        r.field = "body" if r.field == "text" else r.field
    parts = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.col("p_size").cast("string"), F.when(F.col("p_type") == "ECONOMY", ".00001").otherwise(".5")).alias("size"),
        F.when(F.col("p_type") == "PROMO", "stone").otherwise("kg").alias("unit"))
    bal = F.col("s_acctbal")
    origins = table(spark, sf, "supplier").select(
        "s_suppkey", bal, F.when(F.col("s_nationkey") < 5, "Cn").otherwise("CN").alias("country"),
        F.when(F.col("s_nationkey") <= 20, "here").alias("place"),
        F.when(bal > 5000, 300).when(bal < -500, -600).otherwise(100).alias("low"), F.lit(200).alias("high"),
        F.when(F.col("s_nationkey") > 20, None).when(F.col("s_suppkey") > 90, 95.0).otherwise(10.0).alias("lat"), F.lit(20.0).alias("lng"))
    return Q.union_findings([
        Q.findings(docs, "doc_id", doc_rules, blocking=F.col("quality") == 1),
        Q.findings(parts, "p_partkey", Q.number_rules("size", "unit", ["kg", "g"], {"kg": (0, 30.6)})),
        Q.findings(origins, "s_suppkey", Q.origin_rules("country", "place", "low", "high", "lat", "lng"), blocking=bal > 0),
    ])


@query("V14 V8 V1 M15", f"with {DOC_SQL} select entity, rule, field, locale, blocking, '' as message from f")
def quality_findings(spark, sf):
    return _findings(spark, sf)


@query("A7", f"""with {DOC_SQL} select rule, count(*) as findings, count(*) filter (where blocking) as blockers, count(*) filter (where not blocking) as warnings, count(distinct entity) as entities from f group by 1""")
def quality_rollup(spark, sf):
    return Q.rollup(_findings(spark, sf))


@query("O2 O4 K8", f"""with {DOC_SQL} select entity, rule, field, locale, blocking, '' as message from f order by blocking desc, rule, entity, field, locale limit 50""")
def first_findings(spark, sf):
    return Q.head(_findings(spark, sf), 50)


@query("V13", """with n as (select p_partkey, case when p_size > 40 then p_name || ' (红茶)' when p_size > 35 then p_name || '：x' else p_name end nm, case when p_type = 'PROMO' then '红' else p_name end tr from part)
select p_partkey::varchar entity, 'composite-name' rule, 'name' field, null::varchar locale, false blocking, '' message from n where nm like '%红%' union all
select p_partkey::varchar, 'native-transcription', 'transcription', null, false, '' from n where tr = '红' union all
select p_partkey::varchar, 'editorial-delimiter', 'name', null, false, '' from n where nm like '%：%'""")
def naming_audit(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" (红茶)"))).when(F.col("p_size") > 35, F.concat("p_name", F.lit("：x"))).otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_type") == "PROMO", "红").otherwise(F.col("p_name")).alias("transcription"))
    return Q.findings(p, "p_partkey", Q.naming_rules("name", "transcription"))


@query("V7", """select l_orderkey, count(*) filter (where l_linenumber = 1) as defaults, count(*) filter (where l_returnflag = 'N') as unknown_codes from lineitem group by 1
having count(*) filter (where l_linenumber = 1) <> 1 or count(*) filter (where l_returnflag = 'N') > 0""")
def package_defaults(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", (F.col("l_linenumber") == 1).alias("is_default"))
    return Q.package_rules_per_parent(li, "l_orderkey", "l_returnflag", "is_default", ["A", "R"])


@query("V9", """with t as (select l_partkey, l_suppkey, count(*) n from lineitem group by 1, 2)
select l_partkey, l_suppkey::varchar as subject, case when l_partkey = l_suppkey then 'self' when l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) then 'unknown-target' else 'repeated-target' end as problem from t
 where l_partkey = l_suppkey or l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) or n > 1
union all select l_partkey, l_orderkey::varchar, 'repeated-position' from lineitem group by 1, 2 having count(*) > 1""")
def relation_problems(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey")
    return Q.relation_problems(table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey"), "l_partkey", "l_suppkey", "l_orderkey", known)


@query("A23 V12", """with c as (select source, lang, count(*) n from documents group by 1, 2), e as (select source, lang, count(*) n from documents where length(text) > 200 group by 1, 2)
select source, lang, c.n as content_rows, coalesce(e.n, 0) as event_rows from c left join e using (source, lang) where c.n <> coalesce(e.n, 0)""")
def content_count_mismatches(spark, sf):
    d = table(spark, sf, "documents")
    return Q.content_count_mismatches(d.select("source", "lang"), d.where(F.length("text") > 200).select("source", "lang"), ["source", "lang"])


@query("V12", "select o_custkey, count(*) as articles, count(distinct o_orderpriority) as slugs from orders where o_orderstatus = 'P' group by 1 having count(*) > 1")
def one_article_per_entity(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_custkey", "o_orderpriority")
    return Q.one_article_per_entity(o, "o_custkey", "o_orderpriority")


@query("A19", """select count(*) products, count(*) filter (where o_orderstatus = 'F') published, count(distinct o_orderpriority) categories, count(distinct o_custkey) locales, 'categories' as too_few, false as ready from orders""")
def seed_readiness(spark, sf):
    return Q.seed_readiness(table(spark, sf, "orders"), F.col("o_orderstatus") == "F",
                            {"products": 100, "published": 10, "categories": 6, "locales": 5}, "o_orderpriority", "o_custkey")


#: The fold over periods, as recursive SQL: each one against the last that was accepted.
DRIFT_SQL = """k as (select day, n, row_number() over (order by day) i from {days}),
w as (select i, day, n, null::bigint as previous, false as drifted, n as last from k where i = 1 union all
 select k.i, k.day, k.n, w.last, w.last - k.n > w.last * {drop} or k.n > w.last * {grow},
 case when w.last - k.n > w.last * {drop} or k.n > w.last * {grow} then w.last else k.n end from w join k on k.i = w.i + 1)
select day, n, previous, drifted from w"""


@query("A20 T6", """with recursive d as (select datediff('day', date '2024-01-01', ts::date)::int as day, count(*) n from events group by 1), """ + DRIFT_SQL.format(days="d", drop="0.02", grow="1.02"))
def count_drift(spark, sf):
    """Daily counts of all rows as one series."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day")
    days = table(spark, sf, "events").groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    return Q.count_drift(days, "day", "n", max_drop=0.02, max_growth=1.02)


@query("A20 T6", """with recursive d as (select event_type, datediff('day', date '2024-01-01', ts::date)::int as day, count(*) n from events group by 1, 2),
k as (select event_type, day, n, row_number() over (partition by event_type order by day) i from d),
w as (select event_type, i, day, n, null::bigint as previous, false as drifted, n as last from k where i = 1 union all
 select k.event_type, k.i, k.day, k.n, w.last, w.last - k.n > w.last * 0.1 or k.n > w.last * 1.1,
 case when w.last - k.n > w.last * 0.1 or k.n > w.last * 1.1 then w.last else k.n end from w join k on k.event_type = w.event_type and k.i = w.i + 1)
select event_type, day, n, previous, drifted from w""")
def count_drift_all(spark, sf):
    """All rows of all days, one series per event type."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day")
    days = table(spark, sf, "events").groupBy("event_type", day).agg(F.count(F.lit(1)).alias("n"))
    return Q.count_drift(days, "day", "n", max_drop=0.1, max_growth=1.1, by=["event_type"])


@query("V16 V15", """select c_name as entity, 'id-format' as rule, 'id' as field, null::varchar as locale, false as blocking, '' as message from customer where c_acctbal <= 0
union all select c_name, 'collection-missing', 'segment', null, false, '' from customer where c_mktsegment = 'MACHINERY'""")
def reference_contract(spark, sf):
    key = F.md5(F.col("c_custkey").cast("string"))
    uuid = F.concat_ws("-", F.substring(key, 1, 8), F.substring(key, 9, 4), F.substring(key, 13, 4), F.substring(key, 17, 4), F.substring(key, 21, 12))
    c = table(spark, sf, "customer").select(
        F.col("c_name").alias("code"), F.when(F.col("c_acctbal") > 0, uuid).otherwise(key).alias("id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"))
    return Q.reference_contract(c, "id", "code", ["segment"])


@query("V21", """select p_partkey, case when p_type = 'PROMO' then 'ordinal-gap' when p_type = 'SMALL' then 'repeated-transition' else '' end as problems from part""")
def component_problems(spark, sf):
    step = lambda o, a, b: F.struct(o.alias("ordinal"), F.lit(a).alias("contained"), b.alias("container"))
    second = F.when(F.col("p_type") == "PROMO", 3).otherwise(2)
    chain = F.array(step(F.lit(1), "g", F.lit("cake")), F.struct(
        second.alias("ordinal"), F.when(F.col("p_type") == "SMALL", "g").otherwise("cake").alias("contained"),
        F.when(F.col("p_type") == "SMALL", "cake").otherwise("case").alias("container")))
    return table(spark, sf, "part").select("p_partkey", Q.component_problems(chain).alias("problems"))


@query("V22", """with r as (select l_orderkey * 10 + l_linenumber id, l_linenumber, l_quantity, l_returnflag, l_extendedprice from lineitem)
select id::varchar entity, 'row-order' as rule, 'pos' as field, null::varchar as locale, false as blocking, '' as message from r where l_linenumber > 6
union all select id::varchar, 'label', 'label', null, false, '' from r where l_returnflag = 'R'
union all select id::varchar, 'price', 'price', null, false, '' from r where l_extendedprice > 90000
union all select id::varchar, 'quantity', 'qty', null, false, '' from r where (l_quantity > 10 and l_quantity < 15) or l_quantity <= 5""")
def price_row_contract(spark, sf):
    qty = F.col("l_quantity")
    r = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_linenumber").alias("pos"), F.least("l_linenumber", F.lit(6)).alias("idx"),
        F.when(F.col("l_returnflag") == "R", "R ").otherwise(F.col("l_returnflag")).alias("label"),
        F.when((qty > 10) & (qty < 15), "0").when((qty > 5) & (qty <= 10), None).otherwise("500").alias("qty"),
        F.when(F.col("l_extendedprice") > 90000, "-1").otherwise("12.50").alias("price"), (qty > 10).alias("sized"))
    return Q.findings(r, "id", Q.price_row_rules("pos", "idx", "label", "qty", "price", "sized"))


@query("W4 A16", """with e as (select event_type, event_id, value, lag(value) over (partition by event_type order by event_id) p from events) select event_type, event_id, value, p as previous from e where value <= p""")
def row_id_monotone(spark, sf):
    """One series per event type, whose ids have gaps: positions are counted, not taken from the ids."""
    rows = number_rows(table(spark, sf, "events").select("event_type", "event_id", "value"), ["event_type"], ["event_id"], "position")
    return U.not_increasing(rows, ["event_type"], "position", "value", ["event_id"]).select("event_type", "event_id", "value", "previous")


@query("W4 A16", """with e as (select event_id, value, lag(value) over (order by event_id) p from events) select event_id, value, p as previous from e where value <= p""")
def row_id_monotone_all(spark, sf):
    """Every row against the row before it, at counted positions."""
    rows = number_rows(table(spark, sf, "events").select("event_id", "value"), [], ["event_id"], "position")
    return U.not_increasing(rows, [], "position", "value", ["event_id"]).select("event_id", "value", "previous")


PAGE_SQL = """items as (select event_id // 36 as page, event_id % 36 slot, case when event_type = 'error' then 'x' else user_id::varchar end item from events where not (event_type = 'view' and value > 60)),
h as (select *, sha256(slot || ':' || item) h from items),
f as (select page, count(*) n, count(distinct item) d from h group by 1)"""


def _pages(spark, sf):
    """Pages of 36 events; some long-valued views are missing from their page."""
    e = table(spark, sf, "events").where("not (event_type = 'view' and value > 60)")
    return e.select(F.floor(F.col("event_id") / 36).alias("page"), (F.col("event_id") % 36).alias("slot"),
                    F.when(F.col("event_type") == "error", "x").otherwise(F.col("user_id").cast("string")).alias("item"))


@query("W5 F39", f"""with {PAGE_SQL}, m as (select max(page) last from f)
select page, 'next-page-missing' as problem from f, m where page < last and page + 1 not in (select page from f)
union all select page, 'short-page' from f, m where page < last and n < 36 union all select page, 'over-full' from f where n > 36 union all select page, 'repeat-in-page' from f where d < n""")
def page_audit(spark, sf):
    return U.page_problems(U.page_facts(_pages(spark, sf), "page", "slot", "item"), "page", 36)


@query("W5", f"with {PAGE_SQL} select item, count(distinct page) as pages, min(page) as first_page from h group by 1 having count(distinct page) > 1")
def cross_page_duplicates(spark, sf):
    return U.cross_page_duplicates(_pages(spark, sf), "page", "item")


@query("W5", f"with {PAGE_SQL} select max(page) as last_page, (select count(*) from events where event_id < 0) as probe_items, true as complete from f")
def terminal_probe(spark, sf):
    facts = U.page_facts(_pages(spark, sf), "page", "slot", "item")
    return U.terminal_probe(facts, "page", table(spark, sf, "events").where("event_id < 0"))


@query("W5", f"with {PAGE_SQL} select max(page) as last_page, (select count(*) from events where event_id < 5) as probe_items, false as complete from f")
def terminal_probe_finds_more(spark, sf):
    facts = U.page_facts(_pages(spark, sf), "page", "slot", "item")
    return U.terminal_probe(facts, "page", table(spark, sf, "events").where("event_id < 5"))


PAIR_SQL = """c as (select conv_id, turn, role, text, lead(role) over w nr, lead(turn) over w nt, lead(text) over w nx, lag(role) over w pr, lag(turn) over w pt from conversations window w as (partition by conv_id order by turn))"""


@query("W6", f"with {PAIR_SQL} select conv_id, turn, sha256(text) as question_sha, sha256(nx) as answer_sha from c where role = 'user' and nr = 'assistant' and nt = turn + 1")
def adjacent_pairs(spark, sf):
    pairs, _ = U.pair_adjacent(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text", "user", "assistant")
    return pairs.select("conv_id", "turn", F.sha2("question", 256).alias("question_sha"), F.sha2("answer", 256).alias("answer_sha"))


@query("W6", f"""with {PAIR_SQL} select conv_id, turn, role, case when role = 'user' and (nr is null or nt <> turn + 1) then 'unanswered' when role = 'user' then 'not-followed-by-answer' else 'answer-without-question' end as problem
from c where (role = 'user' and (nr is null or nt <> turn + 1 or nr <> 'assistant')) or (role = 'assistant' and (pr is null or pt <> turn - 1 or pr <> 'user'))""")
def unpaired_turns(spark, sf):
    _, problems = U.pair_adjacent(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text", "user", "assistant")
    return problems
