"""Rule books over texts, addresses and values."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import safety as S
from catalogspark.functions.text import code_part
from catalogspark.operators import rule_index as X
from catalogspark.operators import rules as R
from catalogspark.plans.derived import table, texts
from catalogspark.plans.registry import query

#: Rules over the function words of the test texts; a gated rule needs its parent.
WORDS = {
    "fr": ("le", "la", "les", "que"),
    "de": ("der", "die", "und"),
    "en": ("the", "and"),
    "de-neg": ("nicht", "ist nicht"),
    "fr-dans": ("dans", "avec"),
}
GATES = {"de-neg": "de", "fr-dans": "fr"}
BOOK = [
    R.Rule(c, tuple(R.word(w) for w in ws if " " in w), GATES.get(c), tuple(w for w in ws if " " not in w)) for c, ws in WORDS.items()
]


def _hit(code: str, text: str = "text") -> str:
    return "(" + " or ".join(rf"regexp_matches({text}, '\b{p}\b')" for p in WORDS[code]) + ")"


def _labels_sql(text: str = "text", gated: bool = True) -> str:
    parts = [f"case when {_hit(c, text)}{' and ' + _hit(GATES[c], text) if gated and c in GATES else ''} then '{c}' end" for c in WORDS]
    return f"concat_ws(',', {', '.join(parts)})"


@query("R1 R2", f"select doc_id, {_labels_sql()} as labels from documents")
def gated_rule_labels(spark, sf):
    return texts(spark, sf).select("doc_id", F.array_join(R.labels("text", BOOK), ",").alias("labels"))


@query("R1", f"""select label, count(*) as docs from (select unnest(string_split({_labels_sql(gated=False)}, ',')) as label from documents) where label <> '' group by 1""")
def rule_labels(spark, sf):
    open_book = [R.Rule(r.code, r.patterns, words=r.words) for r in BOOK]
    d = texts(spark, sf).select(F.explode_outer(R.labels("text", open_book)).alias("label")).where("label is not null")
    return d.groupBy("label").agg(F.count(F.lit(1)).alias("docs"))


CONTRAST_SQL = r"trim(case when regexp_matches(text, '\b(mit|avec|with)\b') then regexp_extract(text, '(?s)^(.*?)\b(mit|avec|with)\b', 1) else text end)"


@query("R3", f"select doc_id, length({CONTRAST_SQL})::int as kept, {_labels_sql(CONTRAST_SQL)} as labels from documents")
def contrast_stripped_labels(spark, sf):
    head = R.strip_contrast("text", ["mit", "avec", "with"])
    d = texts(spark, sf).withColumn("head", head)
    return d.select("doc_id", F.length("head").alias("kept"), F.array_join(R.labels("head", BOOK), ",").alias("labels"))


NAMES = ["le", "la", "der", "the", "ist"]
HEAD_SQL = r"(case when regexp_matches(text, '[.!?]\s') then regexp_extract(text, '(?s)^(.*?[.!?])\s', 1) else text end)"


def _evidence_sql() -> str:
    strong = ", ".join(rf"case when regexp_matches(h, '\b{n}\s+(?:en|in|of)\b') then '{n}' end" for n in NAMES)
    weak = ", ".join(rf"case when regexp_matches(h, '\b{n}\b') then '{n}' end" for n in NAMES)
    return f"""with t as (select doc_id, {HEAD_SQL} h from documents),
s as (select doc_id, list_filter([{strong}], lambda x: x is not null) st, list_filter([{weak}], lambda x: x is not null) wk from t),
p as (select doc_id, case when len(st) > 0 then st else wk end pool, len(st) ns, len(wk) nw from s)
select doc_id, case when len(pool) = 1 then pool[1] end as value, case when ns > 0 then 'explicit' when nw > 0 then 'mention' end as evidence,
 case when len(pool) > 1 then array_to_string(pool, ',') end as ambiguous from p"""


@query("R4", _evidence_sql())
def explicit_beats_mention(spark, sf):
    d = texts(spark, sf)
    return d.select("doc_id", R.explicit_or_mention("text", NAMES, "(?:en|in|of)").alias("e")).select("doc_id", "e.*")


@query("R5", f"""with t as (select doc_id, lang, source, {HEAD_SQL} h from documents)
select doc_id, case when source = 'src1' then lang when regexp_matches(h, '\\bthe\\b') then 'en' end as language from t""")
def structured_beats_inferred(spark, sf):
    given = F.when(F.col("source") == "src1", F.col("lang")).otherwise(" ")
    guess = F.when(R.first_sentence("text").rlike(R.word("the")), "en")
    return texts(spark, sf).select("doc_id", R.structured_first(given, guess).alias("language"))


@query("R6", """select p_partkey, unnest(case when p_type = 'ECONOMY' and p_size > 25 then ['FAM-1','BIG'] when p_type = 'PROMO' and p_size > 25 then ['FAM-2']
 when p_type = 'PROMO' then ['FAM-3'] else [] end) as code from part""")
def cross_facet_codes(spark, sf):
    size = F.when(F.col("p_size") > 25, "big").otherwise("small")
    pairs = {("ECONOMY", "big"): ["FAM-1", "BIG"], ("PROMO", "big"): ["FAM-2"], ("PROMO", "small"): ["FAM-3"]}
    return table(spark, sf, "part").select("p_partkey", F.explode_outer(R.cross_facets(F.col("p_type"), size, pairs)).alias("code")).where("code is not null")


TYPES = {"ECONOMY": "CAT-ECO", "STANDARD": "CAT-STD", "PROMO": "CAT-PROMO"}
TYPE_SQL = "case p_type when 'ECONOMY' then 'CAT-ECO' when 'STANDARD' then 'CAT-STD' when 'PROMO' then 'CAT-PROMO' end"


@query("R7 R9", f"""select p_partkey, coalesce({TYPE_SQL}, 'CAT-ANY') as code, case when {TYPE_SQL} is null then 'no mapping for ' || p_type end as warning from part""")
def value_mapping_warnings(spark, sf):
    return R.map_values(table(spark, sf, "part"), "p_partkey", "p_type", TYPES, parent="CAT-ANY")


@query("R8", """with n(declared_order, value, code, parent) as (values (1,'MACHINERY','SEG-M','SEG'),(2,'GARDEN','SEG-G','SEG'),(3,'HOUSEHOLD','SEG-H','SEG'),(4,'BUILDING','SEG-B',''))
select declared_order, code, parent, count(*) as uses from n join customer on value = c_mktsegment group by all""")
def observed_taxonomy(spark, sf):
    nodes = [("MACHINERY", "SEG-M", "SEG"), ("GARDEN", "SEG-G", "SEG"), ("HOUSEHOLD", "SEG-H", "SEG"), ("BUILDING", "SEG-B", None)]
    return R.observed_nodes(nodes, table(spark, sf, "customer"), "c_mktsegment")


@query("R10", """with h as (select count(*) hits, min(code) fc from (select distinct p_brand code from part) where lower(trim(code)) = 'brand#12')
select hits, case when hits = 0 then 'absent' when hits = 1 then 'use' else 'ambiguous' end as verdict, case when hits = 1 then fc end as code from h""")
def unique_definition(spark, sf):
    brands = table(spark, sf, "part").select(F.col("p_brand").alias("code"), F.col("p_brand").alias("label")).distinct()
    return R.unique_definition(brands, "label", "BRAND#12")


@query("R11 W1", """with t as (select p_partkey, lower(p_type) tag, 1 src, 0 pos from part union all
 select p_partkey, unnest(string_split(p_name,' ')), 2, unnest(range(1, len(string_split(p_name,' ')) + 1)) from part)
select p_partkey, tag, min(src)::int as source from t group by 1, 2""")
def merged_tags(spark, sf):
    p = table(spark, sf, "part")
    first = p.select("p_partkey", F.lower("p_type").alias("tag"), F.lit(1).alias("source"))
    second = p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("tag"), F.lit(2).alias("source"))
    return first.unionByName(second).groupBy("p_partkey", "tag").agg(F.min("source").alias("source"))


AGENTS = [(["*"], [("/", False)]), (["catalog"], [("/en/", True), ("/en/*7", False), ("/*/1*", True), ("/de/", True), ("/de/*2$", False), ("/", False)])]


@query("P10", r"""
with u as (select page_id, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), ''), '/') as path from pages),
r(pattern, len, allow) as (values ('^/en/', 4, true), ('^/en/.*7', 5, false), ('^/.*/1', 3, true), ('^/de/', 4, true), ('^/de/.*2$', 5, false), ('^/', 1, false)),
m as (select page_id, path, allow, row_number() over (partition by page_id order by len desc, allow desc) rn from u join r on regexp_matches(path, pattern))
select u.page_id, u.path, coalesce(m.allow, false) as allowed from u left join m on u.page_id = m.page_id and rn = 1""")
def longest_match_policy(spark, sf):
    path = F.coalesce(F.nullif(F.try_parse_url("url", F.lit("PATH")), F.lit("")), F.lit("/"))
    d = table(spark, sf, "pages").select("page_id", path.alias("path"))
    return d.withColumn("allowed", R.longest_match("path", R.rules_for_agent(AGENTS, "CatalogBot/1.0")))


@query("P8", r"""
with u as (select page_id, url, regexp_extract(url, '^([a-z]+)://', 1) sch, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) host,
 regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) path, regexp_extract(url, '\?([^#]*)', 1) q, contains(url, '#') frag from pages),
k as (select *, string_split(q, '&') pairs from u)
select page_id, case when host = '' then 'invalid' when sch <> 'https' then 'not-https' when frag then 'fragment'
 when not (host = 'example.com' or host like '%.example.com') then 'host' when not path like '/%' then 'path'
 when q <> '' and len(list_filter(pairs, lambda p: not regexp_matches(p, '^page=[0-9]+$') and not regexp_matches(p, '^ref='))) > 0 then 'query-key'
 when q <> '' and len(list_distinct(list_transform(pairs, lambda p: split_part(p, '=', 1)))) < len(pairs) then 'query-repeat' end as broken_rule from k""")
def url_policy_flags(spark, sf):
    rule = S.url_policy("url", suffixes=["example.com"], query_rules={"page": r"^[0-9]+$", "ref": ""})
    return table(spark, sf, "pages").select("page_id", rule.alias("broken_rule"))


def _flags_sql(patterns) -> str:
    return ", ".join(f"regexp_matches(text, '{p}') as {n}" for n, p in patterns.items())


@query("P7", f"select doc_id, {_flags_sql({**S.CONTACT_PATTERNS, **S.NUMERIC_PATTERNS})} from documents")
def sensitive_text_flags(spark, sf):
    flags = S.contact_flags("text")
    return texts(spark, sf).select("doc_id", *[c.alias(n) for n, c in flags.items()])


@query("P9", f"select doc_id, {_flags_sql(S.UNSAFE_TEXT)}, length(text) > 4000 as too_long from documents")
def boilerplate_flags(spark, sf):
    flags = S.unsafe_text_flags("text", max_length=4000)
    return texts(spark, sf).select("doc_id", *[c.alias(n) for n, c in flags.items()])


@query("P6", """select event_id, k as name from (select event_id, unnest(json_keys(props)) k from events) where k in ('k', 'phone')""")
def forbidden_map_keys(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return S.forbidden_map_keys(e, "event_id", "m", "(?i)phone|^k$")


@query("P3 P4 F1", """with c as (select p_partkey, 'SPEC-' || upper(replace(p_name,' ','-')) attribute, 'SPEC-GROUP-' || p_type grp from part)
select p_partkey, attribute like 'SPEC-S%' or grp like 'SPEC-SGROUP-%' as managed,
 attribute like 'SPEC-RED%' or grp = 'SPEC-GROUP-PROMO' or regexp_matches(attribute, '-RING$') as junk from c""")
def managed_and_junk_codes(spark, sf):
    c = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("SPEC-"), code_part("p_name")).alias("attribute"), F.concat(F.lit("SPEC-GROUP-"), "p_type").alias("grp"))
    junk = R.junk_code("attribute", ["SPEC-RED"], [], ["-RING$"]) | R.junk_code("grp", [], ["SPEC-GROUP-PROMO"], [])
    return c.select("p_partkey", R.prefix_managed("attribute", "grp", "SPEC-S").alias("managed"), junk.alias("junk"))


@query("J16", """with d as (select s_nationkey k, count(*) hits, min(s_name) code from supplier group by 1)
select c_custkey, case when hits = 1 then code end as seller, case when hits is null then 'not-found' when hits > 1 then 'ambiguous' end as warning
from customer left join d on k = c_nationkey""")
def unique_lookup(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("seller"))
    return R.unique_lookup(c, ["nation"], s, "seller").drop("nation")


@query("P12 P18", """select p_partkey, upper(trim(p_name)) as code, case when p_size > 30 and p_type = 'PROMO' then 'missing-detail' else 'fatal' end as issue from part""")
def reference_codes(spark, sf):
    from catalogspark.functions.canon import reference_code_of
    from catalogspark.sources.readers import issue_kind

    p = table(spark, sf, "part").select(
        "p_partkey", F.struct(F.concat(F.lit("  "), F.col("p_name")).alias("code")).alias("ref"),
        F.when(F.col("p_type") == "PROMO", "field").otherwise("card").alias("endpoint"), F.when(F.col("p_size") > 30, 404).otherwise(500).alias("status"))
    return p.select("p_partkey", reference_code_of(p, "ref").alias("code"), issue_kind("endpoint", "status").alias("issue"))


PLAIN_SQL = r"""' ' || trim(regexp_replace(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-/:-@\[-`{{-\x7F]+', ' ', 'g'), ' ') || ' '"""


@query("R1 R2 R9 P4", f"""with b as (select item_id, string_split(trim({PLAIN_SQL.format('text')}), ' ') w from benchmark),
r as (select 'B' || item_id code, array_to_string(w[1:3], ' ') phrase, null needs from b union select 'W' || item_id, w[5], 'B' || item_id from b union select 'F' || (item_id // 10), w[2], null from b),
d as (select doc_id, {PLAIN_SQL.format('text')} t from documents),
h as (select doc_id, code, needs from d join r on contains(t, ' ' || phrase || ' ') where phrase <> '')
select distinct doc_id, code from h where needs is null or exists (select 1 from h g where g.doc_id = h.doc_id and g.code = h.needs)""")
def phrase_rules_from_table(spark, sf):
    """A rule book read from ``benchmark``: first words, a gated word, families of words; over all documents."""
    words = F.split(F.trim(X.plain_words("text")), " ")
    b = table(spark, sf, "benchmark").select("item_id", words.alias("w"))
    name = lambda letter, n: F.concat(F.lit(letter), n.cast("string")).alias("code")
    item = F.col("item_id")
    rules = b.select(name("B", item), F.array_join(F.slice("w", 1, 3), " ").alias("phrase"), F.lit(None).cast("string").alias("needs"))
    rules = rules.unionByName(b.select(name("W", item), F.get("w", F.lit(4)).alias("phrase"), name("B", item).alias("needs")))
    rules = rules.unionByName(b.select(name("F", F.floor(item / 10)), F.get("w", F.lit(1)).alias("phrase"), F.lit(None).cast("string").alias("needs")))
    return X.phrase_labels(texts(spark, sf), "doc_id", "text", rules, requires="needs")


PATH_SQL = "coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), ''), '/')"


@query("P10", rf"""with u as (select page_id, {PATH_SQL} as path from pages),
s as (select path, regexp_extract(path, '^/([a-z]+)/([0-9]+)', ['l', 'n']) x from u),
r as (select '/' || x.l || '/' pattern, x.l <> 'de' allow from s where x.l <> '' union select '/' || x.l || '/' || x.n[1:1], x.n[1:1] in ('2', '4', '6') from s where x.l <> ''
 union select '/*/' || x.n || '$', false from s where len(x.n) = 2 union select '*' || x.n[2:3] || '.html$', true from s where len(x.n) = 3 union select path || '$', x.n < '5' from s where x.l = 'es' union select '/', false),
q as (select allow, len(replace(regexp_replace(pattern, '\$$', ''), '*', '')) n, '^' || replace(replace(pattern, '.', '\.'), '*', '.*') regex from r),
m as (select path, max(struct_pack(n := n, allow := allow)) b from (select distinct path from u) join q on regexp_matches(path, regex) group by path)
select page_id, path, coalesce(b.allow, false) as allowed, b.n::int as matched from u left join m using (path)""")
def longest_match_from_table(spark, sf):
    """Rules derived from the pages themselves: thousands of prefixes, wildcards and whole addresses at size."""
    path = F.coalesce(F.nullif(F.try_parse_url("url", F.lit("PATH")), F.lit("")), F.lit("/"))
    pages = table(spark, sf, "pages").select("page_id", path.alias("path"))
    part = lambda i: F.regexp_extract("path", "^/([a-z]+)/([0-9]+)", i)
    s = pages.select("path", part(1).alias("l"), part(2).alias("n"))
    first = F.substring("n", 1, 1)
    rule = lambda where, pattern, allow: s.where(where).select(pattern.alias("pattern"), allow.alias("allow"))
    rules = rule("l <> ''", F.concat(F.lit("/"), "l", F.lit("/")), F.col("l") != "de")
    rules = rules.unionByName(rule("l <> ''", F.concat(F.lit("/"), "l", F.lit("/"), first), first.isin("2", "4", "6")))
    rules = rules.unionByName(rule("length(n) = 2", F.concat(F.lit("/*/"), "n", F.lit("$")), F.lit(False)))
    rules = rules.unionByName(rule("length(n) = 3", F.concat(F.lit("*"), F.substring("n", 2, 2), F.lit(".html$")), F.lit(True)))
    rules = rules.unionByName(rule("l = 'es'", F.concat("path", F.lit("$")), F.col("n") < "5"))
    rules = rules.unionByName(spark.range(1).select(F.lit("/").alias("pattern"), F.lit(False).alias("allow")))
    return X.longest_rule(pages, "path", rules.distinct())
