"""Text columns over whole documents and part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.plans.derived import table, texts
from catalogspark.plans.registry import query

FOLD = "replace(strip_accents({0}), 'ß', 'SS')"


def _code_sql(expr: str) -> str:
    folded = FOLD.format(expr)
    return f"coalesce(nullif(regexp_replace(regexp_replace(upper({folded}), '[^A-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'UNKNOWN')"


@query("F1 F4", f"select doc_id, sha256({_code_sql('text')}) as code_sha, {_code_sql('source')} as source_code from documents")
def canonical_code(spark, sf):
    d = texts(spark, sf)
    return d.select("doc_id", F.sha2(X.code_part("text"), 256).alias("code_sha"), X.code_part("source").alias("source_code"))


@query("F2", f"""with c as (select doc_id, 'DOC-' || {_code_sql('source')} || '-' || {_code_sql('text')} code from documents)
select doc_id, case when length(code) <= 100 then code else substr(code,1,91) || '-' || upper(substr(sha1(code),1,8)) end as code from c""")
def bounded_code(spark, sf):
    return texts(spark, sf).select("doc_id", X.bounded_code("doc", F.col("source"), F.col("text")).alias("code"))


@query("F3 F4", """select doc_id,
 sha256(regexp_replace(regexp_replace(lower(strip_accents(trim(text))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) as folded,
 sha256(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) as plain from documents""")
def slug(spark, sf):
    d = texts(spark, sf)
    return d.select("doc_id", F.sha2(X.slug("text"), 256).alias("folded"), F.sha2(X.slug("text", folded=False), 256).alias("plain"))


@query("F5 F12", """select p_partkey,
 array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(substr(w,1,1)) || substr(w,2)), ' ') as title,
 upper(substr(p_name,1,1)) || substr(p_name,2) as human, lower(p_type) || '-' || replace(p_name,' ','-') as kebab from part""")
def titles(spark, sf):
    camel = F.concat(F.lower("p_type"), F.regexp_replace(F.initcap("p_name"), " ", ""))
    return table(spark, sf, "part").select(
        "p_partkey", X.titleize(F.translate("p_name", " ", "_")).alias("title"),
        X.humanize(F.translate("p_name", " ", "-")).alias("human"), X.kebab(camel).alias("kebab"))


#: A colon always ends the name; a dash parts where one side looks like a name.
DIVIDERS = [X.Divider("：", lead=9), X.Divider(" — ", needs=2)]


@query("F6", """select p_partkey,
 case when p_type = 'ECONOMY' then p_name when p_type = 'PROMO' then p_name when p_type = 'STANDARD' then p_name
      when p_type = 'SMALL' then upper(replace(p_name,' ','-')) else p_name end as display,
 case when p_type in ('ECONOMY','STANDARD') then '红茶' end as native,
 case when p_type = 'ECONOMY' then 'hong ' || p_name end as transcription,
 case when p_type = 'PROMO' then p_name || '：' || p_brand when p_type = 'STANDARD' then p_name || ' (红茶) extra'
      when p_type = 'SMALL' then upper(replace(p_name,' ','-')) || ' — the ' || p_name end as editorial from part""")
def name_decomposition(spark, sf):
    name, kind = F.col("p_name"), F.col("p_type")
    shown = (
        F.when(kind == "ECONOMY", F.concat(name, F.lit(" (红茶, *hong "), name, F.lit("*)")))
        .when(kind == "STANDARD", F.concat(name, F.lit("  (红茶) extra")))
        .when(kind == "PROMO", F.concat(name, F.lit("：  "), F.col("p_brand")))
        .when(kind == "SMALL", F.concat(F.upper(F.translate(name, " ", "-")), F.lit(" — the "), name))
        .otherwise(name)
    )
    shown = F.when(kind == "PROMO", F.concat(name, F.lit("："), F.col("p_brand"))).otherwise(shown)
    return table(spark, sf, "part").select("p_partkey", X.decompose_name(shown, DIVIDERS).alias("n")).select("p_partkey", "n.*")


@query("F7", """select p_partkey, case when p_size > 40 then '红茶 (' || p_name when p_size = 40 then '红茶' else p_name end as name,
 case when p_size > 40 then 'unterminated' end as error from part""")
def name_unwrap(spark, sf):
    shown = (F.when(F.col("p_size") > 40, F.concat(F.lit("红茶 ("), F.col("p_name"))).when(F.col("p_size") == 40, "红茶")
             .when(F.col("p_size") > 20, F.concat(F.lit("红茶（"), F.col("p_name"), F.lit("）"))).otherwise(F.col("p_name")))
    return table(spark, sf, "part").select("p_partkey", X.unwrap_name(shown, F.lit("红茶")).alias("u")).select("p_partkey", "u.*")


@query("F8", """select doc_id, lang || '-' || upper(lang) as locale, case lang when 'en' then 'en-US' when 'fr' then 'fr-FR' else lang end as alias,
 lang || '-Hans-' || upper(lang) || '-variant' as long_form from documents""")
def locale_codes(spark, sf):
    d = texts(spark, sf)
    return d.select(
        "doc_id", X.canonical_locale(F.concat(F.upper("lang"), F.lit("_"), F.col("lang"))).alias("locale"),
        X.alias_locale(F.upper("lang"), {"en": "en-US", "FR": "fr-FR"}).alias("alias"),
        X.canonical_locale(F.concat(F.col("lang"), F.lit("_hANS__"), F.col("lang"), F.lit("-VARIANT"))).alias("long_form"))


@query("F9", """with t as (select doc_id, text, source || ' ' || lang facts from documents)
select doc_id, sha256(case when length(text) <= 280 then text else rtrim(substr(text,1,279)) || '…' end) as short_sha,
 sha256(case when length(text) + 1 + length(facts) <= 400 then text || ' ' || facts
   else (case when length(text) <= 399 - length(facts) then text else rtrim(substr(text,1,398 - length(facts))) || '…' end) || ' ' || facts end) as composed_sha
from t""")
def text_budget(spark, sf):
    d = texts(spark, sf)
    facts = F.concat_ws(" ", "source", "lang")
    return d.select("doc_id", F.sha2(X.truncate("text", 280), 256).alias("short_sha"),
                    F.sha2(X.compose("text", facts, 400), 256).alias("composed_sha"))


@query("F10", """select p_partkey, 'brand: ' || p_brand || '; size: ' || p_size || case when p_type <> 'PROMO' then '; type: ' || p_type else '' end as facts,
 'temp ' || case when p_size > 25 then p_size::varchar else '?' end || ', weight ' || p_size as recipe from part""")
def factual_text(spark, sf):
    size = F.col("p_size").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        X.facts_text([("brand", F.col("p_brand")), ("size", size), ("type", F.when(F.col("p_type") != "PROMO", F.col("p_type")))]).alias("facts"),
        X.recipe_line([("temp", F.when(F.col("p_size") > 25, F.col("p_size"))), ("weight", F.col("p_size"))]).alias("recipe"))


@query("F11", """select c_custkey,
 case when c_acctbal > 5000 then 'Grown in Port ' || c_nationkey || ' City, NATION' when length(c_name) > 0 then c_mktsegment || ', R' || c_nationkey end as place,
 case when c_acctbal > 5000 then null when c_acctbal > 0 then 'Town ' || c_nationkey end as settlement,
from customer""")
def place_texts(spark, sf):
    n = F.col("c_nationkey").cast("string")
    story = F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("Grown in Port "), n, F.lit(" City, NATION. Then more"))).otherwise(F.lit(""))
    region = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("region, Town "), n, F.lit(". Rest")))
    return table(spark, sf, "customer").select(
        "c_custkey", X.place_text(story, F.col("c_mktsegment"), F.concat(F.lit("R"), n)).alias("place"),
        F.when(~(F.col("c_acctbal") > 5000), X.settlement_candidate(region, F.lit("REGION"))).alias("settlement"))


STRIP_SQL = (r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '(?m)^(#{{1,6}}|>)\s+', '', 'g'), "
             r"'\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[*_`]', '', 'g'), '\s+', ' ', 'g'))")


@query("F14 K12", f"""with m as (select doc_id, '# ' || source || chr(10) || '> [' || lang || '](x) *quote*' || chr(10) || chr(10) || text md, text from documents)
select doc_id, sha256({STRIP_SQL.format('md')}) as plain_sha, source as heading, lang || ' quote' as quoted,
 sha256(case when length(p) > 500 then rtrim(substr(p,1,497)) || '...' else nullif(p,'') end) as excerpt_sha
from (select m.*, d.source, d.lang, coalesce({STRIP_SQL.format('''list_filter(list_transform(regexp_split_to_array(m.text, chr(10) || '\\s*' || chr(10)), lambda b: trim(b)),
   lambda b: b <> '' and not regexp_matches(b, '^#|^[-*]\\s|^`'))[1]''')}, '') p from m join documents d using (doc_id))""")
def markdown_columns(spark, sf):
    d = texts(spark, sf)
    md = F.concat(F.lit("# "), F.col("source"), F.lit("\n> ["), F.col("lang"), F.lit("](x) *quote*\n\n"), F.col("text"))
    return d.select(
        "doc_id", F.sha2(X.strip_markdown(md), 256).alias("plain_sha"), X.first_heading(md, F.lit("none")).alias("heading"),
        X.excerpt(md).alias("quoted"), F.sha2(X.excerpt("text"), 256).alias("excerpt_sha"))


@query("F40", """select p_partkey, case when p_size <= 45 then p_type end as family, case when p_size <= 45 then p_size::bigint end as "index",
 case when p_size <= 45 then p_name end as local, case when p_size <= 45 then '红茶' end as native, case when p_size <= 45 then lower(p_brand) end as transcription from part""")
def label_parse(spark, sf):
    label = F.concat("p_type", F.lit("-"), F.col("p_size").cast("string"), F.lit("."), "p_name", F.lit(" (红茶"),
                     F.when(F.col("p_size") <= 45, ", ").otherwise(" "), F.lower("p_brand"), F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", X.parse_label(label).alias("l")).select("p_partkey", "l.*")


@query("P11", """select doc_id, 'text' as field, length(text)::int as length, 2000 as "limit" from documents where length(text) > 2000
union all select doc_id, 'source', length(source)::int, 4 from documents where length(source) > 4""")
def length_limits(spark, sf):
    return X.over_limit(texts(spark, sf), "doc_id", {"text": 2000, "source": 4})


@query("P13 O3", """with g as (select o_custkey, list(distinct o_orderpriority) p, list(distinct o_orderstatus) s from orders group by 1)
select o_custkey, case when list_contains(p,'3-MEDIUM') then '3-MEDIUM' when list_contains(p,'1-URGENT') then '1-URGENT' else list_min(p) end as priority,
 case list_min(s) when 'P' then 1 when 'O' then 2 else 3 end as status_rank from g""")
def ordered_preference(spark, sf):
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.collect_set("o_orderpriority").alias("p"), F.min("o_orderstatus").alias("s"))
    return g.select("o_custkey", X.preferred("p", ["3-MEDIUM", "1-URGENT"], "none").alias("priority"),
                    X.rank_in_list("s", ["P", "O"]).alias("status_rank"))


@query("F12 A9", """with d as (select doc_id, case when length(text) > 4000 then 'too_long' end a, case when lang <> 'en' then 'not_english' end b,
 case when length(text) < 50 then 'too_short' end c from documents)
select code, count(*) as uses from (select unnest([a,b,c]) code from d) where code is not null group by 1""")
def diagnostic_counts(spark, sf):
    raw = F.array_compact(F.array(
        F.when(F.length("text") > 4000, "SRC_TOO_LONG"), F.when(F.col("lang") != "en", "SRC_NOT_ENGLISH"),
        F.when(F.length("text") < 50, "SRC_TOO_SHORT"), F.when(F.col("lang") != "en", "not_english")))
    d = texts(spark, sf).select(F.explode_outer(X.diagnostic_codes(raw, "SRC")).alias("code")).where("code is not null")
    return d.groupBy("code").agg(F.count(F.lit(1)).alias("uses"))
