"""Definitions, bindings, trees, matching and digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import canon as C
from catalogspark.operators import bindings as B
from catalogspark.operators import hierarchy as H
from catalogspark.operators import match as M
from catalogspark.operators import specs as S
from catalogspark.plans.derived import table
from catalogspark.plans.registry import query
from catalogspark.sources import readers as R

LIMBS_SQL = ", ".join(f"sum(('0x' || substr(h,{a},15))::bigint)::varchar" for a in (1, 16, 31, 46))
SET_SQL = f"sha256(concat_ws(':', count(*)::varchar, {LIMBS_SQL}))"
PART_JSON = "sha256(cast(json_object('p_brand', p_brand, 'p_name', p_name, 'p_partkey', p_partkey, 'p_size', p_size, 'p_type', p_type) as varchar))"
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


@query("A12 F15", f"select p_partkey, {PART_JSON} as row_sha256 from part")
def row_digest(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", C.row_digest(p, PART_COLUMNS).alias("row_sha256"))


@query("A12 S13", f"with t as (select p_type, {PART_JSON} h from part) select p_type, count(*) as row_count, {SET_SQL} as set_sha256 from t group by 1")
def set_digest(spark, sf):
    p = table(spark, sf, "part")
    return C.set_digest(p.withColumn("h", C.row_digest(p, PART_COLUMNS)), "h", by=["p_type"])


@query("F28 F27", """select doc_id, 'SRC-' || upper(substr(sha256(source), 1, 12)) as code, ('0x' || substr(sha256(text),1,8))::bigint % 64 as bucket,
 'key-' || substr(sha256(lang || '|' || source || '|' || doc_id), 1, 32) as item_key from documents""")
def stable_keys(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", C.short_code("SRC", "source").alias("code"), C.key_bucket("text", 64).alias("bucket"),
        C.observation_key("key-", "lang", "source", "doc_id").alias("item_key"))


@query("F16", """select p_partkey, 'number' as kind, '0' || p_size || '.50' as raw, p_size || '.5' as canonical from part
union all select p_partkey, 'boolean', case when p_size > 25 then 'TRUE' else '0' end, case when p_size > 25 then 'true' else 'false' end from part
union all select p_partkey, 'list', '[ "' || p_name || '" , "b"]', '["' || p_name || '","b"]' from part
union all select p_partkey, 'text', p_name, p_name from part""")
def typed_canonical_values(spark, sf):
    size = F.col("p_size").cast("string")
    row = lambda k, v: F.struct(F.lit(k).alias("kind"), v.alias("raw"))
    rows = F.array(
        row("number", F.concat(F.lit("0"), size, F.lit(".50"))), row("boolean", F.when(F.col("p_size") > 25, "TRUE").otherwise("0")),
        row("list", F.concat(F.lit('[ "'), "p_name", F.lit('" , "b"]'))), row("text", F.col("p_name")))
    p = table(spark, sf, "part").select("p_partkey", F.explode(rows).alias("r")).select("p_partkey", "r.*")
    return p.withColumn("canonical", C.typed_value("kind", "raw"))


@query("F13 M14", """select event_id, 'event-type' as path, event_type as value, sha256(event_type) as value_sha256 from events
union all select event_id, 'props.k', props ->> '$.k', sha256(props ->> '$.k') from events where props ->> '$.k' is not null
union all select event_id, 'user-id', user_id::varchar, sha256(user_id::varchar) from events""")
def flatten_json_paths(spark, sf):
    from catalogspark.operators.flatten import flatten_paths

    e = table(spark, sf, "events").select(
        "event_id", F.struct(F.col("event_type").alias("eventType"), F.col("user_id").alias("userId"),
                             F.from_json("props", "struct<k:long,missing:array<string>>").alias("props")).alias("facts"))
    return flatten_paths(e, "event_id", "facts")


@query("F13", """with x as (select event_id, unnest(json_keys(props)) k, props, event_type, user_id from events) select event_id, '$.facts.open.' || k as path, json_extract_string(props, '$.' || k) as value from x
union all select event_id, '$.facts.ids[0].user', user_id::varchar from x union all select event_id, '$.type', event_type from x""")
def open_json_paths(spark, sf):
    """Open facts three levels down, next to shallow ones."""
    from catalogspark.operators.flatten import open_paths

    nested = F.format_string('{"type": "%s", "facts": {"open": %s, "ids": [{"user": %d}]}}', "event_type", "props", "user_id")
    return open_paths(table(spark, sf, "events").withColumn("facts", nested), "event_id", "facts")


@query("A12 F15 J8", """select p_partkey, case when p_partkey % 3 = 0 then 'update' else 'noop' end as action from part""")
def lossless_diff(spark, sf):
    """A price that changes at its twelfth place is a change; the same number at another scale is none."""
    from catalogspark.operators.diff import diff_rows

    price = F.col("p_partkey").cast("decimal(20,12)") / F.lit(7).cast("decimal(2,0)")
    p = table(spark, sf, "part").select("p_partkey", price.cast("decimal(26,12)").alias("price"))
    step = F.when(F.col("p_partkey") % 3 == 0, F.lit("0.000000000001")).otherwise(F.lit("0")).cast("decimal(26,12)")
    desired = p.select("p_partkey", (F.col("price") + step).cast("decimal(30,14)").alias("price"))
    return diff_rows(desired, p, key="p_partkey", fields=["price"]).select("p_partkey", "action")


SPEC_SQL = """spec as (
 select p_partkey, 'SIZE' attribute, 'Number' type, null::varchar as option, p_size::varchar as value, null::double value_min, null::double value_max, 'g' unit from part
 union all select p_partkey, 'NAME', 'CustomText', null, p_name, null, null, null from part
 union all select p_partkey, 'BRAND', 'Option', 'OPT-BRAND-' || replace(upper(p_brand), '#', '-'), null, null, null, null from part
 union all select p_partkey, 'BAND', 'Range', null, null, case when p_size > 30 then p_size else 40 end::double, case when p_size > 10 then 40 else p_size end::double, 'cm' from part
 union all select p_partkey, 'WORDS', 'List', null, '["' || array_to_string(list_distinct_ordered, '","') || '"]', null, null, null from (select p_partkey, case when split_part(p_name,' ',1) = split_part(p_name,' ',2) then [split_part(p_name,' ',1)] else string_split(p_name,' ') end list_distinct_ordered from part)
 union all select p_partkey, 'BIG', 'Boolean', null, (p_size > 25)::varchar, null, null, null from part where p_type <> 'PROMO'
 union all select p_partkey, 'STEEP', 'Duration', null, (p_size * 10)::varchar, null, null, 's' from part where p_size <= 40)"""


def _specs(spark, sf):
    size = F.col("p_size")
    return S.build_specs(table(spark, sf, "part"), "p_partkey", [
        S.number_spec("SIZE", size, 1, "g"), S.text_spec("NAME", F.col("p_name"), 2), S.option_spec("BRAND", F.col("p_brand"), 3),
        S.range_spec("BAND", F.when(size > 30, size).otherwise(40), F.when(size > 10, 40).otherwise(size), 4, "cm"),
        S.list_spec("WORDS", F.concat(F.split("p_name", " "), F.array(F.lit(" "))), 5),
        S.boolean_spec("BIG", F.when(F.col("p_type") == "PROMO", "maybe").when(size > 25, "Yes").otherwise("0"), 6),
        S.duration_spec("STEEP", F.when(size > 40, "soon").otherwise((size * 10).cast("string")), 7),
    ])


@query("F29 F24 F25 M7", f"with {SPEC_SQL} select * from spec")
def spec_rows(spark, sf):
    return _specs(spark, sf).drop("order")


@query("V3", f"""with {SPEC_SQL} select p_partkey, attribute, type, 'reversed' as problem from spec where attribute = 'BAND' and value_min > value_max
union all select p_partkey, 'NAME', 'Date', 'bad-date' from part where p_size > 30 union all select p_partkey, 'NAME', 'Hyperlink', 'bad-hyperlink' from part where p_size <= 30""")
def typed_value_violations(spark, sf):
    kind = F.when(F.col("attribute") != "NAME", F.col("type")).when(F.col("p_size") > 30, "Date").otherwise("Hyperlink")
    sized = _specs(spark, sf).join(table(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey").withColumn("type", kind)
    return S.typed_value_violations(sized, "p_partkey")


@query("V3", """select event_id, 'k' as attribute, t as type, p as problem from (select event_id, event_type, (props ->> '$.k') v from events) e,
 lateral (select case event_type when 'click' then 'Number' when 'view' then 'Boolean' else 'Date' end t, case event_type when 'click' then case when v is null then 'missing-value' end when 'view' then 'bad-boolean' else 'bad-date' end p) where p is not null""")
def event_value_violations(spark, sf):
    kind = F.when(F.col("event_type") == "click", "Number").when(F.col("event_type") == "view", "Boolean").otherwise("Date")
    none = F.lit(None)
    e = table(spark, sf, "events").select(
        "event_id", F.lit("k").alias("attribute"), kind.alias("type"), F.get_json_object("props", "$.k").alias("value"),
        none.cast("string").alias("option"), none.cast("double").alias("value_min"), none.cast("double").alias("value_max"))
    return S.typed_value_violations(e, "event_id")


@query("V4", f"""with {SPEC_SQL}, d(code, kind, unit) as (values ('SIZE','Number','kg'),('NAME','CustomText',null),('BRAND','CustomText',null),('BAND','Range','cm'),('WORDS','List',null),('BIG','Boolean',null))
select p_partkey, attribute, case when code is null then 'undefined' when attribute = 'SIZE' then 'unit' else 'type' end as problems
from spec left join d on attribute = code where code is null or type <> kind or spec.unit is distinct from d.unit""")
def definition_mismatches(spark, sf):
    from catalogspark.scale import literal_table

    d = literal_table(spark, ["attribute", "kind", "unit"], [("SIZE", "Number", "kg"), ("NAME", "CustomText", None), ("BRAND", "CustomText", None),
                                                        ("BAND", "Range", "cm"), ("WORDS", "List", None), ("BIG", "Boolean", None)])
    return S.definition_mismatches(_specs(spark, sf), F.broadcast(d), "p_partkey", "attribute", {"type": "kind", "unit": "unit"})


@query("A10 M8", """select l_partkey as code, min(l_linenumber)::int as l_linenumber, count(*) as observations, min(l_returnflag) as l_returnflag, min(l_linestatus) as l_linestatus,
 concat_ws(',', case when min(l_returnflag) <> max(l_returnflag) then 'l_returnflag' end, case when min(l_linestatus) <> max(l_linestatus) then 'l_linestatus' end) as conflicts from lineitem group by 1""")
def conflict_checked_merge(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("int"))
    return S.merge_definitions(li, "l_partkey", ["l_returnflag", "l_linestatus"], "l_linenumber").withColumnRenamed("l_partkey", "code")


@query("F30 A10", """with t as (select o_custkey p, upper(o_orderpriority) a, o_orderstatus v, o_orderkey ord from orders)
select p, a, arg_min(v, ord) as v, min(ord) as ord, count(*) as copies, min(v) <> max(v) as conflict from t group by 1, 2""")
def normalized_specs(spark, sf):
    t = table(spark, sf, "orders").select(F.col("o_custkey").alias("p"), F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("v"), F.col("o_orderkey").alias("ord"))
    return S.normalize_specs(t, "p", "a", ["v"], "ord")


@query("W10", """select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having min(struct_pack(a := l_partkey, b := l_suppkey)) <> max(struct_pack(a := l_partkey, b := l_suppkey))""")
def repeated_object_conflicts(spark, sf):
    return S.repeated_objects(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", ["l_partkey", "l_suppkey"])


@query("F41", """select p_partkey, p_type not in ('PROMO','STANDARD') and p_brand <> 'Brand#9' and not p_brand like 'Brand#2%' as filterable, p_type <> 'PROMO' and p_brand <> 'Brand#9' and not p_brand like 'Brand#2%' as comparable from part""")
def definition_flags(spark, sf):
    kind = F.when(F.col("p_type") == "PROMO", "CustomText").when(F.col("p_type") == "STANDARD", "Date").otherwise("Option")
    f = S.definition_flags(kind, "p_brand", "Brand#2", "Brand#9")
    return table(spark, sf, "part").select("p_partkey", f.alias("f")).select("p_partkey", "f.*")


@query("J13 A11", "select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_quantity > 49)")
def referenced_definitions(spark, sf):
    defs = table(spark, sf, "part").select("p_partkey", "p_name")
    used = table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return S.referenced_definitions(defs, used, "p_partkey")[0]


@query("V10 A24", "select p_partkey, p_name from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 49)")
def orphan_definitions(spark, sf):
    defs = table(spark, sf, "part").select("p_partkey", "p_name")
    used = table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return S.orphan_definitions(defs, used, "p_partkey")


@query("V2 J24", "select c_custkey, c_nationkey from customer where c_nationkey not in (select s_nationkey from supplier where s_acctbal > 5000)")
def dangling_parents(spark, sf):
    parents = table(spark, sf, "supplier").where("s_acctbal > 5000")
    return S.dangling_parents(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), parents, "c_nationkey", "s_nationkey")


@query("V2", """select p_name as code, count(*) as copies, case when regexp_matches(p_name, '^[a-m]') then 'duplicate' else 'format' end as problem from part group by 1 having not regexp_matches(p_name, '^[a-m]') or count(*) > 1""")
def code_problems(spark, sf):
    return S.code_problems(table(spark, sf, "part").select(F.col("p_name").alias("code")), "code", "^[a-m].*$")


@query("J11 M10", """with a as (select distinct o_orderpriority category, o_custkey product from orders where o_orderstatus = 'P' and o_orderpriority <> '5-LOW'),
n as (select *, row_number() over (partition by category order by product) as "position" from a), c as (select distinct o_orderpriority category from orders)
select c.category, product, "position" from c left join n using (category)""")
def category_binding(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("category"), F.col("o_custkey").alias("product"), "o_orderstatus")
    return B.bind_products(o, o.where("o_orderstatus = 'P' and category <> '5-LOW'"), "category", "product", [])


@query("J12 A5", """select o_orderpriority as category, count(*) as uses from orders where o_orderpriority not in (select o_orderpriority from orders where o_orderpriority < '3') group by 1""")
def missing_categories(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("category"), "o_custkey")
    return B.missing_categories(o, o.where("category < '3'"), "category")


@query("J24", """with u as (select 'nation' d, s_nationkey::varchar code from supplier union all select 'name', upper(s_name) from supplier)
select d as dictionary, code, count(*) as uses from u where (d, code) not in (select 'nation', n_nationkey::varchar from nation where n_regionkey < 3 union all select 'name', upper(s_name) from supplier where s_acctbal > 0) group by 1, 2""")
def reference_availability(spark, sf):
    s = table(spark, sf, "supplier")
    dictionaries = table(spark, sf, "nation").where("n_regionkey < 3").select(F.lit("nation").alias("dictionary"), F.col("n_nationkey").cast("string").alias("code")).unionByName(
        s.where("s_acctbal > 0").select(F.lit("name").alias("dictionary"), F.col("s_name").alias("code")))
    return B.unavailable_codes(s, "s_suppkey", {"s_nationkey": "nation", "s_name": "name"}, dictionaries)


@query("A4", """with p as (select o_custkey, count(distinct o_orderpriority) n from orders group by 1) select coalesce(n, 0) as categories, count(*) as products from customer left join p on o_custkey = c_custkey group by 1""")
def coverage_histogram(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("product"), F.col("o_orderpriority").alias("category"))
    return B.coverage_histogram(table(spark, sf, "customer").select(F.col("c_custkey").alias("product")), a, "product", "category")


@query("A4 A6", """with a as (select distinct o_custkey product, o_orderpriority category from orders), p as (select product, count(*) n from a group by 1)
select (select count(*) from a) assignments, min(n) fewest, max(n) most, (select count(*) from a where category like '1-%') prefix_1, (select count(*) from a where category like '2-%') prefix_2, (select count(distinct category) from a) categories from p""")
def coverage_summary(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("product"), F.col("o_orderpriority").alias("category"))
    return B.coverage_summary(a, "product", "category", ["1-", "2-"])


@query("A5 A24", "select l_suppkey as category, count(distinct l_partkey) as products from lineitem group by 1")
def category_usage(spark, sf):
    return B.category_usage(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("category"), F.col("l_partkey").alias("product")), "category", "product")


@query("A6", """with a as (select distinct l_partkey product, l_returnflag category from lineitem where l_quantity > 48) select (select count(*) from a) bound_pairs,
 count(*) filter (where p_partkey in (select product from a)) assigned, count(*) filter (where p_partkey not in (select product from a)) unassigned from part""")
def placement_summary(spark, sf):
    a = table(spark, sf, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("product"), F.col("l_returnflag").alias("category"))
    return B.placement_summary(table(spark, sf, "part").select(F.col("p_partkey").alias("product")), a, "product", "category")


@query("V6", """select l_orderkey as product, l_returnflag as catalog, l_linestatus as category, case when l_returnflag = 'N' then 'foreign-catalog' else 'duplicate-pair' end as problem
from lineitem group by 1, 2, 3 having l_returnflag = 'N' or count(*) > 1""")
def assignment_problems(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("product"), F.col("l_returnflag").alias("catalog"), F.col("l_linestatus").alias("category"))
    return B.assignment_problems(a, "product", "catalog", "category", ["A", "R"])


@query("V11 J12", """with a as (select distinct l_partkey, l_suppkey from lineitem where l_returnflag <> 'A'), b as (select distinct l_partkey, l_suppkey from lineitem where l_returnflag <> 'R')
select *, 'left-only' as side from (select * from a except select * from b) union all select *, 'right-only' from (select * from b except select * from a)""")
def binding_parity(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return B.binding_parity(li.where("l_returnflag <> 'A'"), li.where("l_returnflag <> 'R'"), ["l_partkey", "l_suppkey"])


def _edges(spark, sf):
    """Region → nation → supplier as one adjacency table."""
    label = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = table(spark, sf, "region").select(label("R", "r_regionkey").alias("code"), F.lit(None).cast("string").alias("parent"))
    n = table(spark, sf, "nation").select(label("N", "n_nationkey").alias("code"), label("R", "n_regionkey").alias("parent"))
    s = table(spark, sf, "supplier").select(label("S", "s_suppkey").alias("code"), label("N", "s_nationkey").alias("parent"))
    return r.unionByName(n).unionByName(s)


EDGES_SQL = """edges as (select 'R' || r_regionkey code, null parent from region union all select 'N' || n_nationkey, 'R' || n_regionkey from nation union all select 'S' || s_suppkey, 'N' || s_nationkey from supplier)"""


@query("M9 J14 S8", f"""with recursive {EDGES_SQL}, up as (select code, parent ancestor, 1 distance from edges where parent is not null
 union all select up.code, e.parent, distance + 1 from up join edges e on e.code = up.ancestor where e.parent is not null) select code, ancestor, distance::int as distance from up""")
def tree_ancestors(spark, sf):
    return H.ancestors(_edges(spark, sf), "code", "parent")


@query("J14", """select 'S' || s_suppkey as code, 'N' || s_nationkey as parent from supplier where s_acctbal < 0
union all select distinct 'N' || s_nationkey, 'R' || n_regionkey from supplier join nation on n_nationkey = s_nationkey where s_acctbal < 0 and s_nationkey > 10
union all select distinct 'N' || n_nationkey, 'R' || n_regionkey from nation where n_nationkey > 10 and n_nationkey not in (select s_nationkey from supplier where s_acctbal < 0)""")
def missing_categories_with_parents(spark, sf):
    poor = table(spark, sf, "supplier").where("s_acctbal < 0").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"))
    edges = _edges(spark, sf)
    reference = edges.join(poor, "code", "left_anti").where("not (code like 'N%' and cast(substring(code, 2, 9) as int) > 10)")
    return H.missing_with_ancestors(edges, reference, "code", "parent")


@query("S8", """select 'R' || r_regionkey as code, null as parent, 1 as level from region union all select 'N' || n_nationkey, 'R' || n_regionkey, 2 from nation""")
def nested_tree_rows(spark, sf):
    kids = table(spark, sf, "nation").groupBy("n_regionkey").agg(
        F.collect_list(F.struct(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"))).alias("children"))
    r = table(spark, sf, "region").join(kids, F.col("r_regionkey") == F.col("n_regionkey"), "left").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"), "children")
    return R.flatten_tree(r, "code", "children", 3)


@query("V2", f"with {EDGES_SQL}, k as (select * from edges where code not like 'N2%') select code, 'missing-parent' as problem from k where parent like 'N2%'")
def broken_parents(spark, sf):
    return H.broken_parents(_edges(spark, sf).where("code not like 'N2%'"), "code", "parent")


@query("J15 J16", """with o as (select c_custkey key, c_nationkey k1, c_mktsegment k2, c_acctbal > 5000 k3 from customer),
c as (select s_suppkey code, s_nationkey k1, case when s_acctbal > 6000 then 'MACHINERY' when s_acctbal > 3000 then 'HOUSEHOLD' else 'BUILDING' end k2, s_acctbal > 5000 k3 from supplier),
x as (select key, (select count(*) from c where c.k1 = o.k1) a, (select min(code) from c where c.k1 = o.k1) ac,
 (select count(*) from c where c.k1 = o.k1 and c.k2 = o.k2) b, (select min(code) from c where c.k1 = o.k1 and c.k2 = o.k2) bc,
 (select count(*) from c where c.k1 = o.k1 and c.k2 = o.k2 and c.k3 = o.k3) c3, (select min(code) from c where c.k1 = o.k1 and c.k2 = o.k2 and c.k3 = o.k3) cc,
 (select count(*) from c where c.k1 = o.k1 and c.k3 = o.k3) d, (select min(code) from c where c.k1 = o.k1 and c.k3 = o.k3) dc from o)
select key as c_custkey, case when a = 0 then 'none' when a = 1 then 'first' when b = 1 then 'first+second' when (case when b > 1 then c3 else d end) = 1 then 'first+third' else 'ambiguous' end as method,
 case when a = 0 then null when a = 1 then ac when b = 1 then bc when (case when b > 1 then c3 else d end) = 1 then (case when b > 1 then cc else dc end) end as matched from x""")
def cascade_match(spark, sf):
    o = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("k1"), F.col("c_mktsegment").alias("k2"), (F.col("c_acctbal") > 5000).alias("k3"))
    bal = F.col("s_acctbal")
    c = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("code"), F.col("s_nationkey").alias("k1"),
        F.when(bal > 6000, "MACHINERY").when(bal > 3000, "HOUSEHOLD").otherwise("BUILDING").alias("k2"), (bal > 5000).alias("k3"))
    return M.cascade_match(o, c, "c_custkey", "code", "k1", "k2", "k3")


@query("J15", """with c as (select s_nationkey k, count(*) n, min(s_suppkey) code from supplier group by 1) select code as matched, count(*) as claims from customer join c on k = c_nationkey and n = 1 group by 1 having count(*) > 1""")
def claimed_twice(spark, sf):
    c = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_nationkey").alias("k1"), F.lit(1).alias("k2"), F.lit(1).alias("k3"))
    o = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("k1"), F.lit(2).alias("k2"), F.lit(2).alias("k3"))
    return M.claimed_twice(M.cascade_match(o, c, "c_custkey", "code", "k1", "k2", "k3"))


@query("A13 V13", """select lower(p_name) as name_key, count(*) as members, min(p_partkey) as first_member from part group by 1 having count(*) > 1""")
def duplicate_names(spark, sf):
    from catalogspark.operators.quality import duplicate_names as duplicates

    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit(" "), F.upper(F.translate("p_name", " ", "_")), F.lit("!")).alias("name"))
    return duplicates(p, "name", "p_partkey")


@query("A13 W8", """select sha256(text) as group_key, count(*) as members, min(doc_id) as first_member, max(doc_id) as last_member from documents group by 1 having count(*) > 1""")
def duplicate_content(spark, sf):
    return M.duplicate_groups(table(spark, sf, "documents"), F.sha2("text", 256), "doc_id")


@query("J20", """with m as (select o_custkey k, case when count(*) > 12 then 'matched-update' when count(*) > 8 then 'matched-noop' else 'missing-create-draft' end st from orders group by 1),
i as (select c_custkey k from customer where c_acctbal > -500), p as (select distinct o_custkey k from orders where o_totalprice > 300000)
select k, case when m.k is null then 'unmapped' when i.k is null then 'unknown-item' when st <> 'matched-noop' and p.k is null then 'patch-missing' when st = 'matched-noop' and p.k is not null then 'patch-unexpected' end as problem
from m full join i using (k) full join p using (k) where m.k is null or i.k is null or (st <> 'matched-noop' and p.k is null) or (st = 'matched-noop' and p.k is not null)""")
def mapping_coverage(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_totalprice")
    m = o.groupBy("k").agg(F.count(F.lit(1)).alias("n")).select(
        "k", F.when(F.col("n") > 12, "matched-update").when(F.col("n") > 8, "matched-noop").otherwise("missing-create-draft").alias("status"))
    items = table(spark, sf, "customer").where("c_acctbal > -500").select(F.col("c_custkey").alias("k"))
    patches = o.where("o_totalprice > 300000").select("k").distinct()
    return M.coverage_violations(m, items, patches, "k", "status")


@query("S12 U1 O1", """select distinct external_id, external_id::bigint as id_order from (select (c_custkey)::varchar external_id from customer where c_custkey > 0 union all select o_custkey::varchar from orders where o_custkey > 0)""")
def external_id_seed(spark, sf):
    codes = table(spark, sf, "customer").select(F.concat(F.lit(" item-"), F.col("c_custkey").cast("string")).alias("code"))
    found = table(spark, sf, "orders").select("o_custkey")
    return R.external_ids(codes, "code", "ITEM-", found).withColumn("id_order", F.col("id_order").cast("long"))


@query("S13", f"with t as (select distinct sha256(o_custkey::varchar) h from orders where o_custkey > 0) select count(*) as row_count, {SET_SQL} as set_sha256 from t")
def seed_digest(spark, sf):
    empty = table(spark, sf, "customer").select(F.lit("none").alias("code"))
    return R.seed_digest(R.external_ids(empty, "code", "ITEM-", table(spark, sf, "orders").select("o_custkey")))


@query("S15", "select distinct l_partkey from lineitem join part on p_partkey = l_partkey where l_returnflag = case when p_size > 25 then 'A' else 'N' end")
def discovered_ids(spark, sf):
    asked = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") > 25, "A").otherwise("N").alias("asked"))
    li = table(spark, sf, "lineitem").select("l_partkey", F.col("l_returnflag").alias("carried")).join(asked, "l_partkey")
    return R.discover(li, "l_partkey", "asked", "carried")[0]


@query("S6 K14 V16", f"""with t as (select sha256(upper('part-' || p_partkey)) h from part) select count(*) as rows, count(*) as codes, 0::bigint as blank_codes, 0::bigint as missing_p_name,
 (select count(*) from part where p_type = 'PROMO') as missing_tags, false as complete, (select {SET_SQL} from t) as set_sha256 from part""")
def baseline_contract(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("code"), "p_name",
                                        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("tags"))
    return R.baseline_contract(p, "code", ["p_name", "tags"])


@query("S6 K14 V16", f"""with t as (select sha256(upper('part-' || p_partkey)) h from part) select count(*) as rows, count(*) as codes, 0::bigint as blank_codes, 0::bigint as missing_p_name,
 true as complete, (select {SET_SQL} from t) as set_sha256 from part""")
def baseline_contract_holds(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("code"), "p_name")
    return R.baseline_contract(p, "code", ["p_name"])


@query("S7 S17", """select 'nations' as dictionary, count(*) as rows, count(distinct n_name) as codes, 0::bigint as bad_codes, true as usable from nation
union all select 'segments', (select count(*) from customer), count(*), count(*) filter (where n > 1), max(n) = 1 from (select c_mktsegment, count(*) n from customer group by 1)""")
def dictionary_contract(spark, sf):
    return R.dictionary_contract({"nations": (table(spark, sf, "nation"), "n_name"), "segments": (table(spark, sf, "customer"), "c_mktsegment")})


@query("S23", f"""with l as (select sha256(cast(json_object('c_custkey', c_custkey, 'c_mktsegment', c_mktsegment) as varchar)) h from customer),
r as (select sha256(cast(json_object('c_custkey', c_custkey, 'c_mktsegment', c_mktsegment) as varchar)) h from customer where c_acctbal > 0)
select (select count(*) from l) as left_rows, (select {SET_SQL} from l) as left_sha256, (select count(*) from r) as right_rows, (select {SET_SQL} from r) as right_sha256, false as agree""")
def paired_references(spark, sf):
    c = table(spark, sf, "customer")
    return R.paired_references(c, c.where("c_acctbal > 0"), "c_custkey", ["c_mktsegment"])


@query("P5", "select p_partkey, p_brand from part where p_brand in ('Brand#3', 'Brand#14')")
def subset_selection(spark, sf):
    return R.select_subset(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", [" brand#3", "BRAND#14", "Brand#999"])[0]


@query("P5 S24", "select 'BRAND#999' as code")
def subset_missing(spark, sf):
    return R.select_subset(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", ["brand#3", "Brand#999"])[1].withColumnRenamed("_want", "code")


@query("S24", "select distinct c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def unavailable_packs(spark, sf):
    have = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return R.unavailable_keys(table(spark, sf, "customer"), have, "c_custkey")


@query("S11 A16", "select count(*) as rows, max(event_id) as max_key from events")
def table_fingerprint(spark, sf):
    return R.table_fingerprint(table(spark, sf, "events"), "event_id")


@query("S14 S19", "select doc_id, lang <> 'fr' as intact from documents")
def replayed_snapshot(spark, sf):
    changed = F.when(F.col("lang") == "fr", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    d = table(spark, sf, "documents").select("doc_id", "text", F.sha2(changed, 256).alias("recorded"))
    return R.replay(d, "text", "recorded").select("doc_id", "intact")


@query("S22", """select distinct source as section, lang as field from documents""")
def field_references(spark, sf):
    nested = table(spark, sf, "documents").select(
        F.create_map(F.col("source"), F.create_map(F.col("lang"), F.length("text"))).alias("sections"))
    return R.field_refs(nested, "sections")


@query("S3", """select source, arg_min(doc_id, (case lang when 'en' then 1 when 'fr' then 2 else 3 end, lang, doc_id)) as doc_id, arg_min(lang, (case lang when 'en' then 1 when 'fr' then 2 else 3 end, lang, doc_id)) as lang from
 (select source, lang, min(doc_id) doc_id from documents group by 1, 2) group by 1""")
def primary_document(spark, sf):
    d = table(spark, sf, "documents").groupBy("source", "lang").agg(F.min("doc_id").alias("doc_id"))
    return R.primary_document(d, "source", "lang", ["fr"])
