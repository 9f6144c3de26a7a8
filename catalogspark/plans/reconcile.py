"""Desired-against-baseline plans and their gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import diff as D
from catalogspark.plans.derived import DIFF_SQL, PART_SQL, part_baseline, part_desired, table
from catalogspark.plans.registry import query

FIELDS = ["name", "brand", "price", "size"]


def part_diff(spark, sf):
    return D.diff_rows(part_desired(spark, sf), part_baseline(spark, sf), "code", FIELDS, identity="id")


@query("J8 F15 A12 F16", DIFF_SQL + """
select code, action,
  concat_ws(',', case when c_brand then 'brand' end, case when c_name then 'name' end,
            case when c_price then 'price' end, case when c_size then 'size' end) as changed_fields,
  case when action in ('update','noop') then b_sha end as before_sha256,
  case when action <> 'conflict' then d_sha end as desired_sha256
from diff""")
def diff_part_actions(spark, sf):
    return part_diff(spark, sf).withColumn("changed_fields", F.array_join("changed_fields", ",")).drop("changes")


@query("J8 U3", DIFF_SQL + """
select code, 'name' as field, b_name as before, d_name as after from diff where action = 'update' and c_name
union all select code, 'price', b_price, d_price from diff where action = 'update' and c_price""")
def diff_part_fields(spark, sf):
    return D.diff_fields(part_diff(spark, sf), "code")


@query("A8", DIFF_SQL + """
select 'action:' || action as measure, count(*) as rows from diff group by action
union all select 'field:name', count(*) from diff where c_name
union all select 'field:price', count(*) from diff where c_price""")
def diff_rollup(spark, sf):
    return D.diff_counts(part_diff(spark, sf))


@query("J8 P17 V19", DIFF_SQL + """
select count(*) filter (where action='create') create_rows, count(*) filter (where action='update') update_rows,
  count(*) filter (where action='noop') noop_rows, count(*) filter (where action='conflict') conflict_rows,
  count(*) filter (where action in ('create','conflict') or c_name) scope_errors, false as eligible from diff""")
def diff_gate(spark, sf):
    return D.diff_gate(part_diff(spark, sf), scope=["price"])


@query("J8 P17 V19", """select count(*) filter (where p_size = 7) as create_rows, count(*) filter (where p_size % 2 = 0) as update_rows, count(*) filter (where p_size % 2 = 1 and p_size <> 7) as noop_rows,
 0::bigint as conflict_rows, count(*) filter (where p_size = 7) as scope_errors, count(*) filter (where p_size = 7) = 0 as eligible from part where p_size <> 7 or p_brand = 'none'""")
def diff_gate_passes(spark, sf):
    """A plan that only changes what it may change is eligible."""
    p = table(spark, sf, "part").where("p_size <> 7").select(F.col("p_partkey").cast("string").alias("code"), F.col("p_size").alias("price"))
    desired = p.select("code", F.when(F.col("price") % 2 == 0, F.col("price") + 1).otherwise(F.col("price")).alias("price"))
    return D.diff_gate(D.diff_rows(desired, p, "code", ["price"]), scope=["price"])


@query("P17", DIFF_SQL + """
select code, action, case when c_name then 'name' else '' end as unexpected_fields
from diff where action in ('create','conflict') or c_name""")
def update_scope_violations(spark, sf):
    return D.scope_violations(part_diff(spark, sf), "code", ["price"])


@query("K11", DIFF_SQL + """
select d.code, case when action='create' then 'delete-created' else 'restore' end as undo,
  b.id, b.name, b.brand, b.price, b.size
from diff d left join baseline b using (code) where action in ('create','update')""")
def rollback_plan(spark, sf):
    return D.rollback_rows(part_diff(spark, sf), part_baseline(spark, sf), "code")


@query("J8 V18 V19", f"with {PART_SQL} " + """
select 'noop' as action, count(*) as rows from desired d
 where not exists (select 1 from baseline b where b.code = d.code and b.id <> d.id)
union all select 'conflict', count(*) from desired d join baseline b using (code) where b.id <> d.id""")
def second_run_is_noop(spark, sf):
    """Apply the plan, diff again: nothing is left to do but the unresolved conflicts."""
    desired, baseline = part_desired(spark, sf), part_baseline(spark, sf)
    after = D.apply_plan(part_diff(spark, sf), desired, baseline, "code")
    again = D.diff_rows(desired, after, "code", FIELDS, identity="id")
    return again.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


def _definitions(spark, sf):
    """Definitions are nations: the new set comes from suppliers, the stored one from the nation table."""
    nation = table(spark, sf, "nation")
    supplier = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.max("s_acctbal").alias("top"))
    desired = supplier.where("top >= 3000").select(
        F.col("s_nationkey").alias("code"),
        F.when(F.col("n") > 4, F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"))).otherwise("SMALL").alias("name"),
    )
    baseline = nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")).where("n_regionkey <> 1")
    customer = table(spark, sf, "customer")
    usage = customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("code")).agg(
        F.count_distinct("c_mktsegment").alias("users"))
    return desired, baseline, usage


@query("J9 A24", """
with desired as (select s_nationkey code, case when count(*) > 4 then 'NATION_' || s_nationkey else 'SMALL' end as name
  from supplier group by s_nationkey having max(s_acctbal) >= 3000),
baseline as (select n_nationkey code, n_name as name from nation where n_regionkey <> 1),
usage as (select c_nationkey code, count(distinct c_mktsegment) users from customer where c_acctbal > 9000 group by 1)
select code, case when b.name is null then 'create' when d.name is null and coalesce(users,0) > 0 then 'conflict'
   when d.name is null then 'delete' when d.name <> b.name then 'update' else 'noop' end as action,
  case when d.name <> b.name then 'name' else '' end as changed_fields, coalesce(users,0) users
from (select coalesce(d.code, b.code) code, d.name dn, b.name bn from desired d full join baseline b on d.code = b.code) k
left join desired d using (code) left join baseline b using (code) left join usage using (code)""")
def definition_diff_full(spark, sf):
    return D.diff_definitions(*_definitions(spark, sf)[:2], "code", ["name"], _definitions(spark, sf)[2])


ORDER_FIELDS = ["status", "priority", "total"]


def _order_states(spark, sf):
    """Live = orders; desired finishes the pending ones; baseline had other priorities for large totals."""
    base = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("decimal(20,2)").alias("total"))
    desired = base.withColumn("status", F.when(F.col("status") == "P", "F").otherwise(F.col("status")))
    stored = base.withColumn("priority", F.when((F.col("total") > 250000), F.lit("1-URGENT")).otherwise(F.col("priority")))
    return base, desired, stored


@query("J10", """
select o_orderkey as key, case when o_orderstatus <> 'P' then 'desired'
  when cast(o_totalprice as decimal(20,2)) <= 250000 or o_orderpriority = '1-URGENT' then 'baseline' else 'conflict' end as state
from orders""")
def three_way_state(spark, sf):
    return D.three_way_state(*_order_states(spark, sf), "key", ORDER_FIELDS)


@query("J7 F36", f"with {PART_SQL} " + """
select d.code, case when b.code is null then 'missing-create-draft' when d.price = b.price then 'matched-noop'
  else 'matched-update' end as status from desired d left join baseline b using (code)""")
def exact_key_reconcile(spark, sf):
    return D.match_exact(part_desired(spark, sf), part_baseline(spark, sf), "code", ["price"])


@query("F36", f"with {PART_SQL} " + """
select d.code, d.name set_name, d.price set_price, b.name undo_name, b.price undo_price
from desired d join baseline b using (code) where d.name <> b.name or d.price <> b.price""")
def source_owned_patches(spark, sf):
    return D.patch_rows(part_desired(spark, sf), part_baseline(spark, sf), "code", ["name", "price"])


@query("J22", f"with {PART_SQL} " + """
select d.code, case when b.code is null then 'create' when b.brand = 'Brand#3' then 'conflict'
  when d.name = b.name and d.price = b.price then 'noop' else 'update' end as action
from desired d left join baseline b using (code)""")
def ownership_upsert(spark, sf):
    live = part_baseline(spark, sf).withColumn("owned", F.col("brand") != "Brand#3")
    return D.upsert_plan(part_desired(spark, sf), live, "code", ["name", "price"], "owned")


@query("A14", """
with a as (select l_orderkey, l_returnflag, case when l_linestatus = 'O' and l_quantity > 45 then 'F' else l_linestatus end st from lineitem),
b as (select l_orderkey, l_returnflag, l_linestatus st from lineitem),
s as (select *, 1 d from a union all select *, -1 d from b)
select l_orderkey, l_returnflag, st as l_linestatus, greatest(sum(d),0)::bigint as added, greatest(-sum(d),0)::bigint as removed
from s group by 1,2,3 having sum(d) <> 0""")
def multiset_diff(spark, sf):
    cols = ["l_orderkey", "l_returnflag", "l_linestatus"]
    before = table(spark, sf, "lineitem").select(*cols, "l_quantity")
    after = before.withColumn(
        "l_linestatus", F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), "F").otherwise(F.col("l_linestatus")))
    return D.structural_diff(after.select(cols), before.select(cols), cols)


@query("A15 J12", """
select distinct l_orderkey, l_partkey from lineitem where l_returnflag = 'A'
except select l_orderkey, l_partkey from lineitem where l_returnflag <> 'A' or l_discount > 0.02""")
def key_subset_violations(spark, sf):
    li = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_partkey"]
    return D.missing_keys(li.where("l_returnflag = 'A'"), li.where("l_returnflag <> 'A' or l_discount > 0.02"), keys)


@query("U2 U3", """
with a as (select distinct o_custkey k from orders), b as (select distinct c_custkey k from customer where c_acctbal > 0)
select coalesce(a.k, b.k) as custkey, case when b.k is null then 'left-only' else 'right-only' end as side
from a full join b on a.k = b.k where a.k is null or b.k is null""")
def code_set_equality(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    b = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"))
    return D.set_equality(a, b, ["custkey"])


def _child(df):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(20,2)").alias("price"))


@query("U3 J8", """
with x as (select l_orderkey, l_partkey, max(l_quantity) q, max(l_shipdate) s from lineitem group by 1,2),
b as (select l_orderkey, l_partkey, q from x where s < timestamp '2001-01-01'),
d as (select l_orderkey, l_partkey, case when q > 40 then 40 else q end q from x where s > timestamp '1996-01-01')
select coalesce(d.l_orderkey,b.l_orderkey) l_orderkey, coalesce(d.l_partkey,b.l_partkey) l_partkey,
 case when b.q is null then 'added' when d.q is null then 'removed' else 'changed' end as change
from d full join b on d.l_orderkey=b.l_orderkey and d.l_partkey=b.l_partkey where d.q is distinct from b.q""")
def child_collection_diff(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.max("l_quantity").alias("q"), F.max("l_shipdate").alias("s"))
    base = lines.where("s < timestamp_ntz'2001-01-01'")
    want = lines.where("s > timestamp_ntz'1996-01-01'").withColumn("q", F.least("q", F.lit(40.0)))
    return D.diff_children(want, base, ["l_orderkey", "l_partkey"], ["q"])


VARIANT_SQL = """
with c as (select distinct l_partkey, l_suppkey from lineitem)
select l_partkey, l_suppkey,
 case when exists (select 1 from supplier where s_suppkey = l_suppkey and s_acctbal > 0) then 'present' else 'create' end seller_status,
 case when exists (select 1 from part where p_partkey = l_partkey and p_size > 10) then 'present' else 'generate' end part_status,
 case when exists (select 1 from lineitem x where x.l_partkey = c.l_partkey and x.l_suppkey = c.l_suppkey and x.l_linestatus = 'F')
      then 'present' else 'curate' end placement_status from c"""


def _variants(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus")
    pairs = li.groupBy("l_partkey", "l_suppkey").agg(F.max(F.col("l_linestatus") == "F").alias("placed"))
    sellers = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    parts = table(spark, sf, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    plan = D.variant_plan(pairs, [("seller", sellers, "l_suppkey", "create"), ("part", parts, "l_partkey", "generate")])
    return plan.withColumn("placement_status", F.when(F.col("placed"), "present").otherwise("curate")).drop("placed")


@query("J21", VARIANT_SQL)
def variant_plan(spark, sf):
    return _variants(spark, sf)


@query("J29", f"""with p as ({VARIANT_SQL}) select count(*) candidates,
 count(*) filter (where seller_status <> 'present') seller_todo, count(*) filter (where part_status <> 'present') part_todo,
 count(*) filter (where placement_status <> 'present') placement_todo from p""")
def variant_plan_todo(spark, sf):
    return D.plan_todo(_variants(spark, sf))


@query("J26", """
with w as (select c_nationkey code, max(c_mktsegment) grp from customer group by 1),
d as (select s_nationkey code, case when count(*) > 5 then null when max(s_acctbal) > 9000 then 'MACHINERY' else 'HOUSEHOLD' end grp
      from supplier group by 1),
u as (select n_regionkey code, count(*) users from nation group by 1)
select w.code, case when d.code is null then 'missing' when d.grp is null then 'set' when d.grp = w.grp then 'noop' else 'conflict' end as action,
 coalesce(users,0) users from w left join d using (code) left join u using (code)""")
def group_repair_plan(spark, sf):
    wanted = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("code")).agg(F.max("c_mktsegment").alias("grp"))
    have = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.max("s_acctbal").alias("top")).select(
        "code", F.when(F.col("n") > 5, None).when(F.col("top") > 9000, "MACHINERY").otherwise("HOUSEHOLD").alias("grp"))
    usage = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("code")).agg(F.count(F.lit(1)).alias("users"))
    return D.repair_plan(wanted, have, usage, "code", "grp")


@query("V18", f"with {PART_SQL} " + """
select d.code, 'changed' as change from desired d join baseline b using (code)
where d.id = b.id and d.brand = 'Brand#5'""")
def stored_plan_drift(spark, sf):
    """A stored plan against the plan computed again after one brand has moved."""
    stored = part_diff(spark, sf)
    moved = part_desired(spark, sf).withColumn("price", F.when(F.col("brand") == "Brand#5", F.lit("1.00")).otherwise(F.col("price")))
    again = D.diff_rows(moved, part_baseline(spark, sf), "code", FIELDS, identity="id")
    drift = D.plan_drift(stored, again, "code")
    known = part_baseline(spark, sf).select("code")
    return drift.join(known, "code", "left_semi")
