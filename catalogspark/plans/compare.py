"""Comparing and keeping large tables without reading or shuffling them whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import set_sketch as X
from catalogspark.plans.derived import table
from catalogspark.plans.registry import query
from catalogspark.scale import quantiles, work_dir
from catalogspark.sinks import bucket_tree as B
from catalogspark.sinks import maintained as M
from catalogspark.sources import paged as P


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


#: A few orders change: urgent ones of the highest hundredth of prices are finished, cheap open ones of low priority go.
CHANGE_SQL = """l as (select quantile_disc(o_totalprice, 0.995) hi, quantile_disc(o_totalprice, 0.005) lo from orders),
old as (select o_orderkey, o_orderstatus status, o_orderpriority priority, o_totalprice from orders),
new as (select o_orderkey, case when priority = '1-URGENT' and o_totalprice >= hi then 'X' else status end status, priority from old, l where not (priority = '5-LOW' and o_totalprice <= lo))"""


def _changed(spark, sf):
    orders = table(spark, sf, "orders")
    hi, lo = quantiles(orders, "o_totalprice", ["0.995", "0.005"])
    status = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") >= F.lit(hi)), "X").otherwise(F.col("o_orderstatus")).alias("status")
    kept = orders.where(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") <= F.lit(lo))))
    return kept.select("o_orderkey", status, F.col("o_orderpriority").alias("priority"))


DELTA_SQL = """d as (select o_orderkey, status, priority, count(*) filter (where s = 1) a, count(*) filter (where s = -1) b from
 (select o_orderkey, status, priority, 1 s from new union all select o_orderkey, status, priority, -1 from old) group by all)"""


@query("U2 U3 A14 J12", f"with {CHANGE_SQL}, {DELTA_SQL} select o_orderkey, status, priority, greatest(a - b, 0) as added, greatest(b - a, 0) as removed, true as by_sketch from d where a <> b")
def rows_apart_by_sketch(spark, sf):
    """Few rows differ: they are found through a sketch, and only they are shuffled."""
    got = X.sketched_difference(_changed(spark, sf), _orders(spark, sf), ["o_orderkey", "status", "priority"])
    return got.rows.withColumn("by_sketch", F.lit(got.by_sketch))


@query("U2 U3 J12", """with a as (select o_custkey k, count(*) n from orders group by 1), b as (select c_custkey k, count(*) n from customer where c_acctbal > 0 group by 1)
select coalesce(a.k, b.k) as custkey, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) as added, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) as removed from a full join b on a.k = b.k where coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def keys_apart_by_sketch(spark, sf):
    """Most keys differ: at size the sketch overflows and the plain join decides; the rows are the same."""
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    b = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"))
    return X.sketched_difference(a, b, ["custkey"], cells=1 << 6).rows


LIMBS = ", ".join(f"sum(('0x' || substr(h,{a},15))::bigint)::varchar" for a in (1, 16, 31, 46))


@query("A12 K14 J10", f"""with {CHANGE_SQL}, h as (select priority, sha256(cast(json_object('o_orderkey', o_orderkey, 'priority', priority, 'status', status) as varchar)) h from new)
select priority, count(*) as row_count, sha256(concat_ws(':', count(*)::varchar, {LIMBS})) as set_sha256 from h group by 1""")
def maintained_digests(spark, sf):
    """Digests per priority after a batch of changes, from the state before it and the batch's old and new rows."""
    before, after, columns = _orders(spark, sf), _changed(spark, sf), ["o_orderkey", "status", "priority"]
    root = work_dir(spark, "digests")
    M.start(spark, root, before, columns, ["priority"])
    batch = X.sketched_difference(after, before, columns).rows
    M.update(spark, root, 1, batch.where("removed > 0"), batch.where("added > 0"), columns, ["priority"])
    return M.current(spark, root, 1, ["priority"])


@query("S19 S14 K13", f"""with {CHANGE_SQL}, {DELTA_SQL}
select cast(('0x' || substr(sha256(o_orderkey::varchar), 1, 8))::bigint % 256 as int) as bucket, o_orderkey, status, priority, greatest(a - b, 0) as added, greatest(b - a, 0) as removed from d where a <> b""")
def snapshots_apart_by_tree(spark, sf):
    """Two stored snapshots compared through their trees of bucket digests; only buckets that differ are read."""
    columns = ["o_orderkey", "status", "priority"]
    old, new = work_dir(spark, "snapshot"), work_dir(spark, "snapshot")
    B.write_tree(_orders(spark, sf), old, "o_orderkey")
    B.write_tree(_changed(spark, sf), new, "o_orderkey")
    return B.compare_trees(spark, old, new, columns).rows


@query("S11 A16", "select event_type, count(*) as n, max(event_id) as last_id, true as refused_first from events group by 1")
def paged_snapshot(spark, sf):
    """Events are copied page by page while errors still arrive: refused, then only the pages that changed are read again."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    path, target = work_dir(spark, "growing"), work_dir(spark, "paged")
    events.where("event_type <> 'error'").write.parquet(path)
    read = lambda: spark.read.schema(events.schema).parquet(path)

    def arrive(page: int) -> None:
        if page == 2:
            events.where("event_type = 'error'").write.mode("append").parquet(path)

    P.paged_copy(spark, read, "event_id", target, 4, arrive)
    refused = not P.accepted(spark, target)
    P.paged_copy(spark, read, "event_id", target, 4)
    copy = P.copied(spark, target, events.schema)
    return copy.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id")).withColumn("refused_first", F.lit(refused))
