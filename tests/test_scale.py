"""Skew-safe helpers against brute force, on both of their paths."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark import scale as S
from catalogspark.functions.canon import limb_sums, row_digest, set_digest


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = [("hot" if i % 3 == 0 else f"k{i % 17}", rnd.randrange(10**6), i) for i in range(900)]
    return spark.createDataFrame(data, "k string, v long, i long").repartition(6)


def brute_numbers(data, key):
    out, groups = {}, {}
    for r in data:
        groups.setdefault(key(r), []).append(r)
    for g in groups.values():
        for n, r in enumerate(sorted(g, key=lambda r: (r.v, r.i)), 1):
            out[r.i] = n
    return out


def test_number_rows(skewed):
    got = {r.i: r.n for r in S.number_rows(skewed, ["k"], ["v", "i"], "n").collect()}
    assert got == brute_numbers(skewed.collect(), lambda r: r.k)


def test_numbered_rows_are_not_shuffled_for_a_window(skewed):
    plan = S.number_rows(skewed, ["k"], ["v", "i"], "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "row_number" not in plan  # the sums over a key's slices only


def test_number_rows_without_key(skewed):
    got = {r.i: r.n for r in S.number_rows(skewed, [], ["v", "i"], "n").collect()}
    assert got == brute_numbers(skewed.collect(), lambda r: 0)


def test_number_rows_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, i, i) for i in range(20)] + [("a", 1, 99)], "k string, v long, i long")
    assert S.number_rows(df, ["k"], ["v", "i"], "n").count() == 21


@pytest.mark.parametrize("block", [2, 5, 1 << 16])
def test_neighbours(spark, block):
    data = [("hot", p, f"t{p}") for p in range(57) if p != 13] + [("b", 0, "x"), ("b", 1, "y")]
    df = spark.createDataFrame(data, "k string, p long, t string").repartition(5)
    have = {(k, p): t for k, p, t in data}
    got = S.neighbours(df, ["k"], "p", ["t"], block=block).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r._prev.t if r._prev else None) == have.get((r.k, r.p - 1))
        assert (r._next.t if r._next else None) == have.get((r.k, r.p + 1))


def test_set_digest_is_free_of_order_and_partitioning(skewed):
    digest = lambda df: rows(set_digest(df.select("k", row_digest(df, ["v", "i"]).alias("h")), "h", by=["k"]))
    assert digest(skewed) == digest(skewed.orderBy(F.desc("v")).repartition(3)) == digest(skewed.coalesce(1))


def test_set_digest_counts_copies(spark):
    one = spark.createDataFrame([(1,), (2,)], "v int")
    digest = lambda df: set_digest(df.select(row_digest(df, ["v"]).alias("h")), "h").collect()[0].set_sha256
    assert digest(one) != digest(one.union(one)) and digest(one) != digest(one.where("v = 1"))


def test_with_scalars(spark):
    df = S.with_scalars(spark.range(3), spark.range(5).agg(F.max("id").alias("m"), F.count(F.lit(1)).alias("c")))
    assert rows(df) == [(0, 4, 5), (1, 4, 5), (2, 4, 5)]
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_dir_comes_from_the_session(spark):
    assert S.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert S.work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("bins", [2, 4096])
def test_quantiles_are_exact(spark, bins):
    rnd = random.Random(3)
    values = [rnd.choice([7.25, rnd.random() * 1e9, -rnd.random()]) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "v double").repartition(5)
    shares, ranked = ["0", "0.005", "0.5", "0.995", "1"], sorted(values)
    assert S.quantiles(df, "v", shares, bins) == [ranked[0], ranked[1], ranked[199], ranked[397], ranked[399]]
    assert S.quantiles(df.where("v is null"), "v", ["0.5"], bins) == [None]


def test_sums_of_limbs_do_not_wrap(spark):
    digests = ["f" * 64, "0" * 59 + "fffff", "8" * 64]
    got = spark.createDataFrame([(d,) for d in digests * 500], "h string").agg(*limb_sums("h")).first()
    assert [int(x) for x in got] == [sum(500 * int(d[at - 1:at + 14], 16) for d in digests) for at in (1, 16, 31, 46)]


def test_a_scan_of_one_row_group_is_spread(spark, tmp_path):
    spark.range(60_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = spark.read.parquet(str(tmp_path / "t"))
        assert df.rdd.getNumPartitions() > 4  # more splits than cores, and all rows in one of them
        got = S.spread(df).groupBy(F.spark_partition_id()).count().collect()
        assert len(got) >= 4 and max(r["count"] for r in got) < 30_000 and sum(r["count"] for r in got) == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
