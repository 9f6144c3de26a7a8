"""Sketches, kept digests and bucket trees against plain recomputation."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark.functions.canon import row_digest, set_digest
from catalogspark.operators import set_sketch as X
from catalogspark.operators.diff import structural_diff
from catalogspark.sinks import bucket_tree as B
from catalogspark.sinks import maintained as M


def table(spark, ids, name="a"):
    return spark.createDataFrame([(i, f"{name}{i % 7}", None if i % 5 == 0 else i / 4) for i in ids], "id long, k string, v double")


@pytest.mark.parametrize(("apart", "copies", "cells"), [(0, 1, 64), (1, 1, 64), (30, 1, 64), (30, 3, 64), (90, 2, 64), (400, 1, 64)])
def test_sketched_difference_is_exact(spark, apart, copies, cells):
    same = table(spark, list(range(1000)) * 2)
    left = same.unionByName(table(spark, list(range(2000, 2000 + apart)) * copies))
    right = same.unionByName(table(spark, range(2000 + apart // 2, 2000 + apart + apart // 2)))
    columns = ["id", "k", "v"]
    got = X.sketched_difference(left.repartition(5), right.repartition(2), columns, cells)
    assert rows(got.rows) == rows(structural_diff(left, right, columns))
    if apart <= 30:
        assert got.by_sketch
    if apart == 400:
        assert not got.by_sketch  # more than the cells can tell apart


def test_a_full_sketch_is_built_anew_in_its_size(spark):
    same = spark.range(40_000).select("id", F.sha1(F.col("id").cast("string")).alias("k"))
    left = same.where("id % 100 <> 7").unionByName(spark.range(50_000, 50_300).select("id", F.lit("new").alias("k")))  # 700 codes, 192 cells
    got = X.sketched_difference(left, same.repartition(3), ["id", "k"], 64)
    assert got.by_sketch and rows(got.rows) == rows(structural_diff(left, same, ["id", "k"]))
    most = X.sketched_difference(left, same.where("id % 2 = 0"), ["id", "k"], 64)
    assert not most.by_sketch and rows(most.rows) == rows(structural_diff(left, same.where("id % 2 = 0"), ["id", "k"]))


def test_a_sketch_that_was_misread_is_noticed(spark, monkeypatch):
    left, right = table(spark, range(100)), table(spark, range(3, 100))
    whole = X._undone
    monkeypatch.setattr(X, "_undone", lambda sketch, cells: dict(list(whole(sketch, cells).items())[1:]))  # one code is lost
    got = X.sketched_difference(left, right, ["id", "k", "v"], 64)
    assert not got.by_sketch and rows(got.rows) == rows(structural_diff(left, right, ["id", "k", "v"]))


def test_undoing_random_sketches():
    rng = random.Random(2)
    for n in (0, 1, 10, 100):
        cells, sketch = 64, {}
        want = {rng.randrange(-(1 << 63), 1 << 63): rng.choice([-3, -1, 1, 2]) for _ in range(n)}
        for code, copies in want.items():
            for p in X._places(code, cells):
                cell = sketch.setdefault(p, [0] * 7)
                cell[0], cell[1], cell[2] = cell[0] + copies, cell[1] + copies * code, cell[2] + copies * X._second(code)
        got = X._undone(sketch, cells)
        assert got == want or (n == 100 and got is None)


def test_kept_digests_follow_batches(spark, tmp_path):
    columns, by, root = ["id", "k", "v"], ["k"], str(tmp_path / "kept")
    live = table(spark, range(200))
    M.start(spark, root, live, columns, by)
    rng = random.Random(1)
    for version in range(1, 4):
        gone = [rng.randrange(200) for _ in range(20)]
        removed = live.where(F.col("id").isin(gone))
        added = removed.withColumn("v", F.coalesce("v", F.lit(0.0)) + version).unionByName(table(spark, [1000 * version + 1], "b"))
        live = live.where(~F.col("id").isin(gone)).unionByName(added)
        M.update(spark, root, version, removed, added, columns, by)  # sees the batch and the last state only
        want = set_digest(live.withColumn("h", row_digest(live, columns)), "h", by)
        assert rows(M.current(spark, root, version, by)) == rows(want)
        assert M.drift(spark, root, version, live, columns, by).isEmpty()
    assert rows(M.drift(spark, root, 3, live.where("k <> 'a1'"), columns, by).select("k")) == [("a1",)]
    with pytest.raises(ValueError):
        M.update(spark, root, 4, table(spark, range(500), "b"), live.where("1 = 0"), columns, by)


def test_trees_are_written_by_as_many_tasks_as_buckets_ask(spark, tmp_path):
    B.write_tree(table(spark, range(3000)), str(tmp_path / "t"), "id", depth=1)
    files = spark.read.parquet(str(tmp_path / "t" / "data")).select(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-", 1).alias("task")).distinct().count()
    assert files > 4  # more than one task, or than the session's four partitions


def test_trees_lead_to_the_buckets_that_differ(spark, tmp_path):
    old, new = table(spark, range(600)), table(spark, [i for i in range(600) if i != 17]).withColumn("v", F.when(F.col("id") == 300, 9.5).otherwise(F.col("v")))
    for name, df in (("old", old), ("new", new), ("same", old.repartition(7))):
        B.write_tree(df, str(tmp_path / name), "id", depth=2)
    path = lambda n: str(tmp_path / n)
    got = B.compare_trees(spark, path("old"), path("new"), ["id", "k", "v"])
    assert rows(got.rows.select("id", "added", "removed")) == [(17, 0, 1), (300, 0, 1), (300, 1, 0)]
    assert 1 <= len(got.buckets) <= 2 and got.levels[0] == 1 and got.levels[2] <= 2 * B.FAN
    files = spark.read.parquet(f"{path('new')}/data").where(F.col("bucket").isin(got.buckets)).select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert files <= 2
    same = B.compare_trees(spark, path("old"), path("same"), ["id", "k", "v"])
    assert same.rows.isEmpty() and same.levels == [1]
