"""Paged copies of tables that stay, change and stop."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark.sources import paged as P


def test_a_stable_table_is_copied_in_even_pages(spark, tmp_path):
    path, target = str(tmp_path / "t"), str(tmp_path / "copy")
    spark.range(1000).selectExpr("id", "id % 7 as v").write.parquet(path)
    read = lambda: spark.read.parquet(path)
    pages = P.paged_copy(spark, read, "id", target, pages=5)
    assert len(pages) == 5 and P.accepted(spark, target)
    assert rows(P.copied(spark, target, read().schema)) == rows(read())
    sizes = [r.row_count for r in P.fingerprints(read(), "id", P._edges(spark, target)).collect()]
    assert max(sizes) <= 2 * min(sizes)
    assert P.paged_copy(spark, read, "id", target) == []
    plan = P._range(read(), "id", P._edges(spark, target), 1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id" in plan


def test_a_changed_table_is_refused_and_only_changed_pages_are_read_again(spark, tmp_path):
    path, target = str(tmp_path / "t"), str(tmp_path / "copy")
    spark.range(0, 1000, 2).selectExpr("id", "id % 7 as v").write.parquet(path)
    read = lambda: spark.read.parquet(path)
    schema = read().schema

    def grow(page):
        if page == 2:
            spark.createDataFrame([(1, 0), (5000, 1)], schema).write.mode("append").parquet(path)

    assert len(P.paged_copy(spark, read, "id", target, 5, grow)) == 5
    assert not P.accepted(spark, target)
    with pytest.raises(ValueError):
        P.copied(spark, target, schema)
    assert P.paged_copy(spark, read, "id", target, 5) == [0, 4]
    assert P.accepted(spark, target) and rows(P.copied(spark, target, schema)) == rows(read())


def test_a_run_that_stopped_goes_on(spark, tmp_path):
    path, target = str(tmp_path / "t"), str(tmp_path / "copy")
    spark.range(300).write.parquet(path)
    read = lambda: spark.read.parquet(path)

    def stop(page):
        if page == 1:
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        P.paged_copy(spark, read, "id", target, 4, stop)
    assert P.paged_copy(spark, read, "id", target, 4) == [2, 3] and P.accepted(spark, target)
    empty = str(tmp_path / "none")
    assert P.paged_copy(spark, lambda: read().where("id < 0"), "id", empty, 3) == [] and P.accepted(spark, empty)
    assert P.copied(spark, empty, read().schema).isEmpty()
    with pytest.raises(ValueError):
        P.paged_copy(spark, lambda: read().select(F.when(F.col("id") > 5, F.col("id")).alias("id")), "id", str(tmp_path / "x"))
