"""Operator state over several runs: nothing counted twice, nothing lost, late rows kept aside."""

import datetime

from pyspark.sql import functions as F

from catalogspark.streaming import stateful as S

AT = lambda d, h=0: datetime.datetime(2024, 1, d, h)
SCHEMA = "id long, k string, ts timestamp"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(path)


def test_windows_late_rows_and_restarts(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    schema = spark.createDataFrame([], SCHEMA).schema
    build = S.closed_windows("ts", "1 day", ["k"], [F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")], unique="id")
    run = lambda: S.stateful_job(spark, src, schema, out, chk, "ts", "1 day", build)
    got = lambda: {(r.window_start.day, r.k): (r.n, r.ids) for r in S.results(spark, out).collect()}
    land(spark, src, [(1, "a", AT(1, 3)), (2, "b", AT(1, 5)), (3, "a", AT(2, 1)), (1, "a", AT(1, 3))])
    run()
    assert got() == {}  # day 1 may still grow
    land(spark, src, [(4, "a", AT(1, 23)), (2, "b", AT(1, 5)), (5, "a", AT(4, 2))])  # out of order, but in time; a repeated row
    run()
    assert got() == {(1, "a"): (2, 5), (1, "b"): (1, 2), (2, "a"): (1, 3)}
    land(spark, src, [(6, "a", AT(1, 9)), (7, "a", None), (8, "a", AT(4, 3)), (9, "a", AT(7, 1))])
    run()
    assert got() == {(1, "a"): (2, 5), (1, "b"): (1, 2), (2, "a"): (1, 3), (4, "a"): (2, 13)}
    assert {r.id for r in S.late_rows(spark, out, schema).collect()} == {6, 7}
    run()  # nothing new
    assert len(got()) == 4


def test_first_arrivals_and_foreign_checkpoints(spark, tmp_path):
    import pytest

    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    schema = spark.createDataFrame([], SCHEMA).schema
    run = lambda c=chk: S.stateful_job(spark, src, schema, out, c, "ts", "10 days", S.first_arrivals("id"), files_per_batch=1)
    land(spark, src, [(i, "a", AT(1 + i % 5)) for i in range(20)])
    run()
    land(spark, src, [(i, "a", AT(1 + i % 5)) for i in range(30)])
    run()
    assert sorted(r.id for r in S.results(spark, out).collect()) == list(range(30))
    assert S.late_rows(spark, out, schema).isEmpty()
    with pytest.raises(ValueError):
        run(str(tmp_path / "other"))
