"""The keyed store: exact answers, files read per batch, bounded runs, repeated batches."""

import pytest
from helpers import rows

from catalogspark.streaming import ingest as I
from catalogspark.streaming.keystore import KeyStore


def keys(spark, *spans):
    out = None
    for a, b in spans:
        part = spark.range(a, b).selectExpr("concat('k', id) as key")
        out = part if out is None else out.unionByName(part)
    return out


def test_known_keys_are_exact_over_runs_and_levels(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), buckets=4, fan=2, bucket_keys=10)
    assert store.known(keys(spark, (0, 5)), -1).isEmpty()
    for n in range(5):
        store.add(keys(spark, (n * 100, n * 100 + 50)), n)
    got = store.known(keys(spark, (30, 70), (410, 420), (900, 950)), 4)
    assert rows(got) == rows(keys(spark, (30, 50), (410, 420)))
    assert rows(store.known(keys(spark, (410, 420)), 3)) == []  # as of an earlier batch
    assert sorted(r.level for r in store.runs(4)) == [0, 2]
    assert store.dead(4) and not {d.rsplit("run=", 1)[1] for d in store.dead(4)} & {r.name for r in store.runs(4)}


def test_filters_keep_batches_from_reading_the_history(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), buckets=16, fan=2, bucket_keys=100)
    store.add(keys(spark, (0, 2000)), 0)
    assert store.known(keys(spark, (5000, 5020)), 0).isEmpty()
    assert len(store.last_read) <= 3  # about one key in a hundred is looked up in vain
    assert store.known(keys(spark, (0, 1), (5000, 5010)), 0).count() == 1
    assert 1 <= len(store.last_read) <= 3
    wanted = store.known(keys(spark, (0, 2000)), 0)
    assert wanted.count() == 2000 and len(store.last_read) == 16


def test_files_stay_bounded_after_fifty_batches(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), buckets=2, fan=4, bucket_keys=5)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for n in range(50):
            if n % 12 == 11:  # asked now and then; every batch is stored
                assert store.known(keys(spark, (10 * n - 5, 10 * n + 10)), n - 1).count() == 5
                assert 1 <= len(store.last_read) <= 2 * 3 * 3  # buckets times runs, not batches
            store.add(keys(spark, (10 * n, 10 * n + 10)), n)
        live = store.runs(49)
        assert len(live) <= 3 * 3 and sum(r.n for r in live) == 500
        assert rows(store.known(keys(spark, (0, 600)), 49)) == rows(keys(spark, (0, 500)))
        assert len(store.last_read) <= 2 * len(live)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), buckets=2, fan=2)
    for n in (0, 1, 1, 2, 2, 3, 3):
        store.add(keys(spark, (10 * n, 10 * n + 10)), n)
    assert rows(store.known(keys(spark, (0, 100)), 3)) == rows(keys(spark, (0, 40)))
    assert sum(r.n for r in store.runs(3)) == 40


def test_empty_batches(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), buckets=2, fan=2)
    store.add(keys(spark, (0, 0)), 0)
    assert store.known(keys(spark, (0, 5)), 0).isEmpty()
    store.add(keys(spark, (0, 3)), 1)
    assert store.known(keys(spark, (0, 5)), 1).count() == 3 and store.known(keys(spark, (0, 0)), 1).isEmpty()


@pytest.mark.parametrize("files", [1, 3])
def test_import_over_batches(spark, tmp_path, files):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    df = spark.range(300).selectExpr("concat('k', id % 60) as key", "id as n", "id % 7 as v")
    df.repartition(6).write.parquet(src)
    I.idempotent_import(spark, src, df.schema, out, chk, "key", "n", buckets=4, files_per_batch=files)
    got = spark.read.parquet(f"{out}/rows")
    assert got.count() == 60 == got.select("key").distinct().count()
