"""Files written and read back; jobs stopped and resumed."""

import gzip
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark import scale as S
from catalogspark.operators import audit
from catalogspark.sinks import handoff as H
from catalogspark.sinks import manifest as K
from catalogspark.sources import blobs as B
from catalogspark.sources import pages as P
from catalogspark.sources import readers as R
from catalogspark.streaming import ingest as I


def test_dump_keeps_number_text_and_bad_lines(spark, tmp_path):
    lines = ['{"slug":"a","lang":"en","n":8.80}', "{bad", '{"slug":"../x","lang":"en","n":1e3}', '{"slug":"b","lang":" "}']
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        f.write("\n".join(lines))
    dump = R.read_dump(spark, str(tmp_path), "slug string, lang string, n string")
    assert rows(R.good_rows(dump, ["slug", "lang"])) == [("a", "en", "8.80")]
    assert sorted(r.reason for r in R.bad_rows(dump, ["slug", "lang"]).collect()) == ["malformed", "missing lang", "unsafe slug"]


def test_document_tree(spark, tmp_path):
    for lang, slug in (("en", "a"), ("de", "a"), ("en", "b")):
        (tmp_path / lang).mkdir(exist_ok=True)
        (tmp_path / lang / f"{slug}.json").write_text(json.dumps({"name": f"{lang}-{slug}"}, indent=1))
    docs = R.read_documents(spark, str(tmp_path), "name string")
    assert rows(docs) == [("de", "a", "de-a"), ("en", "a", "en-a"), ("en", "b", "en-b")]
    assert rows(R.primary_document(docs, "slug", "lang", ["de"])) == [("a", "en", "en-a"), ("b", "en", "en-b")]


@pytest.mark.parametrize("data,declared,problem", [
    (b"\x89PNG\r\n\x1a\n...", "png", None), (b"\xff\xd8\xff..", "jpeg", None), (b"GIF89a", "png", "type-mismatch"),
    (b"RIFF1234WEBP", "webp", None), (b"text", "png", "unknown-type"), (b"", "png", "empty"), (b"\xff\xd8\xff" + b"x" * 100, "jpg", "too-large")])
def test_images(spark, data, declared, problem):
    df = spark.createDataFrame([("k", bytearray(data), declared)], "k string, c binary, d string")
    assert B.image_facts(df, "k", "c", "d", max_bytes=50).collect()[0].problem == problem


def test_manifest_finds_changed_missing_and_new_files(spark, tmp_path):
    for n in "abc":
        (tmp_path / f"{n}.txt").write_text(n)
    stored = S.pinned(K.file_manifest(spark, str(tmp_path)))
    (tmp_path / "a.txt").write_text("A")
    (tmp_path / "b.txt").unlink()
    (tmp_path / "d.txt").write_text("d")
    assert rows(K.manifest_problems(stored, K.file_manifest(spark, str(tmp_path)))) == [("/a.txt", "changed"), ("/b.txt", "missing"), ("/d.txt", "unexpected")]


def test_promotion_is_the_last_step(spark, tmp_path):
    pointer = str(tmp_path / "pointer")
    assert K.current_run(spark, pointer) is None
    K.promote(spark, pointer, "run-1", 1)
    K.promote(spark, pointer, "run-2", 2)
    assert K.current_run(spark, pointer) == "run-2"


def test_checkpoint_depends_on_parameters():
    a = I.checkpoint_path("/c", "job", "1", {"x": 1, "y": 2})
    assert a == I.checkpoint_path("/c", "job", "1", {"y": 2, "x": 1})
    assert a != I.checkpoint_path("/c", "job", "1", {"x": 1, "y": 3}) and a != I.checkpoint_path("/c", "job", "2", {"x": 1, "y": 2})


def test_ingest_resumes_and_rerun_is_a_noop(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    df.where("id < 60").repartition(3).write.parquet(src)
    for _ in range(2):
        I.resumable_ingest(spark, src, df.schema, out, chk, files_per_batch=2)
    assert spark.read.parquet(out).count() == 60
    df.where("id >= 60").write.mode("append").parquet(src)
    I.resumable_ingest(spark, src, df.schema, out, chk, files_per_batch=2)
    assert rows(spark.read.parquet(out).select("id", "v")) == rows(df)


def test_import_keeps_one_row_per_key_over_batches(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    rows_in = [("hot" if i % 3 == 0 else f"k{i % 40}", i) for i in range(300)]
    df = spark.createDataFrame(rows_in, "key string, n long")
    df.repartition(5).write.parquet(src)
    I.idempotent_import(spark, src, df.schema, out, chk, "key", "n", buckets=4, files_per_batch=2)
    df.write.mode("append").parquet(src)
    I.idempotent_import(spark, src, df.schema, out, chk, "key", "n", buckets=4, files_per_batch=2)
    stored = spark.read.parquet(f"{out}/rows")
    assert stored.count() == stored.select("key").distinct().count() == len({k for k, _ in rows_in})


def test_refused_batches_leave_the_baseline(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    base = spark.createDataFrame([(i, "old") for i in range(10)], "k long, v string")
    spark.createDataFrame([(1, "new"), (2, "new")], base.schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(3, "new"), (4, "bad")], base.schema).coalesce(1).write.mode("append").parquet(src)
    I.batched_apply(spark, src, base.schema, out, chk, lambda b: b.where("v = 'bad'"), files_per_batch=1)
    live = {r.k: r.v for r in I.live_table(spark, base, out, base.schema, "k").collect()}
    assert live == {i: ("new" if i in (1, 2) else "old") for i in range(10)}
    assert sorted(r.status for r in I.apply_log(spark, out).collect()) == ["applied", "restored"]


def test_stream_duplicates_are_dropped(spark, tmp_path):
    src = str(tmp_path / "src")
    df = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id % 50 as int),0) ts, concat('k', id % 50) key from range(100)")
    df.coalesce(1).write.parquet(src)
    stream = I.deduplicated_stream(spark.readStream.schema(df.schema).parquet(src), "ts", "key", "1 hour")
    out, chk = str(tmp_path / "out"), str(tmp_path / "chk")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", chk).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 50


def test_handoff_round_trip(spark):
    df = spark.createDataFrame([("p", "Name", "Line one\nline two")], "code string, n string, d string")
    doc = H.handoff_document({"code": F.col("code"), "source_sha256": F.sha2("d", 256)}, {"name": F.col("n"), "description": F.col("d")})
    sent = H.parse_handoff(df.select("code", doc.alias("doc")).withColumnRenamed("code", "key"), "doc", ["code", "source_sha256"])
    r = sent.collect()[0]
    assert (r.code, r.name, r.description) == ("p", "Name", "Line one\nline two")
    back = lambda fix: H.parse_handoff(df.select(F.col("code").alias("key"), fix(doc).alias("doc")), "doc", ["code", "source_sha256"])
    problem = lambda fix: [x.problem for x in H.translation_problems(sent, back(fix), ["key"]).collect()]
    assert problem(lambda d: F.replace(d, F.lit("Name"), F.lit("Nom"))) == []
    assert problem(lambda d: d) == ["not-translated"]
    assert problem(lambda d: F.concat(d, F.lit("x"))) == ["structure-changed"]
    assert problem(lambda d: F.replace(d, F.lit("sha256: "), F.lit("sha256: 0"))) == ["other-source"]


def test_page_state(spark):
    df = spark.createDataFrame([(1, "<script>id(7)</script>"), (2, "none"), (3, "<script>id(1)</script><script>id(2)</script>")], "k int, h string")
    assert rows(P.page_state(df, "k", "h", {"id": r"id\((\d+)\)"}).select("k", "id", "problem")) == [(1, "7", None), (2, None, "no-state"), (3, None, "several-states")]


def test_page_audit_one_change_at_a_time(spark):
    good = [(p, s, p * 3 + s) for p in range(4) for s in range(3)]
    problems = lambda data: rows(audit.page_problems(audit.page_facts(spark.createDataFrame(data, "page long, slot int, item long"), "page", "slot", "item"), "page", 3))
    assert problems(good) == []
    assert problems([g for g in good if g[0] != 2]) == [(1, "next-page-missing")]
    assert problems([g for g in good if g[2] != 4]) == [(1, "short-page")]
    assert problems(good + [(1, 3, 99)]) == [(1, "over-full")]
    assert problems([(p, s, i if p != 3 else s) for p, s, i in good]) == [(3, "repeated-page")]
    assert problems([(p, s, 9 if p == 3 else i) for p, s, i in good]) == [(3, "repeat-in-page")]


def test_file_positions(spark, tmp_path):
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "x"))
    seen = audit.file_positions(spark.read.parquet(str(tmp_path / "x")))
    assert audit.not_increasing(seen, ["file"], "position", "id").isEmpty()
    swapped = seen.withColumn("id", F.when(F.col("id") == 20, 3).otherwise(F.col("id")))
    assert [r.position for r in audit.not_increasing(swapped, ["file"], "position", "id").collect()] == [20]


def test_wide_rows_report_overflow(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, pos int, v string")
    assert rows(H.wide_rows(df, "k", "pos", "c", ["v"], 2)) == [("a", "x", "y"), ("b", "", "")]
    assert rows(H.too_wide(df, "k", "pos", 2)) == [("b", 2)] and H.widest(df, "pos") == 3
