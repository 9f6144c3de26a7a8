"""Cases that once gave wrong answers: lossless digests, no caps, safe re-runs, drift over gaps, late rows."""

import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark import scale as S
from catalogspark.functions import canon as C
from catalogspark.functions import safety, text as X, typed as T
from catalogspark.operators import flatten, quality
from catalogspark.operators.diff import diff_rows
from catalogspark.operators.rules import Rule, labels
from catalogspark.sinks import handoff, manifest
from catalogspark.streaming import ingest as I


@pytest.mark.parametrize("kind, a, b, same", [
    ("decimal(20,12)", "1.000000000001", "1.000000000002", False), ("double", "1e-9", "3e-9", False), ("double", "1e33", "2e33", False),
    ("double", "0.1", "0.1", True), ("float", "0.1", "0.1", True), ("double", "-0.0", "0.0", True), ("double", "123456789.123456789", "123456789.12345679", True),
    ("double", "0.30000000000000004", "0.3", False), ("decimal(38,18)", "0.000000000000000001", "0", False)])
def test_digests_tell_numbers_apart(spark, kind, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(F.col("a").cast(kind), F.col("b").cast(kind))
    one, two = df.select(F.col("a").alias("v")), df.select(F.col("b").alias("v"))
    digest = lambda d: d.select(C.row_digest(d, ["v"])).first()[0]
    assert (digest(one) == digest(two)) is same


def test_small_change_is_an_update(spark):
    side = lambda v: spark.createDataFrame([("p", v)], "code string, v string").select("code", F.col("v").cast("decimal(20,12)").alias("price"))
    plan = diff_rows(side("1.000000000001"), side("1.000000000002"), key="code", fields=["price"])
    assert [r.action for r in plan.collect()] == ["update"]


@pytest.mark.parametrize("raw, out", [("+007.500", "7.5"), ("-0.0", "0"), (".5", "0.5"), ("12.", "12"), (" 1234567890123456789012345678901234567890.10 ", "1234567890123456789012345678901234567890.1"), ("0.0000000000001", "0.0000000000001"), ("1e5", "1e5")])
def test_typed_numbers_are_not_rounded(spark, raw, out):
    assert spark.createDataFrame([(raw,)], "v string").select(C.typed_value(F.lit("number"), "v")).first()[0] == out


def test_open_paths_go_all_the_way_down(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":{"f":7}}}}},"z":1}'), (2, "no json"), (3, None)], "id int, j string")
    assert rows(flatten.open_paths(df, "id", "j")) == [(1, "$.a.b.c.d.e.f", "7"), (1, "$.z", "1")]


def test_wide_rows_take_all_positions(spark):
    df = spark.createDataFrame([("a", i, str(i)) for i in range(9)] + [("b", 0, "x")], "k string, p int, v string")
    assert len(handoff.wide_rows(df, "k", "p", "c", ["v"]).columns) == 10


def test_rules_take_plain_words_only(spark):
    for bad in ("th\u00e9", "c.t", "two words", ""):
        with pytest.raises(ValueError):
            Rule("A", words=(bad,))
    book = [Rule("A", words=("cat",)), Rule("B", patterns=("c.t",))]
    longer = book + [Rule(f"W{i}", words=(f"w{i}",)) for i in range(20)]
    for text in ("a cat", "cot", "concat"):
        got = [spark.createDataFrame([(text,)], "t string").select(labels("t", b)).first()[0] for b in (book, longer)]
        assert got[0] == got[1]


def test_long_text_is_kept(spark):
    long = "word " * 3000
    df = spark.createDataFrame([(long,), ("visit tea-shop.com now",), ("see www.x",), ("fine, at 3.5 g",)], "t string")
    assert [r[0] is not None for r in df.select(safety.safe_text("t")).collect()] == [True, False, False, True]


def test_gcd_beside_null(spark):
    df = spark.createDataFrame([(9007199254740993, 3), (None, 3), (12, None), (12, 18)], "a long, b long").coalesce(1)
    assert [r[0] for r in df.select(T.gcd(F.col("a"), F.col("b"))).collect()] == [3, None, None, 6]


@pytest.mark.parametrize("low, high, story, out", [
    (0.8, 1.2, "", (800.0, 1200.0, True)), (900.0, 1.5, "", (900.0, 1500.0, True)), (0.8, 1200.0, "", (0.8, 1200.0, False)),
    (None, 1.2, "up to 1,200 m", (None, 1200.0, True)), (None, 1.2, "high", (None, 1.2, False)), (0.0, 1.2, "", (0.0, 1.2, False)), (None, None, "", (None, None, False))])
def test_thousands(spark, low, high, story, out):
    df = spark.createDataFrame([(low, high, story)], "l double, h double, s string")
    assert tuple(df.select(T.thousands_repair(F.col("l"), F.col("h"), F.col("s")).alias("r")).select("r.*").first()) == out


@pytest.mark.parametrize("story, region, out", [
    ("Lincang City/Prefecture, in the south", "x", "Lincang"), ("From the hills, Old Port Town. More", "x", "Old Port"), ("region, Mill Creek. Rest", "Region", "Mill Creek"),
    ("nothing here", "x", None), ("a very long name of many more words than four Village", "x", None)])
def test_settlements(spark, story, region, out):
    df = spark.createDataFrame([(story, region)], "s string, r string")
    assert df.select(X.settlement_candidate("s", "r")).first()[0] == out


def test_title_case_at_every_word(spark):
    assert spark.sql("select \"don't stop/go_on\" t").select(X.titleize("t")).first()[0] == "Don'T Stop/Go On"


def test_drift_passes_over_gaps_and_refused_periods(spark):
    df = spark.createDataFrame([(1, 100), (3, 1), (4, 1), (5, 90), (6, 300)], "day int, n long")
    got = {r.day: (r.previous, r.drifted) for r in quality.count_drift(df, "day", "n").collect()}
    assert got == {1: (None, False), 3: (100, True), 4: (100, True), 5: (100, False), 6: (90, True)}


def test_another_version_is_refused(spark, tmp_path):
    src, out, base = (str(tmp_path / n) for n in ("src", "out", "chk"))
    df = spark.range(10)
    df.repartition(3).write.parquet(src)
    run = lambda v: I.resumable_ingest(spark, src, df.schema, out, I.checkpoint_path(base, "job", v, {}), files_per_batch=1)
    run("1")
    with pytest.raises(ValueError):
        run("2")
    run("1")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))


def test_finished_batches_are_proven_before_a_run_goes_on(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    df = spark.range(30).withColumn("v", F.col("id") % 4)
    df.where("id < 10").coalesce(1).write.mode("append").parquet(src)
    run = lambda: I.resumable_ingest(spark, src, df.schema, out, chk, files_per_batch=1, proven=True)
    run()
    df.where("id between 10 and 19").coalesce(1).write.mode("append").parquet(src)
    run()
    assert I.broken_batches(spark, out).isEmpty()
    df.where("id = 3").write.mode("append").parquet(f"{out}/batch=1")  # somebody else wrote there
    df.where("id >= 20").coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(ValueError, match="changed"):
        run()
    assert rows(I.broken_batches(spark, out)) == [(1, "changed")]
    assert not S.path_exists(spark, f"{out}/batch=2")


def test_late_rows_are_counted_and_marked(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    for days in ([(1, 1), (1, 2), (3, 5)], [(1, 3), (3, 6)]):
        spark.createDataFrame([(at(*d),) for d in days], "ts timestamp").coalesce(1).write.mode("append").parquet(src)
        I.windowed_counts(spark, src, spark.createDataFrame([], "ts timestamp").schema, out, chk, "ts", [], "1 day", "1 hour")
    got = {r.window_start.day: (r.n, r.n_late) for r in I.window_totals(spark, out).collect()}
    assert got == {1: (3, 1), 3: (2, 0)}


def test_promotion_comes_after_the_gate(spark, tmp_path):
    root = str(tmp_path / "runs")
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    told = [manifest.promote_run(spark, root, run, n, part, "k") for n, (run, part) in enumerate([("a", df), ("b", df.where("id < 10")), ("a", df), ("c", df.where("id < 90"))])]
    assert told == [True, False, False, True] and manifest.current_run(spark, f"{root}/current") == "c"


def test_a_promotion_that_stopped_can_be_repeated(spark, tmp_path, monkeypatch):
    df = spark.range(100).withColumn("k", F.col("id") % 2)

    def stopped(root, where, name, n=1, data=df):
        def stop(*args, **kw):
            raise RuntimeError(where)

        with monkeypatch.context() as m:
            m.setattr(manifest, where, stop)
            with pytest.raises(RuntimeError, match=where):
                manifest.promote_run(spark, root, name, n, data, "k")

    root = str(tmp_path / "pointer")  # after the verdict, before the pointer
    stopped(root, "promote", "a")
    assert manifest.current_run(spark, f"{root}/current") is None
    assert manifest.promote_run(spark, root, "a", 1, df, "k") and not manifest.promote_run(spark, root, "a", 2, df, "k")
    assert manifest.current_data(spark, root) == f"{root}/a"
    root = str(tmp_path / "gate")  # after the rows, before the verdict
    stopped(root, "current_data", "a")
    assert manifest.promote_run(spark, root, "a", 1, df, "k")
    root = str(tmp_path / "rows")  # while the rows were written: a folder without its mark
    df.limit(3).write.parquet(f"{root}/a")
    (tmp_path / "rows" / "a" / "_SUCCESS").unlink()
    assert manifest.promote_run(spark, root, "a", 1, df, "k")
    assert manifest.current_data(spark, root) == f"{root}/a~2" and spark.read.parquet(f"{root}/a~2").count() == 100
    # a refusal is remembered: the same run, even with good rows now, stays refused
    assert not manifest.promote_run(spark, root, "b", 2, df.limit(5), "k") and not manifest.promote_run(spark, root, "b", 3, df, "k")
    assert manifest.current_run(spark, f"{root}/current") == "a"


def test_manifest_paths_of_an_odd_root(spark, tmp_path):
    root = str(tmp_path / "a+b (c).d")
    spark.range(5).coalesce(1).write.parquet(f"{root}/x")
    assert [r.file.startswith("/x/part-") for r in manifest.file_manifest(spark, root).collect()] == [True]


def test_path_exists(spark, tmp_path):
    assert S.path_exists(spark, str(tmp_path)) and not S.path_exists(spark, str(tmp_path / "none"))


def test_sheets_notice_changed_text(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "code string, v string")
    lines = handoff.fact_lines(df, "code", {"S": [("v", F.col("v"))]})
    root = str(tmp_path / "p")
    handoff.write_sheets(lines, df, "code", root)
    assert [r.intact for r in handoff.read_sheets(spark, root, "code").collect()] == [True, True]
    lines.where("code = 'a'").withColumn("text", F.lit("other")).write.mode("append").parquet(f"{root}/lines")
    assert sorted((r.code, r.intact) for r in handoff.read_sheets(spark, root, "code").collect()) == [("a", False), ("b", True)]


def test_every_event_is_promoted(spark):
    from catalogspark.plans import load

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = load()[0]["promotion_of_all_events"](spark, "/root/testdata/sf0.001").collect()
    assert {r.run for r in got} == {"run-1"} and sum(r.n for r in got) == events.count()


def test_every_row_is_audited(spark):
    from catalogspark.plans import load

    values = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "value").orderBy("event_id").collect()
    want = {b.event_id for a, b in zip(values, values[1:]) if a.value is not None and b.value is not None and b.value <= a.value}
    assert any(i % 11 == 4 for i in want)
    assert {r.event_id for r in load()[0]["row_id_monotone_all"](spark, "/root/testdata/sf0.001").collect()} == want


def test_audit_over_gaps_in_the_ids(spark):
    from catalogspark.operators import audit

    df = spark.createDataFrame([(1, 1.0), (4, 3.0), (9, 2.0), (20, 2.0)], "id long, v double")
    got = audit.not_increasing(S.number_rows(df, [], ["id"], "position"), [], "position", "v", ["id"])
    assert set(rows(got.select("id", "previous"))) == {(9, 3.0), (20, 2.0)}


def test_drift_per_series(spark):
    df = spark.createDataFrame([("a", 1, 100), ("a", 2, 1), ("a", 3, 95), ("b", 1, 5), ("b", 3, 4), (None, 2, 7), (None, 3, 1)], "k string, day int, n long")
    got = {(r.k, r.day): (r.previous, r.drifted) for r in quality.count_drift(df, "day", "n", by=["k"]).collect()}
    assert got == {("a", 1): (None, False), ("a", 2): (100, True), ("a", 3): (100, False), ("b", 1): (None, False), ("b", 3): (5, False), (None, 2): (None, False), (None, 3): (7, True)}
    long = quality.count_drift(spark.range(60_000).selectExpr("id as day", "100 + id % 2 as n"), "day", "n")
    assert long.count() == 60_000 and long.where("drifted").isEmpty()


def test_every_day_is_counted(spark):
    from catalogspark.plans import load

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert sum(r.n for r in load()[0]["count_drift_all"](spark, "/root/testdata/sf0.001").collect()) == events.count()
