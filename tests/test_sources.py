"""Projection guards, routing, contracts and the small pieces the queries do not name."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark.functions import canon
from catalogspark.operators import assemble, flatten, localize, overlay
from catalogspark.sinks import manifest
from catalogspark.sources import readers as R


def test_allow_list_refuses_nested_columns(spark):
    df = spark.sql("select 1 a, 'x' b, array(1) c")
    assert assemble.allow_list(df, ["b", "a", "zz"]).columns == ["b", "a"]
    with pytest.raises(ValueError):
        assemble.allow_list(df, ["a", "c"])


def test_prune_drops_row_ids(spark):
    assert assemble.prune(spark.sql("select 1 __rowid__, 2 a, 3 b"), ["b"]).columns == ["a"]


def test_routing_splits_every_row_once(spark):
    df = spark.createDataFrame([("s", "short", "x"), ("s", "long", "y" * 301), ("ext_1", "a", "x"), ("s", "a_x2", "x"), ("s", "long", "z")], "section string, field string, value string")
    routing = assemble.route_fields(df, "section", "field", "value", long_text=300, synthetic_section=r"^ext_\d+$", synthetic_field=r"_x\d+$")
    content, specs = assemble.split_routed(df, routing, "section", "field")
    assert rows(specs) == [("s", "short", "x")] and content.count() == 4


def test_assignment_modes(spark):
    df = spark.createDataFrame([("p", "A"), ("p", "b ")], "p string, c string")
    assert localize.catalog_policy(df, "c", "preserve", "x").count() == 2
    assert rows(localize.catalog_policy(df, "c", "target-only", "B")) == [("p", "b ")]
    with pytest.raises(ValueError):
        localize.catalog_policy(df, "c", "other", "B")


def test_subset_names_what_is_missing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "code string")
    found, missing = R.select_subset(df, "code", ["A ", "zz"])
    assert rows(found) == [("a",)] and rows(missing) == [("ZZ",)]


def test_nested_tree(spark):
    df = spark.sql("select 'r' code, array(named_struct('code', 'a', 'children', array(named_struct('code', 'x')))) children")
    assert rows(R.flatten_tree(df, "code", "children", 5)) == [("a", "r", 2), ("r", None, 1), ("x", "a", 3)]


def test_flatten_walks_arrays_and_skips_empty(spark):
    df = spark.sql("select 1 id, named_struct('aB', array('x', '', 'y'), 'n', named_struct('deep', 2.50), 'none', cast(null as string)) f")
    got = rows(flatten.flatten_paths(df, "id", "f").select("path", "value"))
    assert got == [("a-b.0", "x"), ("a-b.2", "y"), ("n.deep", "2.5")]
    assert flatten.too_many_paths(flatten.flatten_paths(df, "id", "f"), "id", 2).count() == 1


def test_open_paths_go_down_all_levels(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [1, "x"]}, "c": true}'), (2, "not json")], "id int, j string")
    assert rows(flatten.open_paths(df, "id", "j")) == [(1, "$.a.b[0]", "1"), (1, "$.a.b[1]", "x"), (1, "$.c", "true")]


def test_canonical_json_sorts_keys_and_drops_nulls(spark):
    df = spark.sql("select 2.50D b, cast(null as string) n, map('z', 1, 'a', 2) m, 'x' a")
    assert df.select(canon.canonical_json(df, df.columns)).collect()[0][0] == '{"a":"x","b":"2.5","m":{"a":2,"z":1}}'


def test_reference_code_of_struct_and_text(spark):
    df = spark.sql("select named_struct('code', ' ab ') s, 'Ab' t")
    r = df.select(canon.reference_code_of(df, "s"), canon.reference_code_of(df, "t")).collect()[0]
    assert r[0] == r[1] == "AB"


def test_baseline_contract_breaks_on_each_defect(spark):
    ok = spark.createDataFrame([("a", "x"), ("b", "y")], "code string, tags string")
    verdict = lambda df, n=None: R.baseline_contract(df, "code", ["tags"], n).collect()[0].complete
    assert verdict(ok, 2) and not verdict(ok, 3)
    assert not verdict(ok.union(ok)) and not verdict(ok.withColumn("tags", F.when(F.col("code") == "a", F.col("tags"))))
    assert not verdict(ok.withColumn("code", F.when(F.col("code") == "a", " ").otherwise(F.col("code"))))


def test_lost_rows_only_for_generated_parents(spark):
    base = spark.createDataFrame([("p", "k1"), ("p", "k2"), ("q", "k1")], "p string, k string")
    gen = spark.createDataFrame([("p", "k1")], "p string, k string")
    assert rows(overlay.lost_rows(base, gen, "p", ["k"], "tags")) == [("p", "tags", "k2")]


def test_stage_disagreements(spark):
    same = spark.createDataFrame([("s1", 5), ("s1", 5)], "snapshot string, items int")
    assert manifest.stage_disagreements(same, ["snapshot", "items"]).isEmpty()
    other = same.union(spark.createDataFrame([("s1", 6)], same.schema))
    assert rows(manifest.stage_disagreements(other, ["snapshot", "items"])) == [("items", 2, "5", "6")]
