"""Plans: idempotence, rollback, and one broken fact at a time."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark.operators import bindings, diff as D, hierarchy, localize, match, overlay, quality, specs
from catalogspark.plans.derived import part_baseline, part_desired

SMALL = "/root/testdata/sf0.001"
FIELDS = ["name", "brand", "price", "size"]


@pytest.fixture(scope="module")
def sides(spark):
    return part_desired(spark, SMALL), part_baseline(spark, SMALL)


def test_apply_then_nothing_is_left(sides):
    desired, baseline = sides
    diff = D.diff_rows(desired, baseline, "code", FIELDS, identity="id")
    after = D.apply_plan(diff, desired, baseline, "code")
    again = D.diff_rows(desired, after, "code", FIELDS, identity="id")
    assert again.where("action in ('create', 'update')").isEmpty()


def test_rollback_restores_the_baseline(sides):
    desired, baseline = sides
    diff = D.diff_rows(desired, baseline, "code", FIELDS, identity="id")
    after = D.apply_plan(diff, desired, baseline, "code")
    undo = D.rollback_rows(diff, baseline, "code")
    restored = after.join(undo.select("code"), "code", "left_anti").unionByName(undo.where("undo = 'restore'").select(*after.columns))
    assert D.structural_diff(restored, baseline, baseline.columns).isEmpty()


def test_diff_of_equal_sides_is_noop(sides):
    _, baseline = sides
    assert {r.action for r in D.diff_rows(baseline, baseline, "code", FIELDS, identity="id").collect()} == {"noop"}


def test_duplicate_keys_are_reported(sides):
    _, baseline = sides
    assert D.duplicate_keys(baseline, ["code"]).isEmpty()
    assert D.duplicate_keys(baseline.union(baseline), ["code"]).count() == baseline.count()


def test_null_and_value_differ(spark):
    a = spark.createDataFrame([("x", None), ("y", "1")], "k string, v string")
    b = spark.createDataFrame([("x", "1"), ("y", "1")], "k string, v string")
    assert rows(D.diff_children(a, b, ["k"], ["v"])) == [("x", "changed")]


def test_definition_delete_in_use_is_a_conflict(spark):
    want = spark.createDataFrame([("a", "1")], "code string, v string")
    have = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "1")], "code string, v string")
    usage = spark.createDataFrame([("b", 3)], "code string, users int")
    assert rows(D.diff_definitions(want, have, "code", ["v"], usage).select("code", "action")) == [("a", "update"), ("b", "conflict"), ("c", "delete")]


def test_overlay_order(spark):
    base = spark.createDataFrame([("p", "a", 1, "old"), ("p", "b", 2, "old")], "p string, k string, pos int, v string")
    gen = spark.createDataFrame([("p", "c", 1, "new"), ("p", "b", 2, "new"), ("q", "z", 5, "new")], "p string, k string, pos int, v string")
    got = {(r.p, r.k): (r.pos, r.v, r.origin) for r in overlay.merge_keyed(base, gen, "p", ["k"], "pos", ["v"]).collect()}
    assert got == {("p", "a"): (1, "old", "baseline"), ("p", "b"): (2, "new", "both"), ("p", "c"): (3, "new", "generated"), ("q", "z"): (1, "new", "generated")}


def test_managed_packages(spark):
    base = spark.createDataFrame([("p", "m1", "old"), ("p", "x", "manual")], "p string, k string, v string")
    gen = spark.createDataFrame([("p", "m1", "new"), ("p", "m2", "new"), ("p", "y", "new"), ("q", "y", "new")], "p string, k string, v string")
    got = rows(overlay.merge_managed(base, gen, "p", "k", ["v"], F.col("k").startswith("m")))
    assert got == [("p", "m1", "new", "replaced"), ("p", "m2", "new", "added"), ("p", "x", "manual", "kept"), ("q", "y", "new", "added")]


def test_cascade(spark):
    cat = spark.createDataFrame([("c1", "a", "x", "n"), ("c2", "b", "x", "n"), ("c3", "b", "y", "n"), ("c4", "d", "x", "1"), ("c5", "d", "x", "2"), ("c6", "e", "q", "1"), ("c7", "e", "q", "1")],
                                "code string, k1 string, k2 string, k3 string")
    obs = spark.createDataFrame([("o1", "a", "?", "?"), ("o2", "b", "y", "?"), ("o3", "d", "x", "2"), ("o4", "e", "q", "1"), ("o5", "zz", "x", "1"), ("o6", "d", "none", "1")],
                                "id string, k1 string, k2 string, k3 string")
    got = {r.id: (r.method, r.matched) for r in match.cascade_match(obs, cat, "id", "code", "k1", "k2", "k3").collect()}
    assert got == {"o1": ("first", "c1"), "o2": ("first+second", "c3"), "o3": ("first+third", "c5"), "o4": ("ambiguous", None), "o5": ("none", None), "o6": ("first+third", "c4")}


def test_trees(spark):
    edges = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "code string, parent string")
    assert rows(hierarchy.ancestors(edges, "code", "parent")) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1)]
    assert rows(hierarchy.missing_with_ancestors(edges, edges.where("code = 'a'"), "code", "parent").select("code")) == [("b",), ("c",)]
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "code string, parent string")
    with pytest.raises(ValueError):
        hierarchy.ancestors(loop, "code", "parent")
    into = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "b")], "code string, parent string")
    with pytest.raises(ValueError):
        hierarchy.ancestors(into, "code", "parent", start=into.where("code = 'a'"))
    chain = spark.createDataFrame([(f"n{i:02d}", f"n{i - 1:02d}" if i else None) for i in range(20)], "code string, parent string")
    assert hierarchy.ancestors(chain, "code", "parent").count() == 190


def test_deep_trees_take_few_rounds(spark):
    chain = spark.range(1000).selectExpr("concat('n', id) code", "case when id > 0 then concat('n', id - 1) end parent")
    some = spark.createDataFrame([("n999",), ("n3",)], "code string")
    rounds = []
    got = hierarchy.ancestors(chain, "code", "parent", start=some, rounds=rounds).collect()
    assert len(rounds) <= 11 and len(got) == 999 + 3
    assert all(int(r.code[1:]) - int(r.ancestor[1:]) == r.distance for r in got)
    two = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("c", "d")], "code string, parent string")
    assert rows(hierarchy.ancestors(two, "code", "parent")) == [("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("a", "d", 2), ("b", "d", 1), ("c", "d", 1)]
    far = spark.range(300).selectExpr("concat('n', id) code", "concat('n', case when id = 0 then 6 else id - 1 end) parent")
    with pytest.raises(ValueError, match="cycle"):  # a ring of seven below a long chain that leads into it
        hierarchy.ancestors(far, "code", "parent", start=some.where("code = 'n3'"))


@pytest.mark.parametrize("change,rule", [
    ({}, None), ({"country": "Cn"}, "origin-country"), ({"place": None, "lat": None}, "origin-place"), ({"low": 900}, "altitude-order"),
    ({"high": 20000}, "altitude-range"), ({"lng": 181.0}, "coordinate-range")])
def test_origin_rules_one_change_at_a_time(spark, change, rule):
    row = {"id": "x", "country": "CN", "place": "here", "low": 100, "high": 200, "lat": 10.0, "lng": 20.0, **change}
    df = spark.createDataFrame([tuple(row.values())], "id string, country string, place string, low int, high int, lat double, lng double")
    got = [r.rule for r in quality.findings(df, "id", quality.origin_rules("country", "place", "low", "high", "lat", "lng")).collect()]
    assert got == ([rule] if rule else [])


@pytest.mark.parametrize("change,rule", [
    ({}, None), ({"pos": 2}, "row-order"), ({"label": " a"}, "label"), ({"price": "0"}, "price"), ({"qty": None}, "quantity"), ({"sized": False}, "quantity")])
def test_price_rows_one_change_at_a_time(spark, change, rule):
    row = {"id": "x", "pos": 1, "idx": 1, "label": "a", "qty": "500", "price": "12.5", "sized": True, **change}
    df = spark.createDataFrame([tuple(row.values())], "id string, pos int, idx int, label string, qty string, price string, sized boolean")
    got = [r.rule for r in quality.findings(df, "id", quality.price_row_rules("pos", "idx", "label", "qty", "price", "sized")).collect()]
    assert got == ([rule] if rule else [])


def test_gate_raises_only_for_blockers(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "id string, pub boolean")
    rule = [quality.RowRule("r", "f", F.lit(True))]
    quality.gate(quality.findings(df.where("not pub"), "id", rule, blocking=F.col("pub")))
    with pytest.raises(ValueError, match="a r f"):
        quality.gate(quality.findings(df, "id", rule, blocking=F.col("pub")))


def test_locale_fallback_order(spark):
    names = spark.createDataFrame([("x", "no", "nn"), ("x", "ru", "rr"), ("y", "fr", "ff")], "k string, lang string, name string")
    got = {(r.k, r.locale): (r.name, r.used_locale) for r in localize.localized_names(names, "k", "lang", "name", ["nb", "de"], {"no": "nb"}).collect()}
    assert got == {("x", "nb"): ("nn", "no"), ("x", "de"): ("rr", "ru"), ("y", "nb"): ("y", "key"), ("y", "de"): ("y", "key")}


def test_definition_checks(spark):
    s = spark.createDataFrame([("p", "A", "Number", "1"), ("p", "B", "Number", "1"), ("p", "C", "Number", "1")], "code string, attribute string, type string, value string")
    d = spark.createDataFrame([("A", "Number"), ("B", "Date"), ("Z", "Date")], "attribute string, type string")
    assert rows(specs.definition_mismatches(s, d, "code", "attribute", {"type": "type"})) == [("p", "B", "type"), ("p", "C", "undefined")]
    assert rows(specs.orphan_definitions(d, s, "attribute")) == [("Z", "Date")]


def test_empty_category_keeps_a_row(spark):
    cats = spark.createDataFrame([("a",), ("b",)], "category string")
    asg = spark.createDataFrame([("a", "p2"), ("a", "p1"), ("a", "p1")], "category string, product string")
    assert rows(bindings.bind_products(cats, asg, "category", "product", [])) == [("a", "p1", 1), ("a", "p2", 2), ("b", None, None)]


def test_label_conflict_and_repair(spark):
    want = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "g"), ("d", "g")], "code string, grp string")
    have = spark.createDataFrame([("a", None), ("b", "g"), ("c", "h")], "code string, grp string")
    use = spark.createDataFrame([("a", 2)], "code string, users int")
    assert rows(D.repair_plan(want, have, use, "code", "grp").select("code", "action")) == [("a", "set"), ("b", "noop"), ("c", "conflict"), ("d", "missing")]
