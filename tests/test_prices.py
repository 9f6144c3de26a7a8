"""Exactness of packages, prices and typed values."""

from decimal import Decimal
from fractions import Fraction

import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogspark.functions import typed as T
from catalogspark.functions import units as U
from catalogspark.operators import prices as P


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).collect()[0].r


@pytest.mark.parametrize("text,exact,diagnostic,n", [
    ("357克/饼 7饼/提 6提/件", True, None, 3), ("", False, "missing", 0), ("0克/饼 7饼/提", False, "quantity-invalid", 0),
    ("357克/饼 junk", False, "grammar-unsupported", 1), ("357克/饼 7片/提", True, None, 2), ("357克/饼 7袋/提", False, "chain-inconsistent", 2),
    ("7饼/提 6提/饼", False, "chain-cyclic", 2), ("1.50千克/袋", True, None, 1), ("0克/饼 junk", False, "quantity-invalid", 0)])
def test_package(spark, text, exact, diagnostic, n):
    p = one(spark, U.parse_package, text)
    assert (p.is_exact, p.diagnostic, len(p.components)) == (exact, diagnostic, n)


def test_unit_weight(spark):
    weight = lambda c: U.unit_weight(U.parse_package(c)["components"])
    assert one(spark, weight, "1.5千克/袋 2袋/件") == "1500.000000" and one(spark, weight, "357克/饼") == "357.000000"


@pytest.fixture(scope="module")
def items(spark):
    df = spark.createDataFrame([("a", "8700", "case", "357克/饼 7饼/提 6提/件"), ("b", "10", "bundle", "357克/饼 7饼/提 6提/件"),
                                ("c", "10", "case", "junk"), ("d", "10", "bag", "357克/饼 7饼/提 6提/件")], "id string, amount string, basis string, pack string")
    return df.select("id", F.col("amount").cast("decimal(20,8)").alias("amount"), "basis", F.lit("CNY").alias("currency"), F.lit(False).alias("hidden"), U.parse_package("pack").alias("package"))


def test_derived_prices(items):
    got = {(r.id, r.basis): r.amount for r in P.price_observations(items, "id").collect()}
    assert got == {
        ("a", "case"): Decimal("8700"), ("a", "bundle"): Decimal("1450"), ("a", "cake"): Decimal("207.14285714"),
        ("b", "bundle"): Decimal("10"), ("b", "cake"): Decimal("1.42857143"), ("c", "case"): Decimal("10"), ("d", "bag"): Decimal("10")}
    assert rows(P.price_diagnostics(items, "id")) == [("d", "basis-not-in-package")]


def test_lineage_finds_each_seeded_error(items):
    good = P.price_observations(items, "id")
    assert P.lineage_violations(good, "id").isEmpty()
    lost = good.where("not (id = 'a' and kind = 'source')")
    assert {r[2] for r in rows(P.lineage_violations(lost, "id"))} == {"source-missing"}
    off = good.withColumn("amount", F.when((F.col("id") == "b") & (F.col("kind") == "derived"), F.col("amount") + Decimal("0.00000001")).otherwise(F.col("amount")).cast("decimal(28,8)"))
    assert rows(P.lineage_violations(off, "id")) == [("b", "cake", "quotient")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**10), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_division_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame([(Decimal(a) / 100, Decimal(b)) for a, b in pairs], "a decimal(20,2), b decimal(12,0)")
    got = df.select("a", "b", T.divide_half_up(F.col("a"), F.col("b")).alias("q"), T.reduced_fraction(F.col("a"), F.col("b"), 2).alias("f")).collect()
    for r in got:
        exact = Fraction(r.a) / Fraction(r.b)
        assert int(r.q * 10**8) == (2 * exact * 10**8 + 1) // 2
        assert Fraction(r.f.numerator, r.f.denominator) == exact and r.f.denominator == exact.denominator


@pytest.mark.parametrize("kind,value,problem", [
    ("Number", "1.5", None), ("Number", "1e3", "bad-number"), ("Date", "2026-02-28", None), ("Date", "2026-02-30", "bad-date"),
    ("Boolean", "true", None), ("Boolean", "yes", "bad-boolean"), ("Duration", "60", None), ("Duration", "-1", "bad-duration"),
    ("Hyperlink", "https://x.org/a", None), ("Hyperlink", "x.org", "bad-hyperlink"), ("List", '["a"]', None), ("List", "[a", "bad-list"),
    ("CustomText", " ", "missing-value"), ("Weird", "x", "unknown-type")])
def test_typed_values(spark, kind, value, problem):
    assert one(spark, lambda c: T.value_problem(F.lit(kind), c), value) == problem


@pytest.mark.parametrize("value,out", [("1,234.5", 1235), ("-2.5", -2), ("x", None)])
def test_rounded_int(spark, value, out):
    assert one(spark, T.rounded_int, value) == out


@pytest.mark.parametrize("value,ok", [("1700000000000", True), ("2024-05-01T10:00:00Z", True), ("2024-13-01", False), ("soon", False)])
def test_timestamps(spark, value, ok):
    assert (one(spark, T.timestamp_of, value) is not None) is ok


def test_golden_counts(spark):
    df = spark.createDataFrame([("g1", "500", "g"), ("g1", "500", "g"), ("g2", "500", "g"), ("g2", None, "g")], "grade string, q string, u string")
    summary = P.offer_summary(df, "grade", "q", "u")
    golden = {"row_count": 4, "grades": 2, "sized_rows": 3, "offers": 2, "duplicate_keys": 1, "unsized_rows": 1}
    assert P.expected_counts(summary, golden).isEmpty()
    assert rows(P.expected_counts(summary, {**golden, "offers": 3})) == [("offers", 2, 3)]
