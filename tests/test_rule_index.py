"""Rule tables against the same rules as expressions."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from catalogspark.operators import rule_index as X
from catalogspark.operators import rules as R

WORDS = "ba de fi gu ko la me no pu ri New York".split()


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    say = lambda: "".join(rng.choice(WORDS) + rng.choice([" ", ", ", ".", "-", "\n"]) for _ in range(rng.randint(0, 25)))
    return spark.createDataFrame([(i, say()) for i in range(200)] + [(900, None), (901, ""), (902, "é ba"), (903, "émeba")], "id int, text string").repartition(3)


def test_phrases_equal_the_expression_form(spark, texts):
    book = [("a", "new york", None), ("a", "ba de", None), ("b", "Gu", "a"), ("c", "la-me no", None), ("d", "pu", "c"), ("e", "absent word", None), ("f", "ba ba", None), ("g", "...", None), ("h", "ri", "nowhere"), ("b", "gu", "a")]
    table = spark.createDataFrame(book, "code string, phrase string, requires string")
    got = X.phrase_labels(texts, "id", "text", table, requires="requires")
    pattern = lambda p: r"(?i)(?<![^\x00-/:-@\[-`{-\x7F])" + r"[\x00-/:-@\[-`{-\x7F]+".join(p.lower().replace("-", " ").split()) + r"(?![^\x00-/:-@\[-`{-\x7F])"
    small = {}
    for code, phrase, needs in book:
        if phrase != "..." and code != "h":
            small.setdefault(code, (needs, []))[1].append(pattern(phrase))
    rules = [R.Rule(code, tuple(p), needs) for code, (needs, p) in small.items()]
    want = texts.select("id", F.explode(R.labels(F.coalesce("text", F.lit("")), rules)).alias("code"))
    assert rows(got) == rows(want) and len(rows(got)) > 40


def test_a_book_of_many_rules(spark, texts):
    many = spark.range(100_000).select(F.concat(F.lit("r"), F.col("id")).alias("code"), F.concat(F.lit("ba w"), F.col("id")).alias("phrase"))
    many = many.unionByName(spark.createDataFrame([("hit", "ba de")], "code string, phrase string"))
    got = X.phrase_labels(texts, "id", "text", many)
    assert {r.code for r in got.collect()} == {"hit"} and got.count() > 5
    assert X.phrase_labels(texts, "id", "text", many.where("1 = 0")).count() == 0


def test_longest_rule_equals_the_expression_form(spark):
    rng = random.Random(9)
    path = lambda: "/" + "/".join(rng.choice(["en", "de", "a.b", "12", "7", "x*y", "q$"]) for _ in range(rng.randint(0, 4))) + rng.choice(["", "/", ".html"])
    paths = spark.createDataFrame([(i, path()) for i in range(300)] + [(900, ""), (901, None)], "id int, path string").repartition(3)
    book = [("/", False), ("/en/", True), ("/en/*7", False), ("/*/12", True), ("/de/$", True), ("/de/", False), ("/*a.b$", False), ("/en/", False), ("*.html", True), ("/en/de/12$", False), ("*7*7", True), ("/q$", True)]
    for rules in (book, [*book, ("*", True)], [("*", False), ("", True)], book[:1], [("*12", True)]):
        table = spark.createDataFrame(rules, "pattern string, allow boolean")
        got = X.longest_rule(paths, "path", table)
        want = paths.select("id", "path", F.coalesce(R.longest_match("path", rules), F.lit(False)).alias("allowed"))
        assert rows(got.select("id", "path", "allowed")) == rows(want)
    assert X.longest_rule(paths, "path", spark.createDataFrame([], "pattern string, allow boolean")).where("allowed or matched is not null").isEmpty()


def test_longest_rule_tells_what_decided(spark):
    paths = spark.createDataFrame([("/en/17",), ("/fr/1",), ("x",)], "path string")
    table = spark.createDataFrame([("/en/", True), ("/*/17$", False), ("/en/1", True)], "pattern string, allow boolean")
    assert rows(X.longest_rule(paths, "path", table)) == [("/en/17", True, 5), ("/fr/1", False, None), ("x", False, None)]
