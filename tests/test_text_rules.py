"""Text columns and rule books on chosen cases."""

import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalogspark.functions import safety, text as X
from catalogspark.operators import rules as R


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).collect()[0].r


def test_folding_is_that_of_unicodedata_and_sends_no_text_to_python(spark):
    chars = [chr(i) for i in range(1, 0x30000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(chars[i:i + 900]) for i in range(0, len(chars), 900)] + ["plain", "", None, "e\u0323\u0301 e\u0301\u0323 \ufb01 \uac01" * 40]
    want = lambda t: t and "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert dict(df.select("i", X.fold("t")).collect()) == {i: want(t) for i, t in enumerate(texts)}
    sent = X._decompose.func
    assert list(sent(pd.Series(["\u00e9\u0301\ufb01z", None])).itertuples(index=False, name=None)) == [("\u00e9\u0301", "e", ["\ufb01fi"]), (None, None, None)]


@pytest.mark.parametrize("value,display,native,spoken,editorial", [
    ("Plain name", "Plain name", None, None, False),
    ("Old Oak (老橡, *lao xiang*)", "Old Oak", "老橡", "lao xiang", False),
    ("老橡 (lao xiang)", "老橡", "老橡", "lao xiang", False),
    ("Oak (老橡) — the story", "Oak", "老橡", None, True),
    ("Oak (from the hills)", "Oak (from the hills)", None, None, False),
    ("Oak：a story", "Oak", None, None, True),
    ("7542——a classic", "7542", None, None, True),
    ("a classic——Oak", "Oak", None, None, True),
    ("A-1 — the classic", "A-1", None, None, True),
    ("the classic — Oak", "the classic — Oak", None, None, False),
    ("the classic — oak (老橡)", "oak", "老橡", None, True),
    ("Oak (one) wood (老橡, 木) end", "Oak (one) wood", "老橡 · 木", None, True),
    ("Oak (老橡", "Oak (老橡", None, None, False),
    ("老橡 (12)", "老橡 (12)", None, None, False),
])
def test_decompose_name(spark, value, display, native, spoken, editorial):
    dividers = [X.Divider("：", lead=9), X.Divider("——", needs=1, lead=-1), X.Divider(" — ", needs=2)]
    n = one(spark, lambda c: X.decompose_name(c, dividers), value)
    assert (n.display, n.native, n.transcription, n.editorial is not None) == (display, native, spoken, editorial)


@pytest.mark.parametrize("value,code", [("Élan  vital!", "ELAN-VITAL"), ("茶", "UNKNOWN"), ("--a__b--", "A-B"), ("ﬁne", "FINE")])
def test_code_part(spark, value, code):
    assert one(spark, X.code_part, value) == code == X.code_literal(value)


def test_bounded_code_is_short_and_stable(spark):
    long = one(spark, lambda c: X.bounded_code("x", c), "word " * 60)
    assert len(long) == 100 and long == one(spark, lambda c: X.bounded_code("x", c), "word " * 60)


def test_words_have_ascii_boundaries(spark):
    assert one(spark, lambda c: c.rlike(X.word("TODO")), "茶TODO茶") is True
    assert one(spark, lambda c: c.rlike(X.word("TODO")), "xTODO") is False
    assert one(spark, lambda c: R.labels(c, [R.Rule("T", words=("TODO",))]), "茶TODO茶") == ["T"]


def test_squeeze_knows_wide_spaces(spark):
    assert one(spark, X.squeeze, "　a   b ") == "a b"


@pytest.mark.parametrize("value,limit,out", [("abc", 3, "abc"), ("abcd", 3, "ab…"), ("ab cd", 4, "ab…"), ("abc", 1, "…"), ("abc", 0, "")])
def test_truncate(spark, value, limit, out):
    assert one(spark, lambda c: X.truncate(c, limit), value) == out


def test_rule_order_gates_and_contrast(spark):
    book = [R.Rule("B", (R.word("bee"),)), R.Rule("A", words=("ant", "ants")), R.Rule("A2", (R.word("red ant"),), requires="A")]
    assert one(spark, lambda c: R.labels(c, book), "a red ant and a bee") == ["B", "A", "A2"]
    assert one(spark, lambda c: R.labels(c, book), "a red antler") == []
    long_book = book + [R.Rule(f"W{i}", words=(f"w{i}",)) for i in range(14)]
    assert one(spark, lambda c: R.labels(c, long_book), "w3, a red ant and a bee w0") == ["B", "A", "A2", "W0", "W3"]
    assert one(spark, lambda c: R.strip_contrast(c, ["unlike"]), "like this, unlike that") == "like this,"


@pytest.mark.parametrize("value,answer", [
    ("From Kent county. Also Essex.", ("Kent", "explicit", None)), ("Kent and Essex.", (None, "mention", "Kent,Essex")),
    ("Made in Essex. Kent later.", ("Essex", "mention", None)), ("Kent county, Essex county", (None, "explicit", "Kent,Essex")), ("Nowhere.", (None, None, None))])
def test_explicit_beats_mention(spark, value, answer):
    r = one(spark, lambda c: R.explicit_or_mention(c, ["Kent", "Essex"], "county"), value)
    assert (r.value, r.evidence, r.ambiguous) == answer


@pytest.mark.parametrize("path,ok", [("/a/x", True), ("/a/b/x", False), ("/a/b/c", True), ("/z", False), ("/a/end.html", False)])
def test_longest_match(spark, path, ok):
    rules = [("/a", True), ("/a/b", False), ("/a/b/c", True), ("/a/*.html$", False)]
    assert one(spark, lambda c: R.longest_match(c, rules), path) is ok


def test_agent_groups():
    groups = [(["*"], [("/", False)]), (["cat"], [("/x", True)]), (["catalog"], [("/y", True)])]
    assert R.rules_for_agent(groups, "CatalogBot") == [("/y", True)] and R.rules_for_agent(groups, "other") == [("/", False)]


@pytest.mark.parametrize("url,rule", [
    ("https://a.example.com/p?page=1", None), ("http://a.example.com/p", "not-https"), ("https://u:p@a.example.com/", "credentials-or-port"),
    ("https://a.example.com:81/", "credentials-or-port"), ("https://a.example.com/#x", "fragment"), ("https://evil.com/", "host"),
    ("https://a.example.com/p?page=x", "query-key"), ("https://a.example.com/p?page=1&page=2", "query-repeat"), ("no url", "invalid")])
def test_url_policy(spark, url, rule):
    assert one(spark, lambda c: safety.url_policy(c, suffixes=["example.com"], query_rules={"page": r"^\d+$"}), url) == rule


@pytest.mark.parametrize("value,hit", [("write to a.b@c.org now", True), ("call (555) 123-4567", True), ("telegram: some_user", True), ("just words 12 34", False)])
def test_contacts(spark, value, hit):
    assert one(spark, safety.has_contact, value) is hit


def test_forbidden_fields_walks_the_schema(spark):
    df = spark.sql("select 1 id, named_struct('phone', 'x', 'ok', array(named_struct('userId', 1))) s")
    assert safety.forbidden_fields(df.schema) == ["s.phone", "s.ok.userId"]


def test_rules_from_table(spark):
    df = spark.createDataFrame([(2, "B", "b", None), (1, "A", "a", None), (3, "B", "bb", None)], "rule_order int, code string, pattern string, requires string")
    assert R.rules_from_table(df, 10) == [R.Rule("A", ("a",)), R.Rule("B", ("b", "bb"))]


def test_labels_parse_and_unwrap(spark):
    p = one(spark, X.parse_label, "fam-3.local name (原, native name)")
    assert (p.family, p["index"], p.local, p.native, p.transcription) == ("fam", 3, "local name", "原", "native name")
    assert one(spark, X.parse_label, "no label") is None
    assert one(spark, lambda c: X.unwrap_name(c, F.lit("原")), "原 (local)").name == "local"
    assert one(spark, lambda c: X.unwrap_name(c, F.lit("原")), "原 (local").error == "unterminated"


@pytest.mark.parametrize("value,out", [("zh_hans_cn", "zh-Hans-CN"), ("EN", "en"), ("pt-br", "pt-BR"), ("", "")])
def test_canonical_locale(spark, value, out):
    assert one(spark, X.canonical_locale, value) == out
