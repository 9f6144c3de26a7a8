"""Collocations against counting every phrase, with any memory budget and any number of splitting steps."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from catalogspark.llm import phrase_trees as P


def brute(rows, least=30, share=80, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, *w[i : i + m]) for i in range(len(w) - m + 1))
    candidates = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    dropped = set()
    for k, a in candidates.items():
        w = k[1:]
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inner = (k[0], *w[i : i + m])
                if 100 * a >= share * f[inner]:
                    dropped.add(inner)
    out = {}
    for k, a in candidates.items():
        if k not in dropped:
            w = k[1:]
            cuts = [(2_000_000 * a // (f[(k[0], *w[:c])] + f[(k[0], *w[c:])]), c) for c in range(1, len(w))]
            score, c = min(cuts)
            out.setdefault(k[0], []).append((-score, -a, " ".join(w).encode(), f[(k[0], *w[:c])], f[(k[0], *w[c:])]))
    return sorted((lang, r, p.decode(), -a, le, ri, n[lang], -s) for lang, of in out.items() for r, (s, a, p, le, ri) in enumerate(sorted(of)[:top], 1))


def corpus():
    rng = random.Random(8)
    word = ["the", "of", "é", "New", "york", "city", "a", "b", "c", "d\x00e", "😀", "\u00a0x"] + [f"w{i}" for i in range(60)]
    pick = lambda: word[min(int(rng.expovariate(0.12)), len(word) - 1)]
    rows = []
    for i in range(260):
        text = "".join(pick() + rng.choice([" "] * 12 + [". ", ", ", "\n", "\t ", "!?", " the of the "]) for _ in range(rng.randint(0, 120)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    rows += [("en", "New York City hall")] * 70 + [("de", "w1 w2 w3 w4 w5 w6 w7")] * 40 + [("fr", "seldom"), ("fr", None), (None, "")]
    rows += [("en", "the " * 4000), ("es", "x y " * 31)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, i, "x") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n long, phrase string").repartition(5)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_equals_counting_every_phrase(spark, rows):
    want = brute(rows)
    assert len(want) > 60 and {r[0] for r in want} >= {"en", "de", "und", "es"}
    assert got(P.collocations(table(spark, rows))) == want


@pytest.mark.parametrize(("budget", "fan"), [(40, 1000), (150, 4)])
def test_small_budgets_and_many_groups(spark, rows, budget, fan):
    assert got(P.collocations(table(spark, rows), budget=budget, fan=fan)) == brute(rows)


def test_first_rows_with_ties_at_the_end(spark, rows, monkeypatch):
    monkeypatch.setattr(P, "SALTS", 3)
    assert got(P.collocations(table(spark, rows), top=7)) == brute(rows, top=7)


def test_hot_tails_by_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(P, "HOT", 0.0)
    assert got(P.collocations(table(spark, [*rows, *[("en", "w9 the w9 of")] * 1200]))) == brute([*rows, *[("en", "w9 the w9 of")] * 1200])


def test_no_phrases(spark, rows):
    assert P.collocations(table(spark, rows).where("1 = 0")).count() == 0
    assert P.collocations(table(spark, [("en", "a b"), (None, None), ("", "")])).count() == 0


def test_groups_hold_about_a_budget(rows):
    """Every leaf of a prefix that is not extended falls into one group; extended prefixes are dealt over several."""
    rng = np.random.default_rng(1)
    w = np.minimum(rng.geometric(0.2, (20000, 4)), 30).astype(np.uint32)
    words, n = np.unique(w[:, 0], return_counts=True)
    hot = words[n > 1000]
    known = P.Prefixes([hot.astype(np.int64)], [n[n > 1000]])
    group = P._group_of(w, known, "en", 50)
    cold = ~np.isin(w[:, 0], hot)
    for x in np.unique(w[cold, 0]):
        assert len(np.unique(group[w[:, 0] == x])) == 1
    for x in hot:
        assert len(np.unique(group[w[:, 0] == x])) > 5


def test_a_chunk_tells_its_words_in_flat_rows():
    """No row holds all words of a chunk: long arrays of strings cost a task's JVM and Python many times their bytes."""
    place, want = P._Open(), Counter()
    for texts in (["The é the. D\x00e", "b the"], ["É NEW the", "", "new b b"]):
        data, bounds = P.text_bytes(pa.array(texts))
        found, _, begins, at, end = P._tokens(data, bounds)
        place.add(found, begins, data, int(bounds[0]) + at, int(bounds[0]) + end)
        want.update(w for t in texts for w in re.findall(r"[^ .]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    words, whole = (b.to_pylist() for b in place.rows("en"))
    assert {r["word"]: r["c"] for r in words} == want and [r["pos"] for r in words] == list(range(len(want)))
    assert [r["c"] for r in words] == sorted(want.values(), reverse=True)
    assert [(r["word"], r["c"]) for r in whole] == [(None, sum(want.values()))]
    tokens = P.unpacked(whole[0]["tokens"])
    assert Counter(words[t - 1]["word"] for t in tokens.tolist() if t) == want and (tokens == 0).sum() == 5


def test_query_equals_sql(spark):
    from check_oracles import compare

    from catalogspark.llm.queries import ORACLES, QUERIES

    name = "op11_phrase_trees"
    assert compare(spark, "/root/testdata/sf0.001", name, QUERIES[name], ORACLES[name])[0] is None
