import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogspark.llm import licence_scan, norm_topk, ordinal_toxicity, subspace_join


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters of close vectors, copies, scaled copies, zero, NULL, NaN, short and repeated rows."""
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for size in (1, 1, 40, 3, 2, 25, 1, 1, 1, 60):
        base = rng.normal(size=40)
        for _ in range(size):
            rows.append((n, (base + rng.normal(size=40) * 0.12).astype(np.float32).tolist()))
            n += 1
    rows += [(n + i, rng.normal(size=40).astype(np.float32).tolist()) for i in range(80)]
    n += 80
    rows += [(n, rows[5][1]), (n + 1, [2 * x for x in rows[5][1]]), (n + 2, [0.0] * 40), (n + 3, None), (n + 4, [1.0, None] * 20), (n + 5, [float("nan")] + [1.0] * 39)]
    rows += [(n + 6, [float("inf")] * 40), (n + 7, [1.0, 0.0]), (n + 8, [1.0, 0.1]), (n + 9, []), (3, rows[3][1]), (None, rows[4][1]), (300, rows[4][1]), (400, rows[60][1])]
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rep int, cell string").repartition(3)


def usable(rows, zero):
    return [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None for x in v) and np.isfinite(np.array(v, float)).all() and (zero or any(v))]


@pytest.mark.parametrize("tile, task", [(50_000, 20_000), (40, 30)])
def test_links_against_all_pairs(vectors, monkeypatch, tile, task):
    monkeypatch.setattr(subspace_join, "TILE_ROWS", tile)
    monkeypatch.setattr(subspace_join, "TASK_ROWS", task)
    got = sorted((tuple(r) for r in subspace_join.link_vectors(vectors).collect()), key=repr)
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    good = usable(rows, False)
    near = [[j for j, (_, w) in enumerate(good) if j != i and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.95] for i, (_, v) in enumerate(good)]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, js in enumerate(near):
        for j in js:
            a, b = root(good[i][0]), root(good[j][0])
            parent[max(a, b)] = min(a, b)
    left = {}
    for (i, v), js in zip(good, near):
        left.setdefault((i, v.tobytes()), []).append(len(js))
    want = []
    for i, v in rows:
        key = (i, np.array(v, np.float64).tobytes()) if v and None not in v else None
        want.append((i, left[key].pop() if left.get(key) else 0, root(i) if i is not None else None, i is None or root(i) == i))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("band, block", [(16_384, 1_024), (50, 2)])
def test_top_products_against_all_pairs(vectors, monkeypatch, band, block):
    monkeypatch.setattr(norm_topk, "BAND_ROWS", band)
    monkeypatch.setattr(norm_topk, "QUERY_ROWS", block)
    monkeypatch.setattr(norm_topk, "STEP", 16)
    got = norm_topk.top_products(vectors, F.col("vec_id") % 10 == 0).collect()
    good = [(i, np.floor(v * 1024).astype(np.int64)) for i, v in usable([(r["vec_id"], r["embedding"]) for r in vectors.collect()], True)]
    want = []
    for q, v in good:
        if q % 10 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:10]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(set(want))


def test_empty_vectors(vectors):
    none = vectors.where("1 = 0")
    assert subspace_join.link_vectors(none).count() == 0 and norm_topk.top_products(none, F.lit(True)).count() == 0
    bad = vectors.where("embedding is null")
    assert [tuple(r)[1:] for r in subspace_join.link_vectors(bad).collect()] and norm_topk.top_products(bad, F.lit(True)).count() == 0


def test_ordinal_fit_recovers_ordered_grades():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, size=(1500, 3))
    grade = np.clip((x[:, 0] + 2 * x[:, 1] + rng.logistic(size=1500) * 0.3) // 3, 0, 3).astype(int)
    rows, cols = np.nonzero(x)
    w, t = ordinal_toxicity.fit_ordinal(rows, cols, x[rows, cols].astype(float), grade, 3, 3)
    assert (np.diff(t) > 0).all() and w[1] > w[0] > 0 and abs(w[2]) < 0.3 * w[0]
    model = ordinal_toxicity.OrdinalModel(np.arange(3, dtype=np.uint64), w, t)
    p = model.grade_probabilities(x @ w)
    assert np.allclose(p.sum(1), 1) and (p.argmax(1) == grade).mean() > 0.8


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abdeghiklmnoprstu") for _ in range(rng.randint(2, 6)))
    common = [word() for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(common) for _ in range(rng.randint(5, 200))]
        bad = i % 6 == 0
        for _ in range(rng.randint(2, 8) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Rotten", "vilex" + word(), "nasty,"]))
        rows.append((i, " ".join(text), "odd", "odd"))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(bad)))
    rows += [(1000, None, None, None), (1001, "", None, None), (None, "rotten nasty rotten", None, None)]
    labels += [(1000, None), (1001, 0), (None, 1), (0, None), (0, 0), (77777, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxicity string, c1 string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_documents(judged):
    docs, labels = judged
    model = ordinal_toxicity.train(docs, labels)
    got = ordinal_toxicity.score(docs, model, into="told").select("*", F.col("told.*")).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 600:
            assert r["toxic"] == (r["doc_id"] % 6 == 0), r
        assert 0 <= r["severity"] <= 3 and r["grade"] in (0, 1, 2, 3)
    assert not any(r["toxic"] for r in got if r["doc_id"] in (1000, 1001)) and [r["toxic"] for r in got if r["doc_id"] is None] == [True]
    amount = [r["severity"] for r in got if r["toxic"]]
    assert max(amount) > 2 > min(amount)


def test_toxicity_without_labels(judged):
    docs, labels = judged
    for none in (labels.where("1 = 0"), labels.where("toxic = 0")):
        model = ordinal_toxicity.train(docs, none)
        assert not any(r["toxic"] or r["probability"] for r in ordinal_toxicity.score(docs, model, into="t").select("t.*").collect())
    assert ordinal_toxicity.score(docs.where("1 = 0"), ordinal_toxicity.train(docs, labels), into="t").count() == 0


def test_licences(spark):
    rng = random.Random(4)
    plain = lambda n: " ".join(rng.choice("the of work was made in an old house by people who read public books version one".split()) for _ in range(n))
    rows, want = [], {}
    for family, templates in licence_scan.TEMPLATES.items():
        for t in templates:
            for text in (t, t.upper(), plain(30) + "\n" + t + "\n" + plain(30), plain(70) + " " + t + " " + plain(70)):
                want[len(rows)] = {family}
                rows.append((len(rows), text))
    both = "Released under the MIT License.\nLicensed under CC BY-NC 4.0."
    want[len(rows)] = {"MIT", "CC-BY-NC"}
    rows.append((len(rows), both))
    for text in [None, "", plain(400), "A driving license is needed.", "the general public was invited", *licence_scan.ORDINARY]:
        want[len(rows)] = set()
        rows.append((len(rows), text))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licences string")
    model = licence_scan.train([plain(40) for _ in range(300)])
    got = {r["doc_id"]: r["licences"] for r in licence_scan.scan(docs, model).collect()}
    texts = dict(rows)
    wrong = [(i, want[i], {x["family"] for x in got[i]}) for i in want if {x["family"] for x in got[i]} != want[i]]
    assert len(wrong) <= 0.03 * len(want), wrong[:10]
    assert not [w for w in wrong if not w[1]]
    spans = {texts[len(want) - 18 + 0] if False else texts[max(k for k in want if want[k] == {"MIT", "CC-BY-NC"})].encode()[x["start"] : x["end"]].decode() for x in got[max(k for k in want if want[k] == {"MIT", "CC-BY-NC"})]}
    assert spans == {"Released under the MIT License", "Licensed under CC BY-NC 4.0"}
    assert licence_scan.scan(docs.where("1 = 0"), model).count() == 0


def test_licence_scan_trains_on_the_corpus(spark):
    docs = spark.createDataFrame([(i, f"some text number {i} " * 30 + ("\nReleased under the MIT License." if i % 10 == 0 else "")) for i in range(60)] + [(None, None)], "doc_id long, text string")
    got = {r["doc_id"]: [x["family"] for x in r["licences"]] for r in licence_scan.scan_licences(docs).collect()}
    assert all(got[i] == (["MIT"] if i % 10 == 0 else []) for i in range(60)) and got[None] == []


def test_licences_over_line_ends():
    mit = ("Copyright (c) 2020 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\n')
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n")
    bsd = ("Copyright (c) 2020, A. Person\r\nAll rights reserved.\r\n\r\nRedistribution and use in source and binary forms, with or without\r\n"
           "modification, are permitted provided that the following conditions are met:\r\n\r\n1. Redistributions of source code must retain the above copyright notice\r\n")
    rng = np.random.default_rng(2)
    plain = lambda n: " ".join(rng.choice(["river", "stone", "of", "the", "to", "green", "works", "and", "letter", "for"], n))
    cases = [
        (mit, ["MIT"]), (gpl, ["GPL-3.0"]), (bsd, ["BSD"]), (gpl.replace("General", "Lesser General"), ["LGPL"]), (gpl.replace("General", "Affero General"), ["AGPL-3.0"]),
        (gpl.replace("version 3", "version 2").replace("Foundation,", "Foundation;"), ["GPL-2.0"]),
        ("Licensed under the MIT License or the Apache License, Version 2.0.", ["Apache-2.0", "MIT"]), ("SPDX-License-Identifier: MIT OR Apache-2.0", ["Apache-2.0", "MIT"]),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA"]), ("Released under the MIT License.\nReleased under the MIT License.", ["MIT", "MIT"]),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy\n\nof this software and associated documentation files", []),
        *[(plain(n) + "\n" + mit.split("\n\n")[1] + plain(50), ["MIT"]) for n in range(0, 45, 3)], (plain(2000), []),
    ]
    model = licence_scan.train([plain(40) for _ in range(300)])
    rows = [t.encode() for t, _ in cases]
    data, bounds = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    got = [[] for _ in cases]
    for r, k, _, _, a, e in licence_scan.scan_batch(model, data, bounds):
        got[r].append(model.families[k])
        assert rows[r][a:e] == rows[r][a:e].strip()
    assert [sorted(g) for g in got] == [w for _, w in cases]


def test_ordinal_fit_is_at_a_minimum_of_the_penalised_likelihood():
    """The gradient by differences of the plainly written loss vanishes at the fitted weights."""
    rng = np.random.default_rng(11)
    x = (rng.random((400, 5)) < 0.4) * rng.integers(1, 4, (400, 5))
    grade = np.searchsorted([0.4, 1.5], x @ [1.0, -0.7, 0.3, 0.0, 0.5] + rng.logistic(size=400))
    rows, cols = np.nonzero(x)
    l2 = 1e-2
    w, t = ordinal_toxicity.fit_ordinal(rows, cols, x[rows, cols].astype(float), grade, 5, 2, l2=l2, steps=4000)

    def loss(theta):
        edge = np.concatenate([[-np.inf], theta[5:], [np.inf]])
        s = x @ theta[:5]
        at = lambda v: 1 / (1 + np.exp(-(v - s)))
        return -np.log(at(edge[grade + 1]) - at(edge[grade])).mean() + l2 / 2 * (theta[:5] ** 2).sum()

    theta, step = np.concatenate([w, t]), 1e-5
    slope = [(loss(theta + step * e) - loss(theta - step * e)) / (2 * step) for e in np.eye(7)]
    assert np.abs(slope).max() < 2e-3 and t[0] < t[1]


def test_toxicity_scores_by_plain_python(spark):
    """Features, evidence and scores again with dictionaries; a long text is read to its end."""
    import math
    import re
    from collections import Counter

    from catalogspark.llm.words import text_bytes

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    long = spark.createDataFrame([(-1, "zq " * 600_000 + "disgusting moron"), (-2, "zq " * 600_000)], docs.schema)
    model = ordinal_toxicity.train(docs, labels)

    def features(text):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
        return Counter([*words, *((n, w[:n]) for w in words for n in (3, 4, 5) if len(w) > n)])

    def code(feature):
        text = feature if isinstance(feature, bytes) else feature[1] + b"q"
        import pyarrow as pa

        data, bounds = text_bytes(pa.array([text.decode("utf-8", "surrogateescape")])) if isinstance(feature, bytes) else (np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        found, _ = ordinal_toxicity._features(data, bounds)
        return found[0] if isinstance(feature, bytes) else found[1 + (3, 4, 5).index(feature[0])]

    grade = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    known = [(features(r["text"]), grade[r["doc_id"]]) for r in docs.collect() if grade.get(r["doc_id"]) is not None]
    seen = [Counter(f for c, g in known if g == kind for f in c) for kind in (0, 1)]
    n = [sum(g == kind for _, g in known) for kind in (0, 1)]
    every = {f for c in seen for f in c if seen[0][f] + seen[1][f] >= 3}

    def evidence(f):
        cells = [(seen[k][f], n[k] * (seen[0][f] + seen[1][f]) / sum(n)) for k in (0, 1)]
        cells += [(n[k] - a, n[k] - e) for k, (a, e) in enumerate(cells)]
        return 2 * sum(a * math.log(a / e) for a, e in cells if a)

    chosen = {f for f in every if evidence(f) >= 2 * math.log(len(every))}
    weight = dict(zip(model.words.tolist(), model.weights.tolist()))
    codes = {f: int(code(f)) for f in chosen if isinstance(f, tuple) or b"\xc3" not in f}
    assert chosen and set(codes.values()) <= set(weight) and len(chosen) == len(weight)
    told = {r["doc_id"]: r["p"] for r in ordinal_toxicity.score(docs.union(long), model).selectExpr("doc_id", "toxicity.probability p").collect()}
    if len(codes) == len(chosen):
        for r in docs.collect():
            s = sum(math.log1p(k) * weight[codes[f]] for f, k in features(r["text"]).items() if f in codes)
            assert abs(told[r["doc_id"]] - (1 - 1 / (1 + math.exp(-(model.thresholds[0] - s))))) < 1e-6
    caught = [i for i, g in grade.items() if g and told.get(i, 0) >= 0.5]
    assert len(caught) >= 6 and not [i for i, g in grade.items() if g == 0 and told.get(i, 0) >= 0.5]
    assert told[-1] > 0.5 > told[-2]


def _plain_paragraphs(n, words=40):
    rng = np.random.default_rng(3)
    return [" ".join(rng.choice("the of work was made in an old house by people who read public books version one and mit not two license".split(), words)) for _ in range(n)]


def test_the_classifier_decides():
    """Paraphrases and short identifiers are classed, denials are not, and without the classifier nothing is found."""
    import dataclasses

    model = licence_scan.train(_plain_paragraphs(300))
    cases = {
        "under the terms of version 3 of the GNU GPL, as the Free Software Foundation published it": {"GPL-3.0"}, "The Apache licence, version 2.0, applies": {"Apache-2.0"},
        "All code is MIT licensed.": {"MIT"}, "SPDX-License-Identifier: GPL-3.0-only": {"GPL-3.0"}, "SPDX-License-Identifier: ISC": {"ISC"}, "SPDX-License-Identifier: BSD-3-Clause": {"BSD"},
        "SPDX-License-Identifier: MPL-2.0": {"MPL-2.0"}, "Licensed under the MIT License.": {"MIT"}, "This is not licensed under the MIT License": set(), "It is no longer under the Apache License 2.0.": set(),
        "mit der Hand": set(), "of of of of of of of of of of of of of of of of of of": set(),
    }
    rows = [t.encode() for t in cases]
    data, bounds = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])

    def families(model):
        confirmed, suspected = licence_scan.find_batch(model, data, bounds)
        got = [set() for _ in rows]
        for r, k, *_ in [*confirmed, *suspected]:
            got[r].add(model.families[k])
        return got, len(confirmed)

    assert families(model) == (list(cases.values()), 1)
    off = dataclasses.replace(model, weights=np.zeros_like(model.weights))
    assert families(off) == ([set()] * len(rows), 0)
    swapped = dataclasses.replace(model, weights=np.roll(model.weights, 1, axis=1), bias=np.roll(model.bias, 1))
    assert families(swapped)[0] != families(model)[0]


def test_window_probabilities_by_a_dense_softmax():
    """Every window of a small corpus: words and pairs by dictionaries, one softmax over all features."""
    import re

    from catalogspark.llm.words import codes, placed_words

    model = licence_scan.train(_plain_paragraphs(200))
    rng = random.Random(5)
    templates = [t for v in licence_scan.TEMPLATES.values() for t in v]
    texts = ["\n".join(rng.choice([rng.choice(templates), p, "", " \t "]) for p in _plain_paragraphs(6, rng.randint(1, 70))) for _ in range(40)] + ["", " ", "one"]
    rows = [t.encode() for t in texts]
    data, bounds = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    word, at, _ = placed_words(data, bounds, codes().mark)
    row = np.searchsorted(bounds[:-1], at, side="right") - 1
    line = licence_scan._paragraphs(data, at, row)
    gram = licence_scan._grams(word, line)
    paragraphs = [re.findall(r"[0-9a-z]+", p.lower()) for t in texts for p in re.split(r"\n[ \t]*(?=\n)", t)]
    paragraphs = [p for p in paragraphs if p]
    code = lambda text: licence_scan._words_of([text])
    place = {int(c): i for i, c in enumerate(model.features)}

    def features(words, after):
        out = {place.get(int(code(w)[0][0])) for w in words}
        for a, b in zip(words, [*words[1:], *after]):
            w, n = code(f"{a} {b}")
            out.add(place.get(int(licence_scan._grams(w, n)[0])))
        return out - {None}

    want = []
    for p in paragraphs:
        blocks = range(0, len(p), licence_scan.BLOCK)
        for i in blocks:
            end = min(len(p), i + 2 * licence_scan.BLOCK)
            x = np.zeros(len(model.features))
            x[list(features(p[i:end], p[end : end + 1]))] = 1
            want.append(x @ model.weights + model.bias)
    z = np.array(want) / model.temperature
    dense = np.exp(z - z.max(1, keepdims=True))
    dense /= dense.sum(1, keepdims=True)
    first = np.append(True, line[1:] != line[:-1])
    inside = np.arange(len(line)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    starts = first | (inside % licence_scan.BLOCK == 0)
    block, block_line = np.cumsum(starts) - 1, line[starts]
    assert len(block_line) == len(dense)
    window, p = licence_scan.window_probabilities(model, word, gram, block, block_line)
    assert np.abs(p - dense[window]).max() < 1e-5
    others = np.setdiff1d(np.arange(len(dense)), window)
    assert (dense[others].argmax(1) == len(model.families)).all()  # windows without a feature are unknown
