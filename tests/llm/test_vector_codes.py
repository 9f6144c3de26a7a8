"""Product codes against the plain method: exact codebooks, codes and errors, whatever the bounds decide."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from catalogspark.llm import vector_codes as V


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error, label error, digest) of the kept rows, by full distance tables."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for size in {len(v) for _, _, v in kept}:
        mine = [r for r in kept if len(r[2]) == size]
        x, edge = np.array([v for _, _, v in mine], np.int64).reshape(len(mine), size), V.part_edges(size, parts)
        seeds = sorted((i, v) for i, _, v in mine if i is not None)[:entries]
        if not seeds:
            out += [(i, None, None, lab, None) for i, lab, _ in mine]
            continue
        books = [np.array([v[edge[p] : edge[p + 1]] for _, v in seeds], np.int64).reshape(len(seeds), -1) for p in range(parts)]
        for turn in range(rounds + 1):
            d = [((x[:, None, edge[p] : edge[p + 1]] - books[p][None]) ** 2).sum(2) for p in range(parts)]
            code = [t.argmin(1) for t in d]
            if turn < rounds:
                for p in range(parts):
                    for e in range(len(seeds)):
                        of = x[code[p] == e, edge[p] : edge[p + 1]]
                        if len(of):
                            books[p][e] = of.sum(0) // len(of)
        digest = hashlib.sha256(",".join(str(y) for b in books for e in b.tolist() for y in e).encode()).hexdigest()
        for n, (i, lab, _) in enumerate(mine):
            out.append((i, "".join(f"{code[p][n]:02x}" for p in range(parts)), int(sum(d[p][n, code[p][n]] for p in range(parts))), lab, digest))
    by_label = defaultdict(lambda: None)
    for _, _, error, lab, _ in out:
        by_label[lab] = by_label[lab] if error is None else (by_label[lab] or 0) + error
    return sorted(((i, c, e, by_label[lab], s) for i, c, e, lab, s in out), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, lab, v, 0, [1], "x") for i, lab, v in rows], "vec_id long, label int, embedding array<double>, v int, need array<int>, code string").repartition(3)


def report(df):
    return sorted((tuple(r) for r in V.code_report(df).collect()), key=repr)


def clustered(n, dim=16, seed=0, spread=0.3, grid=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, dim))[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    x = np.round(x * grid) / grid if grid else x
    return [(int(i), int(i) % 5 if i % 7 else None, [float(y) for y in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("rows", [clustered(900), clustered(700, seed=1, grid=2), clustered(600, dim=8, seed=2, spread=3.0)], ids=["clustered", "ties", "spread"])
def test_codes_are_those_of_the_plain_method(spark, rows):
    assert report(table(spark, rows)) == plain(rows)


def test_odd_vectors(spark):
    rows = clustered(40, seed=3) + [(100, 1, None), (101, 1, [float("nan")] * 16), (102, 1, [float("inf")] + [0.0] * 15), (103, 1, [None] + [0.0] * 15), (None, 2, [0.5] * 16), (7, 3, [0.25] * 16), (7, 3, [0.25] * 16)]
    rows += [(200 + i, 4, [float(i), -1.5, 2.0, 0.1, 0.2, 9.0]) for i in range(5)] + [(300, 4, []), (301, None, [1.0, 2.0]), (None, 9, [1.0, 2.0, 3.0])]
    assert report(table(spark, rows)) == plain(rows)


def test_few_rows_and_empty_table(spark):
    assert report(table(spark, [(5, None, [1.0, 2.0, 3.0, 4.0])])) == plain([(5, None, [1.0, 2.0, 3.0, 4.0])])
    assert report(table(spark, [(5, 1, [1.0] * 8)] * 3)) == plain([(5, 1, [1.0] * 8)] * 3)
    empty = table(spark, [(1, 1, None)])
    assert report(empty) == [] and report(empty.where("1 = 0")) == []


def test_large_numbers_stay_exact_and_too_large_ones_are_refused(spark):
    rows = [(i, 1, [100000.0 + 1e-3 * i, -99999.0 + i % 3, 7.0 * i, 0.0] * 2) for i in range(60)]
    assert report(table(spark, rows)) == plain(rows)
    with pytest.raises(ValueError, match="64 bits"):
        V.code_report(table(spark, [(1, 1, [1e9] * 4)]))


@pytest.mark.parametrize("listed", [1, 3, 40])
def test_list_length_never_changes_the_result(spark, monkeypatch, listed):
    monkeypatch.setattr(V, "LISTED", listed)
    monkeypatch.setattr(V, "LEAST", 1)
    rows = clustered(500, seed=4, grid=4)
    assert report(table(spark, rows)) == plain(rows)


def test_bounds_save_distances_and_lists_adapt(spark):
    rows, log = clustered(3000, seed=5, spread=0.15), []
    V.compress(table(spark, rows), log=log)
    parts = 4 * len(rows)
    last = log[-1]
    assert sum(last["need"].values()) == parts
    assert last["need"].get(0, 0) > 0.5 * parts  # certain without a look at other entries
    assert last["need"].get(last["listed"] + 1, 0) < 0.35 * parts  # one far move lowers every outer bound
    assert V.next_listed({0: 90, 3: 10}, 16) == 4 and V.next_listed({0: 50, 17: 50}, 16) == 32 and V.next_listed({0: 90, 9: 10}, 16) == 9


def test_restored_vectors_are_near(spark):
    rows = clustered(400, seed=6)
    codes, books = V.compress(table(spark, rows))
    want = {i: np.array(v) for i, _, v in rows}
    for r in V.restore(codes, books).collect():
        got = np.array(r["vector"])
        assert got.shape == want[r["vec_id"]].shape
        assert abs(((got - want[r["vec_id"]]) ** 2).sum() - r["error"] / 1024**2) < 0.1


def test_label_totals_of_hot_and_rare_labels(spark):
    rows = [(None, 1)] * 50 + [(1, 2)] * 40 + [(i, 3) for i in range(2, 12)]
    df = spark.createDataFrame(rows, "label int, error long")
    got = {(r["label"], r["t"]) for r in V.with_label_totals(df, "label", "error", "t", hot_share=0.2).collect()}
    assert got == {(None, 50), (1, 80), *((i, 3) for i in range(2, 12))}
    assert V.with_label_totals(df, "label", "error", "t", hot_share=0.2).count() == len(rows)
