import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalogspark.llm import bin_completion, bottomk_dedup, katz_lm, label_shards, length_histogram, temperature_mix
from catalogspark.llm.tokens import UnitEncoder, vocabulary_path
from catalogspark.llm.words import shingle_codes, text_bytes, word_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(lower(text or ""))


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a\n b", "it's  John's\t1,000 x y", "　a 　 b", "é\nÉ", "x" * 3000 + " y", "a <|endoftext|> b", "😀 " * 50, "\r\n\x0b\x0c a", "  \n  z"]


def test_units_give_the_tokenizers_ids(texts):
    t = tokenizer()
    want = [x or "" for x in texts] + ODD
    data, bounds = text_bytes(pa.array([*texts, *ODD]))
    for remember in (0, 50, 10_000):
        e = UnitEncoder(vocabulary_path(), remember)
        for _ in range(2):
            for k, ids in e.encode_rows(data, bounds):
                assert ids.tolist() == t.encode(want[k], add_special_tokens=False).ids, want[k][:80]


def test_long_text_is_encoded_whole(monkeypatch):
    from catalogspark.llm import tokens

    text = "word, another 123 line\nnext " * 4000
    monkeypatch.setattr(tokens, "SLICE_BYTES", 1000)
    data, bounds = text_bytes(pa.array([text, None, text + "x" * 5000]))
    got = dict(UnitEncoder(vocabulary_path()).encode_rows(data, bounds))
    assert got[0].tolist() == tokenizer().encode(text, add_special_tokens=False).ids and len(got[1]) == 0
    assert got[2].tolist() == tokenizer().encode(text + "x" * 5000, add_special_tokens=False).ids


def test_word_codes_equal_words(texts, monkeypatch):
    from catalogspark.llm import words as module

    monkeypatch.setattr(module, "SLICE_BYTES", 64)
    data, bounds = text_bytes(pa.array([*texts, *ODD]))
    code, counts = word_codes(data, bounds)
    seen, at = {}, 0
    for text, n in zip([*texts, *ODD], counts):
        own = words(text)
        assert len(own) == n
        for w, c in zip(own, code[at : at + n].tolist()):
            assert seen.setdefault(w, c) == c
        at += n
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingles_equal_sets(texts, width):
    data, bounds = text_bytes(pa.array(texts))
    code, counts = word_codes(data, bounds)
    got, sizes = shingle_codes(code, counts, width)
    at = 0
    for text, n in zip(texts, sizes):
        w = words(text)
        own = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] or ([tuple(w)] if w else [])
        assert len(own) == n and len(set(own)) == len(set(got[at : at + n].tolist()))
        at += n


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_dedup(rows, width):
    """Sizes and components of (id, text) rows by comparing all pairs."""
    sets = []
    for i, text in rows:
        w = words(text)
        sets.append((i, frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) or (frozenset([tuple(w)]) if w else frozenset())))
    known = [(i, s) for i, s in sets if i is not None]
    links = [(a, b) for n, (a, x) in enumerate(known) for b, y in known[:n] if a != b and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    comp = brute_components({i for i, _ in known}, links)
    return sorted(((i, len(s), comp.get(i), i is None or comp[i] == i) for i, s in sets), key=repr)


@pytest.mark.parametrize("width, short, tile, block", [(2, 64, 4096, 256), (5, 64, 4096, 256), (2, 1, 3, 2), (2, 1, 4096, 3)])
def test_bottomk_against_all_pairs(spark, docs, monkeypatch, width, short, tile, block):
    monkeypatch.setattr(bottomk_dedup, "SHORT_LIST", short)
    monkeypatch.setattr(bottomk_dedup, "TILE", tile)
    monkeypatch.setattr(bottomk_dedup, "BLOCK", block)
    got = sorted((tuple(r) for r in bottomk_dedup.deduplicate(docs, width=width).collect()), key=repr)
    want = brute_dedup([(r["doc_id"], r["text"]) for r in docs.collect()], width)
    assert got == want


def test_rare_values_are_shuffled_as_plain_rows(spark):
    reps = spark.createDataFrame([(i, 3, [i, i + 1, i + 2]) for i in range(9)], "rep long, n long, sketch array<long>")
    rare = bottomk_dedup.rare_values(reps)
    plan = rare._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and "collect_list" not in plan[plan.index("hashpartitioning(rep") :]
    got = {(r["rep"], r["n"], r["value"]) for r in rare.collect()}
    # all but the rarest values of a set that others share too; a set of 3 must share 3, and meet in 2 lists
    assert {v for rep, _, v in got if rep == 4} <= {4, 5, 6} and len({v for rep, _, v in got if rep == 4}) == 2


def test_bottomk_tiles_find_chains(spark, monkeypatch):
    """A chain whose ends are not similar, all of it in the same lists."""
    monkeypatch.setattr(bottomk_dedup, "SHORT_LIST", 1)
    monkeypatch.setattr(bottomk_dedup, "TILE", 4)
    base = [f"w{i}" for i in range(60)]
    rows = [(100 - n, " ".join(f"n{k}" if k < 3 * n else w for k, w in enumerate(base))) for n in range(18)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in bottomk_dedup.deduplicate(frame, width=1).collect()), key=repr)
    assert got == brute_dedup(rows, 1)


@pytest.mark.parametrize("turn", [8, 100])
def test_bottomk_sends_full_sets_only_where_sketches_allow_a_link(spark, monkeypatch, turn):
    """Documents made of passages that many have stand in the same long lists; only two of them are similar."""
    import random

    asked, turns = [], []
    kept, whole_sets = bottomk_dedup.stored, bottomk_dedup.full_sets
    monkeypatch.setattr(bottomk_dedup, "SHORT_LIST", 2)
    monkeypatch.setattr(bottomk_dedup, "STAR_MET", 10**6)  # no pair is found around a centre
    monkeypatch.setattr(bottomk_dedup, "TURN_LISTS", turn)
    monkeypatch.setattr(bottomk_dedup, "stored", lambda df, name: turns.append(name) or kept(df, name))
    monkeypatch.setattr(bottomk_dedup, "full_sets", lambda docs, ids, width: asked.extend(r[0] for r in ids.collect()) or whole_sets(docs, ids, width))
    rng, made = random.Random(5), []
    while len(made) < 14:
        passages = set(rng.sample(range(16), 6))
        if all(len(passages & x) <= 3 for x in made):
            made.append(passages)
    rows = [(i, " ".join(f"p{p}-{k}" for p in sorted(x) for k in range(8))) for i, x in enumerate(made)]
    rows.append((99, " ".join(["new", "words", "here", *rows[13][1].split()[3:]])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in bottomk_dedup.deduplicate(frame, width=1).collect()), key=repr)
    assert got == brute_dedup(rows, 1) and [r[0] for r in got if not r[3]] == [99]
    assert set(asked) == {13, 99}
    assert turns.count("likely-members") == {8: 2, 100: 1}[turn]


def test_bottomk_low_bits_lose_no_pair():
    """Two shared values with equal low bits are still two shared values."""
    sets = [[1, 2, 3, 4, 1 + (1 << 16)], [1, 2, 3, 1 + (1 << 16)], [1, 6, 7, 8, 9]]
    tile = pd.DataFrame({"rep": [5, 6, 7], "comp": [5, 6, 7], "n": [len(x) for x in sets], "tile": 0, "listed": [[1]] * 3, "codes": [[v & 0xFFFF for v in x] for x in sets]})
    for whole in (True, False):
        assert bottomk_dedup._tile_likely((1, whole, 0, 0), tile)["rep"].tolist() == [5, 6]


def test_bottomk_group_around_a_centre(spark, monkeypatch):
    """Copies edited so much that most pairs are not similar: links lead through the centre, or through shared edits."""
    import random

    monkeypatch.setattr(bottomk_dedup, "SHORT_LIST", 4)
    monkeypatch.setattr(bottomk_dedup, "BLOCK", 7)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        text = list(base)
        for k in rng.sample(range(80), rng.randint(0, 14)):
            text[k] = f"e{i // 2}-{k}" if i % 2 else f"x{i}-{k}"
        rows.append((i * 7 % 90, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in bottomk_dedup.deduplicate(frame, width=2).collect()), key=repr)
    assert got == brute_dedup(rows, 2)


def test_keep_one_row_per_component(spark, docs):
    got = bottomk_dedup.keep_one(docs, width=5)
    assert got.columns == docs.columns
    comp = {i: c for i, _, c, _ in brute_dedup([(r["doc_id"], r["text"]) for r in docs.collect()], 5) if i is not None}
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(comp.values())) and ids.count(None) == 2


def test_packing(docs):
    t = tokenizer()
    rows = bin_completion.pack(docs, include_ids=True).collect()
    want = []
    for r in docs.collect():
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        want += [(r["doc_id"], p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(want, key=repr) == sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in rows), key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    counts = np.bincount([r["length"] for r in rows], minlength=1025)
    assert len(bins) <= bin_completion.lower_bound(counts, 1024) + 1


@pytest.mark.parametrize("sizes, best", [([6, 5, 5, 4, 4, 3, 3], 3), ([7, 7, 6, 5, 5], 4), ([10] * 4, 4), ([5, 5, 5, 5, 4, 4, 1, 1], 3), ([], 0), ([4, 4, 4, 3, 3, 3, 3, 3, 3], 3), ([9, 8, 2, 1], 2)])
def test_plan_is_optimal_on_small_cases(sizes, best):
    plan = bin_completion.plan_bins(Counter(sizes), capacity=10)
    assert sum(n for _, n in plan) == best and all(sum(p) <= 10 for p, _ in plan)
    assert Counter(x for p, n in plan for x in p for _ in range(n)) == Counter(sizes)


def test_plan_close_to_the_bound():
    rng = np.random.default_rng(3)
    x = np.minimum(1024, rng.lognormal(6, 1, 5000).astype(int) + 1)
    plan = bin_completion.plan_bins(dict(Counter(x.tolist())))
    counts = np.bincount(x, minlength=1025)
    assert sum(n for _, n in plan) <= 1.002 * bin_completion.lower_bound(counts, 1024) + 1


def test_shards(docs):
    got = label_shards.shard(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows) == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    per = Counter(r["shard"] for r in got)
    assert set(per) <= set(range(8)) and max(per.values()) - min(per.values()) <= 1 and len(per) == 8
    for s in per:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(per[s]))
    homes = defaultdict(set)
    for r in got:
        homes[r["text_crc32"]].add(r["shard"])
    assert all(len(v) == 1 for v in homes.values())  # every group fits


def test_shards_spread_a_group_larger_than_a_shard(spark):
    frame = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).when(F.col("id") % 3 == 1, F.concat(F.lit("p"), F.floor(F.col("id") / 30))).otherwise(F.col("id").cast("string")).alias("text"))
    got = label_shards.shard(frame).collect()
    per = Counter(r["shard"] for r in got)
    assert set(per.values()) == {50}
    homes = defaultdict(set)
    for r in got:
        if r["group_size"] > 1:
            homes[r["text_crc32"]].add(r["shard"])
    assert len(homes.pop(zlib.crc32(b"same"))) <= 5  # 134 rows need 3 shards
    assert sum(len(v) for v in homes.values()) <= 1.3 * len(homes)


def test_early_decisions_are_taken_back():
    """A histogram on which using every tight filling as often as it goes wastes a tenth of the bins."""
    histogram = {205: 1000, 206: 777, 341: 500, 342: 333, 513: 10}
    plan = bin_completion.plan_bins(histogram)
    assert Counter({x: sum(n * f.count(x) for f, n in plan) for x in histogram}) == Counter(histogram) and all(sum(f) <= 1024 for f, _ in plan)
    counts = np.zeros(1025, np.int64)
    for x, n in histogram.items():
        counts[x] = n
    assert 658 <= bin_completion.lower_bound(counts, 1024) <= sum(n for _, n in plan) <= 685


def test_bound_and_best_fit_on_random_histograms():
    rng = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(rng.integers(8, 40))
        counts = np.zeros(capacity + 1, np.int64)
        for x in rng.integers(1, capacity + 1, rng.integers(1, 7)):
            counts[x] += rng.integers(1, 4)
        bins, plan = bin_completion._best_fit(counts, capacity)
        assert all(sum(f) <= capacity for f, _ in plan) and bins == sum(n for _, n in plan)
        assert all(sum(n * f.count(x) for f, n in plan) == counts[x] for x in range(capacity + 1))
        best, _ = bin_completion._search(counts, capacity, 0, 1.0, False, 10**6, None)  # to the end: the optimum
        assert bin_completion.lower_bound(counts, capacity) <= best[0] <= bins


@pytest.mark.parametrize(("groups", "copies"), [(8, 8), (16, 4), (40, 7), (3, 30), (1, 100)])
def test_shards_of_copies_alone(spark, groups, copies):
    """Tables without a document that has no equal: groups still come together, and the cut never grows."""
    frame = spark.range(groups * copies).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % groups).alias("text"))
    got = label_shards.shard(frame).collect()
    per = Counter(r["shard"] for r in got)
    assert max(per.values()) - min(per.get(s, 0) for s in range(8)) <= 1 and sum(per.values()) == groups * copies
    members = defaultdict(Counter)
    for r in got:
        members[r["text_crc32"]][r["shard"]] += 1
    cut = sum(sum(c.values()) - max(c.values()) for c in members.values())
    assert {r["cut_after"] for r in got} == {cut} and all(r["cut_after"] <= r["cut_before"] for r in got)
    if groups % 8 == 0 and copies <= 8:  # a perfect cut exists
        assert cut == 0
    torn = [c for c in members.values() if len(c) > -(-copies // (groups * copies // 8))]
    assert len(torn) <= 8


def brute_katz(train, texts, order):
    """Scores by the definition, on dictionaries."""
    k = katz_lm.KATZ_K
    grams = [Counter() for _ in range(order)]
    history = lambda seq, i, n: tuple(seq[j] if j >= 0 else "</s>" for j in range(i - n + 1, i))
    for seq in train:
        for i, w in enumerate(seq):
            for n in range(1, order + 1):
                grams[n - 1][(history(seq, i, n), w)] += 1
    discounts = []
    for g in grams:
        by = Counter(min(c, k + 2) for c in g.values())
        discounts.append(katz_lm.good_turing(np.array([by[r] for r in range(1, k + 2)], float)))
    d = lambda n, c: 1.0 if c > k else discounts[n - 1][c - 1]
    uni = {w: c for (_, w), c in grams[0].items()}
    total, v = sum(uni.values()), len(uni)
    left = 1 - sum(d(1, c) * c for c in uni.values()) / total if total else 1
    unk = max(left, 0.5 / (total + 0.5 * (v + 1))) if total else 1.0
    p1 = lambda w: (1 - unk) * d(1, uni[w]) * uni[w] / (total * (1 - left)) if w in uni else unk
    follow = [defaultdict(dict) for _ in range(order)]
    for n in range(2, order + 1):
        for (h, w), c in grams[n - 1].items():
            follow[n - 1][h][w] = c

    def p(w, h, n):
        if n == 1:
            return p1(w)
        seen = follow[n - 1].get(h)
        lower_p = lambda x: p(x, h[1:], n - 1)
        if not seen or any(x not in uni for x in h):
            return lower_p(w)
        ch = sum(seen.values())
        mass = sum(d(n, c) * c for c in seen.values())
        kept, room = min(mass / ch, ch / (ch + 1)), 1 - sum(lower_p(x) for x in seen)
        if room < 1e-12:
            return d(n, seen[w]) * seen[w] / mass if w in seen else 0.0
        if w in seen:
            return d(n, seen[w]) * seen[w] / mass * kept
        return (1 - kept) / room * lower_p(w)

    for n in range(2, order + 1):  # exactly normalised
        for h in list(follow[n - 1])[:40]:
            assert abs(sum(p(w, h, n) for w in [*uni, None]) - 1) < 1e-9
    out = []
    for seq in texts:
        base = sum(np.log10((uni.get(w, 0) + 0.5) / (total + 0.5 * (v + 1))) for w in seq)
        out.append((len(seq), sum(w in uni for w in seq), total, base, sum(np.log10(p(w, history(seq, i, order), order)) for i, w in enumerate(seq))))
    return out


@pytest.mark.parametrize("order, chunk", [(1, 500), (2, 500), (2, 10**6), (3, 700)])
def test_katz_against_the_definition(docs, monkeypatch, order, chunk):
    monkeypatch.setattr(katz_lm, "CHUNK_TOKENS", chunk)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    got = katz_lm.score_documents(docs, held, order=order).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    is_held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    seqs = [[*words(t), "</s>"] for _, t in rows]
    want = brute_katz([s for s, h in zip(seqs, is_held) if not h], seqs, order)
    key = lambda x: (repr(x[0]), x[2], x[3], round(x[6], 6))
    got, want = sorted(map(tuple, got), key=key), sorted([(i, h, *w) for (i, _), h, w in zip(rows, is_held, want)], key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 1e-6


def test_katz_without_training_rows(docs):
    got = katz_lm.score_documents(docs, F.lit(True)).collect()
    assert got and all(r["train_tokens"] == 0 and r["score"] == 0 and r["n_known"] == 0 for r in got)


def test_length_report(docs):
    t = tokenizer()
    lens = [len(t.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]
    report = length_histogram.length_report(docs, limits=[16, 100_000])
    for r in report.collect():
        limit = r["context_limit"]
        assert (r["n_docs"], r["n_tokens"]) == (lens.count(limit), limit * lens.count(limit))
        assert r["docs_longer"] == sum(x > limit for x in lens) and r["tokens_longer"] == sum(x for x in lens if x > limit)
        assert r["tokens_kept"] == sum(min(x, limit) for x in lens) and r["tokens_lost"] == sum(lens) - r["tokens_kept"]
        assert r["total_docs"] == len(lens) and r["total_tokens"] == sum(lens)
    q = {r["q"]: r["length"] for r in length_histogram.length_quantiles(report, [0.25, 0.5, 1.0]).collect()}
    assert q == {s: sorted(lens)[int(np.ceil(s * len(lens))) - 1] for s in (0.25, 0.5, 1.0)}


def test_mix_limits_repetition_and_loses_nothing(docs):
    got = temperature_mix.mix(docs, repetition_limit=3.0, into="told")
    assert got.columns == [*docs.columns, "told"]
    rows = got.select("doc_id", "source", "told.*").collect()
    whole = Counter((r["doc_id"], r["source"]) for r in rows if r["epoch"] == 0)
    assert whole == Counter((r["doc_id"], r["source"]) for r in docs.collect())
    cost = Counter()
    for r in docs.collect():
        cost[r["source"]] += len(words(r["text"]))
    used = Counter()
    for r in rows:
        used[r["source"]] += r["n_tokens"]
    weight = {r["source"]: r["weight"] for r in rows}
    times = {s: weight[s] / cost[s] for s in cost if cost[s]}
    assert max(times.values()) <= 3.0 * (1 + 1e-9) * min(times.values())
    budget = max(cost[s] / weight[s] for s in cost if cost[s])
    for s in cost:
        assert used[s] <= round(weight[s] * budget) and used[s] > weight[s] * budget - max(len(words(r["text"])) for r in docs.collect()) - 1


def test_mix_meets_a_target_entropy(spark):
    shares = spark.createDataFrame([("a", 1, 70, 0.7), ("b", 1, 20, 0.2), ("c", 1, 10, 0.1), (None, 1, 0, 0.0)], "source string, n_docs long, n_tokens long, share double")
    alpha = temperature_mix.fit_exponent(shares, repetition_limit=None, target_entropy=1.0)
    w = np.array([0.7, 0.2, 0.1]) ** alpha
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-9
    assert temperature_mix.fit_exponent(shares, repetition_limit=None, target_entropy=2.0) == 0
    assert abs(temperature_mix.fit_exponent(shares, repetition_limit=2.0) - (1 - np.log(2) / np.log(7))) < 1e-9
    assert temperature_mix.fit_exponent(shares.where("source = 'a'")) == 0
    plan = temperature_mix.source_plan(shares, 0.5, budget_tokens=1000).collect()
    assert sum(r["quota"] for r in plan) in (999, 1000, 1001)


def test_mix_runs_no_python(spark, docs):
    plan = temperature_mix.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(nothing):
    assert bottomk_dedup.deduplicate(nothing).count() == 0 and bottomk_dedup.keep_one(nothing).count() == 0
    assert bin_completion.pack(nothing).count() == 0 and label_shards.shard(nothing).count() == 0
    assert katz_lm.score_documents(nothing, F.lit(False)).count() == 0
    assert length_histogram.length_report(nothing).count() == 0 and temperature_mix.mix(nothing).count() == 0


def _fewest(sizes, capacity):
    """Fewest bins, by all ways to fill a bin around the largest item."""
    from functools import cache
    from itertools import combinations

    @cache
    def least(left):
        if not left:
            return 0
        best = len(left)
        for n in range(len(left)):
            for at in combinations(range(1, len(left)), n):
                if left[0] + sum(left[i] for i in at) <= capacity:
                    best = min(best, 1 + least(tuple(x for i, x in enumerate(left) if i and i not in at)))
        return best

    return least(tuple(sorted(sizes, reverse=True)))


def test_packing_is_exact_when_the_nodes_allow():
    import random

    rng = random.Random(11)
    for _ in range(60):
        capacity = rng.choice([20, 30, 50])
        low = rng.randint(1, capacity // 3)
        sizes = [rng.randint(low, max(low, capacity // 2)) for _ in range(rng.randint(1, 10))]
        plan = bin_completion.plan_bins(Counter(sizes), capacity, max_nodes=10**6)
        assert sum(n for _, n in plan) == _fewest(sizes, capacity)
        assert Counter(x for items, n in plan for x in items * n) == Counter(sizes)


def test_fillings_of_any_number_of_pieces_are_undominated():
    counts = np.zeros(1025, np.int64)
    counts[160:241] = 1000
    first = next(f for f in bin_completion.fillings(counts, 784) if f)
    assert sum(first) == 784 and len(first) == 4
    small = np.zeros(13, np.int64)
    small[[2, 3, 5, 6, 7]] = [3, 1, 1, 1, 1]
    number = {2: 3, 3: 1, 5: 1, 6: 1, 7: 1}
    got = {f for f in bin_completion.fillings(small, 12) if f}
    assert (7, 5) in got and (7, 3, 2) not in got  # 5 fits in place of 3 and 2
    assert all(not bin_completion._dominated(f, number, 12) for f in got)
    plan = bin_completion.plan_bins({x: 1000 for x in range(160, 241)})
    assert sum(n for _, n in plan) <= 16_200  # five a bin; 16,967 with greedy fillings alone
