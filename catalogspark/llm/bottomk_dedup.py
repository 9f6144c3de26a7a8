"""Near-duplicate documents from bottom-k sketches: inverted lists, union-sketch estimates, exact Jaccard.

A document's set are its distinct word shingles, as 64-bit codes. One hash function orders all codes, and a sketch keeps
the ``k`` smallest of a set. Documents with equal sets form a class and are represented by the smallest id.

Two sets with Jaccard 0.8 or more share at least ``LIST_SHARED`` of their ``LISTED`` smallest values (all but about 4 pairs
in 10**9 at exactly 0.8, fewer above; smaller sets are listed whole and lose none). Of these values the most frequent
``LIST_SHARED - LIST_MET`` are left out, so that common lines and phrases are looked at last, and values that no other
sketch lists drop out; most documents leave here. Similar sets still meet in at least ``LIST_MET`` lists.

Links are found in two passes over the inverted lists, because only the components are asked for:

1. every member of a list is paired with the list's centre, the member whose listed values are the most frequent ones:
   in a group of edited copies this is the least edited one. Most groups are joined here, with a few pairs per member.
2. lists whose members still lie in different components are compared across components. Short lists give pairs by a
   join. Long ones go to a task per pair of tiles: clusters of overlapping lists as one unit, or list by list where that
   is less work (a pair then in the first of its common lists only). Tiles are met twice: first with 16 bits of each
   sketched value, which tell the members that can have a link at all, then with the full sets of these members only.
   Overlaps come from matrix products, and what leaves the task is a spanning forest of the links found, not the pairs.

Candidates are filtered by the union-sketch estimate and verified on the full sets, 100 * |A & B| >= 80 * |A | B|.

Defined results: texts without words (NULL, empty) have 0 shingles and link with nothing; rows with equal ids and
different texts join the same node; rows without id are returned with a NULL component and kept; repeated rows
come back as often as they came; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from catalogspark.llm.components import components, local_forest
from catalogspark.llm.shared import named_back, place_of, release, renamed, stored
from catalogspark.llm.words import groups, mix64, shingle_codes, text_bytes, word_codes

#: Retained values per sketch, and how many of them two sketches of similar sets share at least.
SKETCH = 64
MIN_SHARED = 28
#: The same for the smallest values, which are inverted; and in how many lists similar sets meet at least.
LISTED = 64
LIST_SHARED = 31
LIST_MET = 2
#: Lists in which a member must meet their centre to be paired with it at once; the second pass finds all others.
STAR_MET = 4
#: Up to this many ids are broadcast (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Lists up to this length are paired by a join; longer ones are compared in tiles of about so many members, block by block.
SHORT_LIST = 8
TILE = 4096
BLOCK = 256
#: Long lists per document, on average, whose members' sketches are sent at once; more are sent in turns.
TURN_LISTS = 4
SIMILARITY_PERCENT = 80

_FACTS = "doc_id long, n_shingles long, code_a long, code_b long, sketch array<long>"


def shingle_sets(frame: DataFrame, width: int, keep: int | None) -> DataFrame:
    """Of ``(doc_id, text)``: set size, a 128-bit code of the set, and its ``keep`` smallest values (None: all)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for i, j in groups(bounds):
                words, counts = word_codes(data, bounds[i : j + 1])
                codes, sizes = shingle_codes(words, counts, width)
                edge = np.concatenate([[0], np.cumsum(sizes)])
                sets = [np.unique(codes[edge[r] : edge[r + 1]]) for r in range(j - i)]
                n = np.array([len(s) for s in sets], np.int64)
                a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                b = np.array([mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                kept = [s[:keep] for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
                # flipped sign bit: signed order in the JVM is the order of the hash
                flat = (np.concatenate(kept) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n), pa.array(a), pa.array(b), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    ["doc_id", "n_shingles", "code_a", "code_b", "sketch"],
                )

    return frame.mapInArrow(per_batch, _FACTS)


def _met(n: str) -> Column:
    """In how many lists a set of ``n`` shingles meets a similar one at least."""
    return F.least(F.lit(LIST_MET), F.ceil(F.col(n) * SIMILARITY_PERCENT / 100)).cast("int")


def _like(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY_PERCENT


def rare_values(reps: DataFrame) -> DataFrame:
    """``rep, n, value, score``: the rarest listed values of each sketch; the score is higher the more others list its values."""
    postings = reps.select("rep", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    lists = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # few values of a sketch meet in one task, so lists are collected behind the shuffle: plain rows take less room there
    met = postings.join(lists, "value").select("rep", "n", "df", "value").repartition("rep")
    shared = met.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"), F.sum(F.log2("df")).alias("score"))
    size = F.least(F.col("n"), F.lit(LISTED))
    need = F.least(F.lit(LIST_SHARED), F.ceil(F.col("n") * SIMILARITY_PERCENT / 100)).cast("int")
    prefix = size - need + _met("n") - (size - F.size("v"))  # values of no other sketch come first
    score = F.floor(F.col("score") / size * 1000).cast("long")
    return shared.where(prefix > 0).select("rep", "n", score.alias("score"), F.explode(F.slice("v", F.lit(1), prefix.cast("int"))).alias("v")).select("rep", "n", "score", "v.value")


def star_pairs(rare: DataFrame) -> DataFrame:
    """Pairs of a member and the centre of its lists that meet often enough."""
    centres = rare.groupBy("value").agg(F.max(F.struct(F.col("score"), (-F.col("rep")).alias("r"), F.col("n"))).alias("c"), F.count(F.lit(1)).alias("m")).where("m > 1")
    mine = rare.select("rep", "value", "n", F.least(F.lit(STAR_MET), _met("n") + 2).alias("met"))
    ends = mine.join(centres.select("value", (-F.col("c.r")).alias("end"), F.col("c.n").alias("n_end")), "value").where((F.col("rep") != F.col("end")) & _like("n", "n_end"))
    counted = ends.groupBy("rep", "end").agg(F.count(F.lit(1)).alias("c"), F.first("met").alias("met")).where("c >= met")
    return counted.select(F.least("rep", "end").alias("a"), F.greatest("rep", "end").alias("b")).distinct()


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """Whole sets of the documents with the given ids, stored: ``doc_id, n_shingles, sketch`` (all values)."""
    ids = stored(ids, "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return stored(shingle_sets(docs.join(ids, "doc_id", "left_semi"), width, None).select("doc_id", "n_shingles", "sketch"), "sets")


def similar_pairs(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar; estimates from the sketches come first."""
    sketch = reps.select("rep", "n", "sketch")
    left, right = (sketch.select([F.col(c).alias(c + s) for c in sketch.columns]) for s in ("_a", "_b"))
    joined = pairs.join(right, F.col("b") == F.col("rep_b")).join(left, F.col("a") == F.col("rep_a"))
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    likely = stored(joined.where(_like("n_a", "n_b")).where(both >= F.least(F.lit(MIN_SHARED), F.ceil(F.size(union) * SIMILARITY_PERCENT / 100))).select("a", "b"), "likely")
    ids = likely.select(F.col("a").alias("doc_id")).unionByName(likely.select(F.col("b").alias("doc_id"))).distinct()
    sets = full_sets(docs, ids, width)
    release(docs.sparkSession)
    # an id that stands on rows with different texts has several sets; a link of any of them counts
    left, right = (sets.select([F.col(c).alias(c + s) for c in sets.columns]) for s in ("_a", "_b"))
    joined = likely.join(right, F.col("b") == F.col("doc_id_b")).join(left, F.col("a") == F.col("doc_id_a"))
    inter = F.size(F.array_intersect("sketch_a", "sketch_b"))
    return joined.where(100 * inter >= SIMILARITY_PERCENT * (F.col("n_shingles_a") + F.col("n_shingles_b") - inter)).select("a", "b").distinct()


def _incidence(arrays: list[np.ndarray], at_least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and column of every element that stands in at least so many of the arrays, and the number of columns."""
    lens = np.array([len(x) for x in arrays])
    flat = np.concatenate(arrays) if len(arrays) else np.zeros(0, np.int64)
    value, place = np.unique(flat, return_inverse=True)
    often = np.bincount(place, minlength=len(value)) >= at_least
    keep = often[place]
    column = np.cumsum(often) - 1
    return np.repeat(np.arange(len(arrays)), lens)[keep], column[place[keep]], int(often.sum())


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left and right arrays, by a matrix product over shared elements."""
    row, col, n = _incidence([*left, *right])
    held = np.zeros((len(left) + len(right), n), np.float32)
    np.add.at(held, (row, col), 1)  # an element that stands twice in an array counts twice
    return held[: len(left)] @ held[len(left) :].T


def _asked(value: int, whole: bool, t1: int, t2: int, tile: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of the pairs between two tiles of a list, or of a cluster of lists, that lie in different components.

    In a cluster pairs are asked for that share a list; in a list, those that share no list with a smaller value. A block
    are the rows of its left and of its right members, and which of their pairs are asked for.
    """
    comp, n, side = (tile[c].to_numpy() for c in ("comp", "n", "tile"))
    listed = [np.asarray(x) for x in tile["listed"]]
    shared = listed if whole else [x[x < value] for x in listed]
    order = np.argsort(n, kind="stable")  # blocks of like sizes: most pairs of blocks differ too much in size
    one, two = (order[side[order] == t] for t in (t1, t2))
    for i in range(0, len(one), BLOCK):
        a = one[i : i + BLOCK]
        for j in range(i if t1 == t2 else 0, len(two), BLOCK):
            b = two[j : j + BLOCK]
            if n[a].max() * 100 < SIMILARITY_PERCENT * n[b].min() or n[b].max() * 100 < SIMILARITY_PERCENT * n[a].min():
                continue
            na, nb = n[a][:, None], n[b][None, :]
            ask = (comp[a][:, None] != comp[b][None, :]) & (100 * np.minimum(na, nb) >= SIMILARITY_PERCENT * np.maximum(na, nb))
            rows, cols = np.flatnonzero(ask.any(1)), np.flatnonzero(ask.any(0))
            if not len(rows):
                continue
            a_asked, b_asked = a[rows], b[cols]
            ask = ask[np.ix_(rows, cols)] & ((_common([shared[k] for k in a_asked], [shared[k] for k in b_asked]) > 0) == whole)
            if ask.any():
                yield a_asked, b_asked, ask


def _tile_likely(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
    """Members of two tiles with a partner that their sketches allow, by the low bits of the retained values.

    Different values may have equal low bits, so no shared value is missed, and some pairs more than by the sketches pass.
    """
    unit, whole = int(key[0]), bool(key[1])
    n, codes = tile["n"].to_numpy(), [np.asarray(x) for x in tile["codes"]]
    near = np.zeros(len(tile), bool)
    for a, b, ask in _asked(unit, whole, int(key[2]), int(key[3]), tile):
        least = -(-SIMILARITY_PERCENT * np.minimum(n[a][:, None], n[b][None, :]) // 100)
        ask &= _common([codes[k] for k in a], [codes[k] for k in b]) >= np.minimum(MIN_SHARED, least)
        near[a[ask.any(1)]] = near[b[ask.any(0)]] = True
    return pd.DataFrame({"unit": unit, "whole": whole, "rep": tile["rep"][near], "n": n[near]})


def _tile_links(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the links between two tiles of a list, or of a cluster of lists, across components."""
    rep, n = tile["rep"].to_numpy(), tile["n"].to_numpy()
    sets = [np.asarray(x) for x in tile["set"]]
    found_a, found_b = [], []
    for a, b, ask in _asked(int(key[0]), bool(key[1]), int(key[2]), int(key[3]), tile):
        both = _common([sets[k] for k in a], [sets[k] for k in b])
        union = n[a][:, None] + n[b][None, :] - both
        p, q = np.nonzero((100 * both >= SIMILARITY_PERCENT * union) & ask)
        found_a.append(rep[a[p]]), found_b.append(rep[b[q]])
    child, parent = local_forest(np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.zeros(0, np.int64),) * 2
    return pd.DataFrame({"a": parent, "b": child})


def _tiles(rows: DataFrame, *columns: str) -> GroupedData:
    """Members with these columns, a group for each pair of tiles of a unit; most units are one tile."""
    met = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    both = [F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2")]
    return met.select("unit", "whole", *both, "tile", "rep", "comp", "n", "listed", *columns).groupBy("unit", "whole", "t1", "t2")


def cross_links(rare: DataFrame, reps: DataFrame, comps: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Links ``(a, b)`` between members of a list that lie in different components: enough to join all that are linked."""
    comp = comps.select(F.col("node").alias("rep"), "component")
    members = rare.select("value", "rep", "n").join(comp, "rep", "left").select("value", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    members = stored(members, "members")
    mixed = members.groupBy("value").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("value", "size")
    members = stored(members.join(mixed, "value"), "mixed")
    long = members.where(F.col("size") > SHORT_LIST)
    held = long.groupBy("rep").agg(F.count(F.lit(1)).alias("held"))
    short = members.where(F.col("size") <= SHORT_LIST).join(held, "rep", "left").select("value", "rep", "comp", "n", _met("n").alias("met"), F.coalesce("held", F.lit(0)).alias("held"))
    other = short.select("value", *[F.col(c).alias(c + "_b") for c in ("rep", "comp", "n", "met", "held")])
    both = short.join(other, "value").where(F.expr("rep < rep_b and comp <> comp_b") & _like("n", "n_b")).groupBy(F.col("rep").alias("a"), F.col("rep_b").alias("b"))
    # long lists are not counted here: a pair may share as many of them as both are in
    enough = F.col("c") + F.col("held") >= F.col("met")
    pairs = both.agg(F.count(F.lit(1)).alias("c"), F.min(F.least("met", "met_b")).alias("met"), F.min(F.least("held", "held_b")).alias("held")).where(enough).select("a", "b")
    links = similar_pairs(pairs, reps, docs, width)
    if long.isEmpty():
        return links
    # lists that overlap form a cluster; it is compared as one unit if that is less work than list by list
    low = long.groupBy("value").agg(F.min("rep").alias("low"))
    clusters = components(long.join(low, "value").where("rep <> low").select("rep", "low"), "rep", "low")
    placed = long.join(clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep")
    work = placed.groupBy("cluster").agg(F.count_distinct("rep").alias("docs"), F.sum("size").alias("by_list"))
    work = work.select("cluster", "docs", (F.col("docs") * F.col("docs") <= F.col("by_list")).alias("whole"))
    placed = stored(placed.join(work, "cluster"), "clusters")
    mine = ["rep", "comp", "n"]
    listed = placed.groupBy(*mine, "cluster", "docs", "whole").agg(F.collect_list("value").alias("listed"))  # at most LISTED values
    once = listed.where("whole").select(F.col("cluster").alias("unit"), "whole", *mine, "listed", F.col("docs").alias("members"))
    each = placed.where("not whole").join(listed.select("rep", "listed"), "rep").select(F.col("value").alias("unit"), "whole", *mine, "listed", F.col("size").alias("members"))
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    rows = once.unionByName(each).select("*", F.pmod(F.xxhash64("rep"), tiles).cast("int").alias("tile"), (tiles - 1).alias("last"))
    # a member stands in many lists, so its whole set is sent only where the sketches allow a link
    codes = reps.select("rep", "n", F.transform("sketch", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("short")).alias("codes"))
    turns = max(1, -(-placed.count() // max(1, TURN_LISTS * reps.count())))
    likely = []
    for turn in range(turns):
        release(docs.sparkSession)
        some = rows.where(F.pmod(F.xxhash64("unit"), F.lit(turns)) == turn).join(codes, ["rep", "n"])
        likely.append(stored(_tiles(some, "codes").applyInPandas(_tile_likely, "unit long, whole boolean, rep long, n long"), "likely-members"))
    near = reduce(DataFrame.unionByName, likely).distinct()
    release(docs.sparkSession)
    if near.isEmpty():
        return links
    full = full_sets(docs, near.select(F.col("rep").alias("doc_id")).distinct(), width).select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.col("sketch").alias("set"))
    asked = rows.join(near, ["unit", "whole", "rep", "n"], "left_semi").join(full, ["rep", "n"])
    return links.unionByName(_tiles(asked, "set").applyInPandas(_tile_links, "a long, b long"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row; ``width`` words make a shingle."""
    spark = docs.sparkSession
    frame = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    facts = stored(shingle_sets(frame, width, SKETCH), "sketches")
    named = facts.where("doc_id is not null and n_shingles > 0")
    code = ["n_shingles", "code_a", "code_b"]
    classes = stored(named.groupBy(*code).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")), "classes")
    release(spark)
    reps = classes.select("rep", F.col("n_shingles").alias("n"), "sketch")
    rare = stored(rare_values(reps), "rare")
    release(spark)
    stars = star_pairs(rare)
    whole = frame.where("doc_id is not null")
    first = stored(similar_pairs(stars, reps, whole, width), "similar")
    same = classes.select(*code, "rep")
    release(spark)
    second = stored(cross_links(rare, reps, components(first, "a", "b"), whole, width), "cross-links")
    release(spark)
    # ids on rows of several classes link those classes
    members = named.select("doc_id", *code).join(same, code).select("doc_id", "rep").where("doc_id <> rep")
    twice = named.select("doc_id", *code).distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    odd = members.join(twice, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comps = components(first.unionByName(second).unionByName(odd), "a", "b")
    placed = facts.join(same, code, "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    # a row without words, or a class without links, is its own component
    out = placed.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every component, the row with the smallest id.

    Rows that repeat that id stay once per text. Rows without id all stay.
    """
    found = deduplicate(docs, doc_id, text, width)
    row_id, body = place_of(docs, doc_id), place_of(docs, text)
    rows = renamed(docs)
    drop = found.where("not kept").select(F.col("doc_id").alias("_drop")).distinct()
    left = rows.join(drop, F.col(row_id).cast("long") == F.col("_drop"), "left_anti")
    ids = stored(found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_twice")), "repeated-ids")
    if ids.isEmpty():
        return left.select(*named_back(docs))
    first = F.row_number().over(Window.partitionBy(row_id, F.md5(F.col(body).cast("string"))).orderBy(F.lit(1)))
    again = left.join(ids, F.col(row_id).cast("long") == F.col("_twice"), "left_semi").select("*", first.alias("_row")).where("_row = 1").drop("_row")
    return left.join(ids, F.col(row_id).cast("long") == F.col("_twice"), "left_anti").unionByName(again).select(*named_back(docs))
