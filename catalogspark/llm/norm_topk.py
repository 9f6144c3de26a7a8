"""Exact top-k inner products: vectors in bands of descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Components become whole numbers floor(scale * x). Candidates are dealt into bands by descending length. The first band
is searched for all queries and gives each query a first k-th score. A later band is searched for a query only if
length(query) * greatest length in the band reaches that score. Inside a band, in steps of descending length, the leading
half of the rotated coordinates gives a partial sum, and the product of the remaining lengths bounds the rest; only pairs
whose bound reaches the k-th score are scored, in whole numbers. Results of bands are merged per query.

A task holds one block of queries and one band, both bounded in rows. The rotation comes from a bounded sample; any
rotation gives the same result. Each band returns at most k rows a query.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite components, and rows without id, take no part;
a query is not its own candidate, which holds for every row with its id; vectors of different lengths do not meet;
ties go to the smaller id; repeated candidate rows each count; repeated query rows are one query; zero vectors score 0;
queries without candidates and empty tables give no rows; labels and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm.shared import stored
from catalogspark.llm.subspace_join import usable_vectors

TOP = 10
SCALE = 1024
#: Rows of a band and of a block of queries.
BAND_ROWS = 16_384
QUERY_ROWS = 1_024
#: Rows the rotation is fitted on (smallest id hashes).
SAMPLE_ROWS = 4_096
STEP = 1_024
#: Whole numbers up to this are exact as doubles.
EXACT = float(1 << 52)


def _rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    rows = [np.array(r["v"], np.float64) for r in vectors.select("v", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()]
    return {size: np.linalg.svd(np.stack([v for v in rows if len(v) == size]), full_matrices=True)[2].T for size in {len(v) for v in rows}}


def _searcher(rotations: dict[int, np.ndarray], top: int):
    def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
        if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1]) < EXACT:
            return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
        return q @ c.T

    def one_size(q_id, q, bound, c_id, c, turn):
        qf, cf = q.astype(np.float64), c.astype(np.float64)
        qr, cr = qf @ turn, cf @ turn
        head = max(1, q.shape[1] // 2)
        q_tail, c_tail = (np.sqrt((v[:, head:] ** 2).sum(1)) for v in (qr, cr))
        q_len, c_len = np.sqrt((qf * qf).sum(1)), np.sqrt((cf * cf).sum(1))
        order = np.argsort(-c_len, kind="stable")
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in q_id]
        floor = bound.copy()
        for at in range(0, len(order), STEP):
            part = order[at : at + STEP]
            slack = 1e-9 * (q_len * c_len[part[0]]) + 1e-6
            alive = np.flatnonzero(q_len * c_len[part[0]] + slack >= floor)
            if not len(alive):
                break  # later vectors are shorter
            reach = qr[alive, :head] @ cr[part, :head].T + q_tail[alive][:, None] * c_tail[part][None, :]
            may = reach + slack[alive][:, None] >= floor[alive][:, None]
            some = may.any(1)
            if not some.any():
                continue
            rows = alive[some]
            exact = scores(q[rows], c[part])
            for n, r in enumerate(rows):
                pick = np.flatnonzero(may[some][n] & (c_id[part] != q_id[r]))
                s, ids = np.concatenate([best[r][0], exact[n, pick]]), np.concatenate([best[r][1], c_id[part[pick]]])
                keep = np.lexsort((ids, -s))[:top]
                best[r] = s[keep], ids[keep]
                if len(keep) == top:
                    floor[r] = max(floor[r], float(best[r][0][-1]))
        return best

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out_q, out_key, out_v, out_s = [], [], [], []
        lens = pdf["v"].map(len).to_numpy()
        for size in np.unique(lens):
            part = pdf[lens == size]
            queries, found = part[part["is_query"]], part[~part["is_query"]]
            if not len(queries) or not len(found):
                continue
            q, c = np.stack(queries["v"].to_list()).astype(np.int64), np.stack(found["v"].to_list()).astype(np.int64)
            bound = queries["floor"].fillna(-np.inf).to_numpy(np.float64)
            turn = rotations.get(int(size), np.eye(int(size)))
            ids, keys = queries["vec_id"].to_numpy(), queries["key"].to_numpy()
            for i, k, (s, v) in zip(ids, keys, one_size(ids, q, bound, found["vec_id"].to_numpy(), c, turn)):
                out_q += [i] * len(s)
                out_key += [k] * len(s)
                out_v.append(v)
                out_s.append(s)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pd.DataFrame({"query_id": np.array(out_q, np.int64), "key": np.array(out_key, np.int64), "vec_id": join(out_v), "score": join(out_s)})

    return run


def top_products(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", top: int = TOP, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the column ``vec_id`` (the row's id)."""
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, vec_id, embedding, zero=True).where("vector is not null")
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    rows = usable.select("vec_id", whole.alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = stored(rows.select("*", length.alias("len")), "whole-vectors")
    n = rows.count()
    n_bands = max(1, -(-n // BAND_ROWS))
    cuts = sorted(set(rows.approxQuantile("len", [i / n_bands for i in range(1, n_bands)], 1 / (4 * n_bands)))) if n_bands > 1 else []
    # band 0 holds the longest vectors; a band that ties make too large is split by hash
    rank = F.lit(len(cuts)) - F.aggregate(F.array(*[F.lit(float(c)) for c in cuts]), F.lit(0), lambda a, c: a + (F.col("len") > c).cast("int")) if cuts else F.lit(0)
    ranked = rows.select("*", rank.cast("int").alias("rank"))
    sizes = {r["rank"]: (r["n"], r["top"]) for r in ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.max("len").alias("top")).collect()}
    first, tops, parts = {}, [], {}
    for r in sorted(sizes):
        first[r], parts[r] = len(tops), max(1, -(-sizes[r][0] // BAND_ROWS))
        tops += [sizes[r][1]] * parts[r]
    if not tops:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    lookup = lambda d: F.element_at(F.array(*[F.lit(int(d.get(r, 1))) for r in range(len(cuts) + 1)]), F.col("rank") + 1)
    band = (lookup(first) + F.pmod(F.xxhash64("vec_id", "v"), lookup(parts))).cast("int")
    bands = ranked.select("vec_id", "v", band.alias("band"))
    queries = rows.where(is_query).select("vec_id", "v", "len").dropDuplicates(["vec_id", "v"]).select("*", F.xxhash64("v").alias("key"))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    queries = queries.select("*", F.pmod(F.xxhash64("vec_id", "key"), F.lit(blocks)).cast("int").alias("block"))
    run = _searcher(_rotations(rows), top)
    schema = "query_id long, key long, vec_id long, score long"
    mine = ["block", "band", "is_query", "vec_id", "key", "v", "floor"]

    def search(asked: DataFrame, numbers: Column) -> DataFrame:
        # a band goes to the blocks that ask for it, at most blocks * bands pairs
        given = bands.where(numbers).join(asked.select("block", "band").distinct(), "band")
        given = given.select("block", "band", F.lit(False).alias("is_query"), "vec_id", F.lit(0).cast("long").alias("key"), "v", F.lit(None).cast("double").alias("floor"))
        return asked.select(*mine).unionByName(given.select(*mine)).groupBy("block", "band").applyInPandas(run, schema)

    ask = queries.select("*", F.lit(0).alias("band"), F.lit(True).alias("is_query"), F.lit(None).cast("double").alias("floor"))
    found = stored(search(ask, F.col("band") == 0), "first-band")
    if len(tops) > 1:
        kth = found.groupBy("query_id", "key").agg(F.min("score").cast("double").alias("s"), F.count(F.lit(1)).alias("n"))
        kth = kth.select(F.col("query_id").alias("vec_id"), "key", F.when(F.col("n") >= top, F.col("s")).alias("floor"))
        reach = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(float(t)).alias("top")) for b, t in enumerate(tops) if b])
        ask = queries.join(kth, ["vec_id", "key"], "left").select("*", F.inline(reach))
        ask = ask.where(F.col("floor").isNull() | (F.col("len") * F.col("top") * (1 + 1e-9) + 1e-6 >= F.col("floor"))).select("*", F.lit(True).alias("is_query"))
        found = found.unionByName(search(ask, F.col("band") > 0))
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= top)
