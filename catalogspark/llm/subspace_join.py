"""All vector pairs with cosine at or above a threshold, by a subspace pigeonhole join.

For unit vectors, cosine >= t means squared distance <= 2 - 2t. The vectors are rotated (principal axes of a bounded
sample; any rotation is right), the axes are dealt into blocks, and the squared-distance budget is split over the blocks
in proportion to their spread. A pair within the whole budget is within budget in at least one block. Each block is a
range join: vectors go to the grid cell of their leading block coordinates and visit later cells within the block's
radius, and the pairs of a cell are compared in the block, then exactly: cosine in double precision over all
components. A pair that several blocks find counts in the first of them only, so counts and links need no list of pairs:
a task returns one row per vector with its links, and a spanning forest.

Equal vectors form a class with one representative and its number of rows. Cells over ``TILE_ROWS`` rows are split into
pairs of tiles. Cells share a task by hash, so that small cells don't cost a task each.

Defined results: vectors that are NULL, zero or hold NULL or non-finite components, and rows without id, have no links
and are kept; vectors of different lengths are not linked; repeated rows link with each other; an empty table gives
no rows; labels and other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.components import components, local_forest
from catalogspark.llm.shared import stored

THRESHOLD = 0.95
#: Rows the rotation and the spreads are fitted on (smallest id hashes).
SAMPLE_ROWS = 4096
#: Axes per block, and leading axes of a block that make its grid.
BLOCK_AXES = 16
GRID_AXES = 2
#: Rows of a cell that one task compares; larger cells are split.
TILE_ROWS = 50_000
#: Rows that cells share a task up to, on average.
TASK_ROWS = 20_000
#: Pairs of a tile compared at once.
STEP = 1024


def vector_rows(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Which rows hold a usable vector, and the vectors as float64."""
    out: list[np.ndarray | None] = []
    for value in column:
        got = value.as_py()
        if got is None or not got or any(x is None for x in got):
            out.append(None)
            continue
        v = np.array(got, np.float64)
        out.append(v if np.isfinite(v).all() else None)
    return np.array([v is not None for v in out], bool), out


def usable_vectors(vectors: DataFrame, vec_id: str, embedding: str, zero: bool) -> DataFrame:
    """``vec_id, code_a, code_b, vector`` with a NULL vector for rows that take no part (``zero``: zero vectors do)."""
    frame = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].cast("array<double>").alias("vector"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (ok, rows) = batch.column(0), vector_rows(batch.column(1))
            a, b, kept = [], [], []
            for i, v in enumerate(rows):
                if v is None or not ids[i].is_valid or not (zero or v.any()):
                    a.append(None), b.append(None), kept.append(None)
                    continue
                v = v + 0.0  # -0.0 and 0.0 are one value
                code = hashlib.blake2b(v.tobytes(), digest_size=16).digest()
                a.append(int.from_bytes(code[:8], "little", signed=True)), b.append(int.from_bytes(code[8:], "little", signed=True)), kept.append(v)
            yield pa.RecordBatch.from_arrays([ids, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(kept, pa.list_(pa.float64()))], ["vec_id", "code_a", "code_b", "vector"])

    return frame.mapInArrow(check, "vec_id long, code_a long, code_b long, vector array<double>")


class Blocks:
    """Rotation, blocks of axes and their squared-distance budgets for vectors of one length."""

    def __init__(self, sample: np.ndarray, size: int, budget: float) -> None:
        if len(sample) > 1:
            spread, axes = np.linalg.eigh(np.cov(sample.T).reshape(size, size))
            self.axes, spread = axes[:, ::-1], np.maximum(spread[::-1], 1e-12)
        else:
            self.axes, spread = np.eye(size), np.ones(size)
        n = -(-size // BLOCK_AXES)
        self.of = [np.arange(b, size, n) for b in range(n)]  # dealt in turn: blocks have about equal spread
        weight = np.array([spread[b].sum() for b in self.of])
        self.budget = budget * (1 + 1e-9) * weight / weight.sum() + 1e-12

    def place(self, y: np.ndarray, b: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home cells of rows in block ``b``, and all cells they must be compared in (home first, then later ones)."""
        radius = np.sqrt(self.budget[b]) * (1 + 1e-6) + 1e-9
        side = 2 * radius
        x = y[:, self.of[b][:GRID_AXES]]
        home, low, high = (np.floor(v / side).astype(np.int64) for v in (x, x - radius, x + radius))
        shape = [low[:, 0], high[:, 0], low[:, -1], high[:, -1]] if x.shape[1] > 1 else [low[:, 0], high[:, 0], home[:, 0] * 0, home[:, 0] * 0]
        cell = lambda p, q: (p + (1 << 20)) << 22 | (q + (1 << 20))
        own = cell(home[:, 0], home[:, 1] if x.shape[1] > 1 else home[:, 0] * 0)
        visits = []
        for p in (shape[0], shape[1]):
            for q in (shape[2], shape[3]):
                visits.append(cell(p, q))
        return own, visits


def _fit(classes: DataFrame, budget: float) -> dict[int, Blocks]:
    """Blocks per vector length from the sample; lengths that it lacks are not rotated."""
    rows = [np.array(r["vector"]) for r in classes.select("vector", F.xxhash64("rep").alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()]
    out = {}
    for size in {len(v) for v in rows}:
        x = np.stack([v for v in rows if len(v) == size])
        with np.errstate(over="ignore"):
            x = x / np.abs(x).max(1, keepdims=True)
        out[size] = Blocks(x / np.linalg.norm(x, axis=1, keepdims=True), size, budget)
    return out


def _unit(vectors: list[np.ndarray]) -> np.ndarray:
    x = np.stack(vectors).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _cells(classes: DataFrame, fitted: dict[int, Blocks], budget: float) -> DataFrame:
    """One row per vector, block and cell: ``cell`` (a hash of length, block and place), ``home``, and the vector."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(fitted)
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                rows = batch.column(2).to_pylist()
                sizes = np.array([len(v) for v in rows])
                for size in np.unique(sizes):
                    size, pick = int(size), np.flatnonzero(sizes == size)
                    blocks = known.setdefault(size, Blocks(np.zeros((0, size)), size, budget))
                    y = _unit([rows[i] for i in pick]) @ blocks.axes
                    for b in range(len(blocks.of)):
                        own, visits = blocks.place(y, b)
                        index, cell, home = [pick], [own], [np.ones(len(pick), bool)]
                        seen = [own]
                        for v in visits:
                            new = (v > own) & np.all([v != s for s in seen], axis=0)
                            seen.append(np.where(new, v, own))
                            index.append(pick[new]), cell.append(v[new]), home.append(np.zeros(int(new.sum()), bool))
                        index = np.concatenate(index)
                        part = batch.take(pa.array(index))
                        n = len(index)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, size, np.int32)), pa.array(np.full(n, b, np.int32)), pa.array(np.concatenate(cell)), pa.array(np.concatenate(home)), part.column(0), part.column(1), part.column(2)],
                            ["size", "block", "cell", "home", "rep", "rows", "vector"],
                        )

    return classes.select("rep", "rows", "vector").mapInArrow(spread, "size int, block int, cell long, home boolean, rep long, rows long, vector array<double>")


def _compare(fitted: dict[int, Blocks], budget: float, threshold: float):
    """The task: all cells of a bucket, each with its home and visiting rows."""

    def pairs_of(x: np.ndarray, y: np.ndarray, blocks: Blocks, b: int, left: np.ndarray, right: np.ndarray, within: bool):
        own = blocks.of[b]
        z = y[:, own].astype(np.float32)
        square = (z * z).sum(1)
        limit = np.float32(blocks.budget[b] * (1 + 1e-4) + 1e-6)
        for i0 in range(0, len(left), STEP):
            a = left[i0 : i0 + STEP]
            for j0 in range(i0 if within else 0, len(right), STEP):
                c = right[j0 : j0 + STEP]
                near = (square[a][:, None] + square[c][None, :] - 2 * (z[a] @ z[c].T)) <= limit
                if within and i0 == j0:
                    near = np.triu(near, 1)
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                for k in range(0, len(i), 65536):
                    p, q = a[i[k : k + 65536]], c[j[k : k + 65536]]
                    gap = (y[p] - y[q]) ** 2
                    ok = gap[:, own].sum(1) <= blocks.budget[b]
                    for earlier in range(b):
                        ok &= gap[:, blocks.of[earlier]].sum(1) > blocks.budget[earlier]
                    p, q = p[ok], q[ok]
                    ok = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                    yield p[ok], q[ok]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known = dict(fitted)
        found_a, found_b = [], []
        rows_of: dict[int, int] = {}
        for (size, b, _, t1, t2), cell in pdf.groupby(["size", "block", "cell", "t1", "t2"], sort=False):
            if len(cell) < 2:
                continue
            blocks = known.setdefault(size, Blocks(np.zeros((0, size)), size, budget))
            rep, home, tile = cell["rep"].to_numpy(), cell["home"].to_numpy(), cell["tile"].to_numpy()
            x = _unit(cell["vector"].to_list())
            y = x @ blocks.axes
            one, two = np.flatnonzero(home & (tile == t1)), np.flatnonzero(home & (tile == t2))
            guests1, guests2 = np.flatnonzero(~home & (tile == t1)), np.flatnonzero(~home & (tile == t2))
            jobs = [(one, one, True), (one, guests1, False)] if t1 == t2 else [(one, two, False), (one, guests2, False), (two, guests1, False)]
            for left, right, within in jobs:
                for p, q in pairs_of(x, y, blocks, int(b), left, right, within):
                    found_a.append(rep[p]), found_b.append(rep[q])
                    # repeated classes cannot occur: one row per class
            rows_of.update(zip(rep.tolist(), cell["rows"].tolist()))
        if not found_a:
            return pd.DataFrame({"node": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64"), "root": pd.Series([], dtype="int64")})
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        node, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        weight = np.array([rows_of[v] for v in node.tolist()], np.int64)
        links = np.zeros(len(node), np.int64)
        half = len(a)
        np.add.at(links, inverse[:half], weight[inverse[half:]])
        np.add.at(links, inverse[half:], weight[inverse[:half]])
        root = node.copy()
        child, parent = local_forest(a, b)
        root[np.searchsorted(node, child)] = parent
        return pd.DataFrame({"node": node, "links": links, "root": root})

    return run


def link_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    budget = max(0.0, 2 - 2 * threshold)
    facts = stored(usable_vectors(vectors, vec_id, embedding, zero=False), "vectors")
    code = ["code_a", "code_b"]
    classes = stored(
        facts.where("vector is not null").groupBy(*code).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("rows"), F.first("vector").alias("vector")), "classes"
    )
    fitted = _fit(classes, budget)
    cells = _cells(classes, fitted, budget)
    place = ["size", "block", "cell"]
    # classes with one id (an id on several rows) stay apart by their code, which the representative carries
    sizes = stored(cells.groupBy(*place).agg(F.count(F.lit(1)).alias("n")), "cells")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tile = F.lit(0)
    if total[1] > TILE_ROWS:
        cells = cells.join(sizes, place)
        tiles = F.ceil(F.col("n") / TILE_ROWS).cast("int")
        tile = F.pmod(F.xxhash64("rep", "cell"), tiles).cast("int")
        cells = cells.select("*", tile.alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
        cells = cells.select("*", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"))
    else:
        cells = cells.select("*", tile.alias("tile"), tile.alias("t1"), tile.alias("t2"))
    buckets = max(1, int(total[0]) // TASK_ROWS)
    keyed = cells.select("*", F.pmod(F.xxhash64(*place, "t1", "t2"), F.lit(buckets)).alias("bucket"))
    found = stored(keyed.groupBy("bucket").applyInPandas(_compare(fitted, budget, threshold), "node long, links long, root long"), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(found.where("node <> root"), "node", "root")
    joined = (
        facts.select("vec_id", *code)
        .join(classes.select(*code, "rep", "rows"), code, "left")
        .join(links.withColumnRenamed("node", "rep"), "rep", "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    )
    n = F.when(F.col("rep").isNull(), 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("rows") - 1)
    out = joined.select("vec_id", n.cast("long").alias("n_links"), F.coalesce("component", "rep", "vec_id").alias("component_id"))
    return out.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
