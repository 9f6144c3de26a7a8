"""Product codes of vectors: whole-number codebooks per part, assigned with adaptive distance bounds.

Components become whole numbers floor(scale * x); a vector is cut into equal consecutive parts, and each part position
has a codebook of at most 256 entries. An entry starts as that part of one of the smallest ids; a round assigns every
part to its nearest entry (squared distance, ties to the lower index) and moves entries to the floor of their parts' mean.

The assignment keeps bounds after Drake and Hamerly. Next to each part stand, as Parquet between rounds, an upper bound
of the distance to its own entry, its ``b`` closest other entries with lower bounds in rising order, and one outer lower
bound for all the others. When entries have moved, bounds are shifted by the movements. A part whose upper bound stays
below all lower bounds keeps its entry. Otherwise its own distance is taken exactly, in whole numbers; then those listed
entries whose bound does not exceed it are; and only if the outer bound is reached are all entries. Bounds are rounded
outwards, and nothing is decided on an equal or overlapping bound, so results are those of the plain method. After each
round ``b`` follows what the parts needed: all but 1 % of them within the list, a doubled list if over 5 % were not.

Sums of entries are kept by difference: after the first round only parts that changed their entry are added up again.
The driver holds codebooks and their sums (entries times components, whatever the number of rows).

Defined results: vectors that are NULL or hold NULL or non-finite components are dropped. Vectors of different lengths
are coded apart, with codebooks of their own; a length that does not divide is cut with the longer parts first, and an
empty vector has empty parts at distance 0. Rows without id are coded but start no entry; without any id, code and error
are NULL. Repeated ids are rows like others (starting entries in order of id, then components). Fewer rows than entries
make fewer entries. An empty table gives no rows. Other columns are ignored. Components beyond +-2^17 are refused:
their squared distances need not fit 64 bits.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.shared import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Listed entries per part in the first round, and their least and greatest number.
LISTED, LEAST, MOST = 16, 4, 64
#: Greatest absolute component, after scaling.
LIMIT = 1 << 27
#: Rows of full distance tables worked on together.
ROWS = 4096
#: A label with more than this share of the rows is joined by broadcast; there are fewer than 1 / share of them.
HOT_SHARE = 1e-3

_STATE = "code array<short>, before array<short>, upper array<float>, outer array<float>, near array<short>, lower array<float>, need array<short>"


def part_edges(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return np.cumsum([0, *(len(x) for x in np.array_split(np.arange(length), parts))]).tolist()


@dataclass
class Codebooks:
    """For vectors of one length: per part an (entries, components) array of whole numbers."""

    parts: list[np.ndarray]

    def digest(self) -> str:
        text = ",".join(str(x) for part in self.parts for entry in part.tolist() for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _all_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact: products of whole numbers as doubles while they fit."""
    span = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if 8 * max(1, x.shape[1]) * span * span < 1 << 53:
        x, c = x.astype(np.float64), c.astype(np.float64)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


class _Part:
    """State of one part position over some rows: arrays in step with them."""

    def __init__(self, code, upper, outer, near, lower) -> None:
        self.code, self.upper, self.outer, self.near, self.lower = code, upper, outer, near, lower
        self.need = np.zeros(len(code), np.int16)

    @classmethod
    def fresh(cls, x: np.ndarray, c: np.ndarray, b: int) -> _Part:
        n, k = len(x), len(c)
        out = cls(np.zeros(n, np.int16), np.zeros(n, np.float32), np.full(n, np.inf, np.float32), np.full((n, b), -1, np.int16), np.full((n, b), np.inf, np.float32))
        for at in range(0, n, ROWS):
            d = _all_distances(x[at : at + ROWS], c)
            rows = slice(at, at + len(d))
            keep = min(k, b + 2)
            found = np.argpartition(d, keep - 1, axis=1)[:, :keep] if keep < k else np.broadcast_to(np.arange(k), d.shape)
            found = np.sort(found, axis=1)
            far = np.take_along_axis(d, found, 1)
            order = np.argsort(far, axis=1, kind="stable")  # ties: the lower index first
            found, far = np.take_along_axis(found, order, 1), np.take_along_axis(far, order, 1)
            # the nearest one by distance, then index; a tie at the edge of the partition could hide a lower index
            own = d.argmin(1)
            hidden = found[:, 0] != own
            if hidden.any():
                found, far = found.copy(), far.copy()
                found[hidden, 0] = own[hidden]
            root = np.sqrt(far.astype(np.float64))
            out.code[rows], out.upper[rows] = own, _up(root[:, 0])
            listed = min(b, keep - 1)
            out.near[rows, :listed], out.lower[rows, :listed] = found[:, 1 : 1 + listed], _down(root[:, 1 : 1 + listed])
            if keep == b + 2:
                out.outer[rows] = _down(root[:, b + 1])
            if hidden.any():  # bounds without knowledge for these rows: they are looked at again
                out.near[rows][hidden] = -1
                out.lower[rows][hidden] = np.inf
                out.outer[rows][hidden] = 0
        return out

    def fitted(self, b: int) -> _Part:
        """Lists of ``b`` entries: dropped ones go under the outer bound, missing ones are empty."""
        have = self.near.shape[1]
        if have > b:
            self.outer = np.minimum(self.outer, self.lower[:, b:].min(1))
            self.near, self.lower = self.near[:, :b], self.lower[:, :b]
        elif have < b:
            n = len(self.code)
            self.near = np.concatenate([self.near, np.full((n, b - have), -1, np.int16)], axis=1)
            self.lower = np.concatenate([self.lower, np.full((n, b - have), np.inf, np.float32)], axis=1)
        return self

    def assign(self, x: np.ndarray, c: np.ndarray, moved: np.ndarray) -> None:
        """The nearest entries after the entries moved by ``moved``."""
        b = self.near.shape[1]
        self.upper = _up(self.upper.astype(np.float64) + moved[self.code])
        shift = np.where(self.near >= 0, moved[np.maximum(self.near, 0)], 0.0)
        self.lower = _down(self.lower.astype(np.float64) - shift)
        self.outer = _down(self.outer.astype(np.float64) - moved.max(initial=0))
        order = np.argsort(self.lower, axis=1, kind="stable")
        self.near, self.lower = np.take_along_axis(self.near, order, 1), np.take_along_axis(self.lower, order, 1)
        nearest = np.minimum(self.lower[:, 0] if b else np.inf, self.outer)
        rows = np.flatnonzero(~(self.upper < nearest))
        own = ((x[rows] - c[self.code[rows]]) ** 2).sum(1)
        self.upper[rows] = _up(np.sqrt(own.astype(np.float64)))
        left = ~(self.upper[rows] < nearest[rows])
        rows, own = rows[left], own[left]
        far = ~(self.upper[rows] < self.outer[rows])
        full = rows[far]
        if len(full):
            new = _Part.fresh(x[full], c, b)
            for name in ("code", "upper", "outer", "near", "lower"):
                getattr(self, name)[full] = getattr(new, name)
            self.need[full] = b + 1
        rows, own = rows[~far], own[~far]
        if not len(rows):
            return
        r, z = np.nonzero(self.lower[rows] <= self.upper[rows][:, None])
        entry = self.near[rows[r], z]
        d = ((x[rows[r]] - c[entry]) ** 2).sum(1)
        self.lower[rows[r], z] = _down(np.sqrt(d.astype(np.float64)))
        self.need[rows] = np.bincount(r, minlength=len(rows))
        # the best of the listed ones per row: least distance, then least index
        order = np.lexsort((entry, d, r))
        first = order[np.flatnonzero(np.append(True, np.diff(r[order]) > 0))] if len(order) else order
        at = r[first]
        old = self.code[rows[at]]
        better = (d[first] < own[at]) | ((d[first] == own[at]) & (entry[first] < old))
        first, at, old = first[better], at[better], old[better]
        to = rows[at]
        self.code[to], self.upper[to] = entry[first], _up(np.sqrt(d[first].astype(np.float64)))
        self.near[to, z[first]], self.lower[to, z[first]] = old, _down(np.sqrt(own[at].astype(np.float64)))
        order = np.argsort(self.lower[rows], axis=1, kind="stable")
        self.near[rows], self.lower[rows] = np.take_along_axis(self.near[rows], order, 1), np.take_along_axis(self.lower[rows], order, 1)


def _matrix(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    return column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(x).ravel(), kind))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    size = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(size).tolist():
        yield length, np.flatnonzero(size == length)


def _assigner(books: dict[int, Codebooks], moved: dict[int, list[np.ndarray]] | None, b: int, parts: int):
    """Rows with vectors (and their state, after the first round) to rows with the new state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows in _by_length(batch):
                edge = part_edges(length, parts)
                x = _matrix(batch.column("v"), rows, length).astype(np.int64)
                n, done = len(rows), []
                old = np.full((n, parts), -1, np.int16)
                if moved is not None:
                    old, near = _matrix(batch.column("code"), rows, parts), batch.column("near").take(pa.array(rows)).flatten()
                    listed = len(near) // (n * parts)
                    near = near.to_numpy(zero_copy_only=False).reshape(n, parts, listed)
                    lower = _matrix(batch.column("lower"), rows, parts * listed).reshape(n, parts, listed)
                    upper, outer = _matrix(batch.column("upper"), rows, parts), _matrix(batch.column("outer"), rows, parts)
                for p in range(parts):
                    part, c = x[:, edge[p] : edge[p + 1]], books[length].parts[p]
                    if moved is None:
                        done.append(_Part.fresh(part, c, b))
                    else:
                        state = _Part(*(np.array(a[:, p]) for a in (old, upper, outer, near, lower))).fitted(b)
                        state.assign(part, c, moved[length][p])
                        done.append(state)
                beside = lambda name: np.stack([getattr(s, name) for s in done], axis=1).reshape(n, -1)
                told = [_lists(beside("code"), pa.int16()), _lists(old, pa.int16()), _lists(beside("upper"), pa.float32()), _lists(beside("outer"), pa.float32()),
                        _lists(beside("near"), pa.int16()), _lists(beside("lower"), pa.float32()), _lists(beside("need"), pa.int16())]
                kept = batch.select(["vec_id", "label", "v"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, *told], ["vec_id", "label", "v", "code", "before", "upper", "outer", "near", "lower", "need"])

    return run


def _changes(parts: int, sizes: dict[int, int]):
    """Per task: for each entry, how many parts came or went and the sum of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for length, rows in _by_length(batch):
                edge, k = part_edges(length, parts), sizes[length]
                if length not in sums:
                    sums[length] = [np.zeros((k, edge[p + 1] - edge[p] + 1), np.int64) for p in range(parts)]
                x = _matrix(batch.column("v"), rows, length).astype(np.int64)
                new, old = _matrix(batch.column("code"), rows, parts), _matrix(batch.column("before"), rows, parts)
                for p in range(parts):
                    change = np.flatnonzero(new[:, p] != old[:, p])
                    part = np.concatenate([np.ones((len(change), 1), np.int64), x[change, edge[p] : edge[p + 1]]], axis=1)
                    np.add.at(sums[length][p], new[change, p], part)
                    gone = old[change, p] >= 0
                    np.subtract.at(sums[length][p], old[change, p][gone], part[gone])
        rows = [(length, p, int(e), s[e].tolist()) for length, of in sums.items() for p, s in enumerate(of) for e in np.flatnonzero(s.any(1))]
        cols = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["length", "part", "entry", "s"])

    return run


def _final(books: dict[int, Codebooks], parts: int):
    """Codes as hex and exact errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows in _by_length(batch):
                edge = part_edges(length, parts)
                x, code = _matrix(batch.column("v"), rows, length).astype(np.int64), _matrix(batch.column("code"), rows, parts)
                error = sum(((x[:, edge[p] : edge[p + 1]] - books[length].parts[p][code[:, p]]) ** 2).sum(1) for p in range(parts))
                hexed = ["".join(f"{e:02x}" for e in row) for row in code.tolist()]
                kept = batch.select(["vec_id", "label"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([length] * len(rows), pa.int32()), pa.array(hexed), pa.array(error, pa.int64())], ["vec_id", "label", "length", "code", "error"])

    return run


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """``vec_id, label, v``: the kept rows with whole-number components."""
    usable = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[label].alias("label"), vectors[embedding].cast("array<double>").alias("e"))
    return rows.where(F.col("e").isNotNull() & usable).select("vec_id", "label", F.transform("e", lambda x: F.floor(x * scale)).alias("v"))


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, log: list[dict] | None = None) -> tuple[DataFrame, dict[int, Codebooks]]:
    """``vec_id, label, length, code, error`` of the kept rows, and the codebooks by length of vector.

    ``log`` receives, per round, the length of the lists and how many parts needed 0, 1, .. entries (over it: all).
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, vec_id, embedding, label, scale)
    kind = rows.schema["label"].dataType.simpleString()
    facts = rows.groupBy(F.size("v").alias("length")).agg(
        F.count("vec_id").alias("ids"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("span")).collect()  # one row a length
    if any((f["span"] or 0) > LIMIT or f["length"] * 4 * (f["span"] or 0) ** 2 >= 1 << 62 for f in facts):
        raise ValueError(f"components beyond +-{LIMIT / scale:g}: squared distances may pass 64 bits")
    rows = rows.select("vec_id", "label", F.col("v").cast("array<int>").alias("v"))
    coded = [f["length"] for f in facts if f["ids"]]
    books: dict[int, Codebooks] = {}
    for length in coded:
        first = rows.where((F.size("v") == length) & F.col("vec_id").isNotNull()).orderBy("vec_id", "v").limit(entries).select("v").collect()
        x, edge = np.array([r["v"] for r in first], np.int64).reshape(len(first), length), part_edges(length, parts)
        books[length] = Codebooks([x[:, edge[p] : edge[p + 1]] for p in range(parts)])
    sizes = {length: len(books[length].parts[0]) for length in coded}
    out_schema = f"vec_id long, label {kind}, length int, code string, error long"
    without = [f["length"] for f in facts if not f["ids"]]
    rest = rows.where(F.size("v").isin(without)).select("vec_id", "label", F.size("v").alias("length"), F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not coded:
        return rest, books
    most = max(sizes.values()) - 1
    b, moved = min(LISTED, most), None
    totals = {(n, p): [[0] * (1 + books[n].parts[p].shape[1]) for _ in range(sizes[n])] for n in coded for p in range(parts)}
    state = rows.where(F.size("v").isin(coded))
    for turn in range(rounds + 1):
        state = state.mapInArrow(_assigner(dict(books), moved, b, parts), f"vec_id long, label {kind}, v array<int>, {_STATE}")
        state = stored(state, "bounds")
        if log is not None or turn:
            counted = state.select(F.explode("need").alias("need")).groupBy("need").count().collect()  # at most b + 2 rows
            need = {r["need"]: r["count"] for r in counted}
            if log is not None:
                log.append({"listed": b, "need": need})
            if turn:
                b = min(most, next_listed(need, b))
        if turn == rounds:
            break
        changed = state.where("before[0] < 0 or code <> before")
        sums = changed.select("v", "code", "before").mapInArrow(_changes(parts, sizes), "length int, part int, entry int, s array<long>")
        sums = sums.select("length", "part", "entry", F.posexplode("s")).groupBy("length", "part", "entry", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
        for r in sums.collect():  # at most lengths * parts * entries * components
            totals[r["length"], r["part"]][r["entry"]][r["pos"]] += int(r["s"])
        moved = {}
        for length in coded:
            old = books[length].parts
            new = [np.array([[s // t[0] for s in t[1:]] if t[0] else o for t, o in zip(totals[length, p], old[p].tolist())], np.int64).reshape(old[p].shape) for p in range(parts)]
            moved[length] = [np.nextafter(np.sqrt(((a - c) ** 2).sum(1).astype(np.float64)), np.inf) * (a != c).any(1) for a, c in zip(new, old)]
            books[length] = Codebooks(new)
    coded_rows = stored(state.select("vec_id", "label", "v", "code").mapInArrow(_final(dict(books), parts), out_schema), "codes")
    return coded_rows.unionByName(rest) if without else coded_rows, books


def next_listed(need: dict[int, int], b: int) -> int:
    """The list length for the next round, from how many entries the parts needed."""
    total = sum(need.values())
    if need.get(b + 1, 0) > 0.05 * total:
        return min(MOST, 2 * b)
    seen = 0
    for n in sorted(need):
        seen += need[n]
        if seen >= 0.99 * total:
            return max(LEAST, min(n, b))
    return b


def restore(codes: DataFrame, books: dict[int, Codebooks], code: str = "code", length: str = "length", into: str = "vector", scale: int = SCALE) -> DataFrame:
    """All columns of ``codes`` and the vector that each code stands for (the middle of the scaled cell)."""
    def table(n: int) -> Column:
        parts = []
        for p, entries in enumerate(books[n].parts):
            place = F.conv(F.substring(codes[code], 2 * p + 1, 2), 16, 10).cast("int")
            values = F.from_json(F.lit(json.dumps(((entries + 0.5) / scale).tolist())), "array<array<double>>")  # folded into one constant
            parts.append(F.element_at(values, place + 1))
        return F.concat(*parts)

    vector = F.lit(None).cast("array<double>")
    for n in books:
        vector = F.when(codes[length] == n, table(n)).otherwise(vector)
    return codes.select("*", vector.alias(into))


def with_label_totals(rows: DataFrame, label: str, value: str, into: str, hot_share: float = HOT_SHARE) -> DataFrame:
    """Add the sum of ``value`` over rows of the same label, NULLs together. Labels of many rows go by broadcast (fewer
    than 1 / hot_share rows), so that no task gathers their rows; the others meet by a shuffle."""
    totals = rows.groupBy(label).agg(F.sum(value).alias(into), F.count(F.lit(1)).alias("_n"))
    totals = stored(totals.withColumnRenamed(label, "_label"), "label-totals")
    bar = (totals.agg(F.sum("_n").alias("n")).first()["n"] or 0) * hot_share
    hot, cold = totals.where(F.col("_n") > bar), totals.where(F.col("_n") <= bar)
    same = rows[label].eqNullSafe(F.col("_label"))
    often = rows.join(F.broadcast(hot), same)
    seldom = rows.join(F.broadcast(hot), same, "left_anti")
    seldom = seldom.join(cold, seldom[label].eqNullSafe(F.col("_label")))
    return often.unionByName(seldom).drop("_label", "_n")


def code_report(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the kept rows."""
    codes, books = compress(vectors, vec_id, embedding, label)
    digest = F.lit(None).cast("string")
    for length, book in books.items():
        digest = F.when(F.col("length") == length, book.digest()).otherwise(digest)
    out = with_label_totals(codes, "label", "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
