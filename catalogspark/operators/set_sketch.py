"""Multiset differences through an invertible sketch: only rows that differ are shuffled.

Every row has a 64-bit code. A sketch is three tables of cells; a row adds its sign (one side +1, the other -1), its code
and a second, non-linear function of it to one cell of each. Equal rows cancel, so what is left tells the differences. It
is built by one aggregate with as many groups as cells (map-side combined, a fixed number of rows is shuffled) and undone
on the driver, cell by cell. A sketch that holds too much still tells how many codes differ; unless they are a large part
of the rows, a second one of that size is built in parts (a code lies in one part) and each part is undone by a task.
The rows behind the codes found are then compared exactly; their digests must add up to what the whole sides differ by,
else (or when too many rows differ for a sketch) the plain join decides.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import LIMBS, row_digest
from catalogspark.operators.diff import structural_diff
from catalogspark.scale import pinned

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Cells per table (a power of two); about four fifths of three times as many differing rows can be told apart.
CELLS = 1 << 13
#: A sketch is built anew, larger, if at most one row of so many differs; else the plain join is no dearer.
FEW = 16
#: Filled share of the cells of a part: well below four fifths, so that parts with more codes than others are undone too.
FILLED = 0.6
#: Codes that are broadcast to the rows (8 bytes each); more are joined as Spark sees fit.
BROADCAST = 1 << 20
#: Numbers are added up in pieces of so many bits, so that sums of a million million rows fit into 64.
PIECE = 21
_SUMS = ["x", "y", *[f"l{i}" for i in range(4)]]


@dataclass
class Difference:
    """``rows``: columns, added, removed (copies on one side only). ``by_sketch``: whether a sketch sufficed."""

    rows: DataFrame
    by_sketch: bool


def _code_of(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")


def _code(df: DataFrame, columns: Sequence[str]) -> Column:
    """A 64-bit code of a row from its canonical digest."""
    return _code_of(row_digest(df, list(columns)))


def _second(code: int) -> int:
    """A function of the code that sums of other codes do not meet."""
    u = code & ((1 << 64) - 1)
    return (u & 0x7FFFFFFF) * (u >> 33)


def _places(code: int, cells: int) -> list[int]:
    u = code & ((1 << 64) - 1)
    return [i * cells + ((u >> 21 * i) & (cells - 1)) for i in range(3)]


def _told(left: DataFrame, right: DataFrame, columns: Sequence[str], cells: int, parts: int = 1) -> DataFrame:
    """Cells that are not empty: part, cell, n, and the sums of codes, second function and (first table) limbs in pieces."""
    side = lambda df, sign: df.select(row_digest(df, list(columns)).alias("h"), F.lit(sign).cast("long").alias("s"))
    rows = side(left, 1).unionByName(side(right, -1))
    limbs = [F.conv(F.substring("h", at, 15), 16, 10).cast("long").alias(f"l{i}") for i, at in enumerate(LIMBS)]
    rows = rows.select("s", _code_of(F.col("h")).alias("x"), *limbs)
    place = [(F.lit(i * cells) + F.shiftrightunsigned("x", 21 * i).bitwiseAND(F.lit(cells - 1))).cast("int") for i in range(3)]
    second = F.col("x").bitwiseAND(F.lit(0x7FFFFFFF).cast("long")) * F.shiftrightunsigned("x", 33)
    part = F.pmod(F.xxhash64("x"), F.lit(parts)).cast("int")
    cell = rows.select("x", "s", second.alias("y"), *[f"l{i}" for i in range(4)], part.alias("part"), F.posexplode(F.array(*place)).alias("table", "cell"))
    low = F.lit((1 << PIECE) - 1).cast("long")

    def piece(name: str, i: int) -> Column:
        bits = F.shiftright(name, PIECE * i)  # the highest piece keeps the sign
        value = (bits if i == 2 else bits.bitwiseAND(low)) * F.col("s")
        return F.sum(F.when(F.col("table") == 0, value).otherwise(0) if name.startswith("l") else value).alias(f"{name}_{i}")

    sums = [piece(name, i) for name in _SUMS for i in range(3)]
    told = cell.groupBy("part", "cell").agg(F.sum("s").alias("n"), *sums)
    return told.where(" or ".join(f"{c} <> 0" for c in told.columns[2:]))


def _whole(row, name: str) -> int:
    return sum(int(row[f"{name}_{i}"]) << PIECE * i for i in range(3))


def _limbs(sums: DataFrame) -> list[int]:
    """Limbs of the digests over all cells."""
    names = [f"l{i}_{j}" for i in range(4) for j in range(3)]
    got = sums.agg(*[F.coalesce(F.sum(F.col(n).cast("decimal(38,0)")), F.lit(0)).alias(n) for n in names]).first()
    return [_whole(got, f"l{i}") for i in range(4)]


def _sketch(left: DataFrame, right: DataFrame, columns: Sequence[str], cells: int) -> dict[int, list[int]]:
    """Cells that are not empty: number, codes, second function, and (in the first table) limbs of the digests."""
    rows = _told(left, right, columns, cells).collect()  # at most 3 * cells
    return {r["cell"]: [r["n"], *[_whole(r, name) for name in _SUMS]] for r in rows}


def _size(sketch: dict[int, list[int]], cells: int) -> int:
    """About how many codes a sketch holds (a code with c copies too many counts c * c times).

    Codes are spread evenly around 0, so the square of a sum of codes is on average the sum of their squares.
    """
    return round(3 * sum(v[1] ** 2 for c, v in sketch.items() if c < cells) / (1 << 126))


def _undone(sketch: dict[int, list[int]], cells: int) -> dict[int, int] | None:
    """Codes and how many copies one side has more; None if the sketch holds too much."""
    left = {c: v[:3] for c, v in sketch.items() if any(v[:3])}
    found: dict[int, int] = {}
    queue = list(left)
    while queue:
        c = queue.pop()
        n, x, y = left.get(c, (0, 0, 0))
        if not n or x % n or y % n:
            continue
        code = x // n
        if not -(1 << 63) <= code < 1 << 63 or _second(code) * n != y or c not in _places(code, cells):
            continue
        found[code] = found.get(code, 0) + n
        for p in _places(code, cells):
            have = left.setdefault(p, [0, 0, 0])
            have[0], have[1], have[2] = have[0] - n, have[1] - code * n, have[2] - y
            if not any(have):
                del left[p]
            else:
                queue.append(p)
    return None if left else {c: n for c, n in found.items() if n}


def _undo_part(cells: int):
    """The codes of one part as rows; one row without a code if the part holds too much."""

    def run(keys: tuple, told: pd.DataFrame) -> pd.DataFrame:
        got = _undone({r["cell"]: [int(r["n"]), _whole(r, "x"), _whole(r, "y")] for r in told.to_dict("records")}, cells)
        return pd.DataFrame({"_x": pd.array([None] if got is None else list(got), dtype="Int64")})

    return run


def _larger(left: DataFrame, right: DataFrame, columns: Sequence[str], cells: int, size: int) -> tuple[DataFrame, list[int]] | None:
    """The codes by a sketch in parts, and the limbs; None if it would hold a large part of the rows.

    Two codes may share all their cells; they hardly share their part too when there are four times as many.
    """
    total, parts = left.count() + right.count(), 2
    while parts * 3 * cells * FILLED < size:
        parts *= 2
    while size * FEW <= total and parts * 3 * cells <= total:
        told = pinned(_told(left, right, columns, cells, parts))
        codes = pinned(told.select("part", "cell", "n", *[f"{k}_{i}" for k in ("x", "y") for i in range(3)]).groupBy("part").applyInPandas(_undo_part(cells), "_x long"))
        if codes.where("_x is null").isEmpty():
            return codes, _limbs(told)
        parts *= 4
    return None


def sketched_difference(left: DataFrame, right: DataFrame, columns: Sequence[str], cells: int = CELLS) -> Difference:
    """Rows (with their copies) that ``left`` has more (added) or less (removed) than ``right``, exact in every case."""
    spark, sketch = left.sparkSession, _sketch(left, right, columns, cells)
    found = _undone(sketch, cells)
    if found is not None:
        codes, limbs = spark.createDataFrame([(c,) for c in found], "_x long"), [sum(v[3 + i] for v in sketch.values()) for i in range(4)]
        some = F.broadcast(codes)  # fewer than 3 * cells numbers
    else:
        larger = _larger(left, right, columns, cells, _size(sketch, cells))
        if larger is None:
            return Difference(structural_diff(left, right, columns), False)
        codes, limbs = larger
        some = F.broadcast(codes) if codes.count() <= BROADCAST else codes
    of = lambda df: df.select(*columns, _code(df, columns).alias("_x")).join(some, "_x", "left_semi").select(*columns)
    diff = structural_diff(of(left), of(right), columns).persist()
    signed = (F.col("added") - F.col("removed")).cast("decimal(38,0)")
    limb = [F.coalesce(F.sum(F.conv(F.substring(row_digest(diff, list(columns)), at, 15), 16, 10).cast("decimal(38,0)") * signed), F.lit(0)).alias(f"l{i}") for i, at in enumerate(LIMBS)]
    if [int(x) for x in diff.agg(*limb).first()] != limbs:
        diff.unpersist()
        return Difference(structural_diff(left, right, columns), False)
    return Difference(diff, True)
