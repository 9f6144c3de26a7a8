"""Best-fit packing by bin completion over the histogram of piece lengths.

Documents become token pieces of at most ``capacity`` ids; only longer documents are cut, and only their first piece
may be shorter. Lengths are whole numbers up to the capacity, so the packing problem is a histogram with at most
``capacity`` entries: the search for fillings runs on that bounded table, and Spark places the documents: it numbers
the pieces of each length and looks up, by length and number, the sequence and offset the plan gives.

First incumbents are the best-fit-decreasing packing and a dive that takes the first choice throughout. Dives with one
other decision, early ones first (another filling, or a smaller share of its greatest possible number), follow in limited
discrepancy order; a better one becomes the base of the next, up to ``max_dive_nodes`` nodes.

The search is branch and bound. A node takes the largest length left and enumerates fillings of the rest of its bin, of
any number of pieces, the least waste first, from a table of the sums that the lengths left can reach. Fillings that
another one with larger items dominates are left out: those where an unused length fits in place of some of the items
(none, one or several) that are together not longer. A filling is used at once as often as the counts allow, or a share
of that; all smaller numbers are tried after the other fillings. A node is cut when its bins plus the lower bound of
what is left reach the incumbent, or when the same lengths were left before with no more bins. All alternatives stay on
the stack, so the search is exact when it ends by itself; it also ends when the incumbent meets the lower bound of the
whole, or after ``max_nodes`` nodes and tested fillings with the best incumbent found.

Defined results: a NULL text is empty and has its end id alone; rows with equal or NULL ids are packed each on their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain, islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.shared import BUCKET_ROWS, numbered, stored
from catalogspark.llm.tokens import UnitEncoder, vocabulary_path
from catalogspark.llm.words import text_bytes

CAPACITY = 1024
END_ID = 2
#: Search nodes after which the best packing found so far is taken.
MAX_NODES = 6_000
#: Pairs and triples that are looked for among so many of the largest lengths, before all fillings are enumerated.
FIRST = 48
#: Largest lengths that a greedy filling starts from.
STARTS = 3
#: Nodes of the dives with one other decision, and what is tried there: fillings, and shares of their greatest number.
MAX_DIVE_NODES = 1_500
OTHERS, PARTS = 3, (1.0, 0.75, 0.5, 0.3, 0.15, 0.05)
#: Entries of the stack that keep their enumeration; earlier ones start it again when the search comes back.
LIVE = 32

#: Shares of its greatest possible number that a filling is used at once, one search each, without and with greedy fillings, until the bound is met.
SHARES = (1.0, 0.5, 0.2)

Plan = list[tuple[tuple[int, ...], int]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best over all thresholds of counting large items and the waste beside them."""
    sizes = np.arange(capacity + 1)
    number, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * sizes)])
    half = capacity // 2
    k = np.arange(0, half + 1)
    above = number[-1] - number[capacity - k + 1]  # longer than capacity - k
    mid_n = number[capacity - k + 1] - number[half + 1]
    mid_sum = total[capacity - k + 1] - total[half + 1]
    low_sum = total[half + 1] - total[k]
    over = np.maximum(0, -(-(low_sum - (mid_n * capacity - mid_sum)) // capacity))
    by_waste = int((above + mid_n + over).max()) if len(k) else 0
    return max(by_waste, *(_rounded_bound(counts, capacity, sizes, k) for k in range(2, 9)))


def _rounded_bound(counts: np.ndarray, capacity: int, sizes: np.ndarray, k: int) -> int:
    """Bins by a dual-feasible function: a length counts as its whole (k+1)-ths of a bin over k, or as it is if they are whole."""
    whole, rest = np.divmod((k + 1) * sizes, capacity)
    plain = int((counts * sizes)[rest == 0].sum())
    rounded = int((counts * whole)[rest > 0].sum())
    return -(-(plain * k + rounded * capacity) // (capacity * k))


def fillings(counts: np.ndarray, room: int, greedy: bool = False) -> Iterator[tuple[int, ...] | None]:
    """Undominated fillings of ``room`` from the lengths that are left, least waste first; None for each dominated one.

    One item that fills the room exactly dominates every other filling. Pairs and triples of large items that fill it
    come next, then, with ``greedy``, those that take the largest item that fits again and again, then all fillings,
    larger items before smaller.
    """
    have = [int(x) for x in np.flatnonzero(counts[: room + 1] > 0) if x]
    if not have:
        yield ()
        return
    if have[-1] == room:
        yield (room,)
        return
    number = {x: int(counts[x]) for x in have}
    given = set()
    for fill in chain(_small_fillings(have, number, room), _greedy_fillings(have, number, room) if greedy else ()):
        if fill not in given:
            given.add(fill)
            yield None if _dominated(fill, number, room) else fill
    sums = [1]  # sums of the i smallest lengths, as bits
    for x in have:
        reach, left, step = sums[-1], min(number[x], room // x), 1
        while left > 0:
            reach |= reach << (min(step, left) * x)
            left, step = left - step, step * 2
        sums.append(reach & ((2 << room) - 1))
    for total in range(room, 0, -1):
        if sums[-1] >> total & 1:
            for fill in _exact_fillings(have, number, sums, len(have), total):
                if fill not in given:
                    yield None if _dominated(fill, number, room) else fill


def _small_fillings(have: list[int], number: dict[int, int], room: int) -> Iterator[tuple[int, ...]]:
    """Pairs, then triples, that fill the room exactly; each large item with its largest partner."""
    large = have[::-1][:FIRST]
    for x in large:
        if number.get(room - x, 0) > (room - x == x):
            yield tuple(sorted((x, room - x), reverse=True))
    for x in large:
        for y in [y for y in have if y < room - x][::-1][:FIRST]:
            triple = tuple(sorted((x, y, room - x - y), reverse=True))
            if all(number.get(v, 0) >= triple.count(v) for v in triple):
                yield triple
                break


def _greedy_fillings(have: list[int], number: dict[int, int], room: int) -> list[tuple[int, ...]]:
    """From each of the largest lengths the largest item that fits, again and again; the least waste first."""
    out = []
    for first in have[::-1][:STARTS]:
        items, left = [first], room - first
        for x in reversed(have):
            n = min(number[x] - (x == first), left // x)
            items += [x] * n
            left -= n * x
        out.append(tuple(sorted(items, reverse=True)))
    return sorted(out, key=lambda f: room - sum(f))


def _exact_fillings(have: list[int], number: dict[int, int], sums: list[int], i: int, total: int) -> Iterator[tuple[int, ...]]:
    """All fillings of exactly ``total`` from the ``i`` smallest lengths; every step can be completed."""
    if not total:
        yield ()
        return
    for j in range(i - 1, -1, -1):
        if not sums[j + 1] >> total & 1:
            return
        x = have[j]
        for n in range(min(number[x], total // x), 0, -1):
            if sums[j] >> (total - n * x) & 1:
                for rest in _exact_fillings(have, number, sums, j, total - n * x):
                    yield (x,) * n + rest


def _dominated(fill: tuple[int, ...], number: dict[int, int], room: int) -> bool:
    """Whether an unused length fits in place of items that are together not longer: one shorter item, none, or several."""
    unused = 0
    for x, n in number.items():
        if n > fill.count(x):
            unused |= 1 << x
    single, several = 1, 0
    for x in fill:
        several |= (several | (single & ~1)) << x
        single |= 1 << x

    def spread(bits: int, n: int) -> int:
        """The bits moved up by 0 to ``n``."""
        done = 0
        while done < n:
            step = min(done + 1, n - done)
            bits |= bits << step
            done += step
        return bits

    waste = room - sum(fill)
    return bool(unused & (spread(several, waste) | (spread(single << 1, waste - 1) if waste else 0)))


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES, max_dive_nodes: int = MAX_DIVE_NODES) -> Plan:
    """Bins as ``(lengths, how often)`` for all items of the histogram (length to number, lengths 1..capacity)."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] += n
    least = lower_bound(counts, capacity)
    best: tuple[int, Plan] | None = _best_fit(counts, capacity)
    best = _dives(counts, capacity, least, best, max_dive_nodes)
    for share, greedy in product(SHARES, (False, True)):
        best, whole = _search(counts, capacity, least, share, greedy, max_nodes, best)
        if whole or best[0] <= least:
            break
    return best[1]


def _best_fit(counts: np.ndarray, capacity: int) -> tuple[int, Plan]:
    """Best fit decreasing over the histogram: equal bins are filled together."""
    by_room: dict[int, dict[tuple[int, ...], int]] = {}

    def put(fill: tuple[int, ...], n: int) -> None:
        place = by_room.setdefault(capacity - sum(fill), {})
        place[fill] = place.get(fill, 0) + n

    for x in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[x])
        while left:
            rooms = [r for r in by_room if r >= x and by_room[r]]
            if not rooms:
                each = capacity // x
                if left >= each:
                    put((x,) * each, left // each)
                if left % each:
                    put((x,) * (left % each), 1)
                break
            fill, n = by_room[min(rooms)].popitem()
            each = min(sum([capacity, *[-y for y in fill]]) // x, left)
            used = min(n, left // each)
            if used < n:
                put(fill, n - used)
            put(fill + (x,) * each, used)
            left -= each * used
    plan = [(fill, n) for place in by_room.values() for fill, n in place.items()]
    return sum(n for _, n in plan), plan


def _dives(counts: np.ndarray, capacity: int, least: int, best: tuple[int, Plan], max_nodes: int) -> tuple[int, Plan]:
    """Dives from the whole histogram with one decision other than in the base, the first decisions first."""
    nodes = 0

    def dive(base: list[tuple[int, float]]) -> tuple[int, Plan]:
        nonlocal nodes
        state, plan, bins = counts.copy(), [], 0
        while state.any():
            nodes += 1
            which, share = base[len(plan)] if len(plan) < len(base) else (0, 1.0)
            top = int(np.flatnonzero(state)[-1])
            state[top] -= 1
            some = [f for f in islice(fillings(state, capacity - top, True), 4 * (which + 1)) if f is not None]
            state[top] += 1
            items = (top, *(some[min(which, len(some) - 1)] if some else _greedy_fill(state, top, capacity)))
            most = min(int(state[x]) // items.count(x) for x in set(items))
            often = max(1, int(most * share))
            for x in items:
                state[x] -= often
            plan.append((items, often))
            bins += often
            if bins + lower_bound(state, capacity) >= best[0]:
                return best[0] + 1, plan
        return bins, plan

    base: list[tuple[int, float]] = []
    got = dive(base)
    depth = len(got[1])
    best = min(best, got, key=lambda b: b[0])
    better = True
    while better and best[0] > least and nodes < max_nodes:
        better = False
        for at, which, share in product(range(min(depth, 12)), range(OTHERS), PARTS):
            if best[0] <= least or nodes >= max_nodes:
                break
            tried = [*base[:at], *[(0, 1.0)] * (at - len(base)), (which, share), *base[at + 1 :]]
            if tried == base:
                continue
            got = dive(tried)
            if got[0] < best[0]:
                best, base, depth, better = got, tried, len(got[1]), True
    return best


def _greedy_fill(state: np.ndarray, top: int, capacity: int) -> tuple[int, ...]:
    """The largest item that fits, again and again, beside ``top``."""
    out, room = [], capacity - top
    for x in np.flatnonzero(state[: room + 1])[::-1].tolist():
        n = min(int(state[x]) - (x == top), room // x)
        out += [x] * n
        room -= n * x
    return tuple(out)


def _options(state: np.ndarray, capacity: int, share: float, greedy: bool) -> Iterator[tuple[tuple[int, ...], int] | None]:
    """Bins around the largest length left, and how often each is used at once; None for each dominated one."""
    top = int(np.flatnonzero(state)[-1])
    left = state.copy()
    left[top] -= 1
    for others in (False, True):
        for fill in fillings(left, capacity - top, greedy):
            if fill is None:
                yield None
                continue
            items = (top, *fill)
            most = min(int(state[x]) // items.count(x) for x in set(items))
            often = max(1, int(most * share))
            if others:
                yield from ((items, n) for n in range(most, 0, -1) if n != often)
            else:
                yield items, often


def _search(counts: np.ndarray, capacity: int, least: int, share: float, greedy: bool, max_nodes: int, best: tuple[int, Plan] | None) -> tuple[tuple[int, Plan], bool]:
    """Depth-first from the whole histogram; the incumbent may come from an earlier search. Also whether it is the best there is."""
    stack: list[list] = []  # state, its options, how many are used, bins, plan as (earlier plan, bin)
    seen: dict[bytes, int] = {}
    state, plan, bins, nodes = counts, None, 0, 0
    while best is None or best[0] > least:
        nodes += 1
        key = blake2b(state.tobytes(), digest_size=16).digest()
        if not state.any():
            if best is None or bins < best[0]:
                best = bins, _unwound(plan)
        elif (best is None or bins + lower_bound(state, capacity) < best[0]) and bins < seen.get(key, bins + 1):
            seen[key] = bins
            stack.append([state, None, 0, bins, plan])
            if len(stack) > LIVE:
                stack[-LIVE - 1][1] = None
        choice = None
        while stack and choice is None:
            if best is not None and nodes > max_nodes:
                return best, best[0] <= least
            node = stack[-1]
            if node[1] is None:
                node[1] = islice(_options(node[0], capacity, share, greedy), node[2], None)
            try:
                choice = next(node[1])
            except StopIteration:
                stack.pop()
                continue
            node[2] += 1
            nodes += choice is None
        if choice is None:
            return best, True
        items, often = choice
        state = node[0].copy()
        for x in items:
            state[x] -= often
        plan, bins = (node[4], choice), node[3] + often
    return best, True


def _unwound(plan: tuple | None) -> Plan:
    out = []
    while plan is not None:
        plan, choice = plan
        out.append(choice)
    return out[::-1]


def encode_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int | None = END_ID,
    vocabulary: str | None = None, include_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``."""
    path = vocabulary or vocabulary_path()
    frame = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder(path)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            rows, cols, ids_out = [], [[], [], [], []], []
            for k, ids in encoder.encode_rows(data, bounds):
                ids = np.concatenate([ids, tail])
                start, length = 0, len(ids) % capacity or min(len(ids), capacity)
                piece = 0
                while start < len(ids):
                    part = ids[start : start + length]
                    rows.append(k)
                    for c, v in zip(cols, (piece, start, length, zlib.crc32(part.astype("<u4").tobytes()))):
                        c.append(v)
                    if include_ids:
                        ids_out.append(part.astype(np.int32))
                    start, length, piece = start + length, capacity, piece + 1
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]]
            if include_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * include_ids)

    return frame.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * include_ids)


def placements(plan: Plan) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length: ``(first number, numbers, per bin, first sequence, first offset)`` of each run of its pieces."""
    taken: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for items, often in plan:
        offset = 0
        for length in dict.fromkeys(items):
            per = items.count(length)
            out.setdefault(length, []).append((taken.get(length, 0), per * often, per, sequence, offset))
            taken[length] = taken.get(length, 0) + per * often
            offset += per * length
        sequence += often
    return out


def place(pieces: DataFrame, capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces. The plan has at most ``capacity`` rows and is broadcast."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    runs = placements(plan_bins(histogram, capacity, max_nodes))
    schema = "_length long, _runs array<struct<first:long,n:long,per:long,seq:long,off:long>>"
    lookup = spark.createDataFrame([(k, v) for k, v in runs.items()], schema)
    buckets = max(8, sum(histogram.values()) // BUCKET_ROWS)
    ordered = numbered(pieces, ["length"], [F.xxhash64("doc_id", "piece")], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "_rank", buckets)
    joined = ordered.join(F.broadcast(lookup), ordered["length"] == lookup["_length"])
    run = F.filter("_runs", lambda x: (x["first"] <= F.col("_rank")) & (F.col("_rank") < x["first"] + x["n"]))[0]
    at = F.col("_rank") - F.col("_run.first")
    return joined.withColumn("_run", run).select(
        *pieces.columns,
        (F.col("_run.seq") + F.floor(at / F.col("_run.per"))).cast("long").alias("sequence_id"),
        (F.col("_run.off") + F.pmod(at, F.col("_run.per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int | None = END_ID,
         vocabulary: str | None = None, include_ids: bool = False, max_nodes: int = MAX_NODES) -> DataFrame:
    """Encode, cut and place all documents; one row per piece."""
    pieces = stored(encode_pieces(docs, doc_id, text, capacity, end_id, vocabulary, include_ids), "pieces")
    return place(pieces, capacity, max_nodes)
