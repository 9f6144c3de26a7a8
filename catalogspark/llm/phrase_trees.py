"""Collocations from depth-truncated suffix subtrees that are built apart, group by group of word prefixes.

Texts are cut into pieces, pieces into words; every word position begins a suffix, cut after four words, at the end of
its piece, or before a word that is too rare for any phrase. Counts of phrases are sums over the leaves of the suffix tree
of all pieces. The tree is never built whole; after ERA it is partitioned vertically:

1. A word whose suffixes exceed the memory budget of a group is extended by its next word, and again, until every prefix
   fits or has four words. Counts of the extended prefixes are exact and small in number (at most budget-th parts of all
   positions per level), and are what the driver knows.
2. Prefixes are dealt into groups of about one budget by their hash. A task sorts the suffixes of its chunk, adds equal
   ones up, and sends each group its leaves as one packed row. With more groups than ``FAN``, leaves go to ranges of
   groups first, are added up again there, and are split further, so packed rows never get tiny.
3. A group sorts its leaves: subtrees are runs of the sorted rows, and the count of a node is the sum of its run. A node
   is told with the counts of its ancestors, which are the left parts of its cuts; those above the group's subtrees are
   the extended prefixes of step 1.

Right parts of cuts are tails of phrases, found level by level: a phrase joins its tail, which already knows its own
tails. Tails with very many words before them (few, by their counts) are joined by broadcast, the others by a shuffle.
A phrase lies in a longer one with enough occurrences just if it does in one that is longer by one word. Scores are whole
numbers from decimals. The first rows per language are chosen in salted parts and merged, so no task sees a whole language.

Words are numbered per language by falling frequency; a chunk gets the numbers of its own words only. Inside a chunk words
are told apart by 64-bit codes, between chunks by their bytes.

Defined results: NULL texts are empty and give no phrase; NULL languages are ``und``, together with rows that say so;
ids are not used, repeated rows count each time; a text without words adds nothing; languages without a phrase of 30
occurrences give no rows, nor does an empty table; ties are broken by the phrase; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm.katz_lm import packed, unpacked
from catalogspark.llm.shared import numbered, release, stored
from catalogspark.llm.words import codes, groups, mix64, placed_words, text_bytes

LONGEST = 4
LEAST = 30
SHARE = 80
TOP = 2000
SCALE = 2_000_000
#: Word positions of one chunk, and of all chunks that a task holds open.
CHUNK_TOKENS, HELD_TOKENS = 1_000_000, 4_000_000
#: Leaves of one group (the memory budget), and extended prefixes that the driver may have to know per level.
BUDGET, PREFIXES = 1_000_000, 300_000
#: Groups that one task writes to.
FAN = 1_000
#: Parts in which the first rows of a language are chosen.
SALTS = 64
#: Tails that are joined by broadcast have more than this part of all positions; there are fewer than 4 / HOT of them.
HOT = 1e-5
TEXT_BYTES = 2 << 20

_BREAKS = [ord(c) for c in ".,;:!?\n\x0b\x0c\r"]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word of consecutive rows: code, row, whether it begins a piece, start and end (from the first row's start)."""
    is_break, sep = np.zeros(256, bool), np.zeros(256, bool)
    is_break[_BREAKS] = True
    sep[[*_BREAKS, 0x20, 0x09]] = True
    found, at, end = placed_words(data, bounds, sep)
    row = np.searchsorted(bounds - bounds[0], at, side="right") - 1
    piece = np.cumsum(is_break[data[int(bounds[0]) : int(bounds[-1])]], dtype=np.int32)[at] if len(at) else at
    begins = np.ones(len(at), bool)
    begins[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
    return found, row, begins, at, end


class _Open:
    """Words of one language that a task has read: codes with a zero before each piece, and the distinct words' bytes."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.seen = np.zeros(0, np.uint64)
        self.codes: list[np.ndarray] = []  # of the distinct words, as they came
        self.lengths: list[np.ndarray] = []
        self.letters: list[np.ndarray] = []
        self.size = 0

    def add(self, found: np.ndarray, begins: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        token = np.zeros(len(found) + int(begins.sum()), np.uint64)
        token[np.arange(len(found)) + np.cumsum(begins)] = found
        self.parts.append(token)
        self.size += len(found)
        word, first = np.unique(found, return_index=True)
        new = ~np.isin(word, self.seen, assume_unique=True)
        word, first = word[new], first[new]
        length = (end - start)[first]
        byte = np.arange(int(length.sum())) + np.repeat(start[first] - (np.cumsum(length) - length), length)
        self.seen = np.sort(np.concatenate([self.seen, word]))
        self.codes.append(word), self.lengths.append(length), self.letters.append(_LOWER[data[byte]])

    def spelled(self) -> pa.Array:
        """The distinct words in the order of their codes."""
        code, length, letters = (np.concatenate(x) for x in (self.codes, self.lengths, self.letters))
        offsets = np.append(0, np.cumsum(length)).astype(np.int64)
        text = pa.LargeStringArray.from_buffers(len(code), pa.py_buffer(offsets), pa.py_buffer(letters)).take(pa.array(np.argsort(code)))
        try:
            text.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            text = pa.array([x.decode("utf-8", "replace") for x in text.cast(pa.large_binary()).to_pylist()], pa.large_string())
        return text.cast(pa.string())

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        """A row per distinct word, by falling count, and a row with all words as places among them (0 before a piece)."""
        chunk, text = uuid.uuid4().int & ((1 << 62) - 1), self.spelled()
        token = np.concatenate(self.parts)
        self.parts.clear()
        word, index, n = np.unique(token, return_inverse=True, return_counts=True)
        gap = int(len(word) and word[0] == 0)
        order = np.argsort(-n[gap:], kind="stable")
        place = np.zeros(len(word), np.uint32)
        place[gap + order] = np.arange(1, len(order) + 1)
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.binary()]

        def told(*columns: object) -> pa.RecordBatch:
            rows = len(columns[1])
            head = [pa.repeat(pa.scalar(chunk, kinds[0]), rows), pa.repeat(pa.scalar(lang, kinds[1]), rows)]
            rest = [pa.nulls(rows, t) if c is None else pa.array(c, t) for c, t in zip(columns, kinds[2:])]
            return pa.RecordBatch.from_arrays([*head, *rest], ["chunk", "lang", "pos", "word", "c", "tokens"])

        yield told(np.arange(len(order), dtype=np.int32), text.take(pa.array(order)), n[gap:][order].astype(np.int32), None)
        yield told(None, [None], [self.size], [packed(place[index])])


_CHUNK = "chunk long, lang string, pos int, word string, c int, tokens binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Per task and language, chunks: a row per distinct word with its count, and one with all words (see ``_Open.rows``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Open] = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            of_row, name = langs.indices.to_numpy(zero_copy_only=False), langs.dictionary.to_pylist()
            data, bounds = text_bytes(batch.column(1))
            for i, j in groups(bounds, TEXT_BYTES):
                found, row, begins, at, end = _tokens(data, np.asarray(bounds[i : j + 1]))
                lang, base = of_row[i:j][row], int(bounds[i])
                for code in np.unique(lang).tolist():
                    mine = np.flatnonzero(lang == code)
                    place = held.setdefault(name[code], _Open())
                    place.add(found[mine], begins[mine], data, base + at[mine], base + end[mine])
                    if place.size >= CHUNK_TOKENS:
                        yield from held.pop(name[code]).rows(name[code])
                if sum(x.size for x in held.values()) >= HELD_TOKENS:
                    for lang_name in list(held):
                        yield from held.pop(lang_name).rows(lang_name)
        for lang_name in list(held):
            yield from held.pop(lang_name).rows(lang_name)

    return docs.mapInArrow(run, _CHUNK)


@dataclass
class Prefixes:
    """Extended prefixes of one language: per depth, sorted keys (place of the shorter prefix, next word) and counts."""

    keys: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)

    def places(self, w: np.ndarray) -> np.ndarray:
        """For rows of four words: place of each row's prefix of 1, 2, 3 words among the extended ones, else -1."""
        out = np.full((len(w), LONGEST - 1), -1, np.int64)
        before = np.zeros(len(w), np.int64)
        for depth, keys in enumerate(self.keys):
            key = (before << 32) | w[:, depth].astype(np.int64)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            ok = (before >= 0) & (w[:, depth] > 0) & (keys[at] == key if len(keys) else False)
            before = out[:, depth] = np.where(ok, at, -1)
        return out


def _suffixes(token: np.ndarray) -> np.ndarray:
    """The four words from each word on; zeros after a break."""
    at = np.flatnonzero(token)
    pad = np.append(token, np.zeros(LONGEST, token.dtype))
    w = np.zeros((len(at), LONGEST), np.uint32)
    w[:, 0] = token[at]
    for d in range(1, LONGEST):
        w[:, d] = np.where(w[:, d - 1] > 0, pad[at + d], 0)
    return w


def _order(w: np.ndarray) -> np.ndarray:
    bits = np.uint64(16 if len(w) and int(w.max()) < 1 << 16 else 32)
    high, low = (w[:, d].astype(np.uint64) << bits | w[:, d + 1] for d in (0, 2))
    return np.lexsort((low, high)) if bits == 32 else np.argsort(high << np.uint64(32) | low)


def _leaves(w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, and the sums of their counts."""
    order = _order(w)
    w, n = w[order], n[order]
    first = np.flatnonzero(np.append(True, (w[1:] != w[:-1]).any(1))) if len(w) else np.zeros(0, np.int64)
    return w[first], np.add.reduceat(n, first) if len(first) else n


def _group_of(w: np.ndarray, known: Prefixes, lang: str, n_groups: int) -> np.ndarray:
    """The group of each leaf by the hash of its prefix that is not extended; -1 if the leaf is an extended prefix itself."""
    root = 1 + (known.places(w) >= 0).sum(1)
    salt = np.uint64(int.from_bytes(lang.encode()[:8], "little")) ^ np.uint64(len(lang))
    code = np.full(len(w), salt, np.uint64)
    for d in range(LONGEST):
        code = np.where(d < root, mix64(code * np.uint64(0xD6E8FEB86659FD93) + w[:, d].astype(np.uint64) + np.uint64(1)), code)
    ends = np.take_along_axis(w, (root - 1)[:, None], 1)[:, 0] == 0
    return np.where(ends, -1, (code % np.uint64(n_groups)).astype(np.int64))


def _blobs(lang: str, w: np.ndarray, n: np.ndarray, known: Prefixes, n_groups: int, stride: int) -> pa.RecordBatch:
    """One packed row per range of ``stride`` groups."""
    group = _group_of(w, known, lang, n_groups)
    w, n, group = w[group >= 0], n[group >= 0], group[group >= 0] // stride
    order = np.argsort(group, kind="stable")
    w, n, group = w[order], n[order], group[order]
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(edge.tolist(), [*edge.tolist()[1:], len(group)]):
        part = np.concatenate([w[a:b].T.ravel(), n[a:b]])
        small = part.max() < 1 << 16
        rows.append(packed(part.astype(np.uint16 if small else np.uint32 if part.max() < 1 << 32 else np.uint64)))
    return pa.RecordBatch.from_arrays([pa.array(group[edge].astype(np.int32)), pa.array([lang] * len(rows), pa.string()), pa.array(rows, pa.binary())], ["bin", "lang", "data"])


def _unblob(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    part = unpacked(data).reshape(LONGEST + 1, -1)
    return part[:LONGEST].T.astype(np.uint32), part[LONGEST].astype(np.int64)


def _deal(coded: DataFrame, known: dict[str, Prefixes], n_groups: int, fan: int) -> DataFrame:
    """``bin, lang, data``: leaves by group, split in as many steps as ``fan`` allows."""
    strides = [1]
    while -(-n_groups // strides[-1]) > fan:
        strides.append(strides[-1] * fan)
    strides.reverse()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, tokens in zip(batch.column("lang").to_pylist(), batch.column("tokens")):
                w = _suffixes(unpacked(tokens.as_py()))
                yield _blobs(lang, *_leaves(w, np.ones(len(w), np.int64)), known.get(lang) or Prefixes(), n_groups, strides[0])

    def again(stride: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[str, list] = {}

            def flush() -> Iterator[pa.RecordBatch]:
                for lang, parts in held.items():
                    w, n = (np.concatenate(x) for x in zip(*parts))
                    yield _blobs(lang, *_leaves(w, n), known.get(lang) or Prefixes(), n_groups, stride)
                held.clear()

            for batch in batches:
                for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data").to_pylist()):
                    held.setdefault(lang, []).append(_unblob(data))
                    if sum(len(n) for parts in held.values() for _, n in parts) >= CHUNK_TOKENS:
                        yield from flush()
            yield from flush()

        return run

    rows = coded.select("lang", "tokens").mapInArrow(first, "bin int, lang string, data binary")
    for stride in strides[1:]:
        rows = rows.repartition("bin").mapInArrow(again(stride), "bin int, lang string, data binary")
    return rows


_NODE = "lang string, m int, w1 int, w2 int, w3 int, w4 int, n long, l1 long, l2 long, l3 long"


def _subtrees(known: dict[str, Prefixes], least: int):
    """A group's leaves to its nodes of two words or more: words, count, and the counts of the shorter prefixes."""
    names = ["lang", "m", "w1", "w2", "w3", "w4", "n", "l1", "l2", "l3"]
    kinds = [pa.string(), *[pa.int32()] * 5, *[pa.int64()] * 4]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        by_lang: dict[str, list] = {}
        for lang, data in zip(table["lang"].to_pylist(), table["data"].to_pylist()):
            by_lang.setdefault(lang, []).append(_unblob(data))
        for lang in list(by_lang):
            w, n = (np.concatenate(x) for x in zip(*by_lang.pop(lang)))
            w, n = _leaves(w, n)
            prefixes = known.get(lang) or Prefixes()
            place = prefixes.places(w)
            root = 1 + (place >= 0).sum(1)
            upto = np.append(0, np.cumsum(n))
            change = np.append(True, np.zeros(len(w) - 1, bool))
            above: list[np.ndarray] = []  # per row, the count of its prefix of each length
            for d in range(LONGEST):
                change[1:] |= w[1:, d] != w[:-1, d]
                start = np.flatnonzero(change)
                count = np.diff(np.append(upto[start], upto[-1]))
                per_row = np.repeat(count, np.diff(np.append(start, len(w))))
                if d < len(prefixes.counts) and len(prefixes.counts[d]):
                    per_row = np.where(place[:, d] >= 0, prefixes.counts[d][np.maximum(place[:, d], 0)], per_row)
                above.append(per_row)
                if d:
                    start = start[(w[start, d] > 0) & (count >= least) & (root[start] <= d + 1)]
                    words = np.where(np.arange(LONGEST)[None, :] <= d, w[start], 0)
                    left = [above[k][start] if k < d else np.zeros(len(start), np.int64) for k in range(LONGEST - 1)]
                    cols = [[lang] * len(start), np.full(len(start), d + 1), *words.T, above[d][start], *left]
                    out.append(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names))
        return pa.concat_tables(out)

    return run


def _next_words(known: dict[str, Prefixes], depth: int):
    """How often each word follows each extended prefix of ``depth`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, tokens in zip(batch.column("lang").to_pylist(), batch.column("tokens").to_pylist()):
                if lang not in known:
                    continue
                w = _suffixes(unpacked(tokens))
                before = known[lang].places(w)[:, depth - 1]
                ok = (before >= 0) & (w[:, depth] > 0)
                key, n = np.unique((before[ok] << 32) | w[ok, depth].astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n.astype(np.int64))], ["lang", "key", "n"])

    return run


def _known_prefixes(coded: DataFrame, words: DataFrame, budget: int) -> dict[str, Prefixes]:
    """Prefixes with more suffixes than a group may hold; at most positions / budget of each length."""
    known: dict[str, Prefixes] = {}
    level = words.where(F.col("n") > budget).select("lang", F.col("id").cast("long").alias("key"), "n")
    for depth in range(1, LONGEST):
        rows = level.orderBy("lang", "key").collect()
        for lang in {r["lang"] for r in rows}:
            mine = [r for r in rows if r["lang"] == lang]
            place = known.setdefault(lang, Prefixes())
            place.keys.append(np.array([r["key"] for r in mine], np.int64))
            place.counts.append(np.array([r["n"] for r in mine], np.int64))
        found = {lang: p for lang, p in known.items() if len(p.keys) == depth}
        if not found or depth == LONGEST - 1:
            break
        level = coded.select("lang", "tokens").mapInArrow(_next_words(found, depth), "lang string, key long, n long")
        level = level.groupBy("lang", "key").agg(F.sum("n").alias("n")).where(F.col("n") > budget)
    return known


def _known_rows(known: dict[str, Prefixes], least: int) -> list[tuple]:
    """Extended prefixes of two or three words as nodes."""
    out = []
    for lang, p in known.items():
        chain = {}
        for depth, (keys, counts) in enumerate(zip(p.keys, p.counts)):
            chain[depth] = []
            for key, n in zip(keys.tolist(), counts.tolist()):
                words, left = chain[depth - 1][key >> 32] if depth else ([], [])
                words = [*words, key & 0xFFFFFFFF]
                chain[depth].append((words, [*left, n]))
                if depth and n >= least:
                    out.append((lang, depth + 1, *words, *[0] * (LONGEST - depth - 1), n, *left, *[0] * (LONGEST - 1 - depth)))
    return out


def _with_tail(longer: DataFrame, shorter: DataFrame, m: int, bar: int) -> DataFrame:
    """Phrases of ``m`` words with the counts of their tails: r1 of all but the first word, r2 of all but two, ..."""
    have = [f"r{k}" for k in range(1, m - 1)]
    tails = shorter.select(F.col("lang").alias("_lang"), *[F.col(f"w{k}").alias(f"_w{k + 1}") for k in range(1, m)], F.col("n").alias("_r1"), *[F.col(r).alias(f"_r{int(r[1:]) + 1}") for r in have])
    same = F.col("lang") == F.col("_lang")
    for k in range(2, m + 1):
        same = same & (F.col(f"w{k}") == F.col(f"_w{k}"))
    hot, rest = tails.where(F.col("_r1") > bar), tails.where(F.col("_r1") <= bar)
    keep = [*longer.columns, *[F.col(f"_r{k}").alias(f"r{k}") for k in range(1, m)]]
    often = longer.join(F.broadcast(hot), same).select(*keep)
    seldom = longer.join(F.broadcast(hot), same, "left_anti").join(rest, same).select(*keep)
    return often.unionByName(seldom)


def _first_rows(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows per language with their ``rank``, chosen in salted parts first."""
    salted = rows.select("*", F.pmod(F.xxhash64("w1", "w2", "w3", "w4"), F.lit(SALTS)).alias("_s"))
    part = salted.select("*", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order)).alias("_r")).where(F.col("_r") <= top)
    return part.select("*", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("rank")).where(F.col("rank") <= top).drop("_s", "_r")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, share: int = SHARE, top: int = TOP,
                 budget: int | None = None, fan: int = FAN) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of 2 to 4 words of each language."""
    spark = docs.sparkSession
    given = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("text"))
    chunks = stored(_chunks(given), "chunks")
    whole = chunks.where("tokens is not null")
    totals = whole.groupBy("lang").agg(F.sum("c").alias("total"))
    positions = whole.agg(F.sum("c").alias("n")).first()["n"] or 0
    budget = budget or max(BUDGET, positions // PREFIXES)
    entry = chunks.where("word is not null").select("chunk", "lang", "pos", "word", "c")
    words = entry.groupBy("lang", "word").agg(F.sum("c").alias("n")).where(F.col("n") >= least)
    # by falling size class; the classes are dealt over 64 parts each
    size_class = F.lit(63) - F.floor(F.log2("n")).cast("int")
    words = words.select("*", (size_class * 64 + F.pmod(F.xxhash64("word"), F.lit(64)).cast("int")).alias("_c"))
    words = stored(numbered(words, ["lang"], [F.col("_c")], [F.col("word")], "id", 64 * 64).select("lang", "word", "n", (F.col("id") + 1).cast("int").alias("id")), "words")
    mine = entry.select("chunk", "lang", "pos", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("chunk").alias("of"), "pos", "id")

    def renumber(chunk: pa.Table, ids: pa.Table) -> pa.Table:
        """All words of one chunk under the numbers of its own words; words too rare for any phrase become 0."""
        out = []
        for tokens in chunk["tokens"] if ids.num_rows else ():
            token = unpacked(tokens.as_py())
            number = np.zeros(int(token.max()) + 1, np.uint32)
            number[ids["pos"].to_numpy() + 1] = ids["id"].to_numpy()
            new = number[token]
            # one zero is enough between two words
            new = new[(new > 0) | np.append(True, new[:-1] > 0)]
            out.append(packed(new.astype(np.uint16) if new.max() < 1 << 16 else new))
        return pa.table([chunk["lang"].slice(0, len(out)), pa.array(out, pa.binary())], ["lang", "tokens"])

    of_chunk = whole.select("chunk", "lang", "tokens").groupBy("chunk").cogroup(mine.groupBy("of"))
    coded = stored(of_chunk.applyInArrow(renumber, "lang string, tokens binary"), "coded")
    known = _known_prefixes(coded, words, budget)
    n_groups = max(1, -(-positions // budget))
    dealt = _deal(coded, known, n_groups, fan)
    nodes = dealt.groupBy("bin").applyInArrow(_subtrees(known, least), _NODE)
    above = _known_rows(known, least)
    if above:
        nodes = nodes.unionByName(spark.createDataFrame(above, _NODE))
    nodes = stored(nodes, "nodes")
    release(spark)
    bar = max(1000, int(positions * HOT))
    key = ["lang", "w1", "w2", "w3", "w4"]
    level = {m: nodes.where(F.col("m") == m) for m in (2, 3, 4)}
    told = {2: _with_tail(level[2], words.select("lang", F.col("id").alias("w1"), "n"), 2, bar)}
    told[3] = _with_tail(level[3], told[2], 3, bar)
    told[4] = _with_tail(level[4], told[3], 4, bar)
    none = F.lit(None).cast("long")
    rows = told[2].select(*nodes.columns, "r1", none.alias("r2"), none.alias("r3")).unionByName(told[3].select(*nodes.columns, "r1", "r2", none.alias("r3"))).unionByName(told[4])
    cuts = []
    for k in range(1, LONGEST):
        whole = F.expr(f"(cast(n as decimal(38, 0)) * {SCALE}) div (cast(l{k} as decimal(38, 0)) + cast(r{k} as decimal(38, 0)))")
        cuts.append(F.when(F.col("m") > k, F.struct(whole.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))))
    rows = rows.select(*key, "m", "n", F.array_min(F.array(*cuts)).alias("cut"))
    zero = F.lit(0)
    head = F.struct(F.col("w1"), F.col("w2"), F.when(F.col("m") == 4, F.col("w3")).otherwise(zero).alias("w3"))
    tail = F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3"))
    longer = nodes.where("m > 2").select("lang", "n", F.explode(F.array(head, tail)).alias("in")).groupBy("lang", "in.w1", "in.w2", "in.w3").agg(F.max("n").alias("most"))
    rows = rows.join(longer.withColumn("w4", F.lit(0)), key, "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("n") * share))
    rows = stored(rows.select(*key, F.col("n").alias("a"), "cut.l", "cut.r", "cut.score"), "scored")
    best = [F.desc("score"), F.desc("a")]
    last = _first_rows(rows, best, top).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"), F.max("rank").alias("have"))
    rows = rows.join(last, "lang").where((F.col("have") < top) | (F.struct("score", "a") >= F.col("last"))).drop("last", "have")
    spelled = rows.select(*key, F.posexplode(F.array("w1", "w2", "w3", "w4")).alias("pos", "id")).where("id > 0").join(words.select("lang", "word", "id"), ["lang", "id"])
    spelled = spelled.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    first = _first_rows(rows.join(spelled, key), [*best, F.asc("phrase")], top)
    out = first.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
