"""Katz backoff language model: Good-Turing discounted counts, exactly normalised backoff weights, scores of whole texts.

All n-gram counts come from all training texts. The work is dealt in two kinds of rows, so that no row per token is
shuffled: a *chunk* holds the tokens of some documents as indexes into its sorted distinct words, and a *part* holds the
n-grams whose history (for words: the word) falls into one range of codes, from all chunks. Level n goes like this:

1. chunks send their distinct n-grams with training counts and lower-order probabilities, a row per part,
2. parts add the counts up (the partitioned count tables), and send back to each chunk the counts of its n-grams and,
   per history, the sums that discounts and backoff weight are made of,
3. the numbers of n-grams seen 1..k+1 times, one row per part, give the Good-Turing discounts.

Then chunks evaluate their tokens recursively: p(w|h) = d(c) c(hw) / c(h) if hw was seen, else alpha(h) p(w|h'), with
alpha(h) = (1 - sum of discounted seen) / (1 - sum of lower-order seen); if all followers of h have counts over k, which
are not discounted, the seen ones are scaled down so that one count of c(h) + 1 is left. Histories that a part's share of all tokens would
overflow with are split over all parts by word; their sums are at most four per part and are added up separately.
Unknown words are one outcome, with the mass that discounting takes from known words.

Texts end with an end token, which also stands before the first word. All tables are Parquet in the shared folder.

Defined results: NULL and empty texts are the end token alone; NULL ids are training rows; repeated rows count each time;
without training texts every token is the unknown outcome, with probability 1; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.shared import release, shuffle_width, stored
from catalogspark.llm.words import groups, mix64, text_bytes, word_codes

#: Counts up to this are discounted.
KATZ_K = 5
#: Tokens per chunk, and order of the model.
CHUNK_TOKENS = 1_000_000
ORDER = 2
END = np.uint64(0x656E64656E64656E)

_ROWS = "chunk long, part int, kind int, a binary, b binary, c binary, d binary, e binary"
_NAMES = ["chunk", "part", "kind", "a", "b", "c", "d", "e"]


def packed(x: np.ndarray) -> bytes:
    """An array as compressed byte planes, with its type and length in front."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""
    return x.dtype.str.encode().ljust(4) + len(x).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes) -> np.ndarray:
    kind, n = np.dtype(data[:4].decode().strip()), int.from_bytes(data[4:12], "little")
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data[12:], n * kind.itemsize, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).reshape(n)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 8
    types = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], _NAMES)


def _part_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """Parts by ranges of codes: sorted codes stay in runs."""
    return ((codes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _chunks(docs: DataFrame, parts: int) -> DataFrame:
    """Kind 0: a chunk (facts per document; its words by frequency, as places among the sorted ones; tokens; place of the end).
    Kind 1: sorted words and their training counts, for a part."""

    def build(ids, there, held, counts, tokens) -> Iterator[pa.RecordBatch]:
        chunk = uuid.uuid4().int & ((1 << 62) - 1)
        words, index = np.unique(tokens, return_inverse=True)
        train = np.bincount(index, weights=np.repeat(~held, counts), minlength=len(words)).astype(np.uint32)
        meta = np.concatenate([ids, there, held, counts])
        # tokens are kept as ranks by frequency: small numbers pack well
        order = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable").astype(np.uint32)
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        end = np.searchsorted(words, END)
        rows = [(chunk, -1, 0, packed(meta), packed(order), packed(rank[index]), packed(np.array([end])), None)]
        part = _part_of(words, parts)
        edge = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edge)).tolist():
            cut = slice(edge[p], edge[p + 1])
            rows.append((chunk, p, 1, packed(words[cut]), packed(train[cut]), None, None, None))
        yield _batch(rows)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_rows: list[list[np.ndarray]] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            id_col = batch.column(0)
            ids, there = id_col.fill_null(0).to_numpy(), np.asarray(id_col.is_valid(), np.int64)
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in groups(bounds):
                words, counts = word_codes(data, bounds[i : j + 1])
                tokens = np.full(len(words) + j - i, END, np.uint64)
                ends = np.cumsum(counts + 1) - 1
                inner = np.ones(len(tokens), bool)
                inner[ends] = False
                tokens[inner] = words
                for have, new in zip(held_rows, (ids[i:j], there[i:j], held[i:j], counts + 1, tokens)):
                    have.append(new)
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield from build(*[np.concatenate(x) for x in held_rows])
                    held_rows, size = [[], [], [], [], []], 0
        if size:
            yield from build(*[np.concatenate(x) for x in held_rows])

    return docs.mapInArrow(per_batch, _ROWS)


def _histogram(counts: np.ndarray) -> np.ndarray:
    """Numbers of n-grams seen 1..k+1 times, seen at all, and their total."""
    n = np.bincount(np.minimum(counts, KATZ_K + 2), minlength=KATZ_K + 3)
    return np.concatenate([n[1 : KATZ_K + 2], [int((counts > 0).sum()), int(counts.sum())]]).astype(np.int64)


def _count_words(key: tuple, table: pa.Table) -> pa.Table:
    """A part of level 1: number its words, add their counts, answer every chunk."""
    part = key[0].as_py()
    codes, counts = [unpacked(x) for x in table["a"].to_pylist()], [unpacked(x) for x in table["b"].to_pylist()]
    words, index = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate(counts).astype(np.float64), minlength=len(words)).astype(np.int64)
    number = np.where(total > 0, (np.int64(part) << np.int64(32)) + np.arange(len(words)), -1)
    rows, at = [(0, part, 9, packed(_histogram(total)), None, None, None, None)], 0
    for chunk, own in zip(table["chunk"].to_pylist(), codes):
        mine = index[at : at + len(own)]
        at += len(own)
        rows.append((chunk, part, 10, packed(number[mine]), packed(total[mine]), None, None, None))
    return pa.Table.from_batches([_batch(rows)])


def _count_ngrams(key: tuple, table: pa.Table) -> pa.Table:
    """A part of level n > 1: add n-gram counts and per-history sums, answer every chunk.

    In: per chunk, histories, n-grams of each, words, training counts and hot flags, lower-order probabilities. Out, per
    chunk: n-gram counts, and per history c(h), the sum of counts over k, n_1..n_k, the sum of lower-order seen.
    """
    part = key[0].as_py()
    sent = [[*(unpacked(x) for x in row[:4]), _lower(row[4])] for row in zip(*[table[c].to_pylist() for c in "abcde"])]
    lens = [len(s[2]) for s in sent]
    history = np.concatenate([np.repeat(s[0], s[1]) for s in sent])
    word = np.concatenate([s[2] for s in sent])
    counts = np.concatenate([s[3] >> 1 for s in sent]).astype(np.float64)
    hot_flag = np.concatenate([s[3] & 1 for s in sent]).astype(bool)
    lower = np.concatenate([s[4] for s in sent])
    gram, first, index = np.unique(_gram(history, word), return_index=True, return_inverse=True)
    total = np.bincount(index, weights=counts, minlength=len(gram)).astype(np.int64)
    h, of = np.unique(history[first], return_inverse=True)
    seen = total > 0
    sums = np.zeros((KATZ_K + 3, len(h)))
    sums[0] = np.bincount(of, weights=total, minlength=len(h))
    sums[1] = np.bincount(of, weights=np.where(total > KATZ_K, total, 0), minlength=len(h))
    for r in range(1, KATZ_K + 1):
        sums[1 + r] = np.bincount(of, weights=total == r, minlength=len(h))
    sums[-1] = np.bincount(of, weights=np.where(seen, lower[first], 0.0), minlength=len(h))
    rows, at = [(0, part, 9, packed(_histogram(total)), None, None, None, None)], 0
    hot = np.unique(history[hot_flag])
    if len(hot):
        rows.append((0, part, 8, packed(hot), packed(sums[:, np.searchsorted(h, hot)].ravel()), None, None, None))
    for chunk, own, n in zip(table["chunk"].to_pylist(), sent, lens):
        mine = total[index[at : at + n]]
        at += n
        # per history of the chunk: sums are whole numbers but for the last
        col = sums[:, np.searchsorted(h, own[0])]
        rows.append((chunk, part, 10, packed(mine), packed(col[:-1].astype(np.int64).ravel()), packed(col[-1]), None, None))
    return pa.Table.from_batches([_batch(rows)])


def _lower(data: bytes) -> np.ndarray:
    """Lower-order probabilities from their different values and each n-gram's place among them."""
    n, both = int.from_bytes(data[:8], "little"), unpacked(data[8:])
    return both[:n].view(np.float64)[both[n:]]


def _gram(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(history.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + word.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


class Level:
    """What all parts of a level add up to: discounts, number of seen n-grams, tokens, sums of hot histories."""

    def __init__(self, histogram: np.ndarray, hot: dict[int, np.ndarray]) -> None:
        n, self.distinct, self.tokens = histogram[: KATZ_K + 1].astype(float), int(histogram[-2]), int(histogram[-1])
        self.discount = good_turing(n)
        self.histogram = histogram
        self.hot_keys = np.array(sorted(hot), np.int64)
        self.hot_sums = np.array([hot[k] for k in self.hot_keys.tolist()]).T if hot else np.zeros((KATZ_K + 3, 0))


def good_turing(n: np.ndarray) -> np.ndarray:
    """Katz's factors d_1..d_k from n_1..n_{k+1}; absolute discounting where the counts of counts don't allow them."""
    k = KATZ_K
    out = np.ones(k)
    common = (k + 1) * n[k] / n[0] if n[0] else 1.0
    for r in range(1, k + 1):
        star = (r + 1) * n[r] / n[r - 1] if n[r - 1] else 0.0
        out[r - 1] = (star / r - common) / (1 - common) if common != 1 else 0.0
    if (out <= 0).any() or (out > 1).any() or not np.isfinite(out).all():
        cut = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        out = 1 - min(max(cut, 0.05), 0.95) / np.arange(1, k + 1)
    return out


class Chunk:
    """A chunk with the answers of the levels so far: word numbers and probabilities of its tokens."""

    def __init__(self, table: pa.Table, levels: list[Level], parts: int) -> None:
        cols = {c: table[c].to_pylist() for c in ("level", "part", "kind", *"abcd")}
        base = cols["kind"].index(0)
        meta, order, rank, end = (unpacked(cols[c][base]) for c in "abcd")
        self.index = order[rank].astype(np.int32)
        self.ids, self.there, held, self.counts = meta.reshape(4, -1)
        self.held, self.parts = held.astype(bool), parts
        self.ends = np.cumsum(self.counts)
        answers: dict[int, list] = {}
        for i in range(len(cols["kind"])):
            if cols["kind"][i] == 10:
                answers.setdefault(cols["level"][i], []).append((cols["part"][i], *[unpacked(cols[c][i]) if cols[c][i] is not None else None for c in "abc"]))
        one = sorted(answers[1], key=lambda x: x[0])
        number, count = (np.concatenate([x[i] for x in one]) for i in (1, 2))
        self.count = count[self.index]
        self.number = number[self.index]
        self.end_number = int(number[end[0]])
        self.p = _word_probability(count, levels[0])[self.index]
        history_count = self.count  # of the token itself: it is the next token's history
        for n in range(2, len(levels) + 1):
            history_count = self._climb(n, levels[n - 1], levels, sorted(answers.get(n, []), key=lambda x: x[0]), history_count)
        self.history_count = history_count

    def histories(self, n: int) -> np.ndarray:
        """Code of the n-1 tokens before each token; -1 if one of them is unknown."""
        out = None
        start = np.zeros(len(self.number), np.int64)
        start[self.ends[:-1]] = 1
        place = np.arange(len(self.number)) - np.concatenate([[0], self.ends[:-1]])[np.cumsum(start)]
        for back in range(1, n):
            prior = np.roll(self.number, back)
            prior[place < back] = self.end_number
            code = prior if out is None else (_gram(out, prior) >> np.uint64(1)).astype(np.int64)
            out = code if out is None else np.where((prior < 0) | (out < 0), -1, code)
        return out

    def grams(self, n: int, prior_count: np.ndarray, tokens: int):
        """Distinct n-grams with known history, in order of part, history and word; and each token's n-gram."""
        history = self.histories(n)
        known = np.flatnonzero(history >= 0)
        h, w = history[known], self.number[known]
        prior = np.roll(prior_count, 1)[known]
        start = np.concatenate([[0], self.ends[:-1]])
        first = np.isin(known, start) if n > 1 else None
        prior = np.where(first, self.count[self.ends[0] - 1] if len(self.ends) else 0, prior)
        gram, at, of = np.unique(_gram(h, w), return_index=True, return_inverse=True)
        h, w, prior = h[at], w[at], prior[at]
        hot = prior > tokens / (4 * self.parts)
        code = mix64(np.where(hot, gram, mix64(h.astype(np.uint64))))
        part = _part_of(code, self.parts)
        order = np.lexsort((w, h, part))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return known, rank[of], at[order], h[order], w[order], hot[order], part[order]

    def entries(self, n: int, level_tokens: int) -> list[tuple]:
        """Rows for the parts of level n; the chunk's number is left out."""
        known, of, at, h, w, hot, part = self.grams(n, self.history_count, level_tokens)
        train = np.bincount(of, weights=np.repeat(~self.held, self.counts)[known], minlength=len(h)).astype(np.uint32)
        lower = self.p[known][at]
        edge = np.searchsorted(part, np.arange(self.parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(edge)).tolist():
            cut = slice(edge[p], edge[p + 1])
            own, runs = _runs(h[cut])
            # few different probabilities stand behind many n-grams: they are sent once each
            values, place = np.unique(lower[cut], return_inverse=True)
            kinds = packed(np.concatenate([values.view(np.int64), place]))
            rows.append((p, packed(own), packed(runs.astype(np.uint32)), packed(w[cut]), packed(train[cut] * np.uint32(2) + hot[cut]), len(values).to_bytes(8, "little") + kinds))
        return rows

    def _climb(self, n: int, level: Level, levels: list[Level], answers: list, prior_count: np.ndarray) -> np.ndarray:
        """Probabilities of level n from its answers; returns the counts of the tokens' n-grams."""
        out = np.zeros(len(self.p), np.int64)
        known, of, _, h, _, hot, part = self.grams(n, prior_count, levels[0].tokens)
        if not len(known):
            return out
        edge = np.searchsorted(part, np.arange(self.parts + 1))
        count = np.concatenate([x[1] for x in answers])
        sums = np.zeros((KATZ_K + 3, len(h)))
        for p, _, whole, lower in answers:
            cut = slice(edge[p], edge[p + 1])
            _, runs = _runs(h[cut])
            sums[:-1, cut] = np.repeat(whole.reshape(KATZ_K + 2, -1), runs, axis=1)
            sums[-1, cut] = np.repeat(lower, runs)
        if hot.any():
            sums[:, hot] = level.hot_sums[:, np.searchsorted(level.hot_keys, h[hot])]
        discounted = sums[1] + (level.discount[:, None] * np.arange(1, KATZ_K + 1)[:, None] * sums[2:-1]).sum(0)
        of_h = np.maximum(sums[0], 1)
        room = 1 - sums[-1]
        full = room < 1e-12  # every outcome was seen after this history: nothing to back off to
        # counts over k are not discounted: one more count is set aside for unseen words where less than that is left
        kept = np.minimum(discounted / of_h, of_h / (of_h + 1))
        alpha = np.where(full, 0.0, (1 - kept) / np.where(full, 1, room))
        factor = np.concatenate([[0.0], level.discount, [1.0]])[np.minimum(count, KATZ_K + 1)]
        seen = factor * count / np.maximum(discounted, 1e-300) * np.where(full, 1.0, kept)
        gram_p = np.where(count > 0, seen, np.where(sums[0] > 0, alpha, 1.0))
        backed = count[of] == 0
        self.p = self.p.copy()
        self.p[known] = np.where(backed, gram_p[of] * self.p[known], gram_p[of])
        out[known] = count[of]
        return out


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[first], np.diff(np.append(first, len(x)))


def _word_probability(count: np.ndarray, level: Level) -> np.ndarray:
    """Level 1: discounted relative counts; what is left (or half a count, if nothing is) goes to the unknown outcome."""
    n, hist = level.tokens, level.histogram
    if not n:
        return np.ones(len(count))
    taken = float((hist[:KATZ_K] * np.arange(1, KATZ_K + 1) * (1 - level.discount)).sum()) / n
    unknown = max(taken, 0.5 / (n + 0.5 * (level.distinct + 1)))
    factor = np.concatenate([[0.0], level.discount, [1.0]])[np.minimum(count, KATZ_K + 1)]
    return np.where(count > 0, (1 - unknown) * factor * count / (n * (1 - taken)), unknown)


def _level(answers: DataFrame) -> Level:
    """Add up the parts' histograms (a row each) and the sums of hot histories (at most four a part)."""
    rows = answers.where("kind in (8, 9)").select("kind", "a", "b").collect()
    histogram, hot = np.zeros(KATZ_K + 3, np.int64), {}
    for r in rows:
        if r["kind"] == 9:
            histogram = histogram + unpacked(bytes(r["a"]))
        else:
            sums = unpacked(bytes(r["b"])).reshape(KATZ_K + 3, -1)
            for i, k in enumerate(unpacked(bytes(r["a"])).tolist()):
                hot[k] = hot.get(k, 0) + sums[:, i]
    return Level(histogram, hot)


def score_documents(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Train on the rows where the column expression ``held_out`` is not true, score all rows.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, scores in log10.
    """
    spark = docs.sparkSession
    frame = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), docs[text].cast("string").alias("text"))
    parts = max(shuffle_width(spark), 2 * frame.rdd.getNumPartitions())
    first = stored(_chunks(frame, parts), "katz-chunks")
    chunks = first.where("kind = 0").select(F.lit(0).alias("level"), *_NAMES[:7])
    answers = [stored(first.where("kind = 1").groupBy("part").applyInArrow(_count_words, _ROWS), "katz-1")]
    levels = [_level(answers[0])]
    for n in range(2, order + 1):
        release(spark)
        send = _sender(list(levels), parts, n)
        sent = _gathered(chunks, answers).groupBy("chunk").applyInArrow(send, _ROWS)
        answers.append(stored(sent.groupBy("part").applyInArrow(_count_ngrams, _ROWS), f"katz-{n}"))
        levels.append(_level(answers[-1]))
    release(spark)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _gathered(chunks, answers).groupBy("chunk").applyInArrow(_scorer(levels, parts), schema)


def _gathered(chunks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Every chunk with its answers of all levels so far."""
    out = chunks
    for n, a in enumerate(answers, 1):
        out = out.unionByName(a.where("kind = 10").select(F.lit(n).alias("level"), *_NAMES[:7]))
    return out


def _sender(levels: list[Level], parts: int, n: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        rows = Chunk(table, levels, parts).entries(n, levels[0].tokens)
        return pa.Table.from_batches([_batch([(key[0].as_py(), p, n, *data) for p, *data in rows])])

    return send


def _scorer(levels: list[Level], parts: int):
    def score(key: tuple, table: pa.Table) -> pa.Table:
        c = Chunk(table, levels, parts)
        n, v = levels[0].tokens, levels[0].distinct
        start = np.concatenate([[0], c.ends[:-1]])
        add = lambda x: np.add.reduceat(x, start)
        base = np.log10((c.count + 0.5) / (n + 0.5 * (v + 1)))
        return pa.table({
            "doc_id": pa.array(c.ids, mask=c.there == 0), "held_out": pa.array(c.held), "n_tokens": pa.array(c.counts.astype(np.int64)),
            "n_known": pa.array(add((c.count > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(c.ids), n, np.int64)),
            "base_score": pa.array(add(base)), "score": pa.array(add(np.log10(c.p))),
        })

    return score
