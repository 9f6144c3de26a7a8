"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse as an incremental state machine.

**Sufficient lookahead.** Compare the merging of a text w with that of w followed by anything. Up to some border the two
token sequences agree; it starts at the end of w. Rule (a, b) moves it to the left only where ``a`` stands before it and
``b`` behind it in one of the two, by the length of ``a``. From then on the token behind the border begins, by its chain
of left parts, with ``a``. So the border moves along chains of rules of rising rank in which the left part of a rule is
in the left chain of the next rule's right part; the longest such chain, in bytes, is found in one pass over the merge
list. Tokens that end at least so far before the end of what was read never change: they are emitted, and the rest is
merged anew with what follows. Merging starts afresh at a token border without any difference.

A text is cut into pieces as the vocabulary's pre-tokenizer does (contractions; runs of letters, digits or other marks
with one blank before; white space), vectorised over slices. Distinct short pieces of a slice are merged together, all
in step: in each step every piece applies its lowest rule. Longer pieces go through the transducer in windows. Working
memory is bounded by the slice, the window and the remembered pieces, whatever the length of a text or of a piece; a
text that exceeds a slice is cut where white space begins, else where letters, digits and marks meet, else inside its
piece. Pieces are remembered by 64-bit codes. The class of a character that the running Python does not know is asked from
the pre-tokenizer of ``tokenizers``; cutting and merging are always done here.

Decoding gathers the tokens' bytes and keeps at most three bytes of an unfinished character between blocks.

Defined results: NULL texts are empty; an empty text has no ids; names of special tokens in a text become their ids;
bytes that are no UTF-8 count as U+FFFD; NULL and repeated ids of documents are rows like others; an empty table gives
no rows; other columns, whatever their names, are ignored (``digests``) or carried along (``encode``, ``decode``).
Unknown ids decode to nothing, NULL ids and NULL arrays to the empty text.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.shared import named_back, place_of, renamed
from catalogspark.llm.tokens import vocabulary_path
from catalogspark.llm.words import codes, hash_runs, text_bytes

#: Bytes worked on together, and bytes of a long piece merged together.
SLICE = 1 << 20
WINDOW = 4096
#: Pieces up to this many bytes are merged in step with others.
SHORT = 48
#: Distinct pieces remembered per task.
REMEMBERED = 1_000_000

_LETTER, _DIGIT, _MARK, _WHITE, _EDGE = range(5)
_NONE = np.int32(0x7FFFFFFF)
_WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def sufficient_lookahead(rules: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which a token border is final, for a merge list in order of rank."""
    left = {a + b: a for a, b in rules}
    reach: dict[bytes, int] = {}
    most = 0
    for a, b in rules:
        far, part = 0, b
        while part is not None:
            far = max(far, reach.get(part, 0))
            part = left.get(part)
        far += len(a)
        reach[a] = max(reach.get(a, 0), far)
        most = max(most, far)
    return most


class Merges:
    """A byte-level BPE vocabulary read from its file: merge rules, token bytes, special tokens, lookahead."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not spec["normalizer"] and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        if not plain or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        raw = lambda s: bytes(byte_of[c] for c in s)
        vocab = model["vocab"]
        added = spec["added_tokens"]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError(f"{path}: special tokens that change their surroundings")
        self.special = {x["content"].encode(): x["id"] for x in added}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for s, i in vocab.items():
            self.token_bytes[i] = raw(s) if all(c in byte_of for c in s) else s.encode()
        for s, i in self.special.items():
            self.token_bytes[i] = s
        self.byte_id = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.product = np.array([vocab[a + b] for a, b in rules], np.int32)
        self.lookahead = sufficient_lookahead([(raw(a), raw(b)) for a, b in rules])
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in rules], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], np.int64(2**63 - 1)), np.append(order.astype(np.int32), _NONE)
        self.rank_of = dict(zip(keys.tolist(), range(len(rules))))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge_in_step(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces, in order, and how many each has."""
        n = ends - starts
        first = np.cumsum(n) - n
        at = np.repeat(starts - first, n) + np.arange(int(n.sum()))
        ids = self.byte_id[buf[at]]
        piece, last = np.arange(len(n)), np.zeros(len(ids), bool)
        last[first + n - 1] = True
        rank = np.append(self.rank(ids[:-1], ids[1:]), _NONE)
        rank[last] = _NONE
        told_piece, told_n, told_ids = [], [], []
        while len(n):
            low = np.minimum.reduceat(rank, first)
            done = low == _NONE
            if done.any():
                of = np.repeat(done, n)
                told_piece.append(piece[done]), told_n.append(n[done]), told_ids.append(ids[of])
                ids, rank, last = ids[~of], rank[~of], last[~of]
                piece, n, low = piece[~done], n[~done], low[~done]
                first = np.cumsum(n) - n
                if not len(n):
                    break
            hit = rank == np.repeat(low, n)
            chained = hit[1:] & hit[:-1]
            if chained.any():  # a run of equal tokens pairs up from its left
                place = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, 0))
                hit &= (place - begin) % 2 == 0
            at = np.flatnonzero(hit)
            ids[at] = self.product[rank[at]]
            last[at] |= last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            n = n - np.add.reduceat(hit, first, dtype=np.int64)
            first = np.cumsum(n) - n
            ids, rank, last = ids[keep], rank[keep], last[keep]
            at = (np.cumsum(keep) - 1)[at]
            at = np.concatenate([at, at[at > 0] - 1])
            fresh = self.rank(ids[at], ids[np.minimum(at + 1, len(ids) - 1)])
            fresh[last[at]] = _NONE
            rank[at] = fresh
        piece, n, ids = np.concatenate(told_piece), np.concatenate(told_n), np.concatenate(told_ids)
        order = np.argsort(piece)
        begin = (np.cumsum(n) - n)[order]
        n = n[order]
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return ids[at], n

    def merge_window(self, data: bytes) -> list[int]:
        """Ids of one window, by a queue of its pairs."""
        if not data:
            return []
        ids = self.byte_id[np.frombuffer(data, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get, product = self.rank_of.get, self.product
        queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i] << 32) | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i, a, b = heapq.heappop(queue)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two is part of another token by now
            made = int(product[r])
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get((made << 32) | ids[k])) is not None:
                    heapq.heappush(queue, (r, i, made, ids[k]))
            p = before[i]
            if p >= 0 and (r := get((ids[p] << 32) | made)) is not None:
                heapq.heappush(queue, (r, p, ids[p], made))
        return [x for x in ids if x >= 0]


class PieceTransducer:
    """One piece of any length: bytes in, tokens out as soon as nothing that follows can change them."""

    def __init__(self, merges: Merges, window: int = WINDOW) -> None:
        self.merges, self.window = merges, max(window, 2 * merges.lookahead + 256)
        self.held = bytearray()

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), self.window):
            self.held += data[at : at + self.window]
            if len(self.held) >= self.window:
                ids = self.merges.merge_window(bytes(self.held))
                stable, n = 0, 0
                for i in ids:
                    size = len(self.merges.token_bytes[i])
                    if stable + size > len(self.held) - self.merges.lookahead:
                        break
                    stable, n = stable + size, n + 1
                out += ids[:n]
                del self.held[:stable]
        return out

    def finish(self) -> list[int]:
        out = self.merges.merge_window(bytes(self.held))
        self.held.clear()
        return out


class Encoder:
    """Ids of whole texts; remembers the ids of distinct short pieces."""

    def __init__(self, path: str, remember: int = REMEMBERED, limit: int = SLICE) -> None:
        self.merges = Merges(path)
        self.remember, self.limit = remember, limit
        self.kind = np.full(0x110000, 255, np.uint8)
        self.kind[_WHITE_SPACE] = _WHITE
        self.codes, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _kinds(self, point: np.ndarray) -> np.ndarray:
        kind = self.kind[point]
        new = np.unique(point[kind == 255])
        if len(new):
            of = {"L": _LETTER, "N": _DIGIT}
            for c in new.tolist():
                name = unicodedata.category(chr(c))
                self.kind[c] = self._asked(chr(c)) if name == "Cn" else of.get(name[0], _MARK)
            kind = self.kind[point]
        return kind

    @staticmethod
    def _asked(char: str) -> int:
        """The class whose runs a character joins in ``tokenizers``."""
        from tokenizers import pre_tokenizers

        cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return next((kind for kind, lead in ((_LETTER, "a"), (_DIGIT, "1"), (_MARK, "!")) if len(cut.pre_tokenize_str(lead + char)) == 1), _WHITE)

    def _starts(self, buf: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Byte offsets at which the pieces of a slice begin; ``rows`` are the offsets at which its texts do."""
        point = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
        offset = np.flatnonzero((buf & 0xC0) != 0x80)
        kind = self._kinds(point)
        head = np.zeros(len(point) + 1, bool)  # texts begin here; the end of the slice counts
        head[np.searchsorted(offset, rows)] = True
        head[-1] = True
        start = head[:-1].copy()
        start[1:] |= kind[1:] != kind[:-1]
        white = kind == _WHITE
        next_kind = np.append(kind[1:], _EDGE)
        next_kind[head[1:]] = _EDGE
        # the last of several white characters before something else is on its own, or leads it if it is a blank
        final = white & (next_kind != _WHITE) & (next_kind != _EDGE)
        start |= final
        led = np.append(False, (final & (point == 0x20))[:-1])
        start &= ~led | head[:-1]
        mark = np.flatnonzero(start & (point == 0x27))
        if len(mark):  # contractions
            pad = np.append(point, np.zeros(3, np.uint32))
            edge = np.append(head, np.ones(3, bool))
            one, two = pad[mark + 1], pad[mark + 2]
            in_one, in_two = ~edge[mark + 1], ~edge[mark + 1] & ~edge[mark + 2]
            short = in_one & np.isin(one, [ord(c) for c in "stmd"])
            pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
            long = in_two & np.any([(one == a) & (two == b) for a, b in pairs], axis=0)
            for at, size in ((mark[short], 2), (mark[long], 3)):
                start[at + 1] = False
                nxt = at + size
                start[nxt[nxt < len(start)]] = True
        return offset[start]

    def _encode(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        short = e - s <= SHORT
        if short.all():
            return self.merges.merge_in_step(buf, s, e)
        n, parts = np.zeros(len(s), np.int64), {}
        if short.any():
            flat, n[short] = self.merges.merge_in_step(buf, s[short], e[short])
        for i in np.flatnonzero(~short).tolist():
            machine = PieceTransducer(self.merges)
            ids = machine.feed(buf[s[i] : e[i]].tobytes()) + machine.finish()
            parts[i], n[i] = ids, len(ids)
        end = np.cumsum(n)
        out, mine = np.zeros(int(end[-1]), np.int32), np.ones(int(end[-1]), bool)
        for i, ids in parts.items():
            out[end[i] - n[i] : end[i]] = ids
            mine[end[i] - n[i] : end[i]] = False
        if short.any():
            out[mine] = flat
        return out, n

    def _slice(self, buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice, and how many stand before each of its texts and before its end."""
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(rows) + 1, np.int64)
        s = self._starts(buf, np.unique(rows[rows < len(buf)]))
        e = np.append(s[1:], len(buf))
        unit, first, inverse = np.unique(hash_runs(buf, s, e, codes().raw), return_index=True, return_inverse=True)
        place = np.searchsorted(self.codes, unit)
        known = np.zeros(len(unit), bool)
        if len(self.codes):
            known = self.codes[np.minimum(place, len(self.codes) - 1)] == unit
        at, n, ids = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64), self.ids
        at[known], n[known] = self.at[place[known]], self.n[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            flat, size = self._encode(buf, s[first[new]], e[first[new]])
            n[new], at[new] = size, len(ids) + np.cumsum(size) - size
            ids = np.concatenate([ids, flat])
            if len(self.codes) + len(new) <= self.remember and len(ids) <= 8 * self.remember:
                where = place[new]
                self.codes, self.at, self.n = (np.insert(a, where, b[new]) for a, b in ((self.codes, unit), (self.at, at), (self.n, n)))
                self.ids = ids
        n = n[inverse]
        end = np.cumsum(n)
        take = np.repeat(at[inverse] - (end - n), n) + np.arange(int(end[-1]))
        edge = np.append(0, end)
        return ids[take], edge[np.searchsorted(s, np.append(rows, len(buf)))]

    def _cut(self, buf: np.ndarray) -> int:
        """The last byte of a slice at which its text can be cut into two that are encoded on their own; 0 if none."""
        offset = np.flatnonzero((buf & 0xC0) != 0x80)
        offset = offset[:-1] if len(offset) > 1 else offset  # the last character may be cut
        point = np.frombuffer(buf[: offset[-1]].tobytes().decode().encode("utf-32-le"), np.uint32)
        if len(point) < 2:
            return 0
        kind = self._kinds(point)
        good = np.flatnonzero((kind[1:] == _WHITE) & (kind[:-1] != _WHITE)) + 1
        if not len(good):
            quiet = point != 0x27
            good = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != _WHITE) & (kind[:-1] != _WHITE) & quiet[:-1] & quiet[1:]) + 1
        return int(offset[good[-1]]) if len(good) else 0

    def _run(self, buf: np.ndarray) -> Iterator[np.ndarray]:
        """A text of one piece, or of a run of characters that is longer than a slice and what follows."""
        said = buf[:3].tobytes()
        if said[:2] in (b"'s", b"'t", b"'m", b"'d") or said in (b"'re", b"'ve", b"'ll"):
            size = 2 if said[1:2] in b"stmd" else 3
            yield self._slice(buf[:size], np.zeros(1, np.int64))[0]
            yield from self.blocks(buf[size:])
            return
        machine = PieceTransducer(self.merges)
        at, kind = 0, None
        while at < len(buf):
            to = min(len(buf), at + self.limit)
            while to < len(buf) and buf[to] & 0xC0 == 0x80:
                to += 1
            part = buf[at:to]
            point = np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32)
            offset = np.append(np.flatnonzero((part & 0xC0) != 0x80), len(part))
            kinds = self._kinds(point)
            if kind is None:
                lead = int(len(point) > 1 and point[0] == 0x20 and kinds[1] != _WHITE)
                kind = kinds[lead]
            else:
                lead = 0
            other = np.flatnonzero(kinds[lead:] != kind)
            if len(other):
                end = lead + int(other[0])
                if kind == _WHITE and at + end > 1:
                    end -= 1  # the last one leads what follows, or is on its own
                yield np.array(machine.feed(part[: offset[end]].tobytes()) + machine.finish(), np.int32)
                yield from self.blocks(buf[at + int(offset[end]) :])
                return
            # of white space, one character stays back: it may belong to what follows
            stop = offset[-2] if kind == _WHITE and to < len(buf) else offset[-1]
            yield np.array(machine.feed(part[:stop].tobytes()), np.int32)
            at += int(stop)
        yield np.array(machine.finish(), np.int32)

    def blocks(self, buf: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of one text without special tokens, in blocks."""
        while len(buf) > self.limit:
            cut = self._cut(buf[: self.limit])
            if not cut:
                yield from self._run(buf)
                return
            yield self._slice(buf[:cut], np.zeros(1, np.int64))[0]
            buf = buf[cut:]
        if len(buf):
            yield self._slice(buf, np.zeros(1, np.int64))[0]

    def _text(self, buf: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of one text, in blocks; special tokens are found first, from the left, the longest of those that begin together."""
        at, data = 0, buf.tobytes() if self.merges.special else b""
        while True:
            found = [(i, -len(name), name) for name in self.merges.special if (i := data.find(name, at)) >= 0]
            if not found:
                yield from self.blocks(buf[at:])
                return
            i, _, name = min(found)
            yield from self.blocks(buf[at:i])
            yield np.array([self.merges.special[name]], np.int32)
            at = i + len(name)

    def rows(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) in order of rows; a row comes in one or more blocks."""
        i, n = 0, len(bounds) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + self.limit, side="right")) - 1)
            buf = data[int(bounds[i]) : int(bounds[j])]
            whole = buf.tobytes()
            try:
                whole.decode()
                alone = len(buf) > self.limit or any(name in whole for name in self.merges.special)
            except UnicodeDecodeError:
                alone = True
            if alone:
                for k in range(i, j):
                    text = data[int(bounds[k]) : int(bounds[k + 1])].tobytes().decode("utf-8", "replace").encode()
                    yield k, np.zeros(0, np.int32)
                    yield from ((k, ids) for ids in self._text(np.frombuffer(text, np.uint8)))
            else:
                ids, edge = self._slice(buf, np.asarray(bounds[i:j]) - int(bounds[i]))
                for k in range(i, j):
                    yield k, ids[edge[k - i] : edge[k - i + 1]]
            i = j


class ByteToText:
    """Ids in, text out: the bytes of an unfinished character (three at most) wait for the next block."""

    def __init__(self, merges: Merges) -> None:
        self.bytes_of = dict(enumerate(merges.token_bytes))
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        get = self.bytes_of.get
        return self.state.decode(b"".join([get(i, b"") for i in ids]))

    def finish(self) -> str:
        out = self.state.decode(b"", True)
        self.state.reset()
        return out


def _carried(df: DataFrame, column: str, cast: str, told: str, fn, into: str) -> DataFrame:
    """``fn`` over the batches' last column, its result beside all columns of ``df`` under the name ``into``."""
    inner = renamed(df).select("*", F.col(place_of(df, column)).cast(cast).alias("_in"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[:-1]) + f", _told {told}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], work(batch.column(batch.num_columns - 1))], [*batch.schema.names[:-1], "_told"])

    return inner.mapInArrow(run, schema).select(*named_back(df), F.col("_told").alias(into))


def encode(docs: DataFrame, text: str = "text", into: str = "ids", path: str | None = None) -> DataFrame:
    """All columns of ``docs`` and the token ids of each whole text."""
    file = path or vocabulary_path()

    def start():
        encoder = Encoder(file)

        def work(column: pa.Array) -> pa.Array:
            data, bounds = text_bytes(column)
            size, parts = np.zeros(len(bounds) - 1, np.int64), []
            for row, ids in encoder.rows(data, bounds):
                size[row] += len(ids)
                parts.append(ids)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(flat, pa.int32()))

        return work

    return _carried(docs, text, "string", "array<int>", start, into)


def decode(rows: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """All columns of ``rows`` and the text of their token ids."""
    file = path or vocabulary_path()

    def start():
        merges = Merges(file)

        def work(column: pa.Array) -> pa.Array:
            out = []
            for got in column:
                machine = ByteToText(merges)
                told = [x for x in got.as_py() or [] if x is not None]
                parts = [machine.feed(told[at : at + SLICE]) for at in range(0, len(told), SLICE)]
                out.append("".join([*parts, machine.finish()]))
            return pa.array(out, pa.string())

        return work

    return _carried(rows, ids, "array<int>", "string", start, into)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text runs through encoder and decoder block by block."""
    file = path or vocabulary_path()
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file)
        decimal = [str(i) for i in range(len(encoder.merges.token_bytes))]
        machine = ByteToText(encoder.merges)
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            count = np.zeros(batch.num_rows, np.int64)
            ids_sha, text_sha, row = [], [], -1

            def finish() -> None:
                text_hash.update(machine.finish().encode())
                ids_sha.append(ids_hash.hexdigest()), text_sha.append(text_hash.hexdigest())

            for k, ids in encoder.rows(data, bounds):
                if k != row:
                    if row >= 0:
                        finish()
                    row, ids_hash, text_hash = k, hashlib.sha256(), hashlib.sha256()
                if len(ids):
                    told = ids.tolist()
                    ids_hash.update((("," if count[k] else "") + ",".join([decimal[i] for i in told])).encode())
                    text_hash.update(machine.feed(told).encode())
                    count[k] += len(told)
            if row >= 0:
                finish()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
