"""Vectorised word codes for Arrow batches: 64-bit codes of words and word shingles, one numpy pass per slice.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Equal words have equal codes;
different words collide with a chance of about 2^-64 per pair. Texts are whole: a long text is walked in slices that
end at a separator, and only its codes are kept. NULL texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on together; a single longer text forms a group of its own.
GROUP_BYTES = 4 << 20
#: Bytes per numpy slice inside a group.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class _Codes:
    """Powers of the odd base and its inverse, grown on demand, and the byte tables."""

    def __init__(self) -> None:
        rng = np.random.Generator(np.random.PCG64(20240607))
        self.raw = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.low = self.raw.copy()
        self.low[65:91] = self.low[97:123]
        self.sep = np.zeros(256, bool)
        self.sep[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        # letters, digits and everything outside ASCII make plain words
        self.mark = np.ones(256, bool)
        self.mark[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
        self.pow = self.inv = np.ones(0, np.uint64)

    def __reduce__(self) -> tuple:
        return _Codes, ()  # tables are made again where they are needed

    def upto(self, n: int) -> None:
        if len(self.pow) < n:
            n = max(n, SLICE_BYTES)
            for name, base in (("pow", _BASE), ("inv", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base & _MASK, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_STATE: list[_Codes] = []


def codes() -> _Codes:
    if not _STATE:
        _STATE.append(_Codes())
    return _STATE[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and n+1 offsets into them; NULL counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n, (_, offsets, data) = len(column), column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def groups(bounds: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [i, j) that hold at most ``limit`` bytes together, or one longer row."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _slices(buf: np.ndarray, starts: np.ndarray, sep: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a byte range at separators or row starts into slices of about ``limit`` bytes."""
    at, n = 0, len(buf)
    while at < n:
        to = min(n, at + limit)
        while to < n:
            cut = np.flatnonzero(sep[buf[to : to + 65536]])
            row = starts[np.searchsorted(starts, to)] if len(starts) and starts[-1] >= to else n
            near = to + int(cut[0]) if len(cut) else to + 65536
            if row <= near or len(cut):
                to = min(row, near, n)
                break
            to = min(n, to + 65536)
        yield at, to
        at = to


def hash_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes of the byte runs [start, end) of a slice."""
    c = codes()
    c.upto(len(buf))
    sums = np.cumsum(table[buf] * c.pow[: len(buf)], dtype=np.uint64)
    before = np.where(starts > 0, sums[np.maximum(starts - 1, 0)], np.uint64(0))
    return mix64((sums[ends - 1] - before) * c.inv[starts])


def word_codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of consecutive rows and the number of words of each row."""
    found, at, _ = placed_words(data, bounds, codes().sep)
    return found, np.diff(np.searchsorted(at, np.asarray(bounds) - int(bounds[0])))


def placed_words(data: np.ndarray, bounds: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, starts and ends (from the first row's start) of the runs of bytes that are no separators."""
    c = codes()
    first, last = int(bounds[0]), int(bounds[-1])
    buf, row_starts = data[first:last], np.asarray(bounds[:-1]) - first
    found, places, stops = [], [], []
    for a, b in _slices(buf, row_starts, sep, SLICE_BYTES):
        part = buf[a:b]
        word = ~sep[part]
        cut = np.zeros(len(part) + 1, bool)
        cut[0] = cut[-1] = True
        lo, hi = np.searchsorted(row_starts, [a, b])
        cut[row_starts[lo:hi] - a] = True
        head = word.copy()
        head[1:] &= ~word[:-1] | cut[1:-1]
        tail = word.copy()
        tail[:-1] &= ~word[1:] | cut[1:-1]
        s, e = np.flatnonzero(head), np.flatnonzero(tail) + 1
        if len(s):
            found.append(hash_runs(part, s, e, c.low))
            places.append(s + a)
            stops.append(e + a)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(places), np.concatenate(stops)


def prefix_codes(data: np.ndarray, first: int, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the first ``length`` (at most 7) bytes of the words that are longer, A-Z lower-cased, and those words' indexes.

    ``starts`` and ``ends`` count from byte ``first`` of ``data``.
    """
    index = np.flatnonzero(ends - starts > length)
    at = starts[index] + first
    value = np.full(len(index), length, np.uint64)
    for j in range(length):
        byte = data[at + j]
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        value |= byte.astype(np.uint64) << np.uint64(8 * (j + 1))
    return mix64(value), index


def shingle_codes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all ``width``-word shingles, row after row, and how many each row has (repeats included).

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    n_rows = len(counts)
    ends = np.cumsum(counts)
    out_counts = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    factor = [np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)) for j in range(width)]
    length = np.uint64(0xA0761D6478BD642F)
    total = len(words)
    if total >= width:
        full = np.zeros(total - width + 1, np.uint64)
        for j in range(width):
            full += words[j : total - width + 1 + j] * factor[j]
        full += np.uint64(int(length) * width & _MASK)
        row = np.repeat(np.arange(n_rows), counts)
        keep = row[: total - width + 1] == row[width - 1 :]
        long_codes = mix64(full[keep])
    else:
        long_codes = np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if not len(short):
        return long_codes, out_counts
    out = np.zeros(int(out_counts.sum()), np.uint64)
    at = np.cumsum(out_counts) - out_counts
    is_short = np.zeros(len(out), bool)
    is_short[at[short]] = True
    for i in short:
        m, e = int(counts[i]), int(ends[i])
        value = (words[e - m : e] * np.array(factor[:m], np.uint64)).sum(dtype=np.uint64, keepdims=True)
        out[at[i]] = mix64(value + np.uint64(int(length) * m & _MASK))[0]
    out[~is_short] = long_codes
    return out, out_counts
