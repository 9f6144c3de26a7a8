"""Token ids of whole texts by a public byte-level BPE vocabulary, encoded once per distinct unit of a task.

The vocabulary's pre-splitting never joins text over a single space (or a single line feed) that stands between two
non-white characters, so a text is cut there into units, each distinct unit is encoded once by ``tokenizers``, and the
ids of a text are its units' ids in order. Distinct units are encoded by the rank form of the same vocabulary, which
gives the ids of ``tokenizers`` with the JSON file (tested) in a sixth of its time; very long units, and texts that
hold the name of a special token, go to ``tokenizers`` itself. The files are parameters, read from the executor's own
installation and never shipped.
"""

from __future__ import annotations

import base64
import os

import numpy as np

from catalogspark.llm.words import SLICE_BYTES, codes, hash_runs

#: Distinct units remembered per task (about 30 bytes each); beyond that, units are encoded again when they recur.
REMEMBERED_UNITS = 1_000_000


#: Units over this many bytes are encoded by ``tokenizers``, whose merge time does not grow with the square of length.
LONG_UNIT = 256


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class UnitEncoder:
    """Ids of texts from remembered units: sorted unit codes, and each unit's place in one long id array."""

    def __init__(self, path: str, remember: int = REMEMBERED_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.encode() for x, i in self.tokenizer.get_vocab().items() if x.startswith("<|") and x.endswith("|>")]
        self.ranks = None
        rank_file = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(rank_file):
            with open(rank_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.width = np.zeros(max(ranks.values()) + 1, np.int64)
            self.width[list(ranks.values())] = [len(x) for x in ranks]
        self.remember = remember
        self.codes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order, and how many each has."""
        out: list = [None] * len(units)
        n = np.zeros(len(units), np.int64)
        joined = [i for i, x in enumerate(units) if self.ranks and x[:1] == b" " and len(x) <= LONG_UNIT]
        flat = np.zeros(0, np.uint32)
        if joined:
            # units that begin with a blank do not join with what stands before them
            try:
                flat = np.array(self.ranks.encode_ordinary(b"".join([units[i] for i in joined]).decode()), np.uint32)
            except UnicodeDecodeError:  # bytes that are no UTF-8: unit by unit below
                joined = []
            else:
                size = np.fromiter((len(units[i]) for i in joined), np.int64, len(joined))
                edge = np.searchsorted(np.cumsum(self.width[flat]), np.cumsum(size)) + 1
                n[joined] = np.diff(edge, prepend=0)
        left = set(joined)
        rest = [i for i in range(len(units)) if i not in left]
        own = [i for i in rest if len(units[i]) > LONG_UNIT or not self.ranks]
        for i, x in zip(own, self.tokenizer.encode_batch_fast([units[i].decode("utf-8", "replace") for i in own], add_special_tokens=False) if own else ()):
            out[i] = x.ids
        for i in rest:
            if out[i] is None:
                out[i] = self.ranks.encode_ordinary(units[i].decode("utf-8", "replace"))
            n[i] = len(out[i])
        if not rest:
            return flat, n
        ends = np.cumsum(n)
        ids = np.zeros(int(ends[-1]), np.uint32)
        mine = np.ones(len(ids), bool)
        for i in rest:
            ids[ends[i] - n[i] : ends[i]] = out[i]
            mine[ends[i] - n[i] : ends[i]] = False
        ids[mine] = flat
        return ids, n

    def _units(self, buf: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
        """Starts of the units of a slice; every row start is one."""
        white = codes().sep[buf]
        inner = ~white[:-2] & ~white[2:] if len(buf) > 2 else np.zeros(0, bool)
        mid = buf[1:-1]
        start = np.zeros(len(buf) + 1, bool)
        if len(inner):
            nxt = buf[2:]
            inner &= (nxt < 0x80) | (nxt > 0xE3) | ((nxt > 0xC2) & (nxt < 0xE1))  # no white space outside ASCII follows
            start[1:-2] |= inner & (mid == 0x20)
            line = inner & (mid == 0x0A)
            start[1:-2] |= line
            start[2:-1] |= line
        start[row_starts] = True
        # a blank next to a row's edge is not between two characters of that row
        for edge in (row_starts - 1, row_starts):
            edge = edge[(edge > 0) & (edge < len(buf))]
            lone = edge[white[edge]]
            lone = lone[~np.isin(lone, row_starts)]
            start[lone] = False
            start[np.setdiff1d(lone[buf[lone] == 0x0A] + 1, row_starts)] = False
        after = row_starts[(row_starts < len(buf) - 1)]
        after = after[buf[after] == 0x0A] + 1
        start[np.setdiff1d(after, row_starts)] = False
        start[0] = True
        return np.flatnonzero(start[: len(buf)])

    def _slice(self, buf: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit starts of a slice, ids per unit, and all ids in order."""
        s = self._units(buf, row_starts)
        e = np.append(s[1:], len(buf))
        unit, first, inverse = np.unique(hash_runs(buf, s, e, codes().raw), return_index=True, return_inverse=True)
        place = np.searchsorted(self.codes, unit)
        known = np.zeros(len(unit), bool)
        if len(self.codes):
            known = self.codes[np.minimum(place, len(self.codes) - 1)] == unit
        at, n = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
        hit = place[known]
        at[known], n[known] = self.at[hit], self.n[hit]
        ids, new = self.ids, np.flatnonzero(~known)
        if len(new):
            flat, size = self._encode([buf[s[i] : e[i]].tobytes() for i in first[new]])
            ids = np.concatenate([self.ids, flat])
            at[new], n[new] = len(self.ids) + np.cumsum(size) - size, size
            if len(self.codes) + len(new) <= self.remember:
                where = place[new]
                self.codes = np.insert(self.codes, where, unit[new])
                self.at = np.insert(self.at, where, at[new])
                self.n = np.insert(self.n, where, n[new])
                self.ids = ids
        n_all, at_all = n[inverse].astype(np.int64), at[inverse]
        ends = np.cumsum(n_all)
        take = np.repeat(at_all - (ends - n_all), n_all) + np.arange(int(ends[-1]) if len(ends) else 0)
        return s, n_all, ids[take]

    def encode_rows(self, data: np.ndarray, bounds: np.ndarray):
        """Yield (row, ids) for consecutive rows; ids are uint32 and whole."""
        limit = SLICE_BYTES
        i, n = 0, len(bounds) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1)
            base, to = int(bounds[i]), int(bounds[j])
            if any(data[base:to].tobytes().find(x) >= 0 for x in self.special):
                for k in range(i, j):
                    text = data[int(bounds[k]) : int(bounds[k + 1])].tobytes().decode("utf-8", "replace")
                    yield k, np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            elif to - base <= limit or to == base:
                starts = np.asarray(bounds[i:j]) - base
                buf = data[base:to]
                filled = starts[starts < len(buf)]
                if len(buf):
                    s, sizes, ids = self._slice(buf, np.unique(filled))
                    edge = np.concatenate([[0], np.cumsum(sizes)])
                    cut = edge[np.searchsorted(s, np.append(starts, len(buf)))]
                else:
                    ids, cut = np.zeros(0, np.uint32), np.zeros(j - i + 1, np.int64)
                for k in range(i, j):
                    yield k, ids[cut[k - i] : cut[k - i + 1]]
            else:
                yield i, self._long(data[base:to], limit)
            i = j

    def _long(self, buf: np.ndarray, limit: int) -> np.ndarray:
        """A row longer than a slice, cut only where units begin."""
        out, at = [], 0
        white = codes().sep
        while at < len(buf):
            to = min(len(buf), at + limit)
            while to < len(buf):
                span = buf[to - 1 : to + 65537]
                w = white[span]
                good = np.flatnonzero((span[1:-1] == 0x20) & ~w[:-2] & ~w[2:] & (span[2:] < 0x80)) if len(span) > 2 else []
                if len(good):
                    to += int(good[0])
                    break
                to = min(len(buf), to + 65536)
            out.append(self._slice(buf[at:to], np.zeros(1, np.int64))[2])
            at = to
        return np.concatenate(out)
