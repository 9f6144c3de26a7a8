"""Licence scan: a trained paragraph classifier names licence families, template comparison confirms them.

Paragraphs end at lines of white space alone or with the row, so a notice wrapped over several lines is one paragraph.
They are cut into blocks of ``BLOCK`` words; every two neighbouring blocks of a paragraph are a window, so every word of
every text is seen twice. Features are the different words and word pairs of a window (letters and digits, A-Z lower-cased;
a pair belongs to the block of its first word). The classifier is a softmax regression over the families and an unknown class, trained on
variants of the templates (words dropped, cropped, ordinary text around), on paraphrases of their names, and on windows
of at most ``SAMPLE_DOCS`` documents, lines that only sound like licences and denials ("not licensed under ..") as
unknown; a temperature fitted on held-out texts calibrates the probabilities. A window whose most probable class is a
family, at ``ACCEPT`` or more, proposes that family, and the others that are more probable there than unknown.

What is proposed is compared with the templates of the family: a shortest run of words that holds at least ``CONFIRM``
of the word pairs of one of them, and touches a window that proposes the family, is a confirmed notice (``licences``).
Of runs in the same place the one with the larger share of its template is kept; another family's beside it only if it
has pairs of its own there and is either whole or no near copy of the kept one's template. Windows that name a family at
``SUSPECT`` or more where none of its notices is confirmed stay visible as ``suspected``, neighbours together.

Families and templates are parameters; the default set quotes the opening or naming phrases of common public licences.

Defined results: NULL and empty texts have no licence (empty lists); repeated rows are scanned each; rows without id are
scanned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.words import codes, groups, mix64, placed_words, text_bytes

BLOCK = 20
#: Least probability of a proposal and of one that is told without confirmation; least share of a template's word pairs.
ACCEPT, SUSPECT = 0.5, 0.8
CONFIRM = 0.8
#: Documents and windows per document that ordinary training paragraphs are drawn from.
SAMPLE_DOCS = 1_000
SAMPLE_WINDOWS = 4
#: Variants of a template, and of a sentence around a name.
VARIANTS, REPEATS = 40, 4

# Naming and opening phrases of public licences.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Released under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "GNU Affero General Public License as published by the Free Software Foundation"],
    "BSD": [
        "Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, Version 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Lines that name licences or copying without granting any.
ORDINARY = [
    "A valid driving license is required for this position.", "The restaurant was licensed to sell beer and wine.", "All rights reserved.",
    "Please read the terms of service and the privacy policy.", "The general public was invited to the hearing.", "Version 2.0 was released in spring.",
    "He holds a pilot license and a degree in law.", "The fishing license costs ten dollars.", "Copyright is held by the respective owners.",
    "The software foundation published its yearly report.", "Permission to film was granted by the city.", "This work was published in 2004.",
]


# Names by which the families are called, as they are written in sentences and after "SPDX-License-Identifier:".
NAMES: dict[str, tuple[list[str], list[str]]] = {
    "MIT": (["MIT License", "MIT licence"], ["MIT"]),
    "Apache-2.0": (["Apache License 2.0", "Apache licence, version 2.0", "Apache 2 license"], ["Apache-2.0"]),
    "GPL-3.0": (["GNU GPL version 3", "GPLv3", "version 3 of the GNU GPL", "GNU General Public License version 3"], ["GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0"]),
    "GPL-2.0": (["GNU GPL version 2", "GPLv2", "version 2 of the GNU GPL", "GNU General Public License version 2"], ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0"]),
    "LGPL": (["GNU LGPL", "Lesser GPL", "GNU Lesser General Public License"], ["LGPL-2.1-only", "LGPL-3.0-or-later"]),
    "AGPL-3.0": (["GNU AGPL", "Affero GPL", "GNU Affero General Public License"], ["AGPL-3.0-only", "AGPL-3.0-or-later"]),
    "BSD": (["BSD license", "BSD 3-Clause License", "2-clause BSD licence"], ["BSD-3-Clause", "BSD-2-Clause"]),
    "MPL-2.0": (["Mozilla Public License 2.0", "MPL version 2.0"], ["MPL-2.0"]),
    "CC-BY": (["CC BY 4.0", "Creative Commons Attribution license"], ["CC-BY-4.0"]),
    "CC-BY-SA": (["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike license"], ["CC-BY-SA-4.0"]),
    "CC-BY-NC": (["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial license"], ["CC-BY-NC-4.0"]),
    "CC0": (["CC0 1.0", "CC0 public domain dedication"], ["CC0-1.0"]),
    "ISC": (["ISC License", "ISC licence"], ["ISC"]),
    "Unlicense": (["Unlicense"], ["Unlicense"]),
}
#: Sentences around a name that grant, and that deny.
GRANTS = ["The {} applies.", "Distributed under the {}.", "All code is available under the terms of the {}.", "You may use this under the {}, as published.", "This package uses the {}.",
          "License: {}", "Everything here is licensed under {}.", "{} licensed.", "All code is {} licensed.", "under the terms of {}, as the foundation published it"]
DENIALS = ["This is not licensed under the {}.", "This is not licensed under {}.", "It is not released under the {}.", "No longer under the {}.", "This work is not under the {}.", "This is not covered by the {}.", "The {} does not apply."]
#: Words that count as features in pairs only.
PAIRED = ["not", "no", "does"]


@dataclass
class LicenceModel:
    """Sorted feature codes with a row of weights each, a bias per class (unknown last), and template word pairs."""

    families: list[str]
    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[tuple[int, np.ndarray]]


def _grams(word: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Codes of the pair of each word with the next one of its paragraph; 0 for the last word of a paragraph."""
    pair = mix64(word[:-1] * np.uint64(0x9FB21C651E98DF25) + word[1:])
    return np.append(np.where(line[:-1] == line[1:], pair, np.uint64(0)), np.uint64(0)) if len(word) else np.zeros(0, np.uint64)


def _words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of some texts and the index of the text each belongs to."""
    data, bounds = text_bytes(pa.array(texts, pa.large_string()))
    word, at, _ = placed_words(data, bounds, codes().mark)
    return word, np.searchsorted(bounds - bounds[0], at, side="right") - 1


def _variants(templates: dict[str, list[str]], names: dict[str, tuple[list[str], list[str]]], ordinary: list[str], rng: np.random.Generator) -> tuple[list[str], list[int]]:
    texts, kinds = [], []

    def add(words: list[str], kind: int, n: int) -> None:
        around = ordinary[rng.integers(len(ordinary))].split() if ordinary else []
        cut = int(rng.integers(0, len(around) + 1)) if n % 2 and around else 0
        texts.append(" ".join(around[:cut][-12:] + words + (around[cut:][:12] if n % 4 == 1 else [])))
        kinds.append(kind)

    for k, family in enumerate(templates):
        for template in templates[family]:
            words = template.split()
            for n in range(VARIANTS):
                kept = [w for w in words if n < 4 or rng.random() > 0.06]
                if n % 5 == 4 and len(kept) > 10:  # the part that a window may hold
                    half = len(kept) * 2 // 3
                    kept = kept[:half] if n % 2 else kept[-half:]
                add(kept, k, n)
        spoken, written = names.get(family, ([], []))
        for n in range(REPEATS):
            for name in spoken:
                for grant in GRANTS:
                    add(grant.format(name).split(), k, n)
            for name in written:
                add(["SPDX-License-Identifier:", name], k, n)
            for denied in [*spoken, *written]:
                add(DENIALS[n % len(DENIALS)].format(denied).split(), len(templates), n)
    return texts, kinds


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(ordinary: list[str], templates: dict[str, list[str]] | None = None, seed: int = 7, steps: int = 200, l2: float = 1e-5,
          names: dict[str, tuple[list[str], list[str]]] | None = None) -> LicenceModel:
    """Fit classifier and temperature; ``ordinary`` are paragraphs without a licence. ``names`` are for own templates."""
    names = (NAMES if templates is None else {}) if names is None else names
    templates = TEMPLATES if templates is None else templates
    rng = np.random.default_rng(seed)
    families = list(templates)
    pairs = []
    for k, family in enumerate(families):
        for text in templates[family]:
            word, line = _words_of([text])
            pairs.append((k, np.unique(_grams(word, line)[:-1])))
    # a drawn paragraph that holds a template is no ordinary one
    plain = []
    for text in ordinary:
        word, line = _words_of([text])
        own = _grams(word, line)
        if all(np.isin(t, own).mean() < 0.5 for _, t in pairs):
            plain.append(text)
    texts, kinds = _variants(templates, names, plain, rng)
    extra = [*ORDINARY * (VARIANTS // 4), ""]
    texts, kinds = [*texts, *plain, *extra], np.array(kinds + [len(families)] * (len(plain) + len(extra)))
    word, line = _words_of(texts)
    gram = _grams(word, line)
    called = [text.format(name) for spoken, written in names.values() for name in [*spoken, *written] for text in [*GRANTS, *DENIALS, "SPDX-License-Identifier: {}"]]
    known = np.unique(np.concatenate([np.concatenate([w, _grams(w, n)]) for w, n in [_words_of([t for v in templates.values() for t in v] + ORDINARY + called)]]))
    known = np.setdiff1d(known[known > 0], _words_of(PAIRED)[0])
    value = np.concatenate([word, gram])
    row = np.concatenate([line, line])
    place = np.minimum(np.searchsorted(known, value), len(known) - 1)
    hit = known[place] == value
    row, col = row[hit], place[hit]
    n_class = len(families) + 1
    w, b = np.zeros((len(known), n_class), np.float32), np.zeros(n_class, np.float32)
    held = rng.random(len(texts)) < 0.2
    target = np.eye(n_class, dtype=np.float32)[kinds]
    m = [np.zeros_like(w), np.zeros_like(b)]
    v = [np.zeros_like(w), np.zeros_like(b)]

    x = np.zeros((len(texts), len(known)), np.float32)
    x[row, col] = 1
    x_fit, fit_target = x[~held], target[~held]

    for t in range(1, steps + 1):
        g = (_softmax(x_fit @ w + b) - fit_target) / max(1, len(x_fit))
        g_w = x_fit.T @ g
        for i, (p, gr) in enumerate(((w, g_w + l2 * w), (b, g.sum(0)))):
            m[i] = 0.9 * m[i] + 0.1 * gr
            v[i] = 0.99 * v[i] + 0.01 * gr * gr
            p -= 0.1 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-9)
    z, y = x[held] @ w + b, kinds[held]
    grid = np.exp(np.linspace(np.log(0.3), np.log(5), 40))
    loss = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return LicenceModel(families, known, w, b, float(grid[int(np.argmin(loss))]) if len(y) else 1.0, pairs)


def sample_paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """At most SAMPLE_DOCS * SAMPLE_WINDOWS windows of 40 words, spread over the sampled documents' whole texts."""
    frame = docs.where(docs[text].isNotNull()).select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    ids = frame.select(F.xxhash64("id").alias("h")).orderBy("h").limit(SAMPLE_DOCS)  # broadcast: SAMPLE_DOCS longs
    chosen = frame.select("text", F.xxhash64("id").alias("h")).join(F.broadcast(ids.distinct()), "h")
    words = F.split("text", r"\s+")
    step = F.greatest(F.lit(40), F.floor(F.size("w") / SAMPLE_WINDOWS))
    starts = F.slice(F.sequence(F.lit(1), F.size("w"), step.cast("int")), 1, SAMPLE_WINDOWS)
    cut = chosen.select("h", words.alias("w")).select("h", F.transform(starts, lambda s: F.array_join(F.slice("w", s, F.lit(40)), " ")).alias("p"))
    rows = cut.select("h", F.explode("p").alias("p")).orderBy("h", "p").limit(SAMPLE_DOCS * SAMPLE_WINDOWS).collect()
    return [r["p"] for r in rows]


def _paragraphs(buf: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A number per word that grows at every line of white space alone and at every row."""
    feeds = np.flatnonzero(buf == 0x0A)
    if not len(feeds):
        return row
    filled = np.maximum.reduceat(((buf != 0x20) & ((buf < 0x09) | (buf > 0x0D))).view(np.uint8), feeds)
    return np.searchsorted(feeds[1:][filled[:-1] == 0], at) + row


def _runs(place: np.ndarray, pair: np.ndarray, need: int) -> Iterator[tuple[int, int, int]]:
    """Disjoint runs ``first, last, pairs`` of the places: the shortest with the most different pairs, then what is left beside it."""
    todo = [(0, len(place))]
    while todo:
        lo, hi = todo.pop()
        want = len(set(pair[lo:hi].tolist()))
        if want < need:
            continue
        held: dict[int, int] = {}
        best, i = (lo, hi - 1), lo
        for j in range(lo, hi):
            held[int(pair[j])] = held.get(int(pair[j]), 0) + 1
            while len(held) == want:
                if place[j] - place[i] < place[best[1]] - place[best[0]]:
                    best = i, j
                g = int(pair[i])
                held[g] -= 1
                if not held[g]:
                    del held[g]
                i += 1
        yield int(place[best[0]]), int(place[best[1]]), want
        todo += [(lo, best[0]), (best[1] + 1, hi)]


def _candidates(model: LicenceModel, gram: np.ndarray, line: np.ndarray) -> list[tuple[int, int, int, float]]:
    """``template, first word, last pair's word, share`` of every run of words that confirms a template."""
    first = np.concatenate([[True], line[1:] != line[:-1]])
    line_start = np.flatnonzero(first)[np.cumsum(first) - 1]
    block_first = first | ((np.arange(len(line)) - line_start) % BLOCK == 0)
    block = np.cumsum(block_first) - 1
    block_line = line[block_first]
    every = np.unique(np.concatenate([t for _, t in model.templates])) if model.templates else np.zeros(0, np.uint64)
    if not len(every):
        return []
    near = np.minimum(np.searchsorted(every, gram), len(every) - 1)
    hits = np.flatnonzero((every[near] == gram) & (gram > 0))
    near = near[hits]
    found = {}
    for t, (_, template) in enumerate(model.templates):
        need = int(np.ceil(CONFIRM * len(template) - 1e-9))
        if not need:
            continue
        reach = max(1, -(-(len(template) + 1) * 3 // (2 * BLOCK)))
        mine = np.isin(every, template)[near]
        at, pair = hits[mine], near[mine]
        if len(at) < need:
            continue
        # windows by their first block: enough different pairs in it and the next blocks of its paragraph
        start = np.concatenate([block[at] - d for d in range(reach + 1)])
        hit = np.tile(np.arange(len(at)), reach + 1)
        start, hit = start[ok := start >= 0], hit[ok]
        start = start[ok := block_line[start] == line[at[hit]]]
        hit = hit[ok]
        seen, n = np.unique(np.unique(np.stack([start, pair[hit]]), axis=1)[0], return_counts=True)
        for w in seen[n >= need]:
            a, e = np.searchsorted(block[at], [w, w + reach + 1])
            while e > a and line[at[e - 1]] != block_line[w]:
                e -= 1
            for i, j, got in _runs(at[a:e], pair[a:e], need):
                found[(t, i, j)] = got / len(template)
    return [(t, i, j, share) for (t, i, j), share in found.items()]


def window_probabilities(model: LicenceModel, word: np.ndarray, gram: np.ndarray, block: np.ndarray, block_line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First blocks of the windows that hold a feature, in order, and their calibrated class probabilities. The other windows have the bias alone."""
    at, feature = [], []
    for value in (word, gram):
        place = np.minimum(np.searchsorted(model.features, value), len(model.features) - 1)
        hit = np.flatnonzero(model.features[place] == value)
        at.append(hit), feature.append(place[hit])
    own, feature = block[np.concatenate(at)], np.concatenate(feature)
    before = (own > 0) & (block_line[np.maximum(own - 1, 0)] == block_line[own])
    window, feature = np.concatenate([own, own[before] - 1]), np.concatenate([feature, feature[before]])
    both = np.unique(window * len(model.features) + feature)  # a feature counts once a window
    window, feature = both // max(1, len(model.features)), both % max(1, len(model.features))
    first = np.flatnonzero(np.append(True, window[1:] != window[:-1])) if len(window) else np.zeros(0, np.int64)
    z = np.zeros((len(first), len(model.bias)))
    edge = np.append(first, len(window))
    for i in range(0, len(first), 20_000):  # rows of weights are looked up for some windows at a time
        part = feature[edge[i] : edge[min(i + 20_000, len(first))]]
        z[i : i + 20_000] = np.add.reduceat(model.weights[part], first[i : i + 20_000] - edge[i])
    return window[first], _softmax((z + model.bias) / model.temperature)


def find_batch(model: LicenceModel, data: np.ndarray, bounds: np.ndarray) -> tuple[list[tuple], list[tuple]]:
    """Confirmed notices of consecutive rows (row, family, probability, share of the template, start, end: bytes of the
    row), and suspected ones (the same without the share)."""
    word, at, end = placed_words(data, bounds, codes().mark)
    if not len(word) or not len(model.features):
        return [], []
    starts = np.asarray(bounds[:-1]) - int(bounds[0])
    row = np.searchsorted(starts, at, side="right") - 1
    line = _paragraphs(data[int(bounds[0]) : int(bounds[-1])], at, row)
    gram = _grams(word, line)
    first = np.append(True, line[1:] != line[:-1])
    block_first = first | ((np.arange(len(line)) - np.flatnonzero(first)[np.cumsum(first) - 1]) % BLOCK == 0)
    block, block_at = np.cumsum(block_first) - 1, np.flatnonzero(block_first)
    block_line = line[block_first]
    window, p = window_probabilities(model, word, gram, block, block_line)
    unknown, best = p[:, -1], p.argmax(1)
    named = (best < p.shape[1] - 1) & (p.max(1) >= ACCEPT)
    proposed = np.where(named[:, None] & (p > unknown[:, None]), p, 0.0)[:, :-1]
    sure = []
    for t, i, j, share in _candidates(model, gram, line) if named.any() else ():
        a, e = np.searchsorted(window, [block[i] - 1, block[min(j + 1, len(block) - 1)] + 1])
        near = np.arange(a, e)[block_line[window[a:e]] == line[i]]
        probability = proposed[near, model.templates[t][0]].max(initial=0.0)
        if probability > 0:
            sure.append((share, float(probability), t, i, j))
    kept: list[tuple[float, float, int, int, int]] = []
    width = max((j - i + 1 for *_, i, j in sure), default=1)
    beside: dict[int, list[tuple[float, float, int, int, int]]] = {}  # kept ones by stretch of ``width`` words
    # the larger share first, then the longer template, then the more probable one
    for f in sorted(sure, key=lambda f: (-f[0], -len(model.templates[f[2]][1]), -f[1], f[2], f[3])):
        stretches = {f[3] // width, f[4] // width}
        if all(_apart(model, gram, f, k) for s in stretches for k in beside.get(s, [])):
            kept.append(f)
            for s in stretches:
                beside.setdefault(s, []).append(f)
    confirmed = [
        (r := int(row[i]), model.templates[t][0], probability, share, int(at[i] - starts[r]), int(end[j + 1] - starts[r]))
        for share, probability, t, i, j in sorted(kept, key=lambda f: f[3:])
    ]
    told = {(model.templates[t][0], b) for _, _, t, i, j in kept for b in range(int(block[i]) - 1, int(block[j + 1]) + 1)}
    suspected: list[list] = []
    block_end = np.append(block_at[1:], len(word)) - 1
    for n in np.flatnonzero(named & (p.max(1) >= SUSPECT)).tolist():
        w, family = int(window[n]), int(best[n])
        if (family, w) in told:
            continue
        last = w + 1 if w + 1 < len(block_line) and block_line[w + 1] == block_line[w] else w
        r = int(row[block_at[w]])
        if suspected and suspected[-1][1] == family and suspected[-1][5] >= w and suspected[-1][6] == block_line[w]:
            suspected[-1][2] = max(suspected[-1][2], float(p[n, family]))
            suspected[-1][4], suspected[-1][5] = int(end[block_end[last]] - starts[r]), last
        else:
            suspected.append([r, family, float(p[n, family]), int(at[block_at[w]] - starts[r]), int(end[block_end[last]] - starts[r]), last, block_line[w]])
    return confirmed, [tuple(x[:5]) for x in suspected]


def scan_batch(model: LicenceModel, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, float, float, int, int]]:
    """The confirmed notices of consecutive rows."""
    return find_batch(model, data, bounds)[0]


def _apart(model: LicenceModel, gram: np.ndarray, new: tuple[float, float, int, int, int], old: tuple[float, float, int, int, int]) -> bool:
    """Whether a candidate is a notice of its own beside a kept one."""
    if new[3] > old[4] or new[4] < old[3]:
        return True
    (family, mine), (other, theirs) = model.templates[new[2]], model.templates[old[2]]
    if family == other:
        return False
    pairs = gram[new[3] : new[4] + 1]
    own = np.isin(pairs, mine) & ~np.isin(pairs, theirs)
    alike = 2 * len(np.intersect1d(mine, theirs)) > max(len(mine), len(theirs))
    return bool(own.any()) and (new[0] >= 1 or not alike)


def scan(docs: DataFrame, model: LicenceModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, licences, suspected``: per row the confirmed notices with family, probability, template share and byte
    span, and what the classifier names without a template that confirms it."""
    frame = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    place = [("start", pa.int64()), ("end", pa.int64())]
    sure = pa.struct([("family", pa.string()), ("probability", pa.float64()), ("template_share", pa.float64()), *place])
    open_ = pa.struct([("family", pa.string()), ("probability", pa.float64()), *place])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            maybe: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            data, bounds = text_bytes(batch.column(1))
            for i, j in groups(bounds):
                confirmed, suspected = find_batch(model, data, bounds[i : j + 1])
                for r, k, p, share, a, e in confirmed:
                    out[i + r].append({"family": model.families[k], "probability": p, "template_share": share, "start": a, "end": e})
                for r, k, p, a, e in suspected:
                    maybe[i + r].append({"family": model.families[k], "probability": p, "start": a, "end": e})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(sure)), pa.array(maybe, pa.list_(open_))], ["doc_id", "licences", "suspected"])

    span = "start:bigint,end:bigint"
    return frame.mapInArrow(run, f"doc_id {kind}, licences array<struct<family:string,probability:double,template_share:double,{span}>>, suspected array<struct<family:string,probability:double,{span}>>")


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Train against the corpus's own ordinary paragraphs, then scan every document."""
    return scan(docs, train(sample_paragraphs(docs, doc_id, text), templates), doc_id, text)
