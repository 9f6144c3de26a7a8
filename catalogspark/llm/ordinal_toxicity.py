"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= j) = sigmoid(t_j - w x): one weight vector is shared by all ordered thresholds. Features are words (runs of
ASCII letters, digits and non-ASCII characters, A-Z lower-cased) and their first 3, 4 and 5 bytes, which stand for the
inflected forms of a stem, with the value log(1 + count). The fit, choice of features included, works on a bounded sample:
at most ``train_rows`` labelled documents, those with the smallest id hashes. Document frequencies among its toxic and
clean texts are added up in Spark; features are ranked by the log-likelihood ratio of the two, and those above the value
that about one feature reaches by chance (2 ln of the number of features) are used, ``max_features`` at most: the floor
follows the table, and small ones keep their strongest words. Every document is scored over its whole text.

``grades_by_amount`` makes grades from a binary label: 0 for clean texts; toxic texts are graded 1..``levels`` by the
quantile of the number of features that mark toxic texts. A table with real grades is used as it is.

Defined results: NULL and empty texts have no features and get the model's base rate; NULL labels are not used, and of
several labels for an id the highest counts; ids that stand on several rows train on each; without labels of both kinds
nothing is toxic (probability 0); repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.shared import named_back, place_of, renamed, stored
from catalogspark.llm.words import codes, groups, placed_words, prefix_codes, text_bytes

#: Labelled documents used for the fit at most.
TRAIN_ROWS = 40_000
#: Features used at most, and the least number of labelled texts one stands in.
MAX_FEATURES = 2_048
MIN_TEXTS = 3
PREFIXES = (3, 4, 5)
#: Text bytes whose features are worked out together.
TEXT_BYTES = 1 << 20
LEVELS = 3
#: A document is rejected at this probability of grade 1 or more.
REJECT_AT = 0.5


@dataclass
class OrdinalModel:
    """Sorted word codes, a weight for each, and the ordered thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def grade_probabilities(self, x: np.ndarray) -> np.ndarray:
        """P(grade = 0..levels) for linear scores."""
        if not len(self.thresholds):
            return np.ones((len(x), 1))
        at_most = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - x[:, None], -500, 500)))
        edge = np.concatenate([np.zeros((len(x), 1)), at_most, np.ones((len(x), 1))], axis=1)
        return np.diff(edge, axis=1)


def _features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature codes of consecutive rows, and the row of each."""
    word, at, end = placed_words(data, bounds, codes().mark)
    row = np.searchsorted(bounds - bounds[0], at, side="right") - 1
    found, rows = [word], [row]
    for length in PREFIXES:
        code, index = prefix_codes(data, int(bounds[0]), at, end, length)
        found.append(code), rows.append(row[index])
    return np.concatenate(found), np.concatenate(rows)


def _feature_counts(batch: pa.RecordBatch, text: int) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """For runs of rows: each row, its distinct features in order, and their counts."""
    data, bounds = text_bytes(batch.column(text))
    for i, j in groups(bounds, TEXT_BYTES):
        found, row = _features(data, bounds[i : j + 1])
        order = np.argsort(row, kind="stable")
        edge = np.searchsorted(row[order], np.arange(j - i + 1))
        found = found[order]
        yield [(i + r, *np.unique(found[edge[r] : edge[r + 1]], return_counts=True)) for r in range(j - i)]


def _frequencies(rows: DataFrame) -> DataFrame:
    """``word, toxic, clean``: in how many training texts of each kind a word stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for run in _feature_counts(batch, 0):
                word, index = np.unique(np.concatenate([w for _, w, _ in run]), return_inverse=True)
                mark = np.repeat([bad[r] for r, _, _ in run], [len(w) for _, w, _ in run]).astype(np.float64)
                toxic = np.bincount(index, weights=mark, minlength=len(word)).astype(np.int64)
                n = np.bincount(index, minlength=len(word))
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(toxic), pa.array(n - toxic)], ["word", "toxic", "clean"])

    partial = rows.select("text", "bad").mapInArrow(count, "word long, toxic long, clean long")
    return partial.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(n_toxic: int, n_clean: int) -> Column:
    """Log-likelihood ratio of a feature's frequency in toxic against clean texts; negative if it marks clean ones."""
    texts = n_toxic + n_clean
    n = F.col("toxic") + F.col("clean")

    def term(seen: Column, of: Column, share: int) -> Column:
        return F.when(seen > 0, seen * F.ln(seen * F.lit(float(texts)) / (of * F.lit(float(share))))).otherwise(0.0)

    with_it = term(F.col("toxic"), n, n_toxic) + term(F.col("clean"), n, n_clean)
    without = term(n_toxic - F.col("toxic"), texts - n, n_toxic) + term(n_clean - F.col("clean"), texts - n, n_clean)
    return F.when(F.col("toxic") * F.lit(float(n_clean)) >= F.col("clean") * F.lit(float(n_toxic)), 1).otherwise(-1) * 2 * (with_it + without)


def _rows_of(rows: DataFrame, words: np.ndarray, marked: np.ndarray) -> DataFrame:
    """Training rows as feature indexes and counts, with the number of marked features."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_i, out_c, amount = [], [], []
            for _, w, c in (row for run in _feature_counts(batch, 0) for row in run):
                place = np.minimum(np.searchsorted(words, w), len(words) - 1)
                ok = words[place] == w
                out_i.append(place[ok].astype(np.int32)), out_c.append(c[ok].astype(np.int32))
                amount.append(float(c[ok][marked[place[ok]]].sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_i, pa.list_(pa.int32())), pa.array(out_c, pa.list_(pa.int32())), pa.array(amount, pa.float64()), batch.column(1)], ["i", "c", "amount", "grade"]
            )

    return rows.select("text", "grade").mapInArrow(pick, "i array<int>, c array<int>, amount double, grade int")


def grades_by_amount(grade: np.ndarray, amount: np.ndarray, levels: int) -> np.ndarray:
    """Grades 1..levels of the rows above 0, by quantiles of their number of marked features."""
    out, bad = np.zeros(len(grade), np.int64), grade > 0
    cuts = np.quantile(amount[bad], np.arange(1, levels) / levels)
    out[bad] = 1 + np.searchsorted(cuts, amount[bad], side="right")
    return out


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int, levels: int, l2: float = 1e-5, steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the cumulative-link likelihood (Adam on all rows).

    Thresholds are a first value and positive gaps, so their order holds throughout.
    """
    n = len(grade)
    share = np.array([(grade <= j).mean() for j in range(levels)]).clip(1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(n_features), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, cut = theta[:n_features], theta[n_features:]
        gaps = np.exp(cut[1:])
        thresholds = np.concatenate([[cut[0]], cut[0] + np.cumsum(gaps)])
        x = np.bincount(rows, weights=values * w[cols], minlength=n)
        edge = np.concatenate([[-np.inf], thresholds, [np.inf]])
        with np.errstate(over="ignore"):
            up, low = (1 / (1 + np.exp(-(edge[grade + s] - x))) for s in (1, 0))
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p / n, low * (1 - low) / p / n
        g_x = d_up - d_low  # of the negative log likelihood
        g_w = np.bincount(cols, weights=values * g_x[rows], minlength=n_features) + l2 * w
        g_t = np.array([d_low[grade == j + 1].sum() - d_up[grade == j].sum() for j in range(levels)])
        g_cut = np.concatenate([[g_t.sum()], gaps * np.cumsum(g_t[::-1])[::-1][1:]])
        g = np.concatenate([g_w, g_cut])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.1 if t < steps * 0.7 else 0.02
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
    cut = theta[n_features:]
    return theta[:n_features], np.concatenate([[cut[0]], cut[0] + np.cumsum(np.exp(cut[1:]))])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "toxic", levels: int | None = LEVELS,
          train_rows: int = TRAIN_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on the labelled documents. ``levels``: make so many grades from a binary label; None: labels are grades."""
    none = OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    sample = labels.where(F.col(grade).isNotNull() & labels[doc_id].isNotNull()).groupBy(labels[doc_id].cast("long").alias("_id")).agg(F.max(F.col(grade).cast("int")).alias("grade"))
    sample = sample.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)  # at most train_rows small rows: broadcast
    frame = docs.select(docs[doc_id].cast("long").alias("_id"), docs[text].cast("string").alias("text"))
    rows = stored(frame.join(F.broadcast(sample), "_id").select("text", "grade", (F.col("grade") > 0).alias("bad")), "labelled")
    n = {r["bad"]: r["n"] for r in rows.groupBy("bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return none
    seen = stored(_frequencies(rows).where(F.col("toxic") + F.col("clean") >= MIN_TEXTS), "features")
    by_chance = 2 * math.log(max(2, seen.count()))
    best = seen.select("word", _evidence(n[True], n[False]).alias("z")).where(F.abs("z") >= by_chance).orderBy(F.desc(F.abs("z")), "word").limit(max_features).collect()
    if not best:
        return none
    words = np.array([r["word"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(words)
    words, marked = words[order], np.array([r["z"] > 0 for r in best])[order]
    got = _rows_of(rows, words, marked).toArrow()  # at most train_rows rows of at most max_features counts
    lens = np.array([len(x) for x in got["i"].to_pylist()])
    cols = np.concatenate([np.array(x, np.int64) for x in got["i"].to_pylist()])
    values = np.log1p(np.concatenate([np.array(x, np.float64) for x in got["c"].to_pylist()]))
    y = got["grade"].to_numpy().astype(np.int64)
    if levels is not None:
        y = grades_by_amount(y, got["amount"].to_numpy(), levels)
    top = int(y.max())
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(y)), lens), cols, values, y, len(words), top)
    return OrdinalModel(words, weights, thresholds)


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", reject_at: float = REJECT_AT, into: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and a struct ``into``: probability of grade 1 or more, expected severity, grade, toxic."""
    told = "struct<probability:double,severity:double,grade:int,toxic:boolean>"

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros(batch.num_rows)
            if len(model.words):
                data, bounds = text_bytes(batch.column(batch.num_columns - 1))
                for i, j in groups(bounds, TEXT_BYTES):
                    found, row = _features(data, bounds[i : j + 1])
                    place = np.minimum(np.searchsorted(model.words, found), len(model.words) - 1)
                    hit = np.flatnonzero(model.words[place] == found)
                    row = row[hit]
                    cell, count = np.unique(row * len(model.words) + place[hit], return_counts=True)
                    np.add.at(x, i + cell // len(model.words), np.log1p(count) * model.weights[cell % len(model.words)])
            p = model.grade_probabilities(x)
            probability, severity = 1 - p[:, 0], p @ np.arange(p.shape[1])
            fields = [pa.array(probability), pa.array(severity), pa.array(p.argmax(1).astype(np.int32)), pa.array(probability >= reject_at)]
            struct = pa.StructArray.from_arrays(fields, ["probability", "severity", "grade", "toxic"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], [*batch.schema.names[:-1], "_told"])

    # columns may have any names: they travel as c0, c1, ... with the text last
    inner = renamed(docs).select("*", F.col(place_of(docs, text)).cast("string").alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[:-1]) + f", _told {told}"
    return inner.mapInArrow(grade, schema).select(*named_back(docs), F.col("_told").alias(into))
