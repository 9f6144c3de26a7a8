"""Exact length histogram: documents by encoded length, and suffix sums that answer every context limit.

The corpus is read once. Each task adds up its own lengths, so one row per task and distinct length is shuffled. All
further answers come from the histogram, which has one row per distinct length: totals, quantiles and the tokens that
remain when every document is cut at a limit.

Defined results: NULL and empty texts have length 0 and count as documents; repeated rows count each time; ids and
other columns are not looked at; an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm.shared import stored
from catalogspark.llm.tokens import UnitEncoder, vocabulary_path
from catalogspark.llm.words import text_bytes

#: Lengths per suffix-sum block: a block is summed in one task, and the blocks' totals are one row each.
BLOCK = 1024


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``length long, n_docs long``: how many texts have each number of ids."""
    path = vocabulary or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = UnitEncoder(path), {}
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            for _, ids in encoder.encode_rows(data, bounds):
                seen[len(ids)] = seen.get(len(ids), 0) + 1
        lengths = np.array(sorted(seen), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(lengths), pa.array(np.array([seen[x] for x in lengths.tolist()], np.int64))], ["length", "n_docs"])

    partial = docs.select(docs[text].cast("string").alias("text")).mapInArrow(count, "length long, n_docs long")
    return partial.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limit_totals(histogram: DataFrame, limits: Sequence[int] = ()) -> DataFrame:
    """One row per distinct length and per asked limit, each taken as a context limit.

    ``n_docs`` have exactly this length, ``docs_longer`` and ``tokens_longer`` lie beyond it, ``tokens_kept`` is the
    corpus cut at the limit, ``tokens_lost`` the rest, and ``docs_within`` is the share of documents that fit (its
    smallest length at or above q is the q-quantile). Sums run inside blocks of lengths; totals of later blocks are
    added by a join, so no task sees more than a block and one row per block.
    """
    rows = histogram.select(F.col("length").cast("long").alias("context_limit"), F.col("n_docs").cast("long"))
    if limits:
        extra = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
        rows = rows.unionByName(histogram.sparkSession.range(1).select(extra.alias("context_limit"), F.lit(0).cast("long").alias("n_docs")))
        rows = rows.groupBy("context_limit").agg(F.sum("n_docs").alias("n_docs"))
    rows = rows.select("*", (F.col("context_limit") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("context_limit") / BLOCK).alias("_block"))
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)  # one row per 1024 lengths
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_d_after"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_t_after"),
        F.sum("_d").over(Window.partitionBy()).alias("total_docs"),
        F.sum("_t").over(Window.partitionBy()).alias("total_tokens"),
    )
    inside = Window.partitionBy("_block").orderBy(F.desc("context_limit")).rowsBetween(Window.unboundedPreceding, -1)
    longer_docs = F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    longer_tokens = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    out = rows.select("*", longer_docs.alias("_d_in"), longer_tokens.alias("_t_in")).join(blocks, "_block").select(
        "context_limit", "n_docs", "n_tokens",
        (F.col("_d_in") + F.col("_d_after")).alias("docs_longer"),
        (F.col("_t_in") + F.col("_t_after")).alias("tokens_longer"),
        "total_docs", "total_tokens",
    )
    kept = F.col("total_tokens") - F.col("tokens_longer") + F.col("context_limit") * F.col("docs_longer")
    return out.select(
        "*", kept.alias("tokens_kept"), (F.col("total_tokens") - kept).alias("tokens_lost"),
        (1 - F.col("docs_longer") / F.col("total_docs")).alias("docs_within"),
    )


def length_quantiles(totals: DataFrame, shares: Iterable[float]) -> DataFrame:
    """``q double, length long``: the smallest length that at least a share q of the documents does not exceed."""
    wanted = [float(q) for q in shares]
    aggs = [F.min(F.when(F.col("docs_within") >= q, F.col("context_limit"))).alias(f"q{i}") for i, q in enumerate(wanted)]
    one = totals.where(F.col("n_docs") > 0).agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"q{i}").alias("length")) for i, q in enumerate(wanted)])))


def length_report(docs: DataFrame, limits: Sequence[int] = (), text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The histogram of the corpus, stored once, with its answers for every length and every asked limit."""
    return limit_totals(stored(length_histogram(docs, text, vocabulary), "lengths"), limits)
