"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.llm import bin_completion, bottomk_dedup, ordinal_toxicity, temperature_mix
from catalogspark.llm.shared import free_name, table
from catalogspark.scale import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, trained on ``labels``, does not reject."""
    told = free_name(docs, "toxicity")
    scored = ordinal_toxicity.score(docs, ordinal_toxicity.train(docs, table(spark, sf_dir, "labels")), into=told)
    return scored.where(~F.col(f"{told}.toxic")).drop(told)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of near duplicates (five-word shingles, Jaccard 0.8): the smallest id."""
    return bottomk_dedup.keep_one(docs, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their tempered weights: every document once at least, documents of small sources again."""
    told = free_name(docs, "mix")
    return temperature_mix.mix(docs, into=told).drop(told)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: one row per piece of a document."""
    return bin_completion.pack(docs)


STAGES: list[tuple[str, Stage]] = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack_sequences)]

#: A trained classifier and a search have no SQL twin; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents to packed sequences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
