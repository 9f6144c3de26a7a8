"""Helpers of the operators: stored intermediates, dense numbering without hot tasks.

Rows that are used twice, or that must not change when an executor is lost, are written as Parquet below
``spark.checkpoint.dir`` and read again; nothing is kept in a machine-local folder.
"""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogspark.scale import work_dir

#: Rows one numbering bucket should hold on average.
BUCKET_ROWS = 50_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: the lineage ends there."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps before the next large step."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, keys: Sequence[str], first: Sequence[Column], then: Sequence[Column], out: str, buckets: int) -> DataFrame:
    """Gapless 0..n-1 per key, in order of bucket and then of ``then``.

    ``first`` are integer columns that pick the bucket: ``(hash,)`` for any order. One window task holds one bucket
    of one key, so a key with a third of all rows is dealt over ``buckets`` tasks. Bucket sizes are one row per key and
    bucket; their running sums give the offsets.
    """
    keyed = df.withColumn("_b", F.pmod(first[0], F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[F.col(k) for k in keys]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*[F.col(k) for k in keys], "_b").orderBy(*then)
    return (
        keyed.withColumn("_r", F.row_number().over(inside) - 1)
        .join(offsets, [*keys, "_b"])
        .withColumn(out, (F.col("_r") + F.col("_off")).cast("long"))
        .drop("_b", "_r", "_off")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def renamed(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ...: operators that carry whole rows can then use any names beside them."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def named_back(like: DataFrame) -> list[Column]:
    """c0, c1, ... under the names they have in ``like``."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(like.columns)]


def place_of(df: DataFrame, name: str) -> str:
    """The name ``renamed`` gives to a column."""
    lower = [c.lower() for c in df.columns]
    return f"c{df.columns.index(name) if name in df.columns else lower.index(name.lower())}"
