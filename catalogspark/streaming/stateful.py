"""Jobs that keep operator state between batches: event-time windows and de-duplication, with nothing lost to lateness.

Spark's stateful operators drop rows behind the watermark without a trace. Here every batch is routed first: rows at or
before the watermark of the batches before (and rows without event time) go to a side table, the others on to the stateful
query, which reads what was routed as its source. That query takes whole routed batches, so its own watermark never runs
ahead of the router's; that it dropped nothing is checked after each run. State lives in RocksDB on the executors, with
its checkpoint in the job's folder, so it may outgrow memory and survives executors and restarts.

A job's folder holds ``routed/batch=N`` (late=false, late=true), ``marks/batch=N`` (the newest event time so far) and
``out/batch=N``. Repeated batches overwrite their own folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.scale import path_exists
from catalogspark.streaming.ingest import claim, read_files, run_available

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _route(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, ts: str, lateness: str, files_per_batch: int | None) -> None:
    def handle(batch: DataFrame, batch_id: int) -> None:
        session, newest = batch.sparkSession, None
        if batch_id:
            newest = session.read.schema("newest timestamp").json(f"{target}/marks/batch={batch_id - 1}").first()["newest"]
        late = F.col(ts).isNull()
        if newest is not None:
            late = late | (F.col(ts) <= F.lit(newest) - F.expr(f"interval {lateness}"))
        path = f"{target}/routed/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(path)
        stored = session.read.schema(T.StructType([*schema.fields, T.StructField("late", T.BooleanType())])).option("basePath", path).parquet(path)
        mark = stored.agg(F.greatest(F.max(ts), F.lit(newest).cast("timestamp")).alias("newest"))
        mark.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{target}/marks/batch={batch_id}")

    run_available(read_files(spark, source, schema, files_per_batch), handle, checkpoint)


def stateful_job(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, ts: str, lateness: str,
    build: Callable[[DataFrame], DataFrame], files_per_batch: int | None = None,
) -> None:
    """Everything that has landed since the last run through ``build`` (stateful operators in append mode), then stop.

    ``build`` gets the stream with its watermark. A target belongs to the checkpoint that fills it.
    """
    claim(spark, target, checkpoint)
    _route(spark, source, schema, target, f"{checkpoint}/route", ts, lateness, files_per_batch)
    if not path_exists(spark, f"{target}/routed"):
        return
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        timely = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{target}/routed/*/late=false")
        stream = build(timely.withWatermark(ts, lateness))

        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target}/out/batch={batch_id}")

        query = run_available(stream, handle, f"{checkpoint}/state")
    finally:
        spark.conf.set(_PROVIDER, before)
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    if dropped:
        raise RuntimeError(f"{dropped} routed rows were late to the stateful query")


def late_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The side table: rows that came after the watermark had passed them, with their batch."""
    shape = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(shape).option("basePath", f"{target}/routed").parquet(f"{target}/routed").where("late").drop("late")


def results(spark: SparkSession, target: str) -> DataFrame:
    """What the stateful query has put out so far."""
    return spark.read.option("basePath", f"{target}/out").parquet(f"{target}/out").drop("batch")


def closed_windows(ts: str, width: str, by: Sequence[str], aggregates: Sequence[Column], unique: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Windows that the watermark has closed, each put out once; with ``unique``, repeated rows count once."""
    def build(stream: DataFrame) -> DataFrame:
        rows = stream.dropDuplicatesWithinWatermark([unique]) if unique else stream
        told = rows.groupBy(F.window(ts, width).alias("w"), *by).agg(*aggregates)
        return told.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in told.columns if c != "w"])

    return build


def first_arrivals(key: str) -> Callable[[DataFrame], DataFrame]:
    """Rows whose key has not come within the watermark; a key's state goes when the watermark passes it."""
    return lambda stream: stream.dropDuplicatesWithinWatermark([key])
