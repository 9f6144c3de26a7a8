"""Incremental jobs: resumable ingest, idempotent import, batched apply with read-back, drift per window."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from catalogspark.functions.canon import row_digest, set_digest
from catalogspark.operators.diff import structural_diff
from catalogspark.scale import path_exists
from catalogspark.streaming.keystore import KeyStore


def checkpoint_path(base: str, name: str, version: str, parameters: Mapping[str, object]) -> str:
    """Checkpoint folder of a job *with these parameters*: another version or parameter never resumes the old state."""
    digest = hashlib.sha256(json.dumps([version, dict(sorted(parameters.items()))], sort_keys=True, default=str).encode()).hexdigest()
    return f"{base}/{name}-{digest[:16]}"


def claim(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Bind a target to the checkpoint that fills it; another checkpoint is refused and nothing is written.

    A new checkpoint counts its batches from 0 and would overwrite the batches of the old one. The guard is a file of
    its own below the target, written once before the first batch.
    """
    guard = f"{target}/_claimed"
    if not path_exists(spark, guard):
        spark.range(1).select(F.lit(checkpoint).alias("checkpoint")).coalesce(1).write.mode("errorifexists").json(guard)
    owner = spark.read.schema("checkpoint string").json(guard).first()["checkpoint"]
    if owner != checkpoint:
        raise ValueError(f"{target} belongs to the job of {owner}: another version or other parameters need another target")


def read_files(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int | None, bytes_per_batch: int = 10 << 30) -> DataFrame:
    """Files as a stream; a batch is bounded by bytes, or by files where the caller says so."""
    bound = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {"maxBytesPerTrigger": bytes_per_batch}
    return spark.readStream.schema(schema).options(recursiveFileLookup="true", **bound).parquet(source)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a stream over all that is there, then stop; returns the finished query."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def resumable_ingest(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int | None = None, proven: bool = False,
) -> None:
    """Everything that has landed since the last run, then stop. A repeated batch overwrites its own folder only.

    With ``proven``, the digest of every finished batch is stored, and a run first compares all finished batches with
    theirs: one that was lost or changed since stops it, before anything is added.
    """
    claim(spark, target, checkpoint)
    if proven and (broken := broken_batches(spark, target).collect()):
        raise ValueError(f"finished batches of {target} are not as they were: {sorted((r.batch, r.problem) for r in broken)}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        path = f"{target}/batch={batch_id}"
        transform(batch).write.mode("overwrite").parquet(path)
        if proven:
            stored = batch.sparkSession.read.parquet(path)
            told = set_digest(stored.select(row_digest(stored).alias("h")), "h")
            told.coalesce(1).write.mode("overwrite").json(f"{target}/_proofs/batch={batch_id}")

    run_available(read_files(spark, source, schema, files_per_batch), handle, checkpoint)


def broken_batches(spark: SparkSession, target: str) -> DataFrame:
    """``batch, problem`` of finished batches whose rows are missing or not those that were stored; one pass over them."""
    proofs = f"{target}/_proofs"
    if not path_exists(spark, proofs):
        return spark.createDataFrame([], "batch long, problem string")
    kept = spark.read.schema("row_count long, set_sha256 string, batch long").option("basePath", proofs).json(proofs)
    rows = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    columns = [c for c in rows.columns if c != "batch"]
    found = set_digest(rows.select(F.col("batch").cast("long").alias("batch"), row_digest(rows, columns).alias("h")), "h", by=["batch"])
    found = found.select(F.col("batch").alias("b"), F.col("row_count").alias("n"), F.col("set_sha256").alias("s"))
    both = kept.join(found, F.col("batch") == F.col("b"), "left").where(F.coalesce(F.col("n"), F.lit(0)) + F.col("row_count") > 0)
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("s") != F.col("set_sha256"), "changed")
    return both.select("batch", problem.alias("problem")).where("problem is not null")


def idempotent_import(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str,
    order: str, buckets: int = 64, files_per_batch: int | None = None,
) -> None:
    """Import rows keyed by a semantic digest: a key that is already stored, or comes again, changes nothing.

    Within a batch the first row by ``order`` is kept (an aggregate). Known keys are looked up in a
    :class:`~catalogspark.streaming.keystore.KeyStore` below the target: of its history a batch reads filters, and the
    buckets in which they hold one of its keys.
    """
    claim(spark, target, checkpoint)
    rest = [f.name for f in schema.fields if f.name != key]

    def handle(batch: DataFrame, batch_id: int) -> None:
        store = KeyStore(batch.sparkSession, f"{target}/keys", key, buckets)
        fresh = batch.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*").persist()
        new = fresh.join(store.known(fresh, batch_id - 1), key, "left_anti") if batch_id else fresh
        new.write.mode("overwrite").parquet(f"{target}/rows/batch={batch_id}")
        fresh.unpersist()
        store.add(batch.sparkSession.read.schema(f"`{key}` string").parquet(f"{target}/rows/batch={batch_id}"), batch_id)

    run_available(read_files(spark, source, schema, files_per_batch), handle, checkpoint)


def batched_apply(
    spark: SparkSession, plan: str, schema: T.StructType, target: str, checkpoint: str,
    valid: Callable[[DataFrame], DataFrame], files_per_batch: int | None = None,
) -> None:
    """Apply a plan batch by batch: write, read back, compare; a batch with a bad or lost row is not taken.

    Batches are added as their own folders with a log row (batch, status, rows); the live table is the
    baseline overlaid with the accepted batches, so refusing a batch restores the rows before it.
    ``valid`` returns the rows of a batch that may *not* be applied.
    """
    claim(spark, target, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        path = f"{target}/rows/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        stored = session.read.schema(schema).parquet(path)
        lost = structural_diff(stored, batch, batch.columns).isEmpty()
        refused = valid(stored).limit(1).count()
        status = "applied" if lost and not refused else "restored"
        log = stored.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(status).alias("status"), "rows")
        log.coalesce(1).write.mode("overwrite").json(f"{target}/log/batch={batch_id}")

    run_available(read_files(spark, plan, schema, files_per_batch), handle, checkpoint)


def apply_log(spark: SparkSession, target: str) -> DataFrame:
    """What happened to every batch."""
    return spark.read.schema("batch_id long, status string, rows long").json(f"{target}/log/*")


def live_table(spark: SparkSession, baseline: DataFrame, target: str, schema: T.StructType, key: str) -> DataFrame:
    """Baseline overlaid with the accepted batches; the latest accepted batch of a key wins."""
    shape = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(shape).option("basePath", f"{target}/rows").parquet(f"{target}/rows")
    accepted = apply_log(spark, target).where("status = 'applied'").select(F.col("batch_id").alias("batch"))
    rest = [f.name for f in schema.fields if f.name != key]
    taken = rows.join(accepted, "batch", "left_semi").groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(key, "_r.*")
    return baseline.join(taken.select(key), key, "left_anti").unionByName(taken.select(*baseline.columns))


def windowed_counts(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, ts: str,
    by: Sequence[str], width: str, lateness: str, files_per_batch: int | None = None,
) -> None:
    """Counts per tumbling window, batch by batch; no row is dropped, however late.

    A batch adds one partial count per window it touches, marked late if the window had been closed before (its end
    lies more than ``lateness`` behind the newest row of earlier batches). :func:`window_totals` adds the parts up.
    """
    claim(spark, target, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        newest = None
        if batch_id > 0:
            before = session.read.schema(_PARTS).option("basePath", f"{target}/parts").parquet(f"{target}/parts")
            newest = before.where(F.col("batch") < batch_id).agg(F.max("newest").alias("m")).first()["m"]
        window = F.window(ts, width)
        parts = batch.groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("newest"))
        closed = F.lit(False) if newest is None else F.col("w.end") < F.lit(newest) - F.expr(f"interval {lateness}")
        parts.select(F.col("w.start").alias("window_start"), *by, "n", "newest", closed.alias("late")).write.mode("overwrite").parquet(f"{target}/parts/batch={batch_id}")

    run_available(read_files(spark, source, schema, files_per_batch), handle, checkpoint)


_PARTS = "window_start timestamp, n long, newest timestamp, late boolean, batch long"


def window_totals(spark: SparkSession, target: str, by: Sequence[str] = ()) -> DataFrame:
    """``window_start, by…, n, n_late``: all rows of a window, and how many of them came after it was closed."""
    rows = spark.read.option("basePath", f"{target}/parts").parquet(f"{target}/parts")
    return rows.groupBy("window_start", *by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_late"))


def deduplicated_stream(stream: DataFrame, ts: str, key: str, lateness: str) -> DataFrame:
    """Rows whose key has not come within the watermark; state is dropped when the watermark passes."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])
