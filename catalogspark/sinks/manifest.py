"""Writing with proof: partitioned records, file manifests, addressed data sets, read-back, promotion."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions.canon import row_digest, set_digest
from catalogspark.operators.diff import structural_diff
from catalogspark.scale import path_exists, with_scalars
from catalogspark.sources.blobs import read_files


def write_records(df: DataFrame, path: str, category: str, per_file: int = 250_000) -> None:
    """Records as JSON lines under one folder per category; the category also stays in the record.

    Rows are range-partitioned by category and a hash of the row, so a category that holds most rows is
    written by many tasks.
    """
    spread = df.withColumn("category_folder", F.col(category)).repartitionByRange("category_folder", F.xxhash64(*df.columns))
    spread.write.partitionBy("category_folder").option("maxRecordsPerFile", per_file).mode("errorifexists").json(path)


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path relative to the root, bytes, sha256) of every data file, on any file system. Files are bounded by the writer.

    A file's path is cut behind the root by length, so the root may hold any characters.
    """
    inside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()
    relative = F.substring("path", F.instr("path", inside) + len(inside), F.lit(1 << 30))
    return read_files(spark, root).select(relative.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_problems(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Files missing, unexpected, or with other bytes than recorded."""
    s = stored.select("file", F.col("bytes").alias("s_bytes"), F.col("sha256").alias("s_sha"))
    joined = s.join(found, "file", "full_outer")
    problem = (
        F.when(F.col("sha256").isNull(), "missing").when(F.col("s_sha").isNull(), "unexpected")
        .when((F.col("s_sha") != F.col("sha256")) | (F.col("s_bytes") != F.col("bytes")), "changed"))
    return joined.select("file", problem.alias("problem")).where("problem is not null")


def read_back_diff(written: DataFrame, read: DataFrame) -> DataFrame:
    """Rows lost or gained between what was meant and what is stored, with their number of copies."""
    return structural_diff(read.select(*written.columns), written, written.columns)


def data_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (row_count, set_sha256) over the whole data set, free of order and partitioning."""
    return set_digest(df.select(row_digest(df, list(columns or df.columns)).alias("h")), "h")


def write_addressed(df: DataFrame, root: str, name: str) -> str:
    """Write under the digest of the content: the same rows always land in the same folder, once."""
    digest = data_digest(df).collect()[0].set_sha256
    path = f"{root}/{name}/digest={digest}"
    df.write.mode("ignore").parquet(path)
    return path


def bundle_identity(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Per part its count and digest, and one identity over all of them (parts in name order)."""
    out = None
    for name in sorted(parts):
        one = data_digest(parts[name]).select(F.lit(name).alias("part"), "row_count", "set_sha256")
        out = one if out is None else out.unionByName(one)
    lines = F.array_sort(F.collect_list(F.concat_ws("=", "part", "set_sha256")))  # one short line per part
    return with_scalars(out, out.agg(F.sha2(F.array_join(lines, "\n"), 256).alias("identity")))


def write_snapshot(df: DataFrame, root: str, flags: Mapping[str, str]) -> None:
    """Data first, then one manifest row: a run without a manifest does not count."""
    df.write.mode("errorifexists").parquet(f"{root}/data")
    manifest = data_digest(df.sparkSession.read.parquet(f"{root}/data"))
    for name, value in flags.items():
        manifest = manifest.withColumn(name, F.lit(value))
    manifest.write.mode("errorifexists").json(f"{root}/manifest")


def verify_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Recorded against recomputed count and digest: one row with the verdict."""
    stored = spark.read.json(f"{root}/manifest").select(F.col("row_count").alias("stored_rows"), F.col("set_sha256").alias("stored_sha256"))
    found = data_digest(spark.read.parquet(f"{root}/data"))
    return with_scalars(stored, found).withColumn("intact", F.col("stored_sha256") == F.col("set_sha256"))


def stage_disagreements(stages: DataFrame, facts: Sequence[str]) -> DataFrame:
    """Facts (snapshot, counts, digests) on which the stage manifests of a run do not agree."""
    names = F.array(*[F.struct(F.lit(f).alias("fact"), F.col(f).cast("string").alias("value")) for f in facts])
    rows = stages.select(F.explode(names).alias("r")).select("r.*").where("value is not null")
    seen = rows.groupBy("fact").agg(F.count_distinct("value").alias("distinct_values"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return seen.where("distinct_values > 1")


def promote(spark: SparkSession, pointer: str, run: str, sequence: int, path: str | None = None) -> None:
    """Make a run the current one by adding a pointer row; older pointers stay as history."""
    row = spark.range(1).select(F.lit(run).alias("run"), F.lit(sequence).cast("long").alias("sequence"), F.lit(path).cast("string").alias("path"))
    row.coalesce(1).write.mode("errorifexists").json(f"{pointer}/sequence={sequence:012d}")


def _pointers(spark: SparkSession, pointer: str) -> DataFrame:
    return spark.read.schema("run string, path string").json(pointer + "/*").select("run", "path", F.col("_metadata.file_path").alias("p"))


def current_run(spark: SparkSession, pointer: str) -> str | None:
    """The run of the highest pointer, or None before the first promotion. Errors other than that are raised."""
    if not path_exists(spark, pointer):
        return None
    best = _pointers(spark, pointer).agg(F.max_by("run", "p").alias("run")).collect()
    return best[0].run if best else None


def current_data(spark: SparkSession, root: str) -> str | None:
    """The folder of the current run's rows."""
    if not path_exists(spark, f"{root}/current"):
        return None
    best = _pointers(spark, f"{root}/current").agg(F.max_by(F.struct("run", "path"), "p").alias("b")).select("b.*").first()
    return best.path or f"{root}/{best.run}"


def _attempt(spark: SparkSession, root: str, run: str) -> tuple[str, bool]:
    """The folder of a run's finished attempt, or the next free one beside those that were broken off."""
    for n in itertools.count(1):
        path = f"{root}/{run}" if n == 1 else f"{root}/{run}~{n}"
        if not path_exists(spark, path):
            return path, False
        if path_exists(spark, f"{path}/_SUCCESS"):
            return path, True


def promote_run(spark: SparkSession, root: str, run: str, sequence: int, rows: DataFrame, by: str, max_drop: float = 0.25, max_growth: float = 2.0) -> bool:
    """Write a run, judge it against the current one, and promote it as the very last step; returns whether it was.

    The gate compares the rows per value of ``by`` and refuses a drop or growth beyond the limits; its verdict is stored.
    The step can be repeated after a stop anywhere: an attempt that was broken off while writing is left aside and
    written anew, a finished one is judged, an accepted one is pointed at. A run that has its pointer, or was refused,
    is a replay: nothing is written, judged or promoted again.
    """
    pointer, told = f"{root}/current", f"{root}/verdicts/run={run}"
    if path_exists(spark, f"{told}/_SUCCESS"):
        verdict = spark.read.schema("path string, accepted boolean").json(told).first()
        known = path_exists(spark, pointer) and not _pointers(spark, pointer).where(F.col("run") == run).isEmpty()
        if known or not verdict.accepted:
            return False
        promote(spark, pointer, run, sequence, verdict.path)
        return True
    path, written = _attempt(spark, root, run)
    if not written:
        rows.write.mode("errorifexists").parquet(path)
    last, accepted = current_data(spark, root), True
    if last is not None:
        count = lambda where, name: spark.read.parquet(where).groupBy(by).agg(F.count(F.lit(1)).alias(name))
        both = count(last, "old").join(count(path, "new"), by, "full_outer").na.fill(0, ["old", "new"])
        accepted = both.where((F.col("old") - F.col("new") > F.col("old") * max_drop) | ((F.col("old") > 0) & (F.col("new") > F.col("old") * max_growth))).isEmpty()
    verdict = spark.range(1).select(F.lit(path).alias("path"), F.lit(accepted).alias("accepted"))
    verdict.coalesce(1).write.mode("overwrite").json(told)  # a verdict without its mark was broken off
    if accepted:
        promote(spark, pointer, run, sequence, path)
    return accepted


def write_console_artifact(parts: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Every part as its own data set, written side by side, read back and counted: (part, rows, set_sha256) of what is stored."""
    spark = next(iter(parts.values())).sparkSession
    with ThreadPoolExecutor(len(parts)) as pool:  # the parts do not depend on each other
        for done in [pool.submit(df.write.mode("errorifexists").parquet, f"{root}/{name}") for name, df in parts.items()]:
            done.result()
    stored = {name: spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in parts.items()}
    return bundle_identity(stored)
