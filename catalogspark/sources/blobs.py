"""Binary files: type by leading bytes, size, digest, and cross-checks with a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.scale import explode_rows

#: Leading bytes of image types.
MAGIC = {"png": "89504E470D0A1A0A", "jpg": "FFD8FF", "gif": "47494638"}


def read_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """All files below a folder as (path, content, length)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", "content", "length")


def detected_type(content: Column) -> Column:
    """Image type from the first bytes, NULL when unknown."""
    head = F.hex(F.substring(content, 1, 12))
    kind = F.when(head.startswith("52494646") & head.endswith("57454250"), "webp")
    for name, magic in MAGIC.items():
        kind = kind.when(head.startswith(magic), name)
    return kind


def image_facts(files: DataFrame, key: str, content: str, declared: str, max_bytes: int = 20 * 1024 * 1024) -> DataFrame:
    """(key, bytes, sha256, detected type, problem) per image."""
    kind = detected_type(F.col(content))
    want = F.regexp_replace(F.lower(F.col(declared)), "^jpeg$", "jpg")
    facts = files.select(key, F.length(content).cast("long").alias("bytes"), F.sha2(content, 256).alias("sha256"), kind.alias("detected"), want.alias("_want"))
    problem = (
        F.when(F.col("bytes") == 0, "empty").when(F.col("bytes") > max_bytes, "too-large")
        .when(F.col("detected").isNull(), "unknown-type").when(F.col("detected") != F.col("_want"), "type-mismatch"))
    return facts.select(key, "bytes", "sha256", "detected", problem.alias("problem"))


def cross_check(records: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Records without a file and files without a record."""
    from catalogspark.operators.diff import set_equality

    sides = set_equality(records, files, [path])
    return sides.select(path, F.when(F.col("side") == "left-only", "file-missing").otherwise("orphan-file").alias("problem"))


def token_check(texts: DataFrame, text: str, pattern: str, known: DataFrame, name: str) -> DataFrame:
    """Inline tokens in texts that no record defines."""
    used = explode_rows(texts, [], F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)), name)
    return used.groupBy(name).agg(F.count(F.lit(1)).alias("uses")).join(known.select(name).distinct(), name, "left_anti")
