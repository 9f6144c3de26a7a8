"""Typed readers: dumps, localized documents, attribute values, trees, reference sets, stored snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.functions.canon import as_col, canonical_json, row_digest, set_digest
from catalogspark.scale import literal_table, with_scalars


def read_dump(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """NDJSON dump (gzip allowed) with a fixed schema; numbers keep their source text in string columns.

    A malformed line is not dropped: it arrives with ``_corrupt_record`` set.
    """
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if "_corrupt_record" not in shape.fieldNames():
        shape = T.StructType(shape.fields + [T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(shape).option("mode", "PERMISSIVE").option("primitivesAsString", "true").json(path)


def bad_rows(rows: DataFrame, identity: Sequence[str], safe_key: str = r"^[A-Za-z0-9][A-Za-z0-9_.-]*$") -> DataFrame:
    """Rows that cannot be used: malformed line, missing identity, unsafe key."""
    reason = F.when(F.col("_corrupt_record").isNotNull(), "malformed")
    for name in identity:
        reason = reason.when(F.coalesce(F.trim(F.col(name)), F.lit("")) == "", f"missing {name}")
    reason = reason.when(~F.col(identity[0]).rlike(safe_key), f"unsafe {identity[0]}")
    return rows.select(*identity, "_corrupt_record", reason.alias("reason")).where(F.col("reason").isNotNull())


def good_rows(rows: DataFrame, identity: Sequence[str], safe_key: str = r"^[A-Za-z0-9][A-Za-z0-9_.-]*$") -> DataFrame:
    """The complement of :func:`bad_rows`."""
    ok = F.col("_corrupt_record").isNull() & F.col(identity[0]).rlike(safe_key)
    for name in identity:
        ok = ok & (F.coalesce(F.trim(F.col(name)), F.lit("")) != "")
    return rows.where(F.coalesce(ok, F.lit(False))).drop("_corrupt_record")


def row_count_check(tables: dict[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """Counted rows against the manifest ``(table_name, expected_rows)``; a line per disagreement."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(manifest, "table_name", "full_outer").where(~F.col("rows").eqNullSafe(F.col("expected_rows")))


def read_documents(
    spark: SparkSession, root: str, schema: str, pattern: str = r"([^/]+)/([^/]+)\.json$", multiline: bool = True
) -> DataFrame:
    """Localized JSON documents in a tree; locale and slug are the two groups of ``pattern`` on the path."""
    path = F.col("_metadata.file_path")
    docs = spark.read.schema(schema).option("multiLine", multiline).option("recursiveFileLookup", "true").json(root)
    return docs.select(F.regexp_extract(path, pattern, 1).alias("lang"), F.regexp_extract(path, pattern, 2).alias("slug"), *docs.columns)


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """Whole text files, one row each, with the path."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def primary_document(cards: DataFrame, key: str, lang: str, requested: Sequence[str]) -> DataFrame:
    """One card per key: English first, then the requested languages in order. A min_by, combined map-side."""
    order = ["en", "en-US", *[r for r in requested if r not in ("en", "en-US")]]
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(lang))
    ranked = cards.withColumn("_rank", F.when(rank == 0, len(order) + 1).otherwise(rank))
    rest = [c for c in cards.columns if c != key]
    return ranked.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("_rank", lang)).alias("_c")).select(key, "_c.*")


def field_refs(nested: DataFrame, sections: str) -> DataFrame:
    """Distinct (section, field) pairs in a ``map<section, map<field, …>>`` column."""
    return (
        nested.select(F.explode(sections).alias("section", "fields"))
        .select("section", F.explode_outer(F.map_keys("fields")).alias("field")).where("field is not null")
        .distinct()
    )


def flatten_tree(nodes: DataFrame, key: str, children: str, depth: int) -> DataFrame:
    """Nested ``children`` arrays of a known depth as rows ``(code, parent, level)``."""
    level = nodes.select(F.col(key).alias("code"), F.lit(None).cast("string").alias("parent"), F.lit(1).alias("level"), F.col(children).alias("_kids"))
    out = level.drop("_kids")
    for n in range(2, depth + 1):
        kids = level.select(F.col("code").alias("parent"), F.explode("_kids").alias("_k"))
        has_more = isinstance(kids.schema["_k"].dataType, T.StructType) and children in kids.schema["_k"].dataType.fieldNames()
        level = kids.select(
            F.col(f"_k.{key}").alias("code"), "parent", F.lit(n).alias("level"),
            (F.col(f"_k.{children}") if has_more else F.lit(None)).alias("_kids"),
        )
        out = out.unionByName(level.drop("_kids"))
        if not has_more:
            break
    return out


def external_ids(codes: DataFrame, code: str, prefix: str, discovered: DataFrame) -> DataFrame:
    """Numeric ids from our own codes ∪ discovered ids, each once, with a numeric sort key."""
    own = codes.select(F.regexp_extract(F.upper(F.trim(F.col(code))), rf"^{prefix}(\d+)$", 1).alias("external_id"))
    both = own.unionByName(discovered.select(F.col(discovered.columns[0]).cast("string").alias("external_id")))
    valid = both.where(F.col("external_id").rlike(r"^[1-9]\d*$"))
    return valid.distinct().withColumn("id_order", F.col("external_id").cast("decimal(38,0)"))


def seed_digest(ids: DataFrame) -> DataFrame:
    """Count and order-free digest of an id set."""
    return set_digest(ids.select(F.sha2("external_id", 256).alias("h")), "h")


def discover(listings: DataFrame, key: str, asked: str, carried: str) -> tuple[DataFrame, DataFrame]:
    """Ids listed under the filter that was asked for, and the listings that carry another one."""
    right = listings.where(F.col(asked).eqNullSafe(F.col(carried))).select(key).distinct()
    wrong = listings.where(~F.col(asked).eqNullSafe(F.col(carried))).select(key, asked, carried)
    return right, wrong


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, bounds: tuple[int, int], partitions: int, page: int = 5000) -> DataFrame:
    """Keyset-partitioned table read: every task reads one key range in pages."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1],
                 numPartitions=partitions, fetchsize=page)
        .load()
    )


def table_fingerprint(df: DataFrame, key: str) -> DataFrame:
    """``(rows, max_key)``: equal before and after a read means that the table did not move meanwhile."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(key).alias("max_key"))


def replay(stored: DataFrame, content: str, recorded: str) -> DataFrame:
    """Stored payloads with a verdict: is the digest still the recorded one?"""
    digest = F.sha2(F.col(content), 256)
    return stored.withColumn("intact", digest.eqNullSafe(F.col(recorded)))


def issue_kind(endpoint: Column | str, status: Column | str) -> Column:
    """A missing detail may be skipped; anything else stops the run."""
    return F.when((as_col(endpoint) == "field") & (as_col(status) == 404), "missing-detail").otherwise("fatal")


def baseline_contract(df: DataFrame, code: str, collections: Sequence[str], expected_rows: int | None = None) -> DataFrame:
    """One row of evidence that a baseline is whole: rows, distinct codes, absent collections, code-set digest."""
    present = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in collections]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.upper(F.trim(F.col(code)))).alias("codes"),
        F.count_if(F.coalesce(F.trim(F.col(code)), F.lit("")) == "").alias("blank_codes"), *present,
    )
    digest = set_digest(df.select(F.sha2(F.upper(F.trim(F.col(code))), 256).alias("h")), "h").select("set_sha256")
    complete = (F.col("rows") == F.col("codes")) & (F.col("blank_codes") == 0) & (F.col("rows") > 0)
    for c in collections:
        complete = complete & (F.col(f"missing_{c}") == 0)
    if expected_rows is not None:
        complete = complete & (F.col("rows") == expected_rows)
    return with_scalars(counts.withColumn("complete", complete), digest)


def dictionary_contract(dictionaries: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Coded dictionaries: rows, distinct codes, digest, verdict. One line per dictionary."""
    out = None
    for name, (df, code) in dictionaries.items():
        keyed = df.select(F.upper(F.trim(F.col(code).cast("string"))).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        one = keyed.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("codes"),
            F.count_if((F.col("n") > 1) | (F.coalesce(F.col("c"), F.lit("")) == "")).alias("bad_codes"),
        ).select(F.lit(name).alias("dictionary"), "rows", "codes", "bad_codes",
                 ((F.col("rows") > 0) & (F.col("bad_codes") == 0)).alias("usable"))
        out = one if out is None else out.unionByName(one)
    return out


def paired_references(left: DataFrame, right: DataFrame, code: str, columns: Sequence[str]) -> DataFrame:
    """Two loads of the same reference: counts and digests side by side, and whether they agree."""
    def facts(df: DataFrame, tag: str) -> DataFrame:
        d = set_digest(df.select(row_digest(df, [code, *columns]).alias("h")), "h")
        return d.select(F.col("row_count").alias(f"{tag}_rows"), F.col("set_sha256").alias(f"{tag}_sha256"))

    return with_scalars(facts(left, "left"), facts(right, "right")).withColumn(
        "agree", F.col("left_sha256") == F.col("right_sha256")
    )


def unavailable_keys(requested: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Requested keys without a stored pack: a warning row each."""
    return requested.select(key).distinct().join(available.select(key).distinct(), key, "left_anti")


def select_subset(df: DataFrame, code: str, only: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of the asked codes, and the asked codes that do not exist."""
    wanted = F.broadcast(literal_table(df.sparkSession, ["_want"], [(o.strip().upper(),) for o in only]).distinct())
    keyed = df.withColumn("_want", F.upper(F.trim(F.col(code))))
    return keyed.join(wanted, "_want", "left_semi").drop("_want"), wanted.join(
        keyed.join(wanted, "_want", "left_semi").select("_want").distinct(), "_want", "left_anti"
    )


def as_payload(df: DataFrame, columns: Sequence[str]) -> Column:
    """Canonical payload text of a row, as stored in snapshots."""
    return canonical_json(df, columns)
