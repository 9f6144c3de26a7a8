"""Hand-off documents and wide rows: built, parsed back and verified."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions.canon import as_col, canonical_json, row_digest, set_digest
from catalogspark.scale import with_scalars

#: Markers around the parts a translator edits.
OPEN, CLOSE = "<!-- edit:{0} -->", "<!-- end:{0} -->"
BLOCKS = ("name", "description")


def handoff_document(header: Mapping[str, Column], blocks: Mapping[str, Column], context: Sequence[tuple[str, Column]] = ()) -> Column:
    """One text per row: header lines, source context, and marked blocks to edit."""
    lines = [F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in header.items()]
    facts = [F.when(v.isNotNull(), F.concat(F.lit(f"- {k}: "), v.cast("string"))) for k, v in context]
    edits = [F.concat(F.lit(OPEN.format(n) + "\n"), v, F.lit("\n" + CLOSE.format(n))) for n, v in blocks.items()]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), *facts, *edits)


def header_value(document: Column | str, name: str) -> Column:
    """Value of a header line."""
    return F.nullif(F.regexp_extract(as_col(document), rf"(?m)^{name}: (.*)$", 1), F.lit(""))


def block_value(document: Column | str, name: str) -> Column:
    """Text between the markers of a block."""
    return F.regexp_extract(as_col(document), rf"(?s){OPEN.format(name)}\n(.*?)\n{CLOSE.format(name)}", 1)


def skeleton_sha256(document: Column | str, blocks: Sequence[str] = BLOCKS) -> Column:
    """Digest of the document with its editable parts blanked: equal means that only text was edited."""
    text = as_col(document)
    for name in blocks:
        text = F.regexp_replace(text, rf"(?s)({OPEN.format(name)}\n).*?(\n{CLOSE.format(name)})", "$1$2")
    return F.sha2(text, 256)


def parse_handoff(df: DataFrame, document: str, headers: Sequence[str], blocks: Sequence[str] = BLOCKS) -> DataFrame:
    """Header values, blocks and the structure digest as columns."""
    return df.select(
        *[c for c in df.columns if c != document], *[header_value(document, h).alias(h) for h in headers],
        *[block_value(document, b).alias(b) for b in blocks], skeleton_sha256(document, blocks).alias("skeleton_sha256"))


def translation_problems(sent: DataFrame, returned: DataFrame, keys: Sequence[str], blocks: Sequence[str] = BLOCKS) -> DataFrame:
    """Returned documents against what was sent: missing, bound to another source, structure changed, text not changed."""
    s = sent.select(*keys, F.col("source_sha256").alias("s_source"), F.col("skeleton_sha256").alias("s_skeleton"), *[F.col(b).alias(f"s_{b}") for b in blocks])
    joined = s.join(returned, list(keys), "left")
    same = F.lit(True)
    for b in blocks:
        same = same & (F.col(b) == F.col(f"s_{b}"))
    problem = (
        F.when(F.col("skeleton_sha256").isNull(), "missing").when(F.col("source_sha256") != F.col("s_source"), "other-source")
        .when(F.col("skeleton_sha256") != F.col("s_skeleton"), "structure-changed")
        .when(same, "not-translated").when(F.trim(F.col(blocks[0])) == "", "empty-text"))
    return joined.select(*keys, problem.alias("problem")).where("problem is not null")


def fact_lines(df: DataFrame, key: str, sections: Mapping[str, Sequence[tuple[str, Column]]]) -> DataFrame:
    """A fact sheet as numbered lines (key, line, section, text): headings and labelled facts that are present.

    Lines stay rows, so a sheet of any length is never gathered; sorted by (key, line) they are the document.
    """
    rows, n = [], 0
    for section, facts in sections.items():
        rows.append(F.struct(F.lit(n).alias("line"), F.lit(section).alias("section"), F.lit(f"## {section}").alias("text")))
        n += 1
        for label, value in facts:
            text = F.when(F.trim(value.cast("string")) != "", F.concat(F.lit(f"- {label}: "), value.cast("string")))
            rows.append(F.struct(F.lit(n).alias("line"), F.lit(section).alias("section"), text.alias("text")))
            n += 1
    return df.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*").where("text is not null")


def write_sheets(lines: DataFrame, context: DataFrame, key: str, root: str) -> None:
    """A package of fact sheets: their lines, one record per sheet with its digests, and one manifest row, written last.

    A sheet has a line per section and fact that the caller names, so its text fits in a row; the context is the row of
    ``context`` for the key, as canonical JSON.
    """
    spark = lines.sparkSession
    lines.write.mode("errorifexists").parquet(f"{root}/lines")
    stored = spark.read.schema(lines.schema).parquet(f"{root}/lines")
    facts = [c for c in context.columns if c != key]
    known = context.select(key, F.sha2(canonical_json(context, facts), 256).alias("context_sha256"))
    _sheets(stored, key).join(known, key, "left").write.mode("errorifexists").parquet(f"{root}/sheets")
    sheets = spark.read.parquet(f"{root}/sheets")
    manifest = set_digest(sheets.select(row_digest(sheets).alias("h")), "h")
    manifest.write.mode("errorifexists").json(f"{root}/manifest")


def _sheets(lines: DataFrame, key: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("line", "text")))
    return lines.groupBy(key).agg(ordered.alias("l")).select(
        key, F.sha2(F.array_join(F.col("l.text"), "\n"), 256).alias("content_sha256"), F.size("l").cast("long").alias("lines"))


def read_sheets(spark: SparkSession, root: str, key: str) -> DataFrame:
    """The sheets of a package; ``intact`` where text still has its digest and the records are those of the manifest."""
    sheets = spark.read.parquet(f"{root}/sheets")
    manifest = spark.read.schema("row_count long, set_sha256 string").json(f"{root}/manifest").select(F.col("row_count").alias("package_sheets"), F.col("set_sha256").alias("_stored"))
    found = set_digest(sheets.select(row_digest(sheets).alias("h")), "h").select(F.col("set_sha256").alias("_found"))
    now = _sheets(spark.read.parquet(f"{root}/lines"), key).select(key, F.col("content_sha256").alias("_now"))
    told = with_scalars(sheets.join(now, key, "left"), manifest, found)
    same = F.coalesce(F.col("_now") == F.col("content_sha256"), F.lit(False)) & (F.col("_stored") == F.col("_found"))
    return told.withColumn("intact", same).drop("_now", "_stored", "_found")


def context_join(products: DataFrame, mapping: DataFrame, observations: DataFrame, media: DataFrame, key: str, observed: str) -> DataFrame:
    """Product ⟕ mapping ⟕ observation ⟕ number of local media: unique right sides, so rows are never multiplied."""
    counts = media.groupBy(observed).agg(F.count(F.lit(1)).alias("media_files"))
    return (
        products.join(mapping, key, "left").join(observations, observed, "left").join(counts, observed, "left")
        .withColumn("media_files", F.coalesce("media_files", F.lit(0)))
    )


def wide_rows(df: DataFrame, key: str, position: str, collection: str, fields: Sequence[str], width: int | None = None) -> DataFrame:
    """Nested rows as ``collection/0/field`` columns, blanks filled, for all positions that occur.

    A caller that fixes ``width`` exports the rows of :func:`too_wide` long.

    Each cell is a conditional maximum: constant state per key, combined map-side, no array is built.
    """
    width = widest(df, position) if width is None else width
    cells = [
        F.coalesce(F.max(F.when(F.col(position) == i, F.col(f).cast("string"))), F.lit("")).alias(f"{collection}/{i}/{f}")
        for i in range(width) for f in fields
    ]
    return df.groupBy(key).agg(*cells)


def too_wide(df: DataFrame, key: str, position: str, width: int) -> DataFrame:
    """Keys with positions the wide form has no column for; they must be exported long."""
    return df.where(F.col(position) >= width).groupBy(key).agg(F.max(position).alias("highest_position"))


def widest(df: DataFrame, position: str) -> int:
    """Number of positions in use, to size the wide form."""
    found = df.agg(F.max(position).alias("m")).collect()[0].m
    return 0 if found is None else int(found) + 1


def union_headers(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts with different headers under the union of all headers, blanks filled."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.na.fill("")
