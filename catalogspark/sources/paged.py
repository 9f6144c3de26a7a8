"""Page by page copies of a table that may change meanwhile: key ranges, a stored cursor, fingerprints before and after.

The keys are cut into ranges of about equal numbers of rows, from quantiles. A page is one scan with its range pushed
down, written to a folder of its own; finished folders are the cursor, so a run that stopped goes on with the next page.
Before the first page and after the last one the table is fingerprinted range by range (rows, greatest key, set digest, in
one aggregate). A copy is accepted only if both agree; otherwise it is refused, and the next call reads the changed ranges
again, and only those.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions.canon import limb_digest, limb_sums, row_digest
from catalogspark.scale import path_exists

_PRINT = "page int, row_count long, last long, set_sha256 string"


def page_edges(df: DataFrame, key: str, pages: int) -> list[int]:
    """Upper ends of all pages but the last one, which is open."""
    found = df.approxQuantile(key, [i / pages for i in range(1, pages)], 1 / (8 * pages))
    return sorted({int(x) for x in found})


def _page(key: str, edges: Sequence[int]) -> Column:
    return F.array_size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<bigint>"), lambda e: e < F.col(key))) if edges else F.lit(0)


def fingerprints(df: DataFrame, key: str, edges: Sequence[int]) -> DataFrame:
    """``page, row_count, last, set_sha256`` of every range that has rows."""
    rows = df.select(_page(key, edges).cast("int").alias("page"), F.col(key).cast("long").alias("_k"), row_digest(df).alias("_h"))
    sums = rows.groupBy("page").agg(F.count(F.lit(1)).alias("row_count"), F.max("_k").alias("last"), *limb_sums("_h"))
    return sums.select("page", "row_count", "last", limb_digest("row_count").alias("set_sha256"))


def _range(df: DataFrame, key: str, edges: Sequence[int], page: int) -> DataFrame:
    """The rows of a page, by plain comparisons that reach the scan."""
    if page:
        df = df.where(F.col(key) > F.lit(edges[page - 1]))
    return df.where(F.col(key) <= F.lit(edges[page])) if page < len(edges) else df


def paged_copy(spark: SparkSession, read: Callable[[], DataFrame], key: str, target: str, pages: int = 8, after_page: Callable[[int], None] | None = None) -> list[int]:
    """Go on with the copy of what ``read`` gives below ``target``; returns the pages that were read in this call.

    The copy is accepted when ``target/accepted`` is there (:func:`accepted`). A call after a refusal reads the ranges
    whose fingerprints changed. NULL keys are refused: they lie in no range. ``after_page`` is called between pages.
    """
    if accepted(spark, target):
        return []
    attempt = 0
    while path_exists(spark, f"{target}/refused/attempt={attempt}/_SUCCESS"):
        attempt += 1
    plan = f"{target}/plan/attempt={attempt}"
    if not path_exists(spark, f"{plan}/_SUCCESS"):
        table = read()
        if not table.where(F.col(key).isNull()).isEmpty():
            raise ValueError(f"rows without {key} cannot be paged")
        edges = _edges(spark, target) if attempt else page_edges(table, key, pages)
        if not attempt:
            spark.createDataFrame([(e,) for e in edges], "edge long").coalesce(1).write.mode("overwrite").json(f"{target}/edges")
        fingerprints(table, key, edges).coalesce(1).write.mode("overwrite").json(plan)
    edges, prints = _edges(spark, target), spark.read.schema(_PRINT)
    want = {r["page"]: (r["row_count"], r["set_sha256"]) for r in prints.json(plan).collect()}  # one row a page
    read_now = []
    for page in sorted(want):
        folder = f"{target}/pages/page={page}/{want[page][1]}"
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            _range(read(), key, edges, page).write.mode("overwrite").parquet(folder)
            read_now.append(page)
            if after_page:
                after_page(page)
    # what is stored must be what was there before, and what is there now
    now = {r["page"]: (r["row_count"], r["set_sha256"]) for r in fingerprints(read(), key, edges).collect()}
    kept = {r["page"]: (r["row_count"], r["set_sha256"]) for r in fingerprints(_stored(spark, target, want, read().schema), key, edges).collect()} if want else {}
    verdict = "accepted" if now == want == kept else f"refused/attempt={attempt}"
    rows = [(page, n, digest) for page, (n, digest) in want.items()]
    spark.createDataFrame(rows, "page int, row_count long, set_sha256 string").coalesce(1).write.mode("overwrite").json(f"{target}/{verdict}")
    return read_now


def _edges(spark: SparkSession, target: str) -> list[int]:
    return sorted(r["edge"] for r in spark.read.schema("edge long").json(f"{target}/edges").collect())


def _stored(spark: SparkSession, target: str, pages: dict[int, tuple[int, str]], schema) -> DataFrame:
    if not pages:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/pages/page={page}/{digest}" for page, (_, digest) in sorted(pages.items())])


def accepted(spark: SparkSession, target: str) -> bool:
    return path_exists(spark, f"{target}/accepted/_SUCCESS")


def copied(spark: SparkSession, target: str, schema) -> DataFrame:
    """The rows of an accepted copy."""
    if not accepted(spark, target):
        raise ValueError(f"{target} holds no accepted copy")
    rows = spark.read.schema("page int, row_count long, set_sha256 string").json(f"{target}/accepted").collect()
    return _stored(spark, target, {r["page"]: (r["row_count"], r["set_sha256"]) for r in rows}, schema)
