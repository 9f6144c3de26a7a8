"""Helpers that keep jobs safe at size: pinned results, work folders, numbering and neighbour look-ups that never put one large key into one task."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows per window task in neighbour look-ups over dense positions.
BLOCK_ROWS = 1 << 16


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. Only a local master may do without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        configured = tempfile.mkdtemp(prefix="catalogspark-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run; nothing is ever overwritten or cleared."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that a lost executor cannot change the rows."""
    shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A small fixed table from values written in the code, as a plain projection (no Python RDD)."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def explode_rows(df: DataFrame, keep: Sequence[Column | str], array: Column | str, name: str) -> DataFrame:
    """One row per non-NULL element of a computed array, next to the kept columns.

    A plain explode makes the optimizer add size and NULL filters that repeat the array expression below the
    generator; the outer form evaluates it once, and the filter stays above.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def with_scalars(df: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Add the columns of one-row results (totals, digests, counts) as scalar subqueries: no join at all."""
    out = df
    for facts in one_row:
        value = facts.select(F.struct(*facts.columns).alias("_s")).scalar()
        out = out.select("*", value.alias("_s")).select(*out.columns, *[F.col(f"_s.{c}").alias(c) for c in facts.columns])
    return out


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan whose rows lie in fewer splits than cores before expensive per-row work.

    A split without the start of a row group is empty, so rows are counted, not splits (no column is read for that). An
    input that is spread already is returned as it is: no shuffle is added there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]  # one number per split
    if max(sizes, default=0) * cores <= 2 * sum(sizes):
        return df
    return df.repartition(cores * min(4, max(1, sum(sizes) // (cores * 10_000))))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    cond = F.lit(True)
    for key in keys:
        cond = cond & left[key].eqNullSafe(right[key])
    return cond


def quantiles(df: DataFrame, value: str, shares: Sequence[str], bins: int = 1 << 12) -> list[float | None]:
    """The smallest value at or below which a share (decimal text: ``"0.995"``) of the finite numbers lies; exact.

    ``percentile_disc`` holds all different values in one task. Here a histogram over the range that holds the wanted
    rank is narrowed to its bin, round by round, until one value is left; a round is one map-side combined aggregate.
    """
    v = F.col(value).cast("double")
    df = df.where(~F.isnan(v) & (F.abs(v) < float("inf")))
    n, low, high = df.agg(F.count(v), F.min(v), F.max(v)).first()
    at = [[low, high, max(1, math.ceil(Fraction(s) * n))] for s in shares]  # a range, and the rank in it
    while open_ := [i for i, (lo, hi, _) in enumerate(at) if lo != hi]:
        bin_of = lambda lo, hi: F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
        places = [F.when(v.between(at[i][0], at[i][1]), F.struct(F.lit(i).alias("i"), bin_of(F.lit(at[i][0]), F.lit(at[i][1])).alias("bin"))) for i in open_]
        binned = explode_rows(df, [v.alias("v")], F.array_compact(F.array(*places)), "p")
        counts = binned.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()  # bins per share
        for i in open_:
            for r in sorted((r for r in counts if r.p.i == i), key=lambda r: r.p.bin):
                if at[i][2] <= r.n:
                    at[i][:2] = r.lo, r.hi
                    break
                at[i][2] -= r.n
    return [lo for lo, _, _ in at]


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """1..n per key in ``order`` (which must be unique within a key).

    Rows are range-split by key and full order and sorted inside each slice; a row's number is its place there less that of
    the key's first row, shifted by the sizes of the key's slices before, so that a key of any size is spread over tasks.
    Slices are stored with the places, because a range split that is computed again after a loss need not fall in the
    same places; rows are shuffled once for the split and once at most to meet their key's numbers.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    sliced = df.repartitionByRange(slices, *[F.col(k) for k in keys], *order).sortWithinPartitions(*keys, *order)
    # the lower 33 bits count the rows of a partition in their order
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sliced = sliced.select("*", F.spark_partition_id().alias("_slice"), place.alias("_place"))
    path = work_dir(df.sparkSession, "slices")
    sliced.write.parquet(path)
    sliced = df.sparkSession.read.schema(sliced.schema).parquet(path)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
    # one row per (key, slice): a key spans at most `slices` rows here
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_slice").alias("_o_slice"),
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    cond = sliced["_slice"] == offsets["_o_slice"]
    for key in keys:
        cond = cond & sliced[key].eqNullSafe(offsets[f"_o_{key}"])
    return sliced.join(offsets, cond, "left").withColumn(out, (F.col("_place") + F.col("_shift")).cast("long")).select(*df.columns, out)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system; other errors (rights, network) are raised."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: Sequence[str],
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``_prev`` and ``_next``: the rows at position−1 and position+1 of the same key, else NULL.

    Rows are windowed per (key, block of positions); the edge rows of a block are also sent to the
    neighbouring block, so no key is ever gathered in one task and the data is shuffled once.
    """
    blk = F.floor(F.col(position) / block)
    inside = F.pmod(F.col(position), F.lit(block))
    homes = F.when(inside == block - 1, F.array(blk, blk + 1)).when(inside == 0, F.array(blk, blk - 1))
    spread = df.withColumn("_home", blk).withColumn(
        "_blk", F.explode(homes.otherwise(F.array(blk)))
    )
    window = Window.partitionBy(*keys, "_blk").orderBy(position)
    payload = F.struct(F.col(position).alias("_pos"), *[F.col(c) for c in columns])
    seen = spread.withColumn("_p", F.lag(payload).over(window)).withColumn("_n", F.lead(payload).over(window))
    return (
        seen.where(F.col("_blk") == F.col("_home"))
        .withColumn("_prev", F.when(F.col("_p._pos") == F.col(position) - 1, F.col("_p")))
        .withColumn("_next", F.when(F.col("_n._pos") == F.col(position) + 1, F.col("_n")))
        .drop("_home", "_blk", "_p", "_n")
    )
