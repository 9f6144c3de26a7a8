"""A table of known keys that grows by batches and is never read whole: buckets, levels of runs, Bloom filters.

Every batch adds a *run*: its new keys by hash bucket, and a Bloom filter per bucket; a run has as many buckets as its
size asks for, up to the store's. When ``fan`` runs stand on a level they are merged into one on the next, so n batches
leave at most (fan - 1) runs on each of log(n) levels, and a key is rewritten once per level. A batch asks the filters
first; only buckets of runs whose filter holds one of its keys are read and joined exactly. A manifest per batch names
the live runs and is written last: a batch that is repeated starts from the manifest before it and writes its own run
folders anew.

Filters are rows (bucket, piece, 4096 bytes), built and asked by Spark's bitmap functions; about ten bits a key and seven
positions, all in one row of the filter, give about one key in a hundred a needless look. Keys are text; the caller gives none that is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions.canon import key_bucket
from catalogspark.scale import path_exists

#: Bits of one filter row, filter bits per key, and positions set per key.
PIECE = 1 << 15
BITS, POSITIONS = 10, 7
#: Keys for which a bucket of its own is worth while, and keys in one file of a bucket at most.
BUCKET_KEYS, FILE_KEYS = 50_000, 4_000_000


@dataclass(frozen=True)
class Run:
    """Keys that came together: level, name of the folder, number of buckets, filter rows per bucket, number of keys."""

    level: int
    name: str
    buckets: int
    pieces: int
    n: int


_RUN = "level int, name string, buckets int, pieces int, n long"


def place(key: str, pieces: int) -> Column:
    """Where a key stands in a filter: one piece, and its bits there."""
    first, step = (F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(1 << 48)) for i in (1, 2))
    bits = F.array(*[F.pmod(first + F.lit(i) * step, F.lit(PIECE)) for i in range(POSITIONS)])
    return F.struct(F.pmod(F.floor(first / PIECE), F.lit(pieces)).cast("int").alias("piece"), bits.alias("bits_of"))


class KeyStore:
    """Keys below ``root``, written by one job, batch after batch. ``buckets`` is a power of two."""

    def __init__(self, spark: SparkSession, root: str, key: str = "key", buckets: int = 64, fan: int = 4, bucket_keys: int = BUCKET_KEYS) -> None:
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.spark, self.root, self.key, self.buckets, self.fan, self.bucket_keys = spark, root, key, buckets, fan, bucket_keys
        self.last_read: list[str] = []
        self._live: dict[int, list[Run]] = {-1: []}

    def runs(self, batch: int) -> list[Run]:
        """The live runs after a batch; none before the first."""
        if batch not in self._live:
            rows = self.spark.read.schema(_RUN).json(f"{self.root}/manifest/batch={batch}").collect()  # at most (fan - 1) a level
            self._live[batch] = sorted((Run(*r) for r in rows), key=lambda r: (r.level, r.name))
        return list(self._live[batch])

    def known(self, keys: DataFrame, batch: int) -> DataFrame:
        """Those of the (distinct) keys that batches up to ``batch`` have stored."""
        live, self.last_read = self.runs(batch), []
        if not live:
            return keys.select(self.key).where("1 = 0")
        bucket = key_bucket(self.key, self.buckets)
        places = F.array(*[F.struct(F.lit(r.name).alias("run"), F.pmod(bucket, F.lit(r.buckets)).cast("int").alias("bucket"), place(self.key, r.pieces).alias("at")) for r in live])
        asked = keys.select(self.key, F.inline(places)).select(self.key, "run", "bucket", "at.*")
        filters = self.spark.read.schema("run string, bucket int, piece int, bits binary").parquet(*[f"{self.root}/filters/run={r.name}" for r in live])
        byte = lambda bit: F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.forall("bits_of", lambda bit: byte(bit).bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8).cast("int") + 1)) > 0)
        maybe = asked.join(filters, ["run", "bucket", "piece"]).where(is_set).select(self.key, "run", "bucket").persist()
        hit = maybe.select("run", "bucket").distinct().collect()  # at most live runs times buckets
        self.last_read = sorted(f"{self.root}/runs/run={p.run}/bucket={p.bucket}" for p in hit)
        if not hit:
            maybe.unpersist()
            return keys.select(self.key).where("1 = 0")
        return self._read(self.last_read).join(maybe.select(self.key).distinct(), self.key, "left_semi")

    def add(self, keys: DataFrame, batch: int) -> None:
        """Store new keys (distinct, not known, cheap to read twice) as the run of this batch; merge full levels; write the manifest."""
        live, n = self.runs(batch - 1), keys.count()
        if n:
            live.append(self._write(keys.select(self.key), n, 0, batch))
        level = 0
        while len(full := [r for r in live if r.level == level]) >= self.fan:
            merged = self._read([f"{self.root}/runs/run={r.name}" for r in full])
            live = [r for r in live if r.level != level] + [self._write(merged, sum(r.n for r in full), level + 1, batch)]
            level += 1
        rows = self.spark.createDataFrame([(r.level, r.name, r.buckets, r.pieces, r.n) for r in live], _RUN)
        rows.coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/batch={batch}")
        self._live[batch] = sorted(live, key=lambda r: (r.level, r.name))

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(f"`{self.key}` string, run string, bucket int").option("basePath", f"{self.root}/runs").parquet(*paths).select(self.key)

    def _write(self, keys: DataFrame, n: int, level: int, batch: int) -> Run:
        buckets = 1
        while buckets < self.buckets and n > buckets * self.bucket_keys:
            buckets *= 2
        run = Run(level, f"L{level}-{batch}", buckets, max(1, -(-BITS * n // (buckets * PIECE))), n)
        placed = keys.select(self.key, F.pmod(key_bucket(self.key, self.buckets), F.lit(buckets)).cast("int").alias("bucket"))
        # keys are unique and hashed, so buckets are even; a large one is several files
        writer = placed.repartition(buckets, "bucket").write.mode("overwrite").option("maxRecordsPerFile", FILE_KEYS)
        writer.partitionBy("bucket").parquet(f"{self.root}/runs/run={run.name}")
        bit = placed.select("bucket", place(self.key, run.pieces).alias("at")).select("bucket", "at.piece", F.explode("at.bits_of").alias("bit"))
        filters = bit.groupBy(F.lit(run.name).alias("run"), "bucket", "piece").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        filters.write.mode("overwrite").parquet(f"{self.root}/filters/run={run.name}")
        return run

    def dead(self, batch: int) -> list[str]:
        """Folders of runs that the manifest of a batch no longer names; they may go once no earlier batch can be repeated."""
        names = {r.name for r in self.runs(batch)}
        earlier = {r.name for b in range(batch) if path_exists(self.spark, f"{self.root}/manifest/batch={b}") for r in self.runs(b)}
        return sorted(f"{self.root}/runs/run={n}" for n in earlier - names)
