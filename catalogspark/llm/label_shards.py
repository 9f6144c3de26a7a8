"""Balanced label propagation over groups of linked documents, with exact shard sizes.

Documents with equal texts are linked. A group is a star around its text's digest, so the shards of a document's
neighbours are the group's counts per shard: one row per group, however large the group. A group larger than a shard is
cut into units of a shard's size and a rest. Every linked document starts on a shard, dealt evenly. In each round every
unsettled unit asks for the shard with most of its documents, among those that have room for the whole unit; shards grant
in order, larger units first, while the quota lasts, and the documents of a granted unit move there. Refused units ask
anew with what room is left, so rounds go on until none is left that fits anywhere; every round settles at least one unit
of each shard that is asked. A settled unit has no cut edge. Units that fit nowhere whole share the free places, one
after the other; documents without links cost nothing anywhere and fill every shard to its exact quota.

Law ``rows``: counts of documents per shard differ by one at most. The cut (documents outside the shard that holds most of
their group) before and after is told with every row. NULL texts count as empty bytes and are equal to empty texts; NULL
and repeated ids are rows like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm.shared import BUCKET_ROWS, numbered, stored

SHARDS = 8
#: Size classes of units (powers of two) that are served from large to small.
CLASSES = 40
#: Groups of more than this part of all rows are joined by broadcast: fewer than 1 / HOT of them.
HOT = 1e-5


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, the size of the document's group, and the cut before and after."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    facts = docs.select(
        docs[doc_id].alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.md5(body).alias("_g"),
    )
    facts = stored(facts.select("*", F.xxhash64("doc_id", "_g").alias("_h")), "texts")
    total = facts.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    bar, cap, buckets = max(BUCKET_ROWS, int(total * HOT)), max(1, quota[-1]), max(8, total // BUCKET_ROWS)
    groups = stored(facts.groupBy("_g").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1"), "groups")
    hot, rest = F.broadcast(groups.where(F.col("_m") > bar)), groups.where(F.col("_m") <= bar)
    linked = facts.join(hot, "_g").unionByName(facts.join(hot, "_g", "left_anti").join(rest, "_g"))
    start = numbered(linked.withColumn("_k", F.lit(0)), ["_k"], [F.col("_h")], [F.col("_h"), F.col("doc_id")], "_i", buckets)
    start = start.select(*linked.columns, F.pmod("_i", F.lit(shards)).cast("int").alias("shard"))
    large = numbered(start.where(F.col("_m") > cap), ["_g"], [F.col("_h")], [F.col("_h"), F.col("doc_id")], "_i", buckets)
    unit = F.concat("_g", F.lit("-"), F.floor(F.col("_i") / cap).cast("string")).alias("_u")
    labels = start.where(F.col("_m") <= cap).select("*", F.col("_g").alias("_u")).unionByName(large.select(*start.columns, unit))
    labels = stored(labels, "labels")
    counts = [F.count_if(F.col("shard") == s).alias(f"_c{s}") for s in range(shards)]
    units = stored(labels.groupBy("_u").agg(F.count(F.lit(1)).alias("_n"), *counts), "units")
    settled, left = _settle(units, list(quota), shards)
    home = settled.select("_u", F.col("_to").alias("_home"))
    big, small = labels.where(F.col("_m") > bar), labels.where(F.col("_m") <= bar)  # units of hot groups are few
    hot_home = F.broadcast(home.join(big.select("_u").distinct(), "_u", "left_semi"))
    homed = big.join(hot_home, "_u", "left").unionByName(small.join(home, "_u", "left"))
    homed = stored(homed.select("doc_id", "size", "text_crc32", "_g", "_u", "_h", "_m", "_home"), "homed")
    placed = homed.where("_home is not null").withColumnRenamed("_home", "shard").drop("_u")
    open_ = homed.where("_home is null").drop("_home").withColumn("_k", F.lit(0))
    open_ = numbered(open_, ["_k"], [F.xxhash64("_u")], [F.col("_u"), F.col("_h"), F.col("doc_id")], "_i", buckets)
    n_open = open_.count()
    single = facts.join(hot, "_g", "left_anti").join(rest, "_g", "left_anti").select("*", F.lit(1).cast("long").alias("_m"), F.lit(0).alias("_k"))
    single = numbered(single, ["_k"], [F.col("_h")], [F.col("_h"), F.col("doc_id")], "_i", buckets)
    loose = open_.drop("_u").unionByName(single.withColumn("_i", F.col("_i") + n_open).select(*[c for c in open_.columns if c != "_u"]))
    at, place = 0, F.lit(0)
    for s in sorted(range(shards), key=lambda s: -left[s]):
        place = F.when(F.col("_i") >= at, s).otherwise(place) if left[s] else place
        at += left[s]
    placed = stored(placed.unionByName(loose.select(*[c for c in placed.columns if c != "shard"], place.cast("int").alias("shard"))), "placed")
    before, after = _cut(labels), _cut(placed.where("_m > 1"))
    out = numbered(placed, ["shard"], [F.col("_h")], [F.col("_h"), F.col("doc_id")], "slot", buckets)
    cut = [F.lit(n).cast("long").alias(name) for name, n in (("cut_before", before), ("cut_after", after))]
    return out.select("doc_id", "size", "text_crc32", "shard", "slot", F.col("_m").alias("group_size"), *cut)


def _cut(labels: DataFrame) -> int:
    """Documents outside the shard that holds most of their group."""
    per = labels.groupBy("_g", "shard").agg(F.count(F.lit(1)).alias("_c")).groupBy("_g").agg((F.sum("_c") - F.max("_c")).alias("_x"))
    return per.agg(F.coalesce(F.sum("_x"), F.lit(0)).alias("n")).first()["n"]


def _settle(units: DataFrame, free: list[int], shards: int) -> tuple[DataFrame, list[int]]:
    """Rounds of asking and granting: ``_u, _to`` of the units that found a shard, and the places left per shard."""
    settled = None
    width = max(256, units.count() // BUCKET_ROWS)
    while True:
        # most documents first; equal ones by a draw from the unit's name, so that units do not all choose alike
        wishes = [F.when(F.col("_n") <= room, F.struct(F.col(f"_c{s}").alias("c"), F.xxhash64("_u", F.lit(s)).alias("d"), F.lit(s).alias("to"))) for s, room in enumerate(free)]
        asked = units.select("_u", "_n", F.array_max(F.array(*wishes))["to"].alias("_to")).where("_to is not null")
        size_class = F.lit(CLASSES) - F.least(F.lit(CLASSES - 1), F.floor(F.log2("_n"))).cast("int")
        keyed = asked.select("*", (size_class * width + F.pmod(F.xxhash64("_u"), F.lit(width)).cast("int")).alias("_b"))
        sums = keyed.groupBy("_to", "_b").agg(F.sum("_n").alias("_s"))
        before = Window.partitionBy("_to").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # <= CLASSES * width rows a shard
        sums = sums.select("_to", "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
        inside = Window.partitionBy("_to", "_b").orderBy(F.desc("_n"), "_u").rowsBetween(Window.unboundedPreceding, 0)
        upto = keyed.select("*", F.sum("_n").over(inside).alias("_in")).join(sums, ["_to", "_b"])
        limit = F.element_at(F.array(*[F.lit(int(x)) for x in free]), F.col("_to") + 1)
        granted = stored(upto.where(F.col("_off") + F.col("_in") <= limit).select("_u", "_n", "_to"), "granted")
        taken = {r["_to"]: r["n"] for r in granted.groupBy("_to").agg(F.sum("_n").alias("n")).collect()}  # one row a shard
        settled = granted if settled is None else settled.unionByName(granted)
        if not taken:
            return settled, free
        free = [room - taken.get(s, 0) for s, room in enumerate(free)]
        units = stored(units.join(granted.select("_u"), "_u", "left_anti"), "units")
