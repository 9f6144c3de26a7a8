"""Temperature mixing of sources: exponentiate token shares, bisect the exponent, realise the weights as block permutations.

Weights are ``share ** alpha`` normalised. ``alpha = 1`` keeps the natural mix, ``alpha = 0`` gives every source the
same weight. The exponent is the smallest in [0, 1] that keeps the repetition limit (the most repeated source is read
at most ``repetition_limit`` times as often as the least repeated one) and, if a target entropy is given, does not
exceed that entropy. Both are monotone in alpha, so a bracket is narrowed step by step over the table of sources.

A source's budget is its weight times the token budget. Without a stated budget the smallest one is taken that reads
every source whole at least once, so that no document is lost. A budget is spent in epochs: whole permutations of the
source, then the beginning of one more. A permutation is a hash order in blocks: the blocks before the cut are
taken whole, the block at the cut up to the budget, so a source with a third of all rows is worked on block by block.

Only DataFrame operations. Defined results: a NULL source is a source of its own; NULL and empty texts have no tokens
and cost nothing, and are read in every whole epoch; a source without any token is read once; repeated rows count each
time; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm.shared import named_back, place_of, renamed, stored

#: Blocks of a permutation: the leading hex digits of the row's hash, 16 ** 3 blocks.
BLOCK_DIGITS = 3
#: Points per narrowing of the bracket; each round is one aggregate over the table of sources.
POINTS = 33
ROUNDS = 10


def text_tokens(text: Column) -> Column:
    """Words of a text: runs of characters other than space and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_shares(docs: DataFrame, tokens: str, source: str) -> DataFrame:
    """One row per source: documents, tokens and share of all tokens."""
    per = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(tokens).alias("n_tokens"))
    total = per.select(F.sum("n_tokens").alias("t")).scalar()
    return per.select("*", (F.col("n_tokens") / F.nullif(total, F.lit(0))).alias("share"))


def _measures(shares: DataFrame, alphas: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy and repetition ratio of the mix for each exponent."""
    grid = F.explode(F.array(*[F.lit(a) for a in alphas])).alias("alpha")
    rows = shares.where("share > 0").select("share", F.log("share").alias("ln"), grid)
    power = F.exp(F.col("alpha") * F.col("ln"))
    ratio = F.exp((F.col("alpha") - 1) * F.col("ln"))  # weight per share, up to a constant
    found = rows.groupBy("alpha").agg(
        (F.log(F.sum(power)) - F.col("alpha") * F.sum(power * F.col("ln")) / F.sum(power)).alias("entropy"),
        (F.max(ratio) / F.min(ratio)).alias("repetition"),
    )
    return {r["alpha"]: (r["entropy"], r["repetition"]) for r in found.collect()}


def fit_exponent(shares: DataFrame, repetition_limit: float | None = 2.0, target_entropy: float | None = None) -> float:
    """The smallest exponent that keeps both limits, to about 1e-15."""
    keeps = lambda m: (repetition_limit is None or m[1] <= repetition_limit) and (target_entropy is None or m[0] <= target_entropy)
    low, high = 0.0, 1.0
    for n in range(ROUNDS):
        alphas = [low + (high - low) * i / (POINTS - 1) for i in range(POINTS)]
        found = _measures(shares, alphas)
        if not found or keeps(found[alphas[0]]):
            return low
        # alpha = 1 always keeps the repetition limit; a target entropy below the natural one is not reached
        first = next((i for i in range(1, POINTS) if keeps(found[alphas[i]])), POINTS - 1)
        low, high = alphas[first - 1], alphas[first]
    return high


def source_plan(shares: DataFrame, alpha: float, budget_tokens: int | None = None) -> DataFrame:
    """Weight, token quota, whole epochs and rest per source."""
    power = F.when(F.col("share") > 0, F.exp(F.lit(alpha) * F.log("share")))
    rows = shares.select("*", power.alias("_p"))
    sums = rows.select(F.sum("_p").alias("z")).scalar()
    rows = rows.select("*", (F.col("_p") / sums).alias("weight"))
    budget = F.lit(float(budget_tokens)) if budget_tokens is not None else rows.select(F.max(F.col("n_tokens") / F.col("weight"))).scalar()
    quota = F.coalesce(F.round(F.col("weight") * budget).cast("long"), F.lit(0))
    epochs = F.when(F.coalesce("n_tokens", F.lit(0)) > 0, F.floor(quota / F.col("n_tokens"))).otherwise(1).cast("int")
    return rows.select(
        "source", "n_docs", "n_tokens", "share", F.coalesce("weight", F.lit(0.0)).alias("weight"), quota.alias("quota"), epochs.alias("whole_epochs"),
        F.when(F.col("n_tokens") > 0, quota - epochs * F.col("n_tokens")).otherwise(0).alias("rest_tokens"),
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", repetition_limit: float | None = 2.0,
    target_entropy: float | None = None, budget_tokens: int | None = None, into: str = "mix",
) -> DataFrame:
    """The mixed corpus: every column of ``docs`` once per reading, and a struct ``into`` that tells the reading.

    It holds n_tokens, weight, epoch, and the place in the epoch's permutation: block, then the row's hash.
    """
    row_id, body, origin = (place_of(docs, c) for c in (doc_id, text, source))
    sized = renamed(docs).select("*", text_tokens(F.col(body).cast("string")).alias("_tokens"), F.xxhash64(F.col(body).cast("string")).alias("_tie"))
    facts = stored(sized.select(F.col(origin).alias("_source"), "_tokens"), "source-tokens")
    shares = stored(source_shares(facts, "_tokens", "_source"), "source-shares")
    plan = stored(source_plan(shares, fit_exponent(shares, repetition_limit, target_entropy), budget_tokens), "source-plan")
    plan = plan.select(F.struct("source").alias("_key"), F.struct("weight", "whole_epochs", "rest_tokens").alias("_plan"))
    joined = sized.select("*", F.struct(F.col(origin).alias("source")).alias("_of")).join(plan, F.col("_of").eqNullSafe(F.col("_key")))
    epoch = lambda df, e: df.select("*", e.alias("_epoch")).select("*", _order(row_id).alias("_hash")).select("*", F.substring("_hash", 1, BLOCK_DIGITS).alias("_block"))
    whole = epoch(joined.where("_plan.whole_epochs > 0"), F.explode(F.sequence(F.lit(0), F.col("_plan.whole_epochs") - 1)))
    part = epoch(joined.where("_plan.rest_tokens > 0"), F.col("_plan.whole_epochs"))
    sizes = part.groupBy("_of", "_block").agg(F.sum("_tokens").alias("_n"), F.first("_plan.rest_tokens").alias("_rest"))
    before = Window.partitionBy("_of").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # at most 16 ** 3 rows a source
    offsets = sizes.select("_of", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < F.col("_rest"))
    inside = Window.partitionBy("_of", "_block").orderBy("_hash", row_id, "_tokens", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = (
        part.join(offsets.select(F.col("_of").alias("_o"), F.col("_block").alias("_b"), "_before"), F.col("_of").eqNullSafe(F.col("_o")) & (F.col("_block") == F.col("_b")))
        .select("*", (F.col("_before") + F.sum("_tokens").over(inside)).alias("_to"))
        .where(F.col("_to") <= F.col("_plan.rest_tokens"))
        .select(whole.columns)
    )
    told = F.struct(F.col("_tokens").alias("n_tokens"), "_plan.weight", F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_hash").alias("place"))
    return whole.unionByName(part).select(*named_back(docs), told.alias(into))


def _order(doc_id: str) -> Column:
    """A hash order of the rows that differs from epoch to epoch."""
    return F.md5(F.concat_ws("-", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.col("_epoch").cast("string")))
