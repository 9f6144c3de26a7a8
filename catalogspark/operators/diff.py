"""Plans: desired against baseline, live state against both, definitions, variants, ownership.

Every comparison is one equi-join (or one union and aggregate) on unique keys, so a single hot key does
not exist by contract; ``duplicate_keys`` reports breaches of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import canonical_field, row_digest
from catalogspark.scale import explode_rows


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a plan over such input is refused."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def _side(df: DataFrame, key: str, fields: Sequence[str], tag: str, identity: str | None = None) -> DataFrame:
    """Key, canonical fields, digest and identity of one side, under tagged names."""
    columns = [F.col(key).alias(f"{tag}_key"), row_digest(df, fields).alias(f"{tag}_sha256")]
    columns += [canonical_field(df, f).cast("string").alias(f"{tag}_{f}") for f in fields]
    if identity:
        columns.append(F.col(identity).alias(f"{tag}_identity"))
    return df.select(*columns)


def _changed(fields: Sequence[str], left: str, right: str) -> Column:
    flags = [F.when(~F.col(f"{left}_{f}").eqNullSafe(F.col(f"{right}_{f}")), F.lit(f)) for f in sorted(fields)]
    return F.array_compact(F.array(*flags))


def diff_rows(
    desired: DataFrame, baseline: DataFrame, key: str, fields: Sequence[str], identity: str | None = None
) -> DataFrame:
    """create / conflict / update / noop for every desired row. Baseline-only rows are kept, never deleted."""
    d = _side(desired, key, fields, "d", identity)
    b = _side(baseline, key, fields, "b", identity)
    joined = d.join(b, d["d_key"] == b["b_key"], "left")
    changed = _changed(fields, "b", "d")
    known = F.col("b_key").isNotNull()
    other = known & ~F.col("b_identity").eqNullSafe(F.col("d_identity")) if identity else F.lit(False)
    action = (
        F.when(~known, "create").when(other, "conflict").when(F.size(changed) > 0, "update").otherwise("noop")
    )
    compared = action.isin("update", "noop")
    return joined.select(
        F.col("d_key").alias(key),
        action.alias("action"),
        F.when(compared, changed).otherwise(F.array().cast("array<string>")).alias("changed_fields"),
        F.when(compared, F.col("b_sha256")).alias("before_sha256"),
        F.when(action != "conflict", F.col("d_sha256")).alias("desired_sha256"),
        F.when(
            action == "update",
            F.array_compact(
                F.array(
                    *[
                        F.when(
                            ~F.col(f"b_{f}").eqNullSafe(F.col(f"d_{f}")),
                            F.struct(
                                F.lit(f).alias("field"),
                                F.col(f"b_{f}").alias("before"),
                                F.col(f"d_{f}").alias("after"),
                            ),
                        )
                        for f in sorted(fields)
                    ]
                )
            ),
        ).alias("changes"),
    )


def diff_fields(diff: DataFrame, key: str) -> DataFrame:
    """One row per changed field with its value before and after."""
    return explode_rows(diff, [key], "changes", "c").select(key, "c.field", "c.before", "c.after")


def diff_counts(diff: DataFrame) -> DataFrame:
    """Counts by action and by changed field in one aggregation."""
    names = F.concat(F.array(F.concat(F.lit("action:"), F.col("action"))),
                     F.transform("changed_fields", lambda f: F.concat(F.lit("field:"), f)))
    return (
        explode_rows(diff, [], names, "measure").groupBy("measure").agg(F.count(F.lit(1)).alias("rows"))
    )


def diff_gate(diff: DataFrame, scope: Sequence[str] | None = None) -> DataFrame:
    """One row: counts, scope violations, and whether the plan may be applied."""
    count = lambda a: F.count_if(F.col("action") == a).alias(f"{a}_rows")
    out_of_scope = _out_of_scope(scope) if scope is not None else F.lit(False)
    return diff.agg(
        count("create"), count("update"), count("noop"), count("conflict"),
        F.count_if(out_of_scope).alias("scope_errors"),
    ).withColumn(
        "eligible", (F.col("create_rows") == 0) & (F.col("conflict_rows") == 0) & (F.col("scope_errors") == 0)
    )


def _out_of_scope(scope: Sequence[str]) -> Column:
    extra = F.array_except(F.col("changed_fields"), F.array(*[F.lit(s) for s in scope]))
    return F.col("action").isin("create", "conflict") | (F.size(extra) > 0)


def scope_violations(diff: DataFrame, key: str, scope: Sequence[str]) -> DataFrame:
    """Operations a scoped update may not carry: creates, conflicts, and changes outside the scope."""
    extra = F.array_except(F.col("changed_fields"), F.array(*[F.lit(s) for s in scope]))
    return diff.where(_out_of_scope(scope)).select(
        key, "action", F.array_join(F.array_sort(extra), ",").alias("unexpected_fields")
    )


def rollback_rows(diff: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """What undoes a plan: the previous row per update, a delete marker per create."""
    touched = diff.where(F.col("action").isin("create", "update")).select(
        F.col(key).alias("_k"), F.when(F.col("action") == "create", "delete-created").otherwise("restore").alias("undo")
    )
    return touched.join(baseline, touched["_k"] == baseline[key], "left").select(
        F.col("_k").alias(key), "undo", *[c for c in baseline.columns if c != key]
    )


def apply_plan(diff: DataFrame, desired: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """Baseline after the plan: created and updated rows from desired, all others as they were."""
    touched = diff.where(F.col("action").isin("create", "update")).select(key)
    return baseline.join(touched, key, "left_anti").unionByName(
        desired.join(touched, key, "left_semi").select(*baseline.columns)
    )


def diff_children(
    desired: DataFrame, baseline: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Keyed collection diff: added / removed / changed items. One union and one aggregate, map-side combined.

    Keys are unique per side, so a maximum per field is the field; presence is counted apart from NULL.
    """
    fixed = {f: canonical_field(desired, f) for f in fields}

    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, F.lit(side).alias("_side"), *[c.alias(f"_v_{f}") for f, c in fixed.items()])

    on = lambda side, c: F.max(F.when(F.col("_side") == side, c))
    both = tagged(desired, 1).unionByName(tagged(baseline, 0))
    merged = both.groupBy(*keys).agg(
        on(1, F.lit(True)).alias("d"), on(0, F.lit(True)).alias("b"),
        *[on(side, F.col(f"_v_{f}")).alias(f"{tag}_{f}") for f in fields for side, tag in ((1, "d"), (0, "b"))],
    )
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f"d_{f}").eqNullSafe(F.col(f"b_{f}"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("d").isNull(), "removed").when(differs, "changed")
    return merged.select(*keys, change.alias("change")).where(F.col("change").isNotNull())


def structural_diff(desired: DataFrame, baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Multiset diff on whole rows: how many copies were added or removed per distinct row."""
    signed = desired.select(*columns, F.lit(1).alias("_s")).unionByName(baseline.select(*columns, F.lit(-1).alias("_s")))
    delta = signed.groupBy(*columns).agg(F.sum("_s").alias("delta")).where(F.col("delta") != 0)
    return delta.select(
        *columns, F.greatest(F.col("delta"), F.lit(0)).alias("added"), F.greatest(-F.col("delta"), F.lit(0)).alias("removed")
    )


def missing_keys(required: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys required but absent. Both sides are reduced to distinct keys first, so hot keys are one row."""
    return required.select(*keys).distinct().join(present.select(*keys).distinct(), list(keys), "left_anti")


def set_equality(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only; empty when the sets are equal."""
    tagged = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = tagged.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.where("l <> r").select(*keys, F.when(F.col("l") == 1, "left-only").otherwise("right-only").alias("side"))


def diff_definitions(
    desired: DataFrame, baseline: DataFrame, key: str, fields: Sequence[str], usage: DataFrame
) -> DataFrame:
    """Full outer plan with deletes; deleting a definition that is still used (``usage``: key, users) is a conflict."""
    d = _side(desired, key, fields, "d")
    b = _side(baseline, key, fields, "b")
    u = usage.select(F.col(key).alias("u_key"), F.col("users"))
    joined = d.join(b, d["d_key"] == b["b_key"], "full_outer").withColumn("_k", F.coalesce("d_key", "b_key"))
    joined = joined.join(u, F.col("_k") == u["u_key"], "left")
    users = F.coalesce(F.col("users"), F.lit(0)).cast("long")
    action = (
        F.when(F.col("b_key").isNull(), "create")
        .when(F.col("d_key").isNull() & (users > 0), "conflict")
        .when(F.col("d_key").isNull(), "delete")
        .when(F.col("d_sha256") != F.col("b_sha256"), "update")
        .otherwise("noop")
    )
    both = F.col("b_key").isNotNull() & F.col("d_key").isNotNull()
    changed = F.when(both, F.array_join(_changed(fields, "b", "d"), ",")).otherwise("")
    return joined.select(F.col("_k").alias(key), action.alias("action"), changed.alias("changed_fields"), users.alias("users"))


def three_way_state(
    live: DataFrame, desired: DataFrame, baseline: DataFrame, key: str, fields: Sequence[str]
) -> DataFrame:
    """Per planned key: live equals desired, equals baseline, or conflicts with both. One shuffle for three inputs."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.col(key), F.lit(tag).alias("_t"), row_digest(df, fields).alias("_h"))

    stacked = reduce(DataFrame.unionByName, [tagged(live, "live"), tagged(desired, "desired"), tagged(baseline, "baseline")])
    pick = lambda t: F.max(F.when(F.col("_t") == t, F.col("_h"))).alias(t)
    wide = stacked.groupBy(key).agg(pick("live"), pick("desired"), pick("baseline")).where(F.col("desired").isNotNull())
    state = (
        F.when(F.col("live").eqNullSafe(F.col("desired")), "desired")
        .when(F.col("live").eqNullSafe(F.col("baseline")), "baseline")
        .otherwise("conflict")
    )
    return wide.select(key, state.alias("state"))


def match_exact(observed: DataFrame, catalog: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Exact-key reconcile of observations: matched-update, matched-noop or missing-create-draft."""
    o, c = _side(observed, key, fields, "o"), _side(catalog, key, fields, "c")
    status = (
        F.when(F.col("c_key").isNull(), "missing-create-draft")
        .when(F.col("o_sha256") == F.col("c_sha256"), "matched-noop")
        .otherwise("matched-update")
    )
    return o.join(c, o["o_key"] == c["c_key"], "left").select(F.col("o_key").alias(key), status.alias("status"))


def patch_rows(observed: DataFrame, catalog: DataFrame, key: str, owned: Sequence[str]) -> DataFrame:
    """Patch and rollback of source-owned fields for matched rows; other fields are never touched."""
    o, c = _side(observed, key, owned, "o"), _side(catalog, key, owned, "c")
    joined = o.join(c, (o["o_key"] == c["c_key"]) & (o["o_sha256"] != c["c_sha256"]), "inner")
    return joined.select(
        F.col("o_key").alias(key),
        *[F.col(f"o_{f}").alias(f"set_{f}") for f in owned],
        *[F.col(f"c_{f}").alias(f"undo_{f}") for f in owned],
    )


def upsert_plan(desired: DataFrame, live: DataFrame, key: str, fields: Sequence[str], owned: str) -> DataFrame:
    """create / noop / update if we own the live row / conflict if we do not."""
    d = _side(desired, key, fields, "d")
    l = _side(live, key, fields, "l", owned)
    action = (
        F.when(F.col("l_key").isNull(), "create")
        .when(~F.coalesce(F.col("l_identity"), F.lit(False)), "conflict")
        .when(F.col("d_sha256") == F.col("l_sha256"), "noop")
        .otherwise("update")
    )
    return d.join(l, d["d_key"] == l["l_key"], "left").select(F.col("d_key").alias(key), action.alias("action"))


def variant_plan(candidates: DataFrame, states: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Chain of left joins: per state ``(name, rows, key, todo)`` a column ``{name}_status``: present or the todo word.

    Each state is reduced to its distinct keys, so a candidate is never multiplied.
    """
    out = candidates
    for name, rows, key, todo in states:
        seen = rows.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn(f"_{name}", F.lit(True))
        out = out.join(seen, key, "left").withColumn(
            f"{name}_status", F.when(F.col(f"_{name}"), "present").otherwise(todo)
        ).drop(f"_{name}")
    return out


def plan_todo(plan: DataFrame) -> DataFrame:
    """Open work per status column; a read-back is complete when every count is 0."""
    names = [c for c in plan.columns if c.endswith("_status")]
    return plan.agg(
        F.count(F.lit(1)).alias("candidates"),
        *[F.count_if(F.col(c) != "present").alias(c.replace("_status", "_todo")) for c in names],
    )


def repair_plan(wanted: DataFrame, definitions: DataFrame, usage: DataFrame, key: str, field: str) -> DataFrame:
    """Fixed list ⟕ definitions ⟕ usage: set the field where empty, noop where equal, conflict where other."""
    w = wanted.select(F.col(key), F.col(field).alias("_want"))
    d = definitions.select(F.col(key), F.col(field).alias("_have"), F.lit(True).alias("_known"))
    action = (
        F.when(F.col("_known").isNull(), "missing")
        .when(F.col("_have").isNull(), "set")
        .when(F.col("_have") == F.col("_want"), "noop")
        .otherwise("conflict")
    )
    return w.join(d, key, "left").join(usage, key, "left").select(
        key, action.alias("action"), F.coalesce("users", F.lit(0)).cast("long").alias("users")
    )


def plan_drift(stored: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """Stored plan against the diff computed again: keys whose action or digests differ, or on one side only."""
    columns = ["action", "before_sha256", "desired_sha256"]
    return diff_children(recomputed.select(key, *columns), stored.select(key, *columns), [key], columns)
