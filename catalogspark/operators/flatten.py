"""Nested facts to dotted paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.functions.canon import number_text
from catalogspark.scale import explode_rows, pinned


def _kebab(name: str) -> str:
    out = ""
    for i, c in enumerate(name):
        out += "-" + c.lower() if c.isupper() and i and not name[i - 1].isupper() else c.lower()
    return out


def _leaves(kind: T.DataType, value: Column, path: Column) -> Column:
    """``array<struct<path, value>>`` of the leaves below a typed value; arrays are walked by index."""
    if isinstance(kind, T.StructType):
        parts = [
            _leaves(f.dataType, value[f.name], F.concat_ws(".", path, F.lit(_kebab(f.name)))) for f in sorted(kind.fields, key=lambda f: f.name)
        ]
        return F.concat(*parts)
    if isinstance(kind, T.ArrayType):
        inner = F.transform(value, lambda v, i: _leaves(kind.elementType, v, F.concat_ws(".", path, i.cast("string"))))
        return F.coalesce(F.flatten(inner), F.array().cast("array<struct<path:string,value:string>>"))
    text = number_text(value, kind)
    return F.array(F.struct(path.alias("path"), F.trim(text).alias("value")))


def flatten_paths(df: DataFrame, key: str, facts: str) -> DataFrame:
    """Typed nested facts as rows (path, value, digest). Empty values give no row; the schema bounds the fan-out.

    A limit on the number of facts is a contract, not a cut: see :func:`too_many_paths`.
    """
    leaves = _leaves(df.schema[facts].dataType, F.col(facts), F.lit(None).cast("string"))
    flat = explode_rows(df, [key], leaves, "r").select(key, "r.path", "r.value")
    return flat.where("value <> ''").withColumn("value_sha256", F.sha2("value", 256))


def too_many_paths(paths: DataFrame, key: str, limit: int = 128) -> DataFrame:
    """Items with more facts than the contract allows."""
    return paths.groupBy(key).agg(F.count(F.lit(1)).alias("paths")).where(F.col("paths") > limit)


#: Up to this depth the levels are one lazy chain; deeper ones are pinned level by level.
LAZY_DEPTH = 6


def json_depth(json: Column) -> Column:
    """How deep objects and arrays are nested in a JSON text; brackets inside strings do not count."""
    brackets = F.regexp_replace(F.regexp_replace(json, r'"(?:[^"\\]++|\\.)*+"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("m"))

    def step(a: Column, c: Column) -> Column:
        d = a["d"] + F.when(c.isin("{", "["), 1).when(c == "", 0).otherwise(-1)
        return F.struct(d.alias("d"), F.greatest(a["m"], d).alias("m"))

    return F.reduce(F.split(brackets, ""), start, step, lambda a: a["m"])


def open_paths(df: DataFrame, key: str, json: str) -> DataFrame:
    """Open JSON text as rows (path, value), however deep: one ``variant_explode`` per level until no nested value is left.

    One aggregate finds the depth. Usual depths are one lazy chain over the texts; of deeper ones every level is pinned,
    so that the work grows with the number of levels, not with its square.
    """
    level = df.select(F.col(key).alias("_id"), F.lit("$").alias("path"), F.try_parse_json(F.col(json)).alias("v")).where("v is not null")
    depth = max(1, df.agg(F.max(json_depth(F.col(json))).alias("d")).first()["d"] or 1)
    out = None
    for n in range(depth):
        exploded = level.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer())).select(
            "_id", "path", "pos", "key", "value")
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), F.col("key"))).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        rows = exploded.select("_id", F.concat("path", step).alias("path"), F.col("value").alias("v"))
        nested = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")
        leaves = rows.where(~nested).select(F.col("_id").alias(key), "path", F.expr("try_variant_get(v, '$', 'string')").alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        level = rows.where(nested)
        if depth > LAZY_DEPTH:
            level = pinned(level.select("_id", "path", F.to_json("v").alias("v"))).select("_id", "path", F.parse_json("v").alias("v"))
    return out
