"""Catalog-shaped inputs derived from the driver tables, each with the SQL that derives the same rows.

Variants are made from ordinary column values (a type that has not been loaded yet, sizes with a new
price), always over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.scale import spread

MONEY = "decimal(20,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spread over the cores when the file has fewer splits (text work is CPU-bound)."""
    return spread(table(spark, sf_dir, "documents"))


def money(name: str):
    return F.col(name).cast(MONEY)


CODE_SQL = "'PART-' || cast(p_partkey as varchar)"


def part_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored catalog: PROMO parts have not been loaded yet."""
    return table(spark, sf_dir, "part").where("p_type <> 'PROMO'").select(
        F.concat(F.lit("PART-"), F.col("p_partkey").cast("string")).alias("code"),
        F.concat(F.lit("id-"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        money("p_retailprice").cast("string").alias("price"),
        F.col("p_size").cast("string").alias("size"),
    )


def part_desired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new catalog: big sizes cost more, ECONOMY parts are renamed, one brand carries foreign ids."""
    price = F.when(F.col("p_size") > 40, F.round(F.col("p_retailprice").cast("decimal(12,2)") * F.lit(1.1).cast("decimal(3,1)"), 2))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("PART-"), F.col("p_partkey").cast("string")).alias("code"),
        F.concat(F.when(F.col("p_brand") == "Brand#7", "x-").otherwise("id-"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_type") == "ECONOMY", F.concat("p_name", F.lit(" value"))).otherwise(F.col("p_name")).alias("name"),
        F.col("p_brand").alias("brand"),
        F.coalesce(price.cast(MONEY), money("p_retailprice")).cast("string").alias("price"),
        F.col("p_size").cast("string").alias("size"),
    )


PART_SQL = f"""
baseline as (
  select {CODE_SQL} code, 'id-' || p_partkey id, p_name as name, p_brand brand,
         cast(cast(p_retailprice as decimal(20,2)) as varchar) price, cast(p_size as varchar) size
  from part where p_type <> 'PROMO'),
desired as (
  select {CODE_SQL} code,
         (case when p_brand = 'Brand#7' then 'x-' else 'id-' end) || p_partkey id,
         case when p_type = 'ECONOMY' then p_name || ' value' else p_name end as name, p_brand brand,
         cast(cast(case when p_size > 40 then round(cast(p_retailprice as decimal(12,2)) * 1.1, 2)
                        else p_retailprice end as decimal(20,2)) as varchar) price,
         cast(p_size as varchar) size
  from part)"""

DIFF_SQL = f"""
with {PART_SQL},
diff as (
  select d.code,
    case when b.code is null then 'create' when b.id <> d.id then 'conflict'
         when d.name <> b.name or d.brand <> b.brand or d.price <> b.price or d.size <> b.size then 'update'
         else 'noop' end as action,
    b.code is not null and b.id = d.id and b.brand <> d.brand c_brand,
    b.code is not null and b.id = d.id and b.name <> d.name c_name,
    b.code is not null and b.id = d.id and b.price <> d.price c_price,
    b.code is not null and b.id = d.id and b.size <> d.size c_size,
    d.name d_name, b.name b_name, d.price d_price, b.price b_price,
    sha256(cast(json_object('brand', d.brand, 'name', d.name, 'price', d.price, 'size', d.size) as varchar)) d_sha,
    sha256(cast(json_object('brand', b.brand, 'name', b.name, 'price', b.price, 'size', b.size) as varchar)) b_sha
  from desired d left join baseline b using (code))
"""
