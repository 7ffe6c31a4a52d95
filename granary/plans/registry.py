"""The registry of queries and the inputs that they share.

The driver's tables hold parts, orders, documents, pages and events; `catalogue`, `offers` and
`feed` derive three product sources from them, in Spark and, for the oracle, in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Source A: one row per part, with gaps by rule."""
    p = table(spark, d, "part")
    gap = lambda k, v: F.when(F.col("p_partkey") % k != 0, v.cast("double"))
    stage = F.when(F.col("p_partkey") % 4 == 0, "puppy").when(F.col("p_partkey") % 4 == 1, "adult").when(F.col("p_partkey") % 4 == 2, "senior")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("product_name"), F.lower("p_type").alias("form"),
        F.col("p_size").cast("long").alias("size"), F.col("p_retailprice").alias("price"), gap(7, 250 + F.col("p_size") * 5).alias("kcal"), gap(11, 10 + F.col("p_size") % 30).alias("protein"),
        gap(13, 5 + F.col("p_size") % 17).alias("fat"), stage.alias("life_stage"), (F.col("p_partkey") % 365).alias("day"), F.lit("catalogue").alias("source"),
    )


CATALOGUE = """catalogue AS (
  SELECT p_partkey AS id, p_brand AS brand, p_name AS product_name, lower(p_type) AS form, CAST(p_size AS BIGINT) AS size, p_retailprice AS price,
    CASE WHEN p_partkey % 7 <> 0 THEN CAST(250 + p_size * 5 AS DOUBLE) END AS kcal,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(10 + p_size % 30 AS DOUBLE) END AS protein,
    CASE WHEN p_partkey % 13 <> 0 THEN CAST(5 + p_size % 17 AS DOUBLE) END AS fat,
    CASE p_partkey % 4 WHEN 0 THEN 'puppy' WHEN 1 THEN 'adult' WHEN 2 THEN 'senior' END AS life_stage,
    p_partkey % 365 AS day, 'catalogue' AS source FROM part)"""


def offers(spark: SparkSession, d: str) -> DataFrame:
    """Source B: offers of a product by retailer (supplier modulo 10), prices in whole units."""
    joined = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("product_name"), F.lower("p_type").alias("form"), (F.col("l_suppkey") % 10).alias("retailer")).agg(
        F.count("*").alias("n_offers"), F.min(F.floor("l_extendedprice")).cast("long").alias("price"), F.max(F.col("l_quantity").cast("long")).alias("stock"), F.max(F.col("l_orderkey") % 365).alias("day")
    )


OFFERS = """offers AS (
  SELECT p_partkey AS id, p_brand AS brand, p_name AS product_name, lower(p_type) AS form, l_suppkey % 10 AS retailer, count(*) AS n_offers,
    CAST(min(floor(l_extendedprice)) AS BIGINT) AS price, CAST(max(CAST(l_quantity AS BIGINT)) AS BIGINT) AS stock, max(l_orderkey % 365) AS day
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4, 5)"""


def feed(spark: SparkSession, d: str) -> DataFrame:
    """Source C: a supplier feed over every third part, names in upper case, other gaps."""
    c = catalogue(spark, d).where(F.col("id") % 3 == 0)
    return c.select(
        (F.col("id") + 1_000_000).alias("id"), F.upper("brand").alias("brand"), F.upper("product_name").alias("product_name"), F.when(F.col("id") % 5 != 0, F.col("form")).alias("form"), (F.col("size") + 1).alias("size"),
        (F.col("price") + 1).alias("price"), F.when(F.col("id") % 2 == 0, F.lit(300.0)).alias("kcal"), F.lit(None).cast("double").alias("protein"), F.col("fat"), F.lit(None).cast("string").alias("life_stage"), (F.col("day") + 10).alias("day"), F.lit("feed").alias("source"),
    )


FEED = """feed AS (
  SELECT id + 1000000 AS id, upper(brand) AS brand, upper(product_name) AS product_name, CASE WHEN id % 5 <> 0 THEN form END AS form, size + 1 AS size, price + 1 AS price,
    CASE WHEN id % 2 = 0 THEN 300.0::DOUBLE END AS kcal, CAST(NULL AS DOUBLE) AS protein, fat, CAST(NULL AS VARCHAR) AS life_stage, day + 10 AS day, 'feed' AS source
  FROM catalogue WHERE id % 3 = 0)"""


def allowlist(spark: SparkSession, d: str) -> DataFrame:
    """Status of each brand by its number; brands of remainder 3 are missing."""
    b = table(spark, d, "part").select(F.col("p_brand").alias("brand")).distinct()
    n = F.regexp_extract("brand", "([0-9]+)", 1).cast("int") % 4
    return b.withColumn("status", F.when(n == 0, "ACTIVE").when(n == 1, "PENDING").when(n == 2, "PAUSED")).where(F.col("status").isNotNull())


ALLOW = """allowlist AS (
  SELECT brand, CASE CAST(regexp_extract(brand, '([0-9]+)', 1) AS INT) % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'PAUSED' END AS status
  FROM (SELECT DISTINCT p_brand AS brand FROM part) WHERE CAST(regexp_extract(brand, '([0-9]+)', 1) AS INT) % 4 < 3)"""


def sql(body: str, *views: str) -> str:
    return f"WITH {', '.join(views)}\n{body}" if views else body
