"""Proportional stratified interleaving into shards.

Rows are shuffled by a seeded hash of key and text (a key, null too, may have many rows) and ranked within their source; the fractional rank
(2 rank + 1) / (2 rows of the source) spreads every source evenly over [0, 1), so cutting the
order by fractional rank into equal runs gives every shard the whole mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import RANK_ROWS, hash_bucket, two_level

SHARDS = 8


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = 11, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """`key`, source, size, text_crc32, shard, slot; a row per input row.

    size: UTF-8 bytes plus 1 (null text: 1); text_crc32 of a null text is that of no bytes, 0.
    A null source is a source of its own.  Ties and repeated rows are ordered by hash, key and
    text hash; fully equal rows are interchangeable.  Shard counts differ by at most one, also
    within no rows or fewer rows than shards.  Other columns are not carried.
    """
    clean = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        (F.octet_length(clean) + 1).cast("long").alias("size"),
        F.crc32(clean.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col(key), clean).alias("_hash"),
        F.xxhash64(clean).alias("_text"),
    )
    per = rows.groupBy("_source").agg(F.count("*").alias("_n"))
    per = per.select(F.col("_source").alias("_k"), "_n", F.sum("_n").over(Window.partitionBy()).alias("_all"), F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())).alias("_s"))
    rows = rows.join(per, F.col("_source").eqNullSafe(F.col("_k"))).drop("_k")
    rows = rows.withColumn("_bucket", hash_bucket(F.col("_hash"), F.ceil(F.col("_n") / RANK_ROWS)))
    order = [F.col("_hash"), F.col("_key"), F.col("_text")]
    ranked = two_level(rows, ["_source"], "_bucket", order, out="_r").drop("_bucket")
    fraction = (F.col("_r") * 2 + 1) / (F.col("_n") * 2)
    ranked = ranked.withColumn("_f", fraction).withColumn("_bucket", F.floor(F.col("_f") * F.ceil(F.col("_all") / RANK_ROWS)))
    placed = two_level(ranked, [], "_bucket", [F.col("_f"), F.col("_s"), *order], out="_g")
    shard = F.expr(f"(_g * {shards}) div _all")
    slot = F.col("_g") - F.expr(f"(((_g * {shards}) div _all) * _all + {shards - 1}) div {shards}")
    return placed.select(F.col("_key").alias(key), F.col("_source").alias("source"), "size", "text_crc32", shard.cast("int").alias("shard"), slot.alias("slot"))
