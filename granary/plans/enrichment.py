"""Queries of enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import enrich as e

from .registry import CATALOGUE, FEED, catalogue, feed, query, sql, table

C = CATALOGUE


@query("f1_classify", sql("""SELECT id, CASE WHEN c >= 0.6 THEN l END AS label, CASE WHEN c >= 0.6 THEN c ELSE 0.0 END AS confidence, CASE WHEN c >= 0.6 THEN g END AS stage, coalesce(CASE WHEN c >= 0.6 THEN l END <> life_stage, false) AS mismatch FROM (
SELECT id, life_stage, CASE WHEN dict IS NOT NULL THEN dict WHEN weak AND band IS NOT NULL THEN band WHEN life_stage IS NOT NULL THEN life_stage WHEN line IS NOT NULL THEN line WHEN contains(product_name, 'gear') THEN 'geared' END AS l,
  CASE WHEN dict IS NOT NULL THEN 0.9::DOUBLE WHEN weak AND band IS NOT NULL THEN CASE WHEN kcal >= 450 THEN 0.75::DOUBLE ELSE 0.65::DOUBLE END WHEN life_stage IS NOT NULL THEN 0.3::DOUBLE WHEN line IS NOT NULL THEN 0.85::DOUBLE WHEN contains(product_name, 'gear') THEN 0.7::DOUBLE END AS c,
  CASE WHEN dict IS NOT NULL THEN 'dictionary' WHEN weak AND band IS NOT NULL THEN CASE WHEN kcal >= 450 THEN 'numeric' ELSE 'numeric weak' END WHEN life_stage IS NOT NULL THEN 'existing' WHEN line IS NOT NULL THEN 'line' WHEN contains(product_name, 'gear') THEN 'package' END AS g
FROM (SELECT *, CASE WHEN contains(product_name, 'cold') THEN 'senior' WHEN contains(product_name, 'old') THEN 'senior' WHEN contains(product_name, 'new') THEN 'puppy' END AS dict, CASE brand WHEN 'Brand#1' THEN 'adult' WHEN 'Brand#2' THEN 'puppy' END AS line,
  CASE WHEN kcal >= 450 AND kcal < 600 THEN 'puppy' WHEN kcal >= 250 AND kcal < 280 THEN 'senior' END AS band, NOT (life_stage IS NULL AND brand IN ('Brand#1', 'Brand#2')) AS weak FROM catalogue))""", C))
def f1(s, d):
    words = s.createDataFrame([(1, "cold", "senior"), (2, "old", "senior"), (3, "new", "puppy")], "ord int, word string, label string")
    lines = s.createDataFrame([("Brand#1", "adult"), ("Brand#2", "puppy")], "brand string, label string")
    got = e.classify(catalogue(s, d), "id", "life_stage", F.col("product_name"), words, lines, F.col("kcal"), [(450, 600, "puppy", True), (250, 280, "senior", False)], [("gear", "geared")])
    return got.select("id", "label", "confidence", "stage", "mismatch")


@query("f2_derive_category", sql("SELECT id, CASE WHEN contains(product_name, 'hot') OR contains(product_name, 'red') THEN 'warm' WHEN contains(product_name, 'cold') OR contains(product_name, 'blue') THEN 'cool' ELSE 'plain' END AS category FROM catalogue", C))
def f2(s, d):
    return catalogue(s, d).select("id", e.derive_category(F.col("product_name"), [("warm", ["hot", "red"]), ("cool", ["cold", "blue"])], "plain").alias("category"))


@query("f3_enrich_price", sql("""SELECT c.id, CASE WHEN g IS NOT NULL THEN 'source' WHEN k IS NOT NULL THEN 'computed' WHEN md IS NOT NULL THEN 'median' ELSE 'none' END AS price_source, round(coalesce(k, md), 4) AS price_per_kg, CASE WHEN round(coalesce(k, md), 4) <= 40 THEN 'low' WHEN round(coalesce(k, md), 4) <= 100 THEN 'mid' WHEN coalesce(k, md) IS NOT NULL THEN 'high' END AS price_bucket
FROM (SELECT id, brand, form, CASE WHEN id % 3 = 0 THEN CAST(size AS DOUBLE) END AS g, CASE WHEN id % 3 = 0 THEN CAST(size AS DOUBLE) WHEN id % 3 = 1 THEN price / size END AS k FROM catalogue) c
LEFT JOIN (SELECT brand, form, quantile_cont(CASE WHEN id % 3 = 0 THEN CAST(size AS DOUBLE) WHEN id % 3 = 1 THEN price / size END, 0.5) AS md FROM catalogue GROUP BY 1, 2) m ON c.brand = m.brand AND c.form = m.form""", C))
def f3(s, d):
    i = F.col("id") % 3
    rows = catalogue(s, d).withColumns({"given": F.when(i == 0, F.col("size").cast("double")), "weight": F.when(i == 1, F.col("size").cast("double"))})
    return e.enrich_price(rows, "id", "given", "price", "weight", ["brand", "form"], [(40, "low"), (100, "mid")], "high").select("id", "price_source", "price_per_kg", "price_bucket")


@query("f4_repair_outliers", sql("""SELECT id, CASE WHEN NOT coalesce(o, false) THEN 'kept' WHEN coalesce(est BETWEEN lo AND hi, false) THEN 'estimated' ELSE 'cleared' END AS action, CASE WHEN NOT coalesce(o, false) THEN kcal WHEN coalesce(est BETWEEN lo AND hi, false) THEN round(est, 4) END AS value_fixed FROM (
SELECT *, kcal IS NOT NULL AND lo IS NOT NULL AND NOT (kcal BETWEEN lo AND hi) AS o FROM (SELECT *, CASE form WHEN 'promo' THEN 300.0 WHEN 'small' THEN 320.0 END AS lo, CASE form WHEN 'promo' THEN 420.0 WHEN 'small' THEN 330.0 END AS hi, protein * 3.5::DOUBLE + fat * 8.5::DOUBLE + greatest(0.0::DOUBLE, 82 - protein - fat) * 3.5::DOUBLE AS est FROM catalogue))""", C))
def f4(s, d):
    bands = s.createDataFrame([("promo", 300.0, 420.0), ("small", 320.0, 330.0)], "form string, low double, high double")
    return e.repair_outliers(catalogue(s, d), "kcal", bands, "form", e.energy_estimate()).select("id", "action", "value_fixed")


@query("f5_enrich_groups", sql("""SELECT id, coalesce(string_agg(g, ',' ORDER BY g), '') AS groups, CASE WHEN id % 9 = 0 THEN 0.0::DOUBLE WHEN count(g) > 0 THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS confidence, id % 9 = 0 AS unknown FROM catalogue LEFT JOIN (SELECT * FROM (VALUES ('metal', 'bolt'), ('warm', 'red'), ('warm', 'hot')) v(g, w)) r ON id % 9 <> 0 AND list_contains(string_split(product_name, ' '), w) GROUP BY id""", C))
def f5(s, d):
    rules = s.createDataFrame([("metal", "bolt"), ("warm", "red"), ("warm", "hot")], "grp string, token string")
    rows = catalogue(s, d).select("id", F.when(F.col("id") % 9 == 0, F.array().cast("array<string>")).otherwise(F.split("product_name", " ")).alias("tokens"))
    return e.enrich_groups(rows, "id", "tokens", rules).withColumn("groups", F.array_join("groups", ","))


@query("f6_reconcile", sql("""SELECT c.id, CASE WHEN NOT coalesce(f.kcal < 310 AND f.size > 40, false) THEN coalesce(c.kcal, f.kcal) END AS kcal, CASE WHEN coalesce(f.kcal < 310 AND f.size > 40, false) THEN 'cleared' WHEN c.kcal IS NOT NULL THEN 'base' WHEN f.kcal IS NOT NULL THEN 'enrichment' ELSE 'none' END AS kcal_origin,
CASE WHEN NOT coalesce(f.kcal < 310 AND f.size > 40, false) THEN coalesce(f.fat, c.fat) END AS fat, CASE WHEN coalesce(f.kcal < 310 AND f.size > 40, false) THEN 'cleared' WHEN f.fat IS NOT NULL THEN 'enrichment' WHEN c.fat IS NOT NULL THEN 'base' ELSE 'none' END AS fat_origin FROM catalogue c LEFT JOIN feed f ON c.id = f.id - 1000000""", C, FEED))
def f6(s, d):
    new = feed(s, d).withColumn("id", F.col("id") - 1_000_000)
    return e.reconcile(catalogue(s, d).select("id", "kcal", "fat"), new, "id", {"kcal": "fill", "fat": "replace"}, (F.col("kcal") < 310) & (F.col("size") > 40))


@query("f7_fill_missing", sql("""SELECT c.id, coalesce(c.kcal, f.kcal) AS kcal, CASE WHEN c.kcal IS NULL AND f.kcal IS NOT NULL THEN 'enrichment' END AS kcal_from, CASE WHEN c.kcal IS NULL AND f.kcal IS NOT NULL THEN round((f.size % 10) / 10.0::DOUBLE * 0.9::DOUBLE, 6) END AS kcal_confidence FROM catalogue c LEFT JOIN feed f ON c.id = f.id - 1000000""", C, FEED))
def f7(s, d):
    new = feed(s, d).withColumns({"id": F.col("id") - 1_000_000, "conf": (F.col("size") % 10) / 10.0})
    return e.fill_missing(catalogue(s, d).select("id", "kcal"), new, "id", ["kcal"], "conf")


@query("f8_extract_from_matches", sql("""SELECT a.id, 'kcal' AS field, b.kcal AS value, round(CASE WHEN a.id % 2 = 0 THEN 0.8::DOUBLE * 0.9::DOUBLE ELSE 0.65::DOUBLE * 0.85::DOUBLE END, 6) AS confidence FROM catalogue a JOIN catalogue b ON b.id = a.id + 1 WHERE a.id % 3 < 2 AND a.kcal IS NULL AND b.kcal BETWEEN 300 AND 450""", C))
def f8(s, d):
    c = catalogue(s, d)
    even = F.col("id") % 2 == 0
    hits = c.select("id", (F.col("id") + 1).alias("match_id"), F.when(even, 0.8).otherwise(0.65).alias("score"), F.when(F.col("id") % 3 == 2, "rejected").when(even, "auto").otherwise("review").alias("tier"))
    return e.extract_from_matches(hits, c, c, "id", "id", {"kcal": (300, 450)})


@query("f9_open_data", sql("""SELECT id, replace(lower(trim(brand)), ' ', '_') || '|' || replace(lower(product_name), ' ', '_') || '|unknown' AS product_key, kcal AS kcal_per_100g, protein AS protein_percent, size * 0.4::DOUBLE AS weight_kg, array_to_string(string_split(product_name, ' '), ',') AS tokens FROM catalogue""", C))
def f9(s, d):
    tags = F.split(F.upper("product_name"), " ")
    made = F.to_json(F.struct(F.concat("brand", F.lit(", Other")).alias("brands"), F.col("product_name"), F.concat(F.col("size").cast("string"), F.lit(" x 400 g")).alias("quantity"), F.struct(F.col("kcal").alias("energy-kcal_100g"), F.col("protein").alias("proteins_100g")).alias("nutriments"), tags.alias("ingredients_tags")))
    got = e.normalize_open_data(catalogue(s, d).select("id", made.alias("j")), "j")
    return got.select("id", "product_key", "kcal_per_100g", "protein_percent", F.round("weight_kg", 9).alias("weight_kg"), F.array_join("ingredients_tokens", ",").alias("tokens"))


@query("f10_infer_from_name", sql("SELECT id, coalesce(life_stage, CASE WHEN contains(product_name, 'old') THEN 'senior' WHEN contains(product_name, 'new') OR contains(product_name, 'small') THEN 'puppy' END) AS life_stage FROM catalogue", C))
def f10(s, d):
    return e.infer_from_name(catalogue(s, d), "life_stage", "product_name", [("senior", ["old"]), ("puppy", ["new", "small"])]).select("id", "life_stage")


@query("f11_replace_default", sql("SELECT id, CASE WHEN life_stage = 'adult' THEN CASE WHEN product_name = 'red bolt' THEN 'direct' WHEN regexp_matches(product_name, 'ring$') THEN 'pattern' WHEN kcal <= 300 THEN 'light' WHEN kcal IS NOT NULL THEN 'heavy' ELSE life_stage END ELSE life_stage END AS life_stage FROM catalogue", C))
def f11(s, d):
    return e.replace_default(catalogue(s, d), "life_stage", "adult", F.col("product_name"), {"red bolt": "direct"}, [("ring$", "pattern")], F.col("kcal"), [(300, "light")], "heavy").select("id", "life_stage")


@query("f12_apply_matches", sql("""SELECT c.id, coalesce(c.kcal, m.kcal) AS kcal, CASE WHEN c.kcal IS NULL AND m.kcal IS NOT NULL THEN 'kcal=' || m.name ELSE '' END AS provenance FROM catalogue c LEFT JOIN (SELECT id, name, kcal FROM (SELECT id - 1 AS id, product_name AS name, kcal, row_number() OVER (PARTITION BY id - 1 ORDER BY product_name) AS n FROM catalogue WHERE (size % 10) / 10.0::DOUBLE >= 0.3) WHERE n = 1) m ON c.id = m.id""", C))
def f12(s, d):
    c = catalogue(s, d)
    hits = c.select((F.col("id") - 1).alias("id"), F.col("product_name").alias("name"), "kcal", ((F.col("size") % 10) / 10.0).alias("confidence"))
    return e.apply_matches(c.select("id", "kcal"), hits, "id", ["kcal"], 0.3)


@query("f13_normalize_offers", sql("""SELECT id, brand, CASE WHEN contains(product_name, 'bolt') THEN 'hardware' END AS form, CASE WHEN contains(product_name, 'new') THEN 'puppy' ELSE 'all' END AS life_stage, size * 0.5::DOUBLE AS weight_kg, floor(price) AS price, round(floor(price) / (size * 0.5::DOUBLE), 4) AS price_per_kg FROM catalogue""", C))
def f13(s, d):
    rows = catalogue(s, d)
    spec = {"id": F.col("id"), "brand": F.col("brand"), "product_name": F.concat("product_name", F.lit(" "), F.col("size").cast("string"), F.lit(" x 500g")), "price_text": F.concat(F.lit("$ "), F.floor("price").cast("string"))}
    got = e.normalize_offers(rows, spec, [("hardware", ["bolt"])], [("puppy", ["new"])])
    return got.select("id", "brand", "form", "life_stage", F.round("weight_kg", 9).alias("weight_kg"), "price", "price_per_kg")
