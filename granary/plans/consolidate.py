"""Queries of consolidation and brand resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as t
from granary.operators import brands as b
from granary.operators import consolidate as k

from .registry import ALLOW, CATALOGUE, FEED, OFFERS, allowlist, catalogue, feed, offers, query, sql, table

C = CATALOGUE
KEY = "replace(lower(trim(brand)), ' ', '_') || '|' || replace(lower(trim(product_name)), ' ', '_') || '|' || coalesce(replace(lower(trim(form)), ' ', '_'), 'unknown')"
ALL = f"""rows_ AS (SELECT {KEY} AS product_key, * FROM catalogue UNION ALL SELECT {KEY} AS product_key, * FROM feed)"""
ORDER = "kcal IS NULL, (CASE WHEN source = 'catalogue' THEN 1 ELSE 0 END), -day, id"


def keyed(df):
    return df.withColumn("product_key", t.make_key([F.col("brand"), F.col("product_name"), F.col("form")]))


def order():
    return [F.col("kcal").isNull(), F.when(F.col("source") == "catalogue", 1).otherwise(0), -F.col("day"), F.col("id")]


@query("b1_canonicalize", sql(f"""SELECT w.product_key, w.id, w.brand, w.product_name, w.form, w.kcal, w.source, p.sources FROM (SELECT *, row_number() OVER (PARTITION BY product_key ORDER BY {ORDER}) AS n FROM rows_) w
JOIN (SELECT product_key, string_agg(source || ':' || id, ',' ORDER BY {ORDER}) AS sources FROM rows_ GROUP BY 1) p ON w.product_key = p.product_key WHERE n = 1""", C, FEED, ALL))
def b1(s, d):
    got = k.canonicalize([keyed(catalogue(s, d)), keyed(feed(s, d))], "product_key", order(), ["source", "id"])
    return got.select("product_key", "id", "brand", "product_name", "form", "kcal", "source", F.array_join(F.transform("sources", lambda x: F.concat(x["source"], F.lit(":"), x["id"].cast("string"))), ",").alias("sources"))


@query("b2_prefer_newest", sql("SELECT product_key, id FROM (SELECT *, row_number() OVER (PARTITION BY product_key ORDER BY life_stage IS NULL, -day, id) AS n FROM rows_) WHERE n = 1", C, FEED, ALL))
def b2(s, d):
    return k.canonicalize([keyed(catalogue(s, d)), keyed(feed(s, d))], "product_key", [F.col("life_stage").isNull(), -F.col("day"), F.col("id")], ["id"]).select("product_key", "id")


@query("b3_fill_from_losers", sql(f"""SELECT product_key, arg_min(id, n) AS id, arg_min(protein, n) FILTER (protein IS NOT NULL) AS protein, arg_min(life_stage, n) FILTER (life_stage IS NOT NULL) AS life_stage, string_agg(DISTINCT source, ',' ORDER BY source) AS origins
FROM (SELECT *, row_number() OVER (PARTITION BY product_key ORDER BY {ORDER}) AS n FROM rows_) GROUP BY product_key""", C, FEED, ALL))
def b3(s, d):
    rows = [keyed(x).withColumn("origins", F.array("source")) for x in (catalogue(s, d), feed(s, d))]
    got = k.canonicalize(rows, "product_key", order(), ["id"], fill=["protein", "life_stage"], union=["origins"])
    return got.select("product_key", "id", "protein", "life_stage", F.array_join("origins", ",").alias("origins"))


@query("b4_score", sql("SELECT id, CASE WHEN kcal IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN protein IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN life_stage IS NOT NULL THEN 10 ELSE 0 END AS score FROM catalogue", C))
def b4(s, d):
    return catalogue(s, d).select("id", k.score({"kcal": 30, "protein": 20, "life_stage": 10}).alias("score"))


@query("b5_publish", sql("SELECT id, coalesce(kcal, 350.0) AS kcal, coalesce(life_stage, 'all') AS life_stage FROM catalogue", C))
def b5(s, d):
    return k.publish(catalogue(s, d).select("id", "kcal", "life_stage"), {"kcal": 350.0, "life_stage": "all"})


@query("b6_environment", sql("SELECT id, 'preview' AS env FROM catalogue LEFT JOIN allowlist USING (brand) WHERE coalesce(status IN ('ACTIVE', 'PENDING'), true) UNION ALL SELECT id, 'prod' FROM catalogue JOIN allowlist USING (brand) WHERE status = 'ACTIVE'", C, ALLOW))
def b6(s, d):
    c, a = catalogue(s, d), allowlist(s, d)
    preview = k.environment(c, a, "brand", ["ACTIVE", "PENDING"], keep_missing=True).select("id", F.lit("preview").alias("env"))
    return preview.unionByName(k.environment(c, a, "brand", ["ACTIVE"]).select("id", F.lit("prod").alias("env")))


@query("b7_label_environment", sql("SELECT id, CASE status WHEN 'ACTIVE' THEN 'prod' WHEN 'PENDING' THEN 'preview' WHEN 'PAUSED' THEN 'held' ELSE 'unlisted' END AS environment FROM catalogue LEFT JOIN allowlist USING (brand)", C, ALLOW))
def b7(s, d):
    return k.label_environment(catalogue(s, d), allowlist(s, d), "brand").select("id", "environment")


@query("b8_overrides", sql("""SELECT c.id, coalesce(o.kcal, c.kcal) AS kcal, CASE WHEN o.kcal IS NOT NULL THEN 'override' WHEN c.kcal IS NOT NULL THEN 'base' ELSE 'none' END AS kcal_from, coalesce(o.fat, c.fat) AS fat, CASE WHEN o.fat IS NOT NULL THEN 'override' WHEN c.fat IS NOT NULL THEN 'base' ELSE 'none' END AS fat_from
FROM catalogue c LEFT JOIN (SELECT id - 1000000 AS id, kcal, fat + 1 AS fat FROM feed) o ON c.id = o.id""", C, FEED))
def b8(s, d):
    over = feed(s, d).select((F.col("id") - 1_000_000).alias("id"), "kcal", (F.col("fat") + 1).alias("fat"))
    return k.apply_overrides(catalogue(s, d).select("id", "kcal", "fat"), over, "id", ["kcal", "fat"])


@query("b9_profile", """SELECT c_custkey, c_mktsegment AS segment, coalesce(last_status, 'none') AS status, CAST(coalesce(cents, 0) // greatest(coalesce(n_orders, 0), 1) AS BIGINT) AS mean_cents, greatest(c_acctbal, coalesce(biggest, 0.0)) AS most FROM customer
LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status, count(*) AS n_orders, max(o_totalprice) AS biggest, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def b9(s, d):
    o = table(s, d, "orders").withColumnRenamed("o_custkey", "c_custkey").groupBy("c_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"), F.count("*").alias("n_orders"), F.max("o_totalprice").alias("biggest"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    rest = o.select("c_custkey", F.col("last_status"), "n_orders", "biggest", "cents")
    got = k.profile([table(s, d, "customer").withColumn("_none", F.lit("none")), rest], "c_custkey", {"segment": ["c_mktsegment"], "status": ["last_status", "_none"], "n": ["n_orders"], "cents": ["cents"], "bal": ["c_acctbal"], "big": ["biggest"]})
    return got.select("c_custkey", "segment", "status", F.expr("coalesce(cents, 0) div greatest(coalesce(n, 0), 1)").alias("mean_cents"), F.greatest("bal", F.coalesce("big", F.lit(0.0))).alias("most"))


@query("b10_similar", sql("""SELECT c.id, CASE WHEN c.brand = s.brand THEN 3 ELSE 0 END + CASE WHEN c.form = s.form THEN 2 ELSE 0 END + CASE WHEN c.life_stage = s.life_stage THEN 1 ELSE 0 END AS similarity FROM catalogue c, (SELECT * FROM catalogue WHERE id = 17) s WHERE c.id <> 17 ORDER BY similarity DESC, c.id LIMIT 20""", C))
def b10(s, d):
    return k.similar_to(catalogue(s, d), "id", 17, {"brand": 3, "form": 2, "life_stage": 1}, 20)


@query("b10_similar_all", sql("""SELECT id, other, similarity, rank FROM (SELECT a.id, b.id AS other, CASE WHEN a.form = b.form THEN 2 ELSE 0 END + CASE WHEN a.life_stage = b.life_stage THEN 1 ELSE 0 END AS similarity,
row_number() OVER (PARTITION BY a.id ORDER BY CASE WHEN a.form = b.form THEN 2 ELSE 0 END + CASE WHEN a.life_stage = b.life_stage THEN 1 ELSE 0 END DESC, b.id) AS rank FROM catalogue a JOIN catalogue b ON a.brand = b.brand AND a.id <> b.id) WHERE rank <= 3""", C))
def b10b(s, d):
    return k.similar_all(catalogue(s, d), "id", "brand", {"form": 2, "life_stage": 1}, 3)


@query("b11_search", sql("SELECT id, product_name FROM catalogue WHERE form IN ('small', 'large') AND size <= 20 AND brand = 'Brand#7' ORDER BY product_name, id LIMIT 10 OFFSET 2", C))
def b11(s, d):
    from granary.operators.relational import facet_filter, page

    return page(facet_filter(catalogue(s, d), form=["small", "large"], size=(None, 20), brand="Brand#7", life_stage=None).select("id", "product_name"), ["product_name", "id"], 10, 2)


@query("b12_resolve_eav", """SELECT user_id, max(v) FILTER (event_type = 'click') AS click, max(v) FILTER (event_type = 'purchase') AS purchase, max(v) FILTER (event_type = 'view') AS "view" FROM (SELECT user_id, event_type, arg_max(value, (value, event_id)) AS v FROM events GROUP BY 1, 2) GROUP BY user_id""")
def b12(s, d):
    e = table(s, d, "events").select("user_id", "event_type", "value", "event_id")
    return k.resolve_eav(e, "user_id", "event_type", "value", [-F.col("value"), -F.col("event_id")], ["click", "purchase", "view"])


@query("b13_resolve_conflict", sql("""SELECT id, CASE WHEN n IS NOT NULL AND (kcal IS NULL OR id % 3 > 1) THEN n ELSE kcal END AS value, CASE WHEN n IS NOT NULL AND (kcal IS NULL OR id % 3 > 1) THEN 's' || (id % 3) ELSE 's1' END AS value_source FROM (SELECT id, kcal, CASE WHEN id % 5 <> 0 THEN size * 1.0::DOUBLE END AS n FROM catalogue)""", C))
def b13(s, d):
    rows = catalogue(s, d).select("id", "kcal", F.lit("s1").alias("cs"), F.when(F.col("id") % 5 != 0, F.col("size").cast("double")).alias("n"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("ns"))
    return k.resolve_conflict(rows, "kcal", "cs", "n", "ns", {"s0": 1, "s1": 2, "s2": 3}).select("id", "value", "value_source")


@query("b14_attach_published", "SELECT c_custkey, o.o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON o_custkey = c_custkey")
def b14(s, d):
    v = table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).alias("day"), F.when(F.col("o_orderstatus") == "F", "published").otherwise("draft").alias("state"))
    return k.attach_published(table(s, d, "customer").select("c_custkey"), v, "c_custkey", "state", [-F.col("day"), -F.col("o_orderkey")], ["o_orderkey"])


@query("b15_offer_summary", sql("SELECT brand, count(*) AS n_offers, count(DISTINCT retailer) AS n_retailers, min(price) AS min_price, max(price) AS max_price, string_agg(DISTINCT CAST(retailer AS VARCHAR), ',' ORDER BY CAST(retailer AS VARCHAR)) AS retailers, bool_or(stock > 0) AS in_stock FROM offers GROUP BY brand", OFFERS))
def b15(s, d):
    return k.offer_summary(offers(s, d), ["brand"], "retailer", "price", "stock")


ALIASES = [("brand#7", "Seven"), ("BRAND#8 ", "Eight"), ("brand#9", "Nine")]


def aliases(s):
    return s.createDataFrame(ALIASES, "alias string, canonical string")


ALIAS_CASE = "CASE lower(trim(brand)) WHEN 'brand#7' THEN 'Seven' WHEN 'brand#8' THEN 'Eight' WHEN 'brand#9' THEN 'Nine'"


@query("c1_alias", sql(f"SELECT id, {ALIAS_CASE} ELSE brand END AS brand_canonical FROM feed", C, FEED))
def c1(s, d):
    return b.apply_alias(feed(s, d), aliases(s)).select("id", "brand_canonical")


@query("c2_alias_phrase", sql(f"SELECT id, coalesce({ALIAS_CASE} END, CASE WHEN contains(lower(brand), 'd#1') THEN 'Ones' WHEN contains(lower(brand), '2') THEN 'Twos' END, upper(left(trim(brand), 1)) || lower(substring(trim(brand), 2))) AS brand_canonical FROM feed", C, FEED))
def c2(s, d):
    phrases = s.createDataFrame([(1, "d#1", "Ones"), (2, "2", "Twos")], "ord int, phrase string, canonical string")
    return b.apply_alias_phrase(feed(s, d), "id", aliases(s), phrases).select("id", "brand_canonical")


@query("c3_build_aliases", """SELECT o AS observed, CASE WHEN o LIKE 'x%' THEN NULL ELSE 'Brand#' || n END AS canonical, CASE WHEN o LIKE 'x%' THEN 'unmapped' WHEN o LIKE 'Brand#%' THEN 'exact' WHEN o LIKE 'BRAND#%' THEN 'lowered' ELSE 'slug' END AS how FROM (
  SELECT DISTINCT regexp_extract(p_brand, '([0-9]+)', 1) AS n, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN upper(p_brand) WHEN 2 THEN replace(p_brand, '#', ' - ') ELSE 'x' || p_brand END AS o FROM part)""")
def c3(s, d):
    p = table(s, d, "part")
    m = F.col("p_partkey") % 4
    seen = p.select(F.when(m == 0, F.col("p_brand")).when(m == 1, F.upper("p_brand")).when(m == 2, F.replace("p_brand", F.lit("#"), F.lit(" - "))).otherwise(F.concat(F.lit("x"), "p_brand")).alias("name"))
    return b.build_aliases(p.select(F.col("p_brand").alias("canonical")).distinct(), seen)


@query("c4_alias_impact", sql(f"SELECT form, count(DISTINCT brand) AS before, count(DISTINCT {ALIAS_CASE} WHEN 'brand#10' THEN 'Seven' ELSE brand END) AS after, count(*) FILTER (lower(brand) IN ('brand#7', 'brand#8', 'brand#9', 'brand#10')) AS rows_changed FROM catalogue GROUP BY form", C))
def c4(s, d):
    more = s.createDataFrame([*ALIASES, ("brand#10", "Seven")], "alias string, canonical string")
    return b.alias_impact(catalogue(s, d), more, "form")


PHRASES = [("Brand#1", "red", "Red One"), ("Brand#2", "cold", "Cold Two"), ("Brand#2", "old", "Old Two")]


def phrases(s):
    return s.createDataFrame(PHRASES, "source_brand string, prefix string, canonical string")


SPLIT = "CASE WHEN brand = 'Brand#1' AND starts_with(product_name, 'red ') THEN 'Red One' WHEN brand = 'Brand#2' AND starts_with(product_name, 'cold ') THEN 'Cold Two' WHEN brand = 'Brand#2' AND starts_with(product_name, 'old ') THEN 'Old Two' END"


@query("c5_repair_split", sql(f"""SELECT id, coalesce(c, brand) AS brand_fixed, n AS name_fixed, c IS NOT NULL AS split, replace(lower(coalesce(c, brand)), ' ', '_') || '|' || replace(lower(n), ' ', '_') AS key_fixed FROM (SELECT id, brand, {SPLIT} AS c, CASE WHEN {SPLIT} IS NULL THEN product_name ELSE split_part(product_name, ' ', 2) END AS n FROM catalogue)""", C))
def c5(s, d):
    return b.repair_split(catalogue(s, d), "id", phrases(s)).select("id", "brand_fixed", "name_fixed", "split", "key_fixed")


FIND = "SELECT brand, w AS first_word, n, round(n * 1.0::DOUBLE / t, 4) AS consistency, CASE WHEN n * 1.0::DOUBLE / t >= 0.2 THEN 'high' WHEN n * 1.0::DOUBLE / t >= 0.1 THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT brand, w, n, CAST(sum(n) OVER (PARTITION BY brand) AS BIGINT) AS t FROM (SELECT brand, split_part(product_name, ' ', 1) AS w, count(*) AS n FROM catalogue GROUP BY 1, 2)) WHERE n >= 3"


@query("c6_find_splits", sql(FIND, C))
def c6(s, d):
    return b.find_splits(catalogue(s, d))


@query("c7_screen_splits", sql(f"SELECT * FROM ({FIND}) WHERE first_word NOT IN ('large', 'small') AND length(first_word) > 3 AND confidence <> 'low'", C))
def c7(s, d):
    return b.screen_splits(b.find_splits(catalogue(s, d)), ["large", "small"])


@query("c8_split_guards", sql(f"""SELECT guard, n, n = 0 AS passed FROM (SELECT unnest(['split', 'repeated', 'blank', 'bad_slug', 'spellings', 'all']) AS guard, unnest([a, b, c, e, f, a + b + c + e + f]) AS n FROM (
SELECT (SELECT count(*) FROM catalogue WHERE {SPLIT} IS NOT NULL) AS a, (SELECT count(*) FROM catalogue WHERE starts_with(lower(product_name), lower(trim(brand)) || ' ')) AS b, (SELECT count(*) FROM catalogue WHERE coalesce(trim(brand), '') = '') AS c,
(SELECT count(*) FROM catalogue WHERE regexp_matches(replace(lower(trim(brand)), ' ', '_'), '[^a-z0-9_]')) AS e, (SELECT count(*) FROM (SELECT 1 FROM catalogue GROUP BY trim(regexp_replace(lower(brand), '[^a-z0-9]+', '-', 'g'), '-') HAVING count(DISTINCT brand) > 1)) AS f))""", C))
def c8(s, d):
    return b.split_guards(catalogue(s, d), phrases(s), "id")


@query("c9_assign_family", sql("""SELECT id, family, CASE WHEN family = 'ones' AND contains(product_name, 'bolt') THEN 'fasteners' WHEN family = 'ones' AND contains(product_name, 'old') THEN 'classic' WHEN family = 'hots' AND contains(product_name, 'r') THEN 'r-line' END AS series
FROM (SELECT id, product_name, CASE WHEN lower(brand) = 'brand#1' THEN 'ones' WHEN lower(brand) = 'brand#3' THEN 'threes' WHEN regexp_matches(product_name, '^hot') THEN 'hots' ELSE 'other' END AS family FROM catalogue)""", C))
def c9(s, d):
    families = s.createDataFrame([(1, "ones", "brand#1", "$^"), (2, "threes", "brand#3", "$^"), (3, "hots", "-", "^hot")], "ord int, family string, alias string, pattern string")
    series = s.createDataFrame([(1, "ones", "fasteners", "bolt"), (2, "ones", "classic", "old"), (3, "hots", "r-line", "r")], "ord int, family string, series string, pattern string")
    return b.assign_family(catalogue(s, d), "id", families, series).select("id", "family", "series")


@query("c10_brand_anomalies", sql("""SELECT brand, w AS suggested, n FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY n DESC, w) AS k FROM (SELECT CAST(size AS VARCHAR) AS brand, CASE WHEN regexp_matches(product_name, '^(hot|cold|old) ') THEN split_part(product_name, ' ', 1) ELSE split_part(product_name, ' ', 2) END AS w, count(*) AS n FROM catalogue WHERE id % 2 = 0 GROUP BY 1, 2)) WHERE k = 1""", C))
def c10(s, d):
    rows = catalogue(s, d).select(F.when(F.col("id") % 2 == 0, F.col("size").cast("string")).otherwise(F.col("brand")).alias("brand"), "product_name")
    return b.brand_anomalies(rows, ["^(hot|cold|old) ", " ([a-z]+)$"])


@query("c11_clean_names", sql("""SELECT id, CASE WHEN brand = 'Brand#4' AND starts_with(product_name, 'new ') THEN split_part(product_name, ' ', 2) ELSE product_name END AS name_clean, CASE WHEN brand = 'Brand#4' AND starts_with(product_name, 'new ') THEN 'safe' WHEN regexp_matches(product_name, 'gizmo$') THEN 'review' ELSE 'none' END AS action FROM catalogue""", C))
def c11(s, d):
    rules = s.createDataFrame([(1, "Brand#4", "^new ", 0.95), (2, "*", "gizmo$", 0.5)], "ord int, brand string, pattern string, confidence double")
    return b.clean_names(catalogue(s, d), "id", rules).select("id", "name_clean", "action")


@query("c12_brand_audit", sql("""SELECT slug, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (k <= 3) AS witnesses FROM (SELECT id, trim(regexp_replace(lower(brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug, row_number() OVER (PARTITION BY brand ORDER BY id) AS k FROM catalogue) WHERE slug IN ('brand-1', 'brand-2') GROUP BY slug""", C))
def c12(s, d):
    canon = s.createDataFrame([("brand-1",), ("brand-2",), ("brand-x",)], "slug string")
    return b.brand_audit(catalogue(s, d), "id", canon, 3)
