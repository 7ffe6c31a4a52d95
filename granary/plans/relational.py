"""Queries of projection, filters, joins, aggregation, ranking and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary import sources
from granary.functions import text as t
from granary.operators import relational as r

from .registry import ALLOW, CATALOGUE, FEED, OFFERS, allowlist, catalogue, feed, offers, query, sql, table

C = CATALOGUE


@query("p1_to_canonical", sql("SELECT CAST(id AS VARCHAR) AS product_key, brand, CAST(NULL AS VARCHAR) AS gtin, kcal AS kcal_per_100g FROM catalogue", C))
def p1(s, d):
    return r.to_canonical(catalogue(s, d), {"product_key": F.col("id"), "brand": F.col("brand"), "kcal_per_100g": F.col("kcal")}, {"product_key": "string", "brand": "string", "gtin": "string", "kcal_per_100g": "double"})


@query("p2_classify_case", sql("""SELECT id, CASE WHEN form IN ('economy', 'promo') THEN 'budget' WHEN product_name LIKE 'red%' THEN 'red line' WHEN regexp_matches(product_name, '(?i)(ring|rod)$') THEN 'round' ELSE 'other' END AS class FROM catalogue""", C))
def p2(s, d):
    form = F.when(F.col("form").isin("economy", "promo"), F.lit("budget"))
    rules = [("like", "red line", "red%"), ("regex", "round", "(ring|rod)$")]
    return catalogue(s, d).select("id", F.coalesce(form, t.classify_case(F.col("product_name"), rules, "other")).alias("class"))


@query("p3_is_present", sql("SELECT id, life_stage IS NOT NULL AND length(trim(life_stage)) > 0 AS staged, kcal IS NOT NULL AS fed FROM catalogue", C))
def p3(s, d):
    return catalogue(s, d).select("id", t.is_present(F.col("life_stage")).alias("staged"), t.is_present(F.col("kcal"), "any").alias("fed"))


@query("p4_in_band", sql("SELECT id, kcal FROM catalogue WHERE NOT coalesce(kcal BETWEEN 270 AND 450, false)", C))
def p4(s, d):
    from granary.functions.parse import in_band

    return catalogue(s, d).where(~in_band(F.col("kcal"), 270, 450)).select("id", "kcal")


@query("p5_facet_filter", sql("SELECT id FROM catalogue WHERE form IN ('promo', 'small') AND size >= 10 AND size <= 20", C))
def p5(s, d):
    return r.facet_filter(catalogue(s, d), form=["promo", "small"], size=(10, 20), brand=None).select("id")


@query("p6_get_one", sql("SELECT * FROM catalogue WHERE id = 17 AND source = 'catalogue' ORDER BY id LIMIT 1", C))
def p6(s, d):
    return r.get_one(catalogue(s, d), id=17, source="catalogue")


@query("p7_complete_only", sql("SELECT id FROM catalogue WHERE kcal IS NOT NULL AND protein IS NOT NULL AND fat IS NOT NULL AND life_stage IS NOT NULL", C))
def p7(s, d):
    return r.complete_only(catalogue(s, d), ["kcal", "protein", "fat", "life_stage"]).select("id")


@query("p8_tags_contain", sql("SELECT id FROM catalogue WHERE len(list_filter(string_split(product_name || '/' || form, '/'), lambda x: contains(lower(x), 'bolt') OR contains(lower(x), 'prom'))) > 0", C))
def p8(s, d):
    tags = F.split(F.concat_ws("/", "product_name", "form"), "/")
    return catalogue(s, d).where(t.tags_contain(tags, ["bolt", "prom"])).select("id")


@query("p9_exclude_words", sql(r"SELECT id FROM catalogue WHERE NOT coalesce(regexp_matches(product_name, '(?i)\b(ring|gizmo)\b'), false)", C))
def p9(s, d):
    return catalogue(s, d).where(t.exclude_words(F.col("product_name"), ["ring", "gizmo"])).select("id")


@query("p10_ready_rows", sql("SELECT id FROM catalogue JOIN allowlist USING (brand) WHERE size >= 25 AND status IN ('ACTIVE') AND kcal IS NOT NULL", C, ALLOW))
def p10(s, d):
    joined = catalogue(s, d).join(allowlist(s, d), "brand")
    return r.ready_rows(joined, "size", 25, "status", ["ACTIVE"], ["kcal"]).select("id")


@query("j1_inner_gate", sql("SELECT c.id, a.status FROM catalogue c JOIN allowlist a ON c.brand = a.brand", C, ALLOW))
def j1(s, d):
    return catalogue(s, d).join(allowlist(s, d), "brand").select("id", "status")


@query("j2_left_chain", sql("""SELECT c.id, o.price AS offer_price, f.kcal AS feed_kcal FROM catalogue c
LEFT JOIN (SELECT id, price FROM (SELECT id, price, row_number() OVER (PARTITION BY id ORDER BY price) AS n FROM offers) WHERE n = 1) o ON c.id = o.id
LEFT JOIN (SELECT id - 1000000 AS id, kcal FROM feed) f ON c.id = f.id""", C, OFFERS, FEED))
def j2(s, d):
    o = offers(s, d).select("id", F.col("price").alias("offer_price"))
    f = feed(s, d).select((F.col("id") - 1_000_000).alias("id"), F.col("kcal").alias("feed_kcal"))
    return r.left_chain(catalogue(s, d).select("id"), [o, f], "id")


@query("j3_left_overrides", sql("SELECT c.id, coalesce(o.kcal, c.kcal) AS kcal FROM catalogue c LEFT JOIN (SELECT id - 1000000 AS id, kcal FROM feed) o ON c.id = o.id", C, FEED))
def j3(s, d):
    o = feed(s, d).select((F.col("id") - 1_000_000).alias("id"), F.col("kcal").alias("_k"))
    return catalogue(s, d).join(o, "id", "left").select("id", F.coalesce("_k", "kcal").alias("kcal"))


@query("j4_left_where", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' AND o_totalprice > 400000")
def j4(s, d):
    o = table(s, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return r.left_where(table(s, d, "customer"), o, "c_custkey", (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)).select("c_custkey", "o_orderkey")


@query("j5_cross_source_pairs", sql("""SELECT a.id AS id_a, b.id AS id_b, a.source AS source_a, b.source AS source_b FROM (SELECT id, lower(brand) AS brand, lower(product_name) AS product_name, source FROM catalogue UNION ALL SELECT id, lower(brand), lower(product_name), source FROM feed) a
JOIN (SELECT id, lower(brand) AS brand, lower(product_name) AS product_name, source FROM catalogue UNION ALL SELECT id, lower(brand), lower(product_name), source FROM feed) b ON a.brand = b.brand AND a.product_name = b.product_name AND a.source < b.source""", C, FEED))
def j5(s, d):
    low = [F.col("id"), F.lower("brand").alias("brand"), F.lower("product_name").alias("product_name"), F.col("source")]
    both = catalogue(s, d).select(*low).unionByName(feed(s, d).select(*low))
    return r.cross_source_pairs(both, ["brand", "product_name"], "source", ["id", "source"]).drop("brand", "product_name")


@query("j6_block_contains", sql("""SELECT l.id AS id_a, x.id AS id_b, CASE WHEN l.n = x.n THEN 0.95::DOUBLE ELSE 0.8::DOUBLE END AS confidence FROM (SELECT id, brand, product_name AS n FROM catalogue) l
JOIN (SELECT id, brand, CASE WHEN id % 2 = 0 THEN product_name ELSE split_part(product_name, ' ', 2) END AS n FROM catalogue) x ON l.brand = x.brand AND (contains(l.n, x.n) OR contains(x.n, l.n))""", C))
def j6(s, d):
    c = catalogue(s, d)
    short = c.withColumn("product_name", F.when(F.col("id") % 2 == 0, F.col("product_name")).otherwise(F.split_part("product_name", F.lit(" "), F.lit(2))))
    return r.block_contains_match(c, short, "brand", "product_name", "id", "id").select("id_a", "id_b", "confidence")


@query("j7_rule_cross", sql("SELECT c.id, g.rule FROM catalogue c JOIN (SELECT * FROM (VALUES ('round', '(ring|rod)$'), ('cold', '^cold'), ('b', '(^| )b[a-z]+')) v(rule, pattern)) g ON regexp_matches(c.product_name, g.pattern)", C))
def j7(s, d):
    rules = s.createDataFrame([("round", "(ring|rod)$"), ("cold", "^cold"), ("b", "(^| )b[a-z]+")], "rule string, pattern string")
    return r.rule_cross(catalogue(s, d), rules, "product_name", "pattern").select("id", "rule")


@query("j8_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '5-LOW')")
def j8(s, d):
    low = table(s, d, "orders").where("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("c_custkey"))
    return r.semi_on(table(s, d, "customer"), low, ["c_custkey"]).select("c_custkey")


@query("j9_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '5-LOW')")
def j9(s, d):
    low = table(s, d, "orders").where("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("c_custkey"))
    return r.anti_on(table(s, d, "customer"), low, ["c_custkey"]).select("c_custkey")


@query("j10_anti_within", "SELECT e.event_id FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND p.ts > e.ts - INTERVAL 1 DAY)")
def j10(s, d):
    e = table(s, d, "events")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"))
    return r.anti_within(e.where("event_type = 'error'"), bought, "user_id", "ts", "bought", F.expr("interval 1 day")).select("event_id")


@query("j11_either_key", sql("""SELECT id, arg_min(value, "by") AS value, min("by") AS "by" FROM (
  SELECT f.id, c.v AS value, 1 AS "by" FROM feed f JOIN (SELECT size, price, min(id) AS v FROM catalogue GROUP BY 1, 2) c ON f.size = c.size AND f.price = c.price
  UNION ALL SELECT f.id, c.v, 2 FROM feed f JOIN (SELECT upper(brand) AS brand, upper(product_name) AS product_name, min(id) AS v FROM catalogue GROUP BY 1, 2) c ON f.brand = c.brand AND f.product_name = c.product_name) GROUP BY id""", C, FEED))
def j11(s, d):
    c = catalogue(s, d).select("id", "size", "price", F.upper("brand").alias("brand"), F.upper("product_name").alias("product_name"))
    return r.either_key_join(feed(s, d), c.withColumnRenamed("id", "cid"), ["size", "price"], ["brand", "product_name"], "id", "cid")


@query("j12_cascade", sql("""SELECT f.id, coalesce(a.v, b.v) AS match_id, CASE WHEN a.v IS NOT NULL THEN 'key' WHEN b.v IS NOT NULL THEN 'name' ELSE 'new' END AS match_type,
  CASE WHEN a.v IS NOT NULL THEN 1.0::DOUBLE WHEN b.v IS NOT NULL THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM feed f
LEFT JOIN (SELECT upper(brand) AS brand, size, form, min(id) AS v FROM catalogue GROUP BY 1, 2, 3) a ON f.brand = a.brand AND f.size = a.size AND f.form = a.form
LEFT JOIN (SELECT upper(brand) AS brand, upper(product_name) AS product_name, min(id) AS v FROM catalogue WHERE id % 2 = 0 GROUP BY 1, 2) b ON f.brand = b.brand AND f.product_name = b.product_name""", C, FEED))
def j12(s, d):
    c = catalogue(s, d)
    keyed = c.select(F.col("id").alias("m"), F.upper("brand").alias("brand"), "size", "form")
    step = r.cascade_match(feed(s, d), keyed, [("key", ["brand", "size", "form"], 1.0)], "id", "m")
    named = c.where("id % 2 = 0").select(F.col("id").alias("m"), F.upper("brand").alias("brand"), F.upper("product_name").alias("product_name"))
    more = r.cascade_match(feed(s, d), named, [("name", ["brand", "product_name"], 0.9)], "id", "m").toDF("id", "m2", "t2", "c2")
    new = F.col("match_id").isNull()
    return step.join(more, "id").select("id", F.coalesce("match_id", "m2").alias("match_id"), F.when(new, F.col("t2")).otherwise(F.col("match_type")).alias("match_type"), F.when(new, F.col("c2")).otherwise(F.col("confidence")).alias("confidence"))


@query("j13_best_value", "SELECT o_custkey, arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS o_orderkey FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM orders) GROUP BY o_custkey")
def j13(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return r.best_per(o, ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("j14_in_set", sql("SELECT id FROM catalogue WHERE id IN (SELECT DISTINCT id FROM offers WHERE stock >= 50)", C, OFFERS))
def j14(s, d):
    return r.semi_on(catalogue(s, d), offers(s, d).where("stock >= 50"), ["id"]).select("id")


@query("g1_conditional_counts", sql("SELECT brand, count(*) AS n_rows, count(*) FILTER (kcal > 400) AS rich, count(*) FILTER (form = 'promo') AS promo FROM catalogue GROUP BY brand", C))
def g1(s, d):
    return r.conditional_counts(catalogue(s, d), ["brand"], {"rich": F.col("kcal") > 400, "promo": F.col("form") == "promo"})


COVERAGE = "SELECT brand, count(*) AS n_rows, round(count(kcal) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS kcal_pct, round(count(protein) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS protein_pct FROM catalogue GROUP BY brand"


@query("g2_coverage_pct", sql(COVERAGE, C))
def g2(s, d):
    return r.coverage_pct(catalogue(s, d), ["brand"], {"kcal": F.col("kcal"), "protein": F.col("protein")})


@query("g3_mean_coverage", sql(f"SELECT brand, round((kcal_pct + protein_pct) / 2, 3) AS completion FROM ({COVERAGE})", C))
def g3(s, d):
    return g2(s, d).select("brand", r.mean_coverage(["kcal_pct", "protein_pct"], 3).alias("completion"))


@query("g4_distinct_per", sql("SELECT brand, count(DISTINCT product_name) AS names FROM catalogue GROUP BY brand", C))
def g4(s, d):
    return catalogue(s, d).groupBy("brand").agg(F.countDistinct("product_name").alias("names"))


@query("g4_sketches")
def g4b(s, d):
    """Users by day and by month from the same stored sketches: estimates, within the bound that
    the tests hold against exact counts."""
    path = sources.scratch(s, "g4")
    day = table(s, d, "events").withColumn("day", F.to_date("ts"))
    r.distinct_sketches(day, ["day"], "user_id").write.parquet(path)
    kept = s.read.parquet(path)
    days = r.united(kept, ["day"]).withColumn("level", F.lit("day"))
    return days.unionByName(r.united(kept, [F.to_date(F.date_trunc("month", "day")).alias("day")]).withColumn("level", F.lit("month")))


@query("g5_collect_ordered", "SELECT conv_id, to_json(list({'turn': turn, 'role': role} ORDER BY turn)) AS turns FROM conversations GROUP BY conv_id")
def g5(s, d):
    got = r.collect_ordered(table(s, d, "conversations"), ["conv_id"], [F.col("turn")], ["turn", "role"], "turns")
    return got.select("conv_id", F.to_json("turns").alias("turns"))


@query("g6_collect_distinct", sql("SELECT brand, string_agg(DISTINCT form, ', ' ORDER BY form) AS form FROM catalogue GROUP BY brand", C))
def g6(s, d):
    return r.collect_distinct(catalogue(s, d), ["brand"], "form")


@query("g7_first_present", sql("SELECT brand, arg_min(kcal, (-day, kcal)) FILTER (kcal IS NOT NULL) AS kcal, arg_min(life_stage, (-day, life_stage)) FILTER (life_stage IS NOT NULL) AS life_stage FROM catalogue GROUP BY brand", C))
def g7(s, d):
    return r.first_present(catalogue(s, d), ["brand"], ["kcal", "life_stage"], -F.col("day"))


@query("g8_union_arrays", sql("SELECT brand, string_agg(DISTINCT w, ',' ORDER BY w) AS words FROM (SELECT brand, unnest(string_split(product_name, ' ')) AS w FROM catalogue) GROUP BY brand", C))
def g8(s, d):
    words = catalogue(s, d).select("brand", F.split("product_name", " ").alias("words"))
    return r.union_arrays(words, ["brand"], "words").select("brand", F.array_join("words", ",").alias("words"))


@query("g9_any_true", sql("SELECT brand, bool_or(kcal > 470) AS any_rich, max(CASE WHEN form = 'promo' THEN 1 ELSE 0 END) AS has_promo FROM catalogue GROUP BY brand", C))
def g9(s, d):
    return catalogue(s, d).groupBy("brand").agg(F.bool_or(F.col("kcal") > 470).alias("any_rich"), F.max(F.when(F.col("form") == "promo", 1).otherwise(0)).alias("has_promo"))


@query("g10_min_avg_max", sql("SELECT brand, min(size) AS lo, round(avg(size), 4) AS mean, max(size) AS hi, arg_max(id, (day, id)) AS last_id FROM catalogue GROUP BY brand", C))
def g10(s, d):
    return catalogue(s, d).groupBy("brand").agg(F.min("size").alias("lo"), F.round(F.avg("size"), 4).alias("mean"), F.max("size").alias("hi"), F.max_by("id", F.struct("day", "id")).alias("last_id"))


@query("g11_median", sql("SELECT brand, form, quantile_cont(CAST(size AS DOUBLE), 0.25) AS q25, quantile_cont(CAST(size AS DOUBLE), 0.5) AS q50, quantile_cont(CAST(size AS DOUBLE), 0.75) AS q75 FROM catalogue GROUP BY brand, form", C))
def g11(s, d):
    return r.median_by(catalogue(s, d), ["brand", "form"], "size")


@query("g12_having", sql("SELECT brand, count(*) AS n FROM catalogue GROUP BY brand HAVING count(*) > 75", C))
def g12(s, d):
    return catalogue(s, d).groupBy("brand").agg(F.count("*").alias("n")).where("n > 75")


@query("g13_share", sql("SELECT form, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct FROM catalogue GROUP BY form", C))
def g13(s, d):
    return r.share_by(catalogue(s, d), ["form"])


@query("g14_mode", sql("SELECT brand, product_name, n FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY n DESC, product_name) AS k FROM (SELECT brand, product_name, count(*) AS n FROM catalogue GROUP BY 1, 2)) WHERE k = 1", C))
def g14(s, d):
    return r.mode_by(catalogue(s, d), ["brand"], "product_name")


@query("g15_token_freq", r"SELECT token, count(*) AS n FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '')) AS token FROM documents) GROUP BY token ORDER BY n DESC, token LIMIT 50")
def g15(s, d):
    return r.token_freq(table(s, d, "documents"), F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != ""), 50)


@query("g16_counts_as_rows", sql("SELECT unnest(['rows', 'with kcal', 'promo']) AS metric, unnest([count(*), count(kcal), count(*) FILTER (form = 'promo')]) AS value FROM catalogue", C))
def g16(s, d):
    return r.counts_as_rows(catalogue(s, d), {"rows": F.lit(True), "with kcal": F.col("kcal").isNotNull(), "promo": F.col("form") == "promo"})


@query("g17_bin_counts", sql("SELECT CASE WHEN size > 0 AND size <= 10 THEN 'small' WHEN size > 10 AND size <= 30 THEN 'medium' WHEN size > 30 AND size <= 50 THEN 'large' END AS bin, count(*) AS n FROM catalogue GROUP BY 1", C))
def g17(s, d):
    return r.bin_counts(catalogue(s, d), "size", [0, 10, 30, 50], ["small", "medium", "large"])


@query("g18_delta_stats", sql("""SELECT coalesce(a.form, b.form) AS form, coalesce(a.n, 0) AS kcal_before, coalesce(b.n, 0) AS kcal_after, coalesce(b.n, 0) - coalesce(a.n, 0) AS kcal_delta FROM (SELECT form, count(kcal) AS n FROM catalogue GROUP BY 1) a FULL JOIN (SELECT form, count(kcal) AS n FROM feed GROUP BY 1) b ON a.form = b.form""", C, FEED))
def g18(s, d):
    return r.delta_stats(catalogue(s, d), feed(s, d), "form", {"kcal": F.col("kcal").isNotNull()})


@query("w1_rank_rows", sql("SELECT id, row_number() OVER (PARTITION BY brand, product_name ORDER BY kcal DESC NULLS LAST, day DESC, id) AS rank FROM catalogue", C))
def w1(s, d):
    return r.rank_rows(catalogue(s, d), ["brand", "product_name"], [F.desc_nulls_last("kcal"), F.desc("day"), F.asc("id")]).select("id", "rank")


@query("w2_best_per", "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def w2(s, d):
    e = table(s, d, "events").select("user_id", "event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return r.best_per(e, ["user_id", "event_type"], [-F.col("at"), -F.col("event_id")]).select("user_id", "event_type", "event_id")


@query("w3_with_total", sql("SELECT brand, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM (SELECT brand, count(*) AS n FROM catalogue GROUP BY 1)", C))
def w3(s, d):
    return r.with_total(catalogue(s, d).groupBy("brand").agg(F.count("*").alias("n")), "n")


@query("o1_order_custom", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def o1(s, d):
    n = table(s, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return r.order_custom(n, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"], ["o_orderpriority"])


@query("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o2(s, d):
    return table(s, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("o3_page", sql("SELECT id, product_name FROM catalogue ORDER BY product_name, id LIMIT 20 OFFSET 40", C))
def o3(s, d):
    return r.page(catalogue(s, d).select("id", "product_name"), ["product_name", "id"], 20, 40)


@query("o4_top_bottom", sql("SELECT * FROM (SELECT brand, n, 'top' AS side FROM (SELECT brand, count(*) AS n FROM catalogue GROUP BY 1) ORDER BY n DESC, brand LIMIT 3) UNION ALL SELECT * FROM (SELECT brand, n, 'bottom' AS side FROM (SELECT brand, count(*) AS n FROM catalogue GROUP BY 1) ORDER BY n, brand LIMIT 3)", C))
def o4(s, d):
    return r.top_bottom(catalogue(s, d).groupBy("brand").agg(F.count("*").alias("n")), "n", "brand", 3)


@query("o5_rows_of_top_groups", sql("SELECT id, brand FROM catalogue WHERE brand IN (SELECT brand FROM catalogue GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 5)", C))
def o5(s, d):
    return r.rows_of_top_groups(catalogue(s, d), "brand", 5).select("id", "brand")


@query("o6_seeded_sample", sql("SELECT id FROM catalogue ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 50", C))
def o6(s, d):
    return r.seeded_sample(catalogue(s, d), "id", 50, 42).select("id")


@query("o7_row_max_min", sql("SELECT id, greatest(kcal, protein, fat) AS most, least(kcal, protein, fat) AS fewest FROM catalogue", C))
def o7(s, d):
    cols = ("kcal", "protein", "fat")
    return catalogue(s, d).select("id", F.greatest(*cols).alias("most"), F.least(*cols).alias("fewest"))


@query("u1_union_sources", sql("SELECT id, brand, source FROM catalogue UNION ALL SELECT id, brand, source FROM feed", C, FEED))
def u1(s, d):
    return r.union_sources([x.select("id", "brand", "source") for x in (catalogue(s, d), feed(s, d))])


@query("u2_key_diff", sql("SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side FROM (SELECT DISTINCT size AS k FROM catalogue) a FULL JOIN (SELECT DISTINCT size AS k FROM feed) b ON a.k = b.k", C, FEED))
def u2(s, d):
    return r.key_diff(catalogue(s, d).select(F.col("size").alias("k")), feed(s, d).select(F.col("size").alias("k")), "k")


@query("u3_distinct_by", sql("SELECT brand, product_name, min(id) AS id FROM catalogue GROUP BY 1, 2", C))
def u3(s, d):
    return r.best_per(catalogue(s, d).select("brand", "product_name", "id"), ["brand", "product_name"], [F.col("id")])
