"""Queries of quality, gates and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import quality as q

from .registry import ALLOW, CATALOGUE, FEED, SQL, allowlist, catalogue, feed, query, sql, table

C = CATALOGUE
P = q.Profile(("kcal", "protein", "fat"), band=("kcal", 260, 490), marks={"kcal": 85, "protein": 90})
PCT = lambda c: f"round(count({c}) * 100.0::DOUBLE / nullif(count(*), 0), 2)"
BASE = f"SELECT brand, count(*) AS n_rows, {PCT('kcal')} AS kcal_pct, {PCT('protein')} AS protein_pct, {PCT('fat')} AS fat_pct, count(*) FILTER (kcal < 260 OR kcal > 490) AS outliers FROM catalogue GROUP BY brand"
TABLE = f"""SELECT *, round((kcal_pct + protein_pct + fat_pct) / 3, 3) AS completion, kcal_pct >= 85 AS kcal_ok, protein_pct >= 90 AS protein_ok,
CASE WHEN outliers = 0 AND kcal_pct >= 85 AND protein_pct >= 90 THEN 'PASS' WHEN kcal_pct >= 85 * 0.9::DOUBLE AND protein_pct >= 90 * 0.9::DOUBLE THEN 'NEAR' ELSE 'TODO' END AS status FROM ({BASE})"""


def quality(s, d):
    return q.quality_table(catalogue(s, d), ["brand"], P)


@query("q1_quality_table", sql(TABLE, C))
def q1(s, d):
    return quality(s, d)


@query("q2_quality_prod", sql(f"SELECT t.*, a.status AS allow_status, e.enriched_pct FROM ({TABLE}) t JOIN allowlist a ON t.brand = a.brand JOIN (SELECT brand, round(count(*) FILTER (id % 3 = 0) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS enriched_pct FROM catalogue GROUP BY 1) e ON t.brand = e.brand", C, ALLOW))
def q2(s, d):
    return q.quality_prod(catalogue(s, d), allowlist(s, d), "brand", P, F.col("id") % 3 == 0)


@query("q3_quality_arrays", sql(f"SELECT form, count(*) AS n_rows, {PCT('kcal')} AS kcal_pct, round(count(*) FILTER (id % 5 <> 0) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS tokens_pct, round(({PCT('kcal')} + round(count(*) FILTER (id % 5 <> 0) * 100.0::DOUBLE / nullif(count(*), 0), 2)) / 2, 3) AS completion FROM catalogue GROUP BY form", C))
def q3(s, d):
    rows = catalogue(s, d).withColumn("tokens", F.when(F.col("id") % 5 != 0, F.split("product_name", " ")).otherwise(F.array().cast("array<string>")))
    return q.quality_table(rows, ["form"], q.Profile(("kcal",), ("tokens",)))


@query("q4_scoreboard", sql(f"SELECT brand, CASE WHEN kcal_pct >= 90 AND fat_pct >= 95 THEN 'PASS' WHEN kcal_pct >= 90 * 0.95::DOUBLE AND fat_pct >= 95 * 0.95::DOUBLE THEN 'NEAR' ELSE 'TODO' END AS status FROM ({BASE})", C))
def q4(s, d):
    return q.quality_table(catalogue(s, d), ["brand"], q.Profile(("kcal", "fat"), marks={"kcal": 90, "fat": 95}, near=0.95)).select("brand", "status")


@query("q5_ready_groups", sql(f"SELECT brand FROM ({BASE}) WHERE n_rows >= 70 AND kcal_pct >= 84 AND protein_pct >= 89", C))
def q5(s, d):
    return q.ready_groups(quality(s, d), "brand", {"kcal": 84, "protein": 89}, 70)


GATES = f"""SELECT unnest(['kcal', 'promo', 'staged']) AS gate, unnest([80.0::DOUBLE, 20.0::DOUBLE, 70.0::DOUBLE]) AS target, unnest([a, b, c]) AS actual, unnest([a >= 80, b >= 20, c >= 70]) AS passed FROM (SELECT {PCT('kcal')} AS a, {PCT("CASE WHEN form = 'promo' THEN 1 END")} AS b, {PCT('life_stage')} AS c FROM catalogue)"""


def gates(s, d):
    return q.gate_table(catalogue(s, d), {"kcal": (F.col("kcal").isNotNull(), 80), "promo": (F.col("form") == "promo", 20), "staged": (F.col("life_stage").isNotNull(), 70)})


@query("q6_gate_table", sql(GATES, C))
def q6(s, d):
    return gates(s, d)


@query("q7_coverage_delta", sql(f"SELECT unnest(['kcal', 'fat']) AS field, unnest([a.k, a.f]) AS before, unnest([b.k, b.f]) AS after, unnest([round(b.k - a.k, 2), round(b.f - a.f, 2)]) AS delta, unnest([round(b.k - a.k, 2) >= 1.0, round(b.f - a.f, 2) >= 0.0]) AS passed FROM (SELECT {PCT('kcal')} AS k, {PCT('fat')} AS f FROM feed) a, (SELECT {PCT('kcal')} AS k, {PCT('fat')} AS f FROM catalogue) b", C, FEED))
def q7(s, d):
    return q.coverage_delta(feed(s, d), catalogue(s, d), ["kcal", "fat"], {"kcal": 1.0})


WANTED = "(SELECT brand, CASE WHEN status = 'PASS' THEN 'ACTIVE' ELSE 'PENDING' END AS status FROM (" + TABLE + ") WHERE status <> 'TODO')"


def admitted(s, d):
    want = quality(s, d).where("status <> 'TODO'").select("brand", F.when(F.col("status") == "PASS", "ACTIVE").otherwise("PENDING").alias("status"))
    return q.admit(allowlist(s, d), want, "brand", "gate")


@query("q8_admit", sql(f"SELECT coalesce(a.brand, w.brand) AS brand, coalesce(w.status, a.status) AS status FROM allowlist a FULL JOIN {WANTED} w ON a.brand = w.brand", C, ALLOW))
def q8(s, d):
    return admitted(s, d)[0]


@query("q8_admit_audit", sql(f"SELECT w.brand, a.status AS old_status, w.status AS new_status, 'gate' AS actor FROM {WANTED} w LEFT JOIN allowlist a ON a.brand = w.brand WHERE w.status IS DISTINCT FROM a.status", C, ALLOW))
def q8b(s, d):
    return admitted(s, d)[1]


@query("q9_gaps_to_target", sql(f"SELECT brand, round(greatest(0.0, 95.0 - kcal_pct), 2) AS kcal_gap, round(greatest(0.0, 92.0 - protein_pct), 2) AS protein_gap, greatest(round(greatest(0.0, 95.0 - kcal_pct), 2), round(greatest(0.0, 92.0 - protein_pct), 2)) AS largest_gap, 366 - CAST(n_rows AS INT) AS days_since FROM ({BASE})", C))
def q9(s, d):
    rows = quality(s, d).withColumn("validated", F.date_add(F.lit("2023-01-01").cast("date"), F.col("n_rows").cast("int")))
    return q.gaps_to_target(rows, "brand", {"kcal": 95, "protein": 92}, "validated", F.lit("2024-01-02").cast("date"))


@query("q10_field_coverage", sql("SELECT unnest(['kcal', 'protein', 'life_stage']) AS field, unnest([a, b, c]) AS n_present, unnest([n - a, n - b, n - c]) AS n_null, unnest([round(a * 100.0::DOUBLE / n, 2), round(b * 100.0::DOUBLE / n, 2), round(c * 100.0::DOUBLE / n, 2)]) AS pct FROM (SELECT count(*) AS n, count(kcal) AS a, count(protein) AS b, count(life_stage) AS c FROM catalogue)", C))
def q10(s, d):
    return q.field_coverage(catalogue(s, d), ["kcal", "protein", "life_stage"])


@query("q11_distribution", sql("SELECT form, count(kcal) AS n, min(kcal) AS lo, round(avg(kcal), 4) AS mean, max(kcal) AS hi FROM catalogue GROUP BY form", C))
def q11(s, d):
    return q.distribution(catalogue(s, d), ["form"], "kcal")


@query("q11_outliers", sql("SELECT id, 'kcal' AS field, kcal AS value, CASE WHEN kcal < 270 THEN 'low' ELSE 'high' END AS reason FROM catalogue WHERE kcal < 270 OR kcal > 480 UNION ALL SELECT id, 'size', CAST(size AS DOUBLE), CASE WHEN size < 3 THEN 'low' ELSE 'high' END FROM catalogue WHERE size < 3 OR size > 48", C))
def q11b(s, d):
    return q.outliers(catalogue(s, d), "id", {"kcal": (270, 480), "size": (3, 48)})


@query("q12_consistency", sql("SELECT id, 'old but puppy' AS issue FROM catalogue WHERE contains(product_name, 'old') AND life_stage = 'puppy' UNION ALL SELECT id, 'rich senior' FROM catalogue WHERE life_stage = 'senior' AND kcal > 450", C))
def q12(s, d):
    return q.consistency_issues(catalogue(s, d), "id", [("old but puppy", F.contains("product_name", F.lit("old")) & (F.col("life_stage") == "puppy")), ("rich senior", (F.col("life_stage") == "senior") & (F.col("kcal") > 450))])


POINTS = "round((CASE WHEN kcal IS NOT NULL THEN 40 ELSE 0 END + CASE WHEN protein IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN fat IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN life_stage IS NOT NULL THEN 10 ELSE 0 END) * 100.0::DOUBLE / 100, 2)"
GRADE = f"SELECT id, points, CASE WHEN points >= 95 THEN 'A+' WHEN points >= 90 THEN 'A' WHEN points >= 85 THEN 'A-' WHEN points >= 80 THEN 'B+' WHEN points >= 70 THEN 'B' WHEN points >= 60 THEN 'C' WHEN points >= 50 THEN 'D' ELSE 'F' END AS grade FROM (SELECT id, {POINTS} AS points FROM catalogue)"
WEIGHTS = {"kcal": 40, "protein": 30, "fat": 20, "life_stage": 10}


@query("q13_grade", sql(GRADE, C))
def q13(s, d):
    points, name = q.grade(WEIGHTS)
    return catalogue(s, d).select("id", points.alias("points"), name.alias("grade"))


@query("q14_grade_summary", sql(f"SELECT grade, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct FROM ({GRADE}) GROUP BY grade", C))
def q14(s, d):
    from granary.operators.relational import share_by

    return share_by(q13(s, d), ["grade"])


@query("q15_weighted_quality", sql("SELECT id, round((CASE WHEN kcal IS NOT NULL THEN 3.0::DOUBLE ELSE 0 END + CASE WHEN fat IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) / 4.0 * CASE source WHEN 'catalogue' THEN 0.8::DOUBLE WHEN 'feed' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END, 6) AS quality FROM (SELECT id, kcal, fat, source FROM catalogue UNION ALL SELECT id, kcal, fat, source FROM feed)", C, FEED))
def q15(s, d):
    rows = catalogue(s, d).unionByName(feed(s, d))
    return rows.select("id", q.weighted_quality({"kcal": 3.0, "fat": 1.0}, {"catalogue": 0.8, "feed": 0.5}, "source").alias("quality"))


@query("q16_leaderboard", sql(f"SELECT brand, points, row_number() OVER (ORDER BY points DESC, brand) AS place FROM (SELECT brand, round((kcal_pct * 2.0 + fat_pct * 1.0) / 3.0, 4) AS points FROM ({BASE}))", C))
def q16(s, d):
    return q.leaderboard(quality(s, d), "brand", {"kcal": 2.0, "fat": 1.0})


@query("q17_impact_queue", sql(f"SELECT brand, n_rows, round(100.0 - completion, 3) AS gap, round(n_rows * (100.0 - completion), 2) AS impact FROM ({TABLE})", C))
def q17(s, d):
    return q.impact_queue(quality(s, d), "brand")


@query("q18_row_gaps", sql("SELECT id, CAST((kcal IS NULL)::INT + (protein IS NULL)::INT + (life_stage IS NULL)::INT AS INT) AS n_gaps, CASE WHEN kcal IS NULL THEN 'kcal' WHEN protein IS NULL THEN 'protein' WHEN life_stage IS NULL THEN 'life_stage' END AS primary_gap FROM catalogue", C))
def q18(s, d):
    return q.row_gaps(catalogue(s, d), "id", ["kcal", "protein", "life_stage"])


@query("q19_freshness", "SELECT event_id, CASE WHEN a <= 1 THEN 'fresh' WHEN a <= 7 THEN 'recent' ELSE 'stale' END AS bucket, array_to_string(list_filter([CASE WHEN a > 7 THEN 'old' END, CASE WHEN value < 5 THEN 'low value' END], lambda x: x IS NOT NULL), ',') AS reasons FROM (SELECT *, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS a FROM events)")
def q19(s, d):
    age = F.datediff(F.lit("2024-01-31").cast("date"), F.col("ts").cast("date"))
    return table(s, d, "events").select("event_id", q.freshness(age, [(1, "fresh"), (7, "recent")], "stale").alias("bucket"), F.array_join(q.stale_reasons([("old", age > 7), ("low value", F.col("value") < 5)]), ",").alias("reasons"))


@query("q20_provenance_share", sql("SELECT field, origin, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY field), 2) AS pct FROM (SELECT 'form' AS field, form AS origin FROM catalogue UNION ALL SELECT 'life_stage', coalesce(life_stage, 'none') FROM catalogue) GROUP BY 1, 2", C))
def q20(s, d):
    return q.provenance_share(catalogue(s, d), ["form", "life_stage"])


@query("q21_price_report", sql("SELECT brand, form, count(*) AS n_rows, round(count(*) FILTER (id % 6 <> 0) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS priced_pct, min(price) FILTER (id % 6 <> 0) AS lo, max(price) FILTER (id % 6 <> 0) AS hi, count(*) FILTER (id % 6 <> 0 AND id % 4 = 0) AS unbucketed FROM catalogue GROUP BY 1, 2", C))
def q21(s, d):
    rows = catalogue(s, d).withColumns({"price": F.when(F.col("id") % 6 != 0, F.col("price")), "bucket": F.when(F.col("id") % 4 != 0, F.lit("x"))})
    return q.price_report(rows, ["brand", "form"], "price", "bucket")


@query("q22_availability", "SELECT country, count(*) AS n FROM (SELECT DISTINCT s_suppkey, n_name AS country FROM supplier JOIN nation ON n_nationkey IN (s_nationkey, (s_nationkey + 1) % 25)) GROUP BY country")
def q22(s, d):
    n = table(s, d, "nation").select("n_nationkey", "n_name")
    sup = table(s, d, "supplier").select("s_suppkey", F.explode(F.array(F.col("s_nationkey"), (F.col("s_nationkey") + 1) % 25)).alias("n_nationkey"))
    lists = sup.join(F.broadcast(n), "n_nationkey").groupBy("s_suppkey").agg(F.collect_list("n_name").alias("countries"))
    return q.availability(lists, F.col("countries"))


@query("q23_table_health", sql("SELECT unnest(['rows', 'distinct keys', 'bad slug slug', 'array as text tags', 'default kcal']) AS metric, unnest([count(*), count(DISTINCT brand || product_name), count(*) FILTER (id % 10 = 0), count(*) FILTER (id % 3 = 0), count(*) FILTER (kcal = 300)]) AS value FROM catalogue", C))
def q23(s, d):
    rows = catalogue(s, d).withColumns({"k": F.concat("brand", "product_name"), "slug": F.when(F.col("id") % 10 == 0, F.lit("Bad Slug")).otherwise(F.lit("good-slug")), "tags": F.when(F.col("id") % 3 == 0, F.lit(' ["a"]')).otherwise(F.lit("a"))})
    return q.table_health(rows, "k", ["slug"], ["tags"], {"default kcal": F.col("kcal") == 300})


@query("q23_coverage", sql("SELECT unnest(['rows', 'distinct keys', 'present kcal', 'present protein', 'present life_stage']) AS metric, unnest([count(*), count(DISTINCT id), count(kcal), count(protein), count(life_stage)]) AS value FROM catalogue", C))
def q23b(s, d):
    return q.table_health(catalogue(s, d), "id", [], [], {}, ["kcal", "protein", "life_stage"])


@query("q24_repair_slugs", sql("SELECT id, trim(regexp_replace(regexp_replace(lower(trim(brand || ' -- ' || product_name || '!')), '[^a-z0-9_-]+', '-', 'g'), '-+', '-', 'g'), '-') AS slug FROM catalogue", C))
def q24(s, d):
    return q.repair_slugs(catalogue(s, d).select("id", F.concat("brand", F.lit(" -- "), "product_name", F.lit("!")).alias("slug")), ["slug"])


TEXTS = """texts AS (SELECT '["' || replace(product_name, ' ', '","') || '"]' AS tags, CASE WHEN size % 9 = 0 THEN product_name WHEN size % 7 = 0 THEN '{"a": 1}' ELSE '["' || form || '"]' END AS mixed FROM catalogue)"""


@query("q25_array_validity", sql(r"""SELECT field, count(*) AS n, round(count(*) FILTER (regexp_matches(v, '^\["[^"]*"(,"[^"]*")*\]$')) * 100.0::DOUBLE / count(*), 2) AS valid_pct, round(count(*) FILTER (regexp_matches(v, '^\["[^"]*"(,"[^"]*")*\]$')) * 100.0::DOUBLE / count(*), 2) >= 99 AS passed FROM (SELECT 'tags' AS field, tags AS v FROM texts UNION ALL SELECT 'mixed', mixed FROM texts) GROUP BY field""", C, TEXTS))
def q25(s, d):
    tags = F.concat(F.lit('["'), F.replace("product_name", F.lit(" "), F.lit('","')), F.lit('"]'))
    mixed = F.when(F.col("size") % 9 == 0, F.col("product_name")).when(F.col("size") % 7 == 0, F.lit('{"a": 1}')).otherwise(F.concat(F.lit('["'), F.col("form"), F.lit('"]')))
    return q.array_validity(catalogue(s, d).select(tags.alias("tags"), mixed.alias("mixed")), ["tags", "mixed"])


@query("q26_compare_env", sql("SELECT unnest(['rows', 'only here', 'differ']) AS metric, unnest([count(x), count(*) FILTER (y IS NULL), count(*) FILTER (x IS NOT NULL AND y IS NOT NULL AND ak IS DISTINCT FROM bk)]) AS a, unnest([count(y), count(*) FILTER (x IS NULL), count(*) FILTER (x IS NOT NULL AND y IS NOT NULL AND ak IS DISTINCT FROM bk)]) AS b FROM (SELECT a.id AS x, b.id AS y, a.kcal AS ak, b.kcal AS bk FROM (SELECT * FROM catalogue WHERE id % 10 <> 1) a FULL JOIN (SELECT id - 1000000 AS id, kcal FROM feed) b ON a.id = b.id)", C, FEED))
def q26(s, d):
    return q.compare_env(catalogue(s, d).where("id % 10 <> 1"), feed(s, d).withColumn("id", F.col("id") - 1_000_000), "id", ["kcal"])


@query("q27_health_status", sql(f"SELECT count(*) AS n_gates, count(*) FILTER (NOT passed) AS n_failing, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (NOT passed), '') AS failing, CASE WHEN count(*) FILTER (NOT passed) = 0 THEN 'OK' WHEN count(*) FILTER (NOT passed) * 2 < count(*) THEN 'LOW' ELSE 'CRITICAL' END AS status FROM ({GATES})", C))
def q27(s, d):
    return q.health_status(gates(s, d))


@query("q28_recency", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_keys, count(*) FILTER (a <= 1) AS last_1d, count(*) FILTER (a <= 7) AS last_7d FROM (SELECT *, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS a FROM events) GROUP BY event_type")
def q28(s, d):
    return q.recency_metrics(table(s, d, "events"), ["event_type"], "user_id", F.datediff(F.lit("2024-01-31").cast("date"), F.col("ts").cast("date")), [1, 7])


@query("q29_content_completeness", sql("SELECT unnest(['energy', 'label']) AS part, unnest([round(sum((kcal IS NOT NULL AND kcal <> 300)::INT + (protein IS NOT NULL)::INT) * 100.0::DOUBLE / (count(*) * 2), 2), round(sum((life_stage IS NOT NULL AND life_stage <> 'adult')::INT) * 100.0::DOUBLE / count(*), 2)]) AS pct FROM catalogue", C))
def q29(s, d):
    return q.content_completeness(catalogue(s, d), {"energy": {"kcal": 300.0, "protein": None}, "label": {"life_stage": "adult"}})


@query("q30_staging_summary", sql("SELECT source, count(*) AS n_rows, count(DISTINCT brand) AS brands, string_agg(DISTINCT form, ',' ORDER BY form) AS forms FROM (SELECT * FROM catalogue UNION ALL SELECT * FROM feed) GROUP BY source", C, FEED))
def q30(s, d):
    rows = catalogue(s, d).unionByName(feed(s, d))
    return rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.countDistinct("brand").alias("brands"), F.array_join(F.sort_array(F.collect_set("form")), ",").alias("forms"))


@query("q31_check_contract", """SELECT * FROM (VALUES ('p_partkey', 'bigint', 'bigint', 'ok'), ('p_size', 'string', 'int', 'type'), ('p_gtin', 'string', NULL, 'missing'), ('*', NULL, NULL, 'partial')) v("column", expected, found, state)""")
def q31(s, d):
    return q.check_contract(table(s, d, "part"), {"p_partkey": "bigint", "p_size": "string", "p_gtin": "string"})


@query("q32_auto_approve", sql("SELECT id, CASE WHEN id % 2 = 0 AND kcal IS NOT NULL AND contains(product_name, ' ') AND size > 10 THEN 'approved' WHEN id % 2 = 0 THEN 'pending' ELSE 'done' END AS state_new, CASE WHEN id % 2 = 0 THEN array_to_string(list_filter([CASE WHEN kcal IS NULL THEN 'kcal' END, CASE WHEN size <= 10 THEN 'size' END], lambda x: x IS NOT NULL), ',') END AS missing FROM catalogue", C))
def q32(s, d):
    rows = catalogue(s, d).withColumn("state", F.when(F.col("id") % 2 == 0, "pending").otherwise("done"))
    return q.auto_approve(rows, "id", "state", {"kcal": F.col("kcal").isNotNull(), "size": F.col("size") > 10})


@query("q33_compare_tables", sql("""SELECT * FROM (SELECT coalesce(a.id, b.id) AS id, a.v AS ours, b.v AS theirs, CASE WHEN b.id IS NULL THEN 'missing there' WHEN a.id IS NULL THEN 'missing here' WHEN a.v IS DISTINCT FROM b.v THEN 'differs' END AS kind
FROM (SELECT id, CASE form WHEN 'promo' THEN 'sale' ELSE form END AS v FROM catalogue WHERE id % 7 <> 0) a FULL JOIN (SELECT id - 1000000 AS id, CASE WHEN form = 'promo' THEN 'sale' ELSE 'economy' END AS v FROM feed) b ON a.id = b.id) WHERE kind IS NOT NULL""", C, FEED))
def q33(s, d):
    theirs = feed(s, d).select((F.col("id") - 1_000_000).alias("id"), F.when(F.col("form") == "promo", "sale").otherwise("economy").alias("theirs_form"))
    return q.compare_tables(catalogue(s, d).where("id % 7 <> 0"), theirs, "id", "form", "theirs_form", {"promo": "sale"})


@query("q34_work_list", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS domain, 'missing' AS why FROM pages WHERE page_id % 4 = 0 UNION ALL SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1), 'unmatched' FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE url || '&new' END AS url FROM pages) s WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = s.url)")
def q34(s, d):
    p = table(s, d, "pages")
    staged = p.withColumn("url", F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat("url", F.lit("&new"))))
    return q.work_list(p.withColumn("found", F.when(F.col("page_id") % 4 != 0, F.lit(1))), staged, "page_id", "url", "found")


@query("q34_work_counts", "SELECT domain, why, count(*) AS n FROM (" + SQL["q34_work_list"] + ") GROUP BY domain, why")
def q34b(s, d):
    return q.work_counts(q34(s, d))


@query("q35_missing_fields", sql("SELECT unnest(['kcal', 'protein', 'fat', 'life_stage']) AS field, unnest([n - count(kcal), n - count(protein), n - count(fat), n - count(life_stage)]) AS n_missing, unnest([round((n - count(kcal)) * 100.0::DOUBLE / n, 2), round((n - count(protein)) * 100.0::DOUBLE / n, 2), round((n - count(fat)) * 100.0::DOUBLE / n, 2), round((n - count(life_stage)) * 100.0::DOUBLE / n, 2)]) AS percent FROM catalogue, (SELECT count(*) AS n FROM catalogue) t GROUP BY n", C))
def q35b(s, d):
    return q.missing_fields(catalogue(s, d), ["kcal", "protein", "fat", "life_stage"])


@query("q35_completeness_tiers", sql("SELECT CASE WHEN s < 40 THEN 'low' WHEN s < 70 THEN 'mid' ELSE 'high' END AS tier, count(*) AS n FROM (SELECT ((kcal IS NOT NULL)::INT + (protein IS NOT NULL)::INT + (fat IS NOT NULL)::INT + (life_stage IS NOT NULL)::INT) * 100 / 4.0 AS s FROM catalogue) GROUP BY 1", C))
def q35(s, d):
    return q.completeness_tiers(catalogue(s, d), ["kcal", "protein", "fat", "life_stage"])
