"""Queries of matching, duplicates and variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as t
from granary.operators import match as m
from granary.operators.candidates import edit_candidates, token_candidates
from granary.operators import variants as v

from .registry import CATALOGUE, FEED, catalogue, feed, query, sql, table

C = CATALOGUE
#: The right side of matches: the catalogue, most names changed.
REF = """ref AS (SELECT id AS ref_id, brand, CASE WHEN id % 3 = 0 THEN product_name || 's' WHEN id % 3 = 1 THEN product_name ELSE 'super ' || product_name END AS product_name, form, kcal, life_stage, size FROM catalogue)"""


def ref(s, d):
    c = catalogue(s, d)
    name = F.when(F.col("id") % 3 == 0, F.concat("product_name", F.lit("s"))).when(F.col("id") % 3 == 1, F.col("product_name")).otherwise(F.concat(F.lit("super "), "product_name"))
    return c.select(F.col("id").alias("ref_id"), "brand", name.alias("product_name"), "form", "kcal", "life_stage", "size")


SIM = "round(1.0 - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name)), 6)"


@query("d1_block_overlap", sql("""SELECT coalesce(a.form, b.form) AS form, coalesce(x, 0) AS n_left, coalesce(y, 0) AS n_right, coalesce(x, 0) * coalesce(y, 0) AS pairs, CASE WHEN coalesce(y, 0) = 0 THEN 'left' WHEN coalesce(x, 0) = 0 THEN 'right' ELSE 'both' END AS side
FROM (SELECT form, count(*) AS x FROM catalogue WHERE form <> 'promo' GROUP BY 1) a FULL JOIN (SELECT form, count(*) AS y FROM catalogue WHERE form <> 'large' GROUP BY 1) b ON a.form = b.form""", C))
def d1(s, d):
    c = catalogue(s, d)
    return m.block_overlap(c.where("form <> 'promo'"), c.where("form <> 'large'"), "form")


@query("d2_signature", sql("SELECT id, product_name AS clean_name, array_to_string(list_sort(string_split(product_name, ' ')), ',') AS tokens FROM catalogue", C))
def d2(s, d):
    rows = catalogue(s, d).withColumn("product_name", F.concat("brand", F.lit(" "), F.upper("product_name"), F.lit(" 400g")))
    return m.signature(rows, "id", "product_name", "brand").select("id", "clean_name", F.array_join("tokens", ",").alias("tokens"))


@query("d3_weighted_match", sql("""SELECT c.id, x.match_id, x.score, CASE WHEN x.score >= 0.75 THEN 'auto' WHEN x.score >= 0.6 THEN 'review' ELSE 'rejected' END AS tier FROM catalogue c LEFT JOIN (
  SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (SELECT a.id, b.ref_id AS match_id, round(0.6::DOUBLE * (len(list_intersect(string_split(a.product_name, ' '), string_split(b.product_name, ' '))) * 1.0::DOUBLE / len(list_distinct(list_concat(string_split(a.product_name, ' '), string_split(b.product_name, ' ')))))
  + 0.3::DOUBLE * (1.0::DOUBLE - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name))) + 0.1::DOUBLE * (CASE WHEN a.form = b.form THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS score FROM catalogue a JOIN ref b ON a.brand = b.brand)) x ON c.id = x.id AND k = 1""", C, REF))
def d3(s, d):
    parts = {"tokens": (0.6, m.jaccard(F.split("a_product_name", " "), F.split("b_product_name", " "))), "chars": (0.3, m.edit_similarity(F.col("a_product_name"), F.col("b_product_name"))), "form": (0.1, F.when(F.col("a_form") == F.col("b_form"), 1.0).otherwise(0.0))}
    return m.match(catalogue(s, d), ref(s, d), "brand", "id", "ref_id", parts, ["product_name", "form"], [("auto", 0.75), ("review", 0.6)], by=by_tokens())


NOUNS = ["ring", "rod", "gear", "bolt", "plate", "gizmo", "widget"]
HAS = "list_filter(string_split({}, ' '), lambda w: w IN (" + ", ".join(f"'{w}'" for w in NOUNS) + "))"


@query("d3_four_terms", sql(f"""SELECT c.id, x.match_id, x.score, CASE WHEN x.score >= 0.75 THEN 'auto' WHEN x.score >= 0.6 THEN 'review' ELSE 'rejected' END AS tier FROM catalogue c LEFT JOIN (
  SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (SELECT a.id, b.ref_id AS match_id, round(0.5::DOUBLE * (len(list_intersect(string_split(a.product_name, ' '), string_split(b.product_name, ' '))) * 1.0::DOUBLE / len(list_distinct(list_concat(string_split(a.product_name, ' '), string_split(b.product_name, ' ')))))
  + 0.2::DOUBLE * coalesce(len(list_intersect({HAS.format('a.product_name')}, {HAS.format('b.product_name')})) * 1.0::DOUBLE / nullif(greatest(len({HAS.format('a.product_name')}), len({HAS.format('b.product_name')})), 0), 0.0::DOUBLE)
  + 0.2::DOUBLE * (1.0::DOUBLE - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name))) + 0.1::DOUBLE * ((CASE WHEN a.form = b.form THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN a.life_stage = b.life_stage THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / 2.0::DOUBLE), 6) AS score FROM catalogue a JOIN ref b ON a.brand = b.brand)) x ON c.id = x.id AND k = 1""", C, REF))
def d3b(s, d):
    """All four terms: tokens, keywords (here nouns), characters, and form and stage in halves."""
    words = lambda c: F.split(c, " ")
    known = lambda c: F.filter(words(c), lambda w: w.isin(NOUNS))
    agree = lambda c: F.when(F.col(f"a_{c}") == F.col(f"b_{c}"), 1.0).otherwise(0.0)
    parts = {"tokens": (0.5, m.jaccard(words("a_product_name"), words("b_product_name"))), "keywords": (0.2, m.overlap(known("a_product_name"), known("b_product_name"))), "chars": (0.2, m.edit_similarity(F.col("a_product_name"), F.col("b_product_name"))), "hints": (0.1, (agree("form") + agree("life_stage")) / 2.0)}
    return m.match(catalogue(s, d), ref(s, d), "brand", "id", "ref_id", parts, ["product_name", "form", "life_stage"], [("auto", 0.75), ("review", 0.6)], by=by_tokens())


@query("d4_fuzzy", sql(f"""SELECT c.id, x.match_id, x.score, CASE WHEN x.score >= 0.8 THEN 'high' WHEN x.score >= 0.65 THEN 'medium' ELSE 'none' END AS tier FROM catalogue c LEFT JOIN (SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (SELECT a.id, b.ref_id AS match_id, {SIM} AS score FROM catalogue a JOIN ref b ON a.brand = b.brand)) x ON c.id = x.id AND k = 1""", C, REF))
def d4(s, d):
    return m.match(catalogue(s, d), ref(s, d), "brand", "id", "ref_id", {"n": (1.0, m.edit_similarity(F.col("a_product_name"), F.col("b_product_name")))}, ["product_name"], [("high", 0.8), ("medium", 0.65)], "none", by=by_name())


@query("d5_exact_then_fuzzy", sql("""SELECT id, match_id, 1.0::DOUBLE AS score, 'exact' AS how FROM (SELECT a.id, min(b.ref_id) AS match_id FROM catalogue a JOIN ref b ON a.brand = b.brand AND a.product_name = b.product_name GROUP BY 1)
UNION ALL SELECT id, match_id, score, 'fuzzy' FROM (SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (SELECT a.id, b.ref_id AS match_id, round(CASE WHEN a.form = b.form THEN least((1.0::DOUBLE - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name))) * 1.1::DOUBLE, 1.0::DOUBLE)
  ELSE 1.0::DOUBLE - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name)) END, 6) AS score FROM catalogue a JOIN ref b ON a.brand = b.brand WHERE NOT EXISTS (SELECT 1 FROM ref r WHERE r.brand = a.brand AND r.product_name = a.product_name)) WHERE score >= 0.5) WHERE k = 1""", C, REF))
def d5(s, d):
    return m.match_exact_then_fuzzy(catalogue(s, d), ref(s, d), "brand", "product_name", "form", "id", "ref_id")


@query("d6_features", sql("""SELECT id, match_id, score, CASE WHEN score >= 0.4 THEN 'accepted' ELSE 'rejected' END AS tier FROM (SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (
  SELECT a.id, b.ref_id AS match_id, round(0.7::DOUBLE * (1.0::DOUBLE - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name))) + 0.3::DOUBLE * (CASE WHEN a.form = b.form THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS score FROM catalogue a JOIN ref b ON a.brand = b.brand WHERE a.kcal IS NULL AND b.kcal IS NOT NULL)) WHERE k = 1
UNION ALL SELECT a.id, NULL, NULL, 'rejected' FROM catalogue a WHERE a.kcal IS NULL AND NOT EXISTS (SELECT 1 FROM ref b WHERE b.brand = a.brand AND b.kcal IS NOT NULL)""", C, REF))
def d6(s, d):
    parts = {"n": (0.7, m.edit_similarity(F.col("a_product_name"), F.col("b_product_name"))), "f": (0.3, F.when(F.col("a_form") == F.col("b_form"), 1.0).otherwise(0.0))}
    return m.match(catalogue(s, d).where("kcal is null"), ref(s, d).where("kcal is not null"), "brand", "id", "ref_id", parts, ["product_name", "form"], [("accepted", 0.4)], by=by_name())


def by_tokens():
    return "tokens", token_candidates(F.split("a_product_name", " "), F.split("b_product_name", " "))


def by_name(part="n"):
    return part, edit_candidates(F.col("a_product_name"), F.col("b_product_name"))


URLS = """urls AS (SELECT id, brand, kcal, product_name, 'https://shop.example/' || coalesce(life_stage, 'all') || '/' || CASE WHEN size < 15 THEN 'small' WHEN size > 35 THEN 'large' ELSE 'any' END || '/' || replace(product_name, ' ', '-') || '?v=1' AS url FROM catalogue WHERE kcal IS NULL)"""
PATH = "regexp_replace(regexp_replace(lower(a.url), '^[a-z]+://[^/]*', ''), '[?#].*$', '')"


@query("d6_url_features", sql(f"""SELECT id, match_id, score, CASE WHEN score >= 0.4 THEN 'accepted' ELSE 'rejected' END AS tier FROM (SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (
  SELECT a.id, b.ref_id AS match_id, round(0.5::DOUBLE * (1.0::DOUBLE - levenshtein(a.product_name, b.product_name) * 1.0::DOUBLE / greatest(length(a.product_name), length(b.product_name))) + 0.2::DOUBLE * (CASE WHEN coalesce(regexp_matches({PATH}, '(^|[/_.-])' || b.life_stage || '([/_.-]|$)'), false) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
  + 0.1::DOUBLE * (CASE WHEN regexp_matches({PATH}, '(^|[/_.-])small([/_.-]|$)') AND contains(b.product_name, 'small') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) + 0.1::DOUBLE * (CASE WHEN regexp_matches({PATH}, '(^|[/_.-])large([/_.-]|$)') AND contains(b.product_name, 'large') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS score FROM urls a JOIN ref b ON a.brand = b.brand WHERE b.kcal IS NOT NULL)) WHERE k = 1
UNION ALL SELECT a.id, NULL, NULL, 'rejected' FROM urls a WHERE NOT EXISTS (SELECT 1 FROM ref b WHERE b.brand = a.brand AND b.kcal IS NOT NULL)""", C, REF, URLS))
def d6b(s, d):
    """Flags of the URL's path against stage and name of rows that have the field."""
    size = F.when(F.col("size") < 15, "small").when(F.col("size") > 35, "large").otherwise("any")
    url = F.concat(F.lit("https://shop.example/"), F.coalesce("life_stage", F.lit("all")), F.lit("/"), size, F.lit("/"), F.replace("product_name", F.lit(" "), F.lit("-")), F.lit("?v=1"))
    left = catalogue(s, d).where("kcal is null").withColumns({f"url_{n}": c for n, c in t.url_flags(url, ["puppy", "adult", "senior", "small", "large"]).items()})
    stage = F.coalesce(*[F.when(F.col(f"a_url_{w}"), F.lit(w)) for w in ("puppy", "adult", "senior")])
    named = lambda w: F.when(F.col(f"a_url_{w}") & F.contains("b_product_name", F.lit(w)), 1.0).otherwise(0.0)
    parts = {"name": (0.5, m.edit_similarity(F.col("a_product_name"), F.col("b_product_name"))), "stage": (0.2, F.when(stage == F.col("b_life_stage"), 1.0).otherwise(0.0)), "small": (0.1, named("small")), "large": (0.1, named("large"))}
    flags = [f"url_{w}" for w in ("puppy", "adult", "senior", "small", "large")]
    right = ref(s, d).where("kcal is not null").withColumns({f: F.lit(False) for f in flags})
    return m.match(left, right, "brand", "id", "ref_id", parts, ["product_name", "life_stage", *flags], [("accepted", 0.4)], by=by_name("name"))


@query("d7_tokens", sql("""SELECT id, match_id, score FROM (SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (SELECT a.id, b.ref_id AS match_id, CAST(len(list_intersect(string_split(a.product_name, ' '), string_split(b.product_name, ' '))) AS DOUBLE) AS score FROM catalogue a JOIN ref b ON a.brand = b.brand) WHERE score >= 2) WHERE k = 1""", C, REF))
def d7(s, d):
    cut = lambda x: x.withColumn("tokens", F.split("product_name", " "))
    return m.match_tokens(cut(catalogue(s, d)), cut(ref(s, d)), "brand", "tokens", "id", "ref_id")


@query("d8_variants", sql(f"""WITH hit AS (SELECT a.id, min(b.ref_id) AS match_id FROM catalogue a JOIN ref b ON (a.brand || '|' || a.product_name IN (b.brand || '|' || b.product_name, b.brand || '|' || replace(b.product_name, 'super ', ''))) OR (a.brand || '|' || replace(a.product_name, 'super ', '') IN (b.brand || '|' || b.product_name, b.brand || '|' || replace(b.product_name, 'super ', ''))) GROUP BY 1)
SELECT id, match_id, 1.0::DOUBLE AS score, 'key' AS how FROM hit UNION ALL SELECT id, match_id, score, 'fuzzy' FROM (SELECT id, match_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS k FROM (SELECT a.id, b.ref_id AS match_id, {SIM} AS score FROM catalogue a JOIN ref b ON a.brand = b.brand WHERE a.id NOT IN (SELECT id FROM hit)) WHERE score > 0.8) WHERE k = 1""".replace("WITH hit AS", ", hit AS", 1), C, REF).replace(")\n, hit", "), hit", 1))
def d8(s, d):
    keys = F.array(F.concat_ws("|", "brand", "product_name"), F.concat_ws("|", "brand", F.replace("product_name", F.lit("super "), F.lit(""))))
    return m.match_variants(catalogue(s, d), ref(s, d), keys, keys, "brand", "product_name", "id", "ref_id")


@query("d8_char_ratio")
def d8b(s, d):
    """The exact sequence ratio, which SQL can't express; the tests hold it against the library's."""
    return m.match_ratio(catalogue(s, d), ref(s, d), "brand", "product_name", "id", "ref_id", 0.8)


@query("d9_overlap", sql("""SELECT f.id, CASE WHEN n.i IS NOT NULL THEN 'exact' WHEN b.brand IS NOT NULL THEN 'new product' ELSE 'new brand' END AS kind, coalesce(n.i, false) AS improvable FROM feed f LEFT JOIN (SELECT upper(brand) AS brand, upper(product_name) AS product_name, bool_or(kcal IS NULL) AS i FROM catalogue WHERE id % 3 = 1 AND brand <> 'Brand#5' GROUP BY 1, 2) n ON f.brand = n.brand AND f.product_name = n.product_name
LEFT JOIN (SELECT DISTINCT upper(brand) AS brand FROM catalogue WHERE id % 3 = 1 AND brand <> 'Brand#5') b ON f.brand = b.brand""", C, FEED))
def d9(s, d):
    known = catalogue(s, d).where("id % 3 = 1 and brand <> 'Brand#5'").withColumns({"brand": F.upper("brand"), "product_name": F.upper("product_name")})
    return m.catalogue_overlap(feed(s, d), known, "brand", "product_name", "id", F.col("kcal").isNull())


@query("d10_precision", "SELECT tier, count(*) AS n, count(*) FILTER (q = 1) AS n_right, round(count(*) FILTER (q = 1) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS precision FROM (SELECT doc_id, tier FROM (SELECT doc_id, CASE WHEN n_chars > 2000 THEN 'auto' ELSE 'review' END AS tier FROM documents) ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 200) JOIN (SELECT doc_id, quality AS q FROM labels) USING (doc_id) GROUP BY tier")
def d10(s, d):
    rows = table(s, d, "documents").select("doc_id", F.when(F.col("n_chars") > 2000, "auto").otherwise("review").alias("tier"))
    labels = table(s, d, "labels").select("doc_id", (F.col("quality") == 1).alias("right"))
    return m.match_precision(rows, labels, "doc_id", 200)


@query("d11_benchmark", sql("""SELECT count(*) AS matched, count(*) FILTER (form = theirs) AS agreed, round(count(*) FILTER (form = theirs) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS accuracy FROM (SELECT a.form, coalesce(x.form, y.form) AS theirs FROM catalogue a LEFT JOIN (SELECT brand || '|' || product_name AS k, min(form) AS form FROM ref GROUP BY 1) x ON a.brand || '|' || a.product_name = x.k
LEFT JOIN (SELECT brand || '|' || replace(product_name, 'super ', '') AS k, min(form) AS form FROM ref GROUP BY 1) y ON a.brand || '|' || replace(a.product_name, 'super ', '') = y.k) WHERE theirs IS NOT NULL""", C, REF))
def d11(s, d):
    mark = lambda x: x.withColumns({"k1": F.concat_ws("|", "brand", "product_name"), "k2": F.concat_ws("|", "brand", F.replace("product_name", F.lit("super "), F.lit("")))})
    return m.benchmark_accuracy(mark(catalogue(s, d)), mark(ref(s, d)), ["k1", "k2"], "form")


@query("d11_mismatches", sql("""SELECT id, CASE WHEN t1 IS NOT NULL THEN 'k1' ELSE 'k2' END AS by, form AS ours, coalesce(t1, t2) AS theirs FROM (SELECT a.id, a.form, x.form AS t1, y.form AS t2 FROM catalogue a LEFT JOIN (SELECT brand || '|' || product_name AS k, min(form) AS form FROM ref GROUP BY 1) x ON a.brand || '|' || a.product_name = x.k
LEFT JOIN (SELECT brand || '|' || replace(product_name, 'super ', '') AS k, min(form) AS form FROM ref GROUP BY 1) y ON a.brand || '|' || replace(a.product_name, 'super ', '') = y.k) WHERE coalesce(t1, t2) IS NOT NULL AND form <> coalesce(t1, t2)""", C, REF))
def d11b(s, d):
    mark = lambda x: x.withColumns({"k1": F.concat_ws("|", "brand", "product_name"), "k2": F.concat_ws("|", "brand", F.replace("product_name", F.lit("super "), F.lit("")))})
    return m.benchmark_mismatches(mark(catalogue(s, d)), mark(ref(s, d)), ["k1", "k2"], "form", "id")


KEY = "lower(brand) || '|' || product_name"
SCORE = "(CASE WHEN kcal IS NOT NULL THEN 3 ELSE 0 END + CASE WHEN protein IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN life_stage IS NOT NULL THEN 1 ELSE 0 END)"
WEIGHTS = {"kcal": 3, "protein": 2, "life_stage": 1}
RANKED = f"ranked AS (SELECT *, {KEY} AS k, row_number() OVER (PARTITION BY {KEY} ORDER BY {SCORE} DESC, id) AS n FROM catalogue)"


def key():
    return F.concat_ws("|", F.lower("brand"), "product_name")


@query("e1_duplicate_groups", sql(f"SELECT {KEY} AS key, count(*) AS n, min(id) AS first_id FROM catalogue GROUP BY 1 HAVING count(*) > 1", C))
def e1(s, d):
    return v.duplicate_groups(catalogue(s, d), key(), "id")


@query("e2_merge_duplicates", sql("SELECT arg_min(id, n) AS id, arg_min(kcal, n) FILTER (kcal IS NOT NULL) AS kcal, arg_min(protein, n) FILTER (protein IS NOT NULL) AS protein, count(*) AS n_merged FROM ranked GROUP BY k", C, RANKED))
def e2(s, d):
    return v.merge_duplicates(catalogue(s, d), key(), "id", WEIGHTS, ["kcal", "protein"])[0].select("id", "kcal", "protein", "n_merged")


@query("e2_merge_log", sql("""SELECT w.id, 'kcal' AS field, x.from_id FROM ranked w JOIN (SELECT k, arg_min(id, n) AS from_id FROM ranked WHERE kcal IS NOT NULL GROUP BY k) x ON w.k = x.k WHERE w.n = 1 AND w.kcal IS NULL
UNION ALL SELECT w.id, 'protein', x.from_id FROM ranked w JOIN (SELECT k, arg_min(id, n) AS from_id FROM ranked WHERE protein IS NOT NULL GROUP BY k) x ON w.k = x.k WHERE w.n = 1 AND w.protein IS NULL""", C, RANKED))
def e2b(s, d):
    return v.merge_duplicates(catalogue(s, d), key(), "id", WEIGHTS, ["kcal", "protein"])[1]


@query("e3_keep_best", sql(f"SELECT brand, id FROM (SELECT brand, id, row_number() OVER (PARTITION BY brand ORDER BY {SCORE} DESC, -size, id) AS n FROM catalogue) WHERE n = 1", C))
def e3(s, d):
    return v.keep_best(catalogue(s, d), ["brand"], WEIGHTS, F.struct(-F.col("size"), F.col("id"))).select("brand", "id")


@query("e4_suspicious", sql("SELECT id, CASE WHEN id % 10 = 0 THEN 'name is brand' WHEN length(product_name) < 8 THEN 'too short' WHEN product_name IN ('large anvil') THEN 'generic' END AS reason, CASE WHEN id % 10 = 0 THEN 'delete' WHEN length(product_name) < 8 OR product_name IN ('large anvil') THEN 'review' ELSE 'keep' END AS decision FROM catalogue", C))
def e4(s, d):
    rows = catalogue(s, d).withColumn("product_name", F.when(F.col("id") % 10 == 0, F.upper("brand")).otherwise(F.col("product_name")))
    return v.flag_suspicious(rows, "product_name", "brand", ["large anvil"]).select("id", "reason", "decision")


SIZED = "sized AS (SELECT *, CASE id % 4 WHEN 0 THEN product_name || ' ' || size || 'kg' WHEN 1 THEN product_name || ' 6 x ' || size || '00g' WHEN 2 THEN product_name || ' pack of 4' ELSE product_name END AS sized_name, CASE id % 4 WHEN 0 THEN 'size' WHEN 1 THEN 'size_and_pack' WHEN 2 THEN 'pack' END AS kind FROM catalogue)"


def sized(s, d):
    i, n, z = F.col("id") % 4, F.col("product_name"), F.col("size").cast("string")
    return catalogue(s, d).withColumn("sized_name", F.when(i == 0, F.concat(n, F.lit(" "), z, F.lit("kg"))).when(i == 1, F.concat(n, F.lit(" 6 x "), z, F.lit("00g"))).when(i == 2, F.concat(n, F.lit(" pack of 4"))).otherwise(n))


@query("e5_variant_groups", sql("SELECT brand, product_name AS base, count(*) AS n, count(kind) AS n_variants, min(id) AS first_id FROM sized GROUP BY 1, 2 HAVING count(*) > 1 AND count(kind) > 0", C, SIZED))
def e5(s, d):
    return v.variant_groups(sized(s, d), "sized_name", "brand", "id")


@query("e6_variant_type", sql("SELECT id, kind FROM sized", C, SIZED))
def e6(s, d):
    return sized(s, d).select("id", v.variant_type(F.col("sized_name")).alias("kind"))


@query("e7_pick_parent", sql(f"SELECT brand, product_name, id FROM (SELECT brand, product_name, id, row_number() OVER (PARTITION BY brand, product_name ORDER BY round(length(sized_name) * 0.01::DOUBLE - {SCORE}, 6), id) AS n FROM sized) WHERE n = 1", C, SIZED))
def e7(s, d):
    return v.pick_parent(sized(s, d), ["brand", "product_name"], WEIGHTS, "sized_name", "id").select("brand", "product_name", "id")


@query("e8_consistency", sql("SELECT brand, product_name, count(*) AS n, count(DISTINCT kcal) AS n_kcal, count(DISTINCT form) AS n_form, count(DISTINCT kcal) <= 1 AND count(DISTINCT form) <= 1 AS consistent FROM catalogue GROUP BY 1, 2", C))
def e8(s, d):
    return v.group_consistency(catalogue(s, d), ["brand", "product_name"], ["kcal", "form"])


def migrated(s, d):
    return v.migrate_variants(sized(s, d), key(), "id", WEIGHTS, ["kcal", "protein"], "sized_name")


@query("e9_migrate_variants", sql("SELECT p.id AS parent_id, w.id AS variant_id, s.kind FROM ranked w JOIN ranked p ON w.k = p.k AND p.n = 1 AND w.n > 1 JOIN sized s ON s.id = w.id", C, SIZED, RANKED))
def e9(s, d):
    return migrated(s, d)[1].drop("original")


@query("e10_rollup", sql("SELECT brand, product_name, count(*) AS n, min(price) AS min_price, max(price) AS max_price, max(size) AS best_rating, list_sort(list(price))[(count(*) // 2) + 1] AS median_price, array_to_string(list_sort(list(DISTINCT size)), ',') AS sizes FROM catalogue GROUP BY 1, 2", C))
def e10(s, d):
    got = v.rollup_variants(catalogue(s, d), ["brand", "product_name"], "size", "price", "size")
    return got.withColumn("sizes", F.array_join(F.transform("sizes", lambda x: x.cast("string")), ","))


@query("e11_conservation", sql("""SELECT unnest(['before', 'parents', 'variants', 'lost', 'doubled']) AS metric, unnest([before, parents, variants, lost, doubled]) AS value, unnest([true, true, parents + variants = before, lost = 0, doubled = 0]) AS passed
FROM (SELECT (SELECT count(*) FROM catalogue) AS before, (SELECT count(*) FROM up) AS parents, (SELECT count(*) FROM down) AS variants, (SELECT count(*) FROM catalogue WHERE id NOT IN (SELECT id FROM up UNION ALL SELECT id FROM down)) AS lost,
  (SELECT count(*) FROM (SELECT id FROM (SELECT id FROM up UNION ALL SELECT id FROM down) GROUP BY id HAVING count(*) > 1)) AS doubled)""", C, RANKED, "up AS (SELECT arg_min(id, n) AS id FROM ranked GROUP BY k), down AS (SELECT w.id FROM ranked w JOIN up ON w.k = (SELECT k FROM ranked r WHERE r.id = up.id) AND w.id <> up.id)"))
def e11(s, d):
    parents, variants, _ = migrated(s, d)
    return v.verify_conservation(sized(s, d), parents, variants, "id")


@query("e12_variant_summary", sql("SELECT arg_min(id, n) AS parent_id, count(*) - 1 AS n_variants, count(*) > 1 AS has_variants, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (n > 1) AS variant_ids FROM ranked GROUP BY k", C, RANKED))
def e12(s, d):
    parents, variants, _ = migrated(s, d)
    return v.variant_summary(parents, variants, "id")


@query("e13_one_per_url", r"""SELECT u AS base_url, count(*) AS n, arg_min(page_id, (p IS NULL, page_id)) AS id, arg_min(coalesce(p, -1), (p IS NULL, page_id)) AS value FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^[a-z]+://(www\.)?', ''), '[?#].*$', ''), '/[0-9]+/*$', ''), '/+$', '') AS u, CASE WHEN page_id % 3 = 1 THEN page_id END AS p FROM pages) GROUP BY 1""")
def e13(s, d):
    rows = table(s, d, "pages").withColumn("p", F.when(F.col("page_id") % 3 == 1, F.col("page_id")))
    return v.one_per_url(rows, t.normalize_url(F.col("url")), "p", "page_id").withColumn("value", F.coalesce("value", F.lit(-1)))
