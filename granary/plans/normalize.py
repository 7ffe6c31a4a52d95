"""Queries of the scalar transforms, over texts made from the driver's columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import parse as p
from granary.functions import text as t
from granary.operators import rules as o

from .registry import CATALOGUE, catalogue, query, sql, table

C = CATALOGUE


def q(*parts):
    return F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in (y.cast("string") if not isinstance(y, str) else y for y in parts)])


@query("n1_slug_us", sql("SELECT id, replace(lower(trim('  ' || product_name || ' X')), ' ', '_') AS slug FROM catalogue", C))
def n1(s, d):
    return catalogue(s, d).select("id", t.slug_us(q("  ", F.col("product_name"), " X")).alias("slug"))


@query("n2_slug_hy", sql("SELECT id, trim(regexp_replace(lower(brand || ' / ' || product_name || '!'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM catalogue", C))
def n2(s, d):
    return catalogue(s, d).select("id", t.slug_hy(q(F.col("brand"), " / ", F.col("product_name"), "!")).alias("slug"))


@query("n3_make_key", sql("""SELECT id, k AS plain, left(md5(k), 16) AS hashed, b || '_' || left(md5(k), 6) AS prefixed FROM (
  SELECT id, replace(lower(trim(brand)), ' ', '_') AS b, replace(lower(trim(brand)), ' ', '_') || '|' || replace(lower(trim(product_name)), ' ', '_') || '|' || coalesce(life_stage, 'unknown') AS k FROM catalogue)""", C))
def n3(s, d):
    cols = [F.col("brand"), F.col("product_name"), F.col("life_stage")]
    return catalogue(s, d).select("id", t.make_key(cols).alias("plain"), t.make_key(cols, "hash").alias("hashed"), t.make_key(cols, "prefixed", digits=6).alias("prefixed"))


@query("n4_fingerprint", sql("SELECT id, md5(lower(trim(brand)) || '|' || lower(trim(product_name)) || '|' || lower(trim(coalesce(life_stage, '')))) AS fp FROM catalogue", C))
def n4(s, d):
    return catalogue(s, d).select("id", t.fingerprint([F.col("brand"), F.col("product_name"), F.col("life_stage")]).alias("fp"))


@query("n5_clean_text", r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[^A-Za-z0-9 .,%&+-]', ' ', 'g'), ' +', ' ', 'g'))) AS cleaned FROM documents")
def n5(s, d):
    return table(s, d, "documents").select("doc_id", F.md5(t.clean_text(F.col("text"))).alias("cleaned"))


@query("n6_match_name", sql(r"""SELECT id, array_to_string(list_filter(string_split_regex(regexp_replace(regexp_replace(CASE WHEN starts_with(x, b || ' ') THEN substring(x, length(b) + 2) ELSE x END, '([0-9]+ *x *)?[0-9]+([.,][0-9]+)? *(kg|g|lb|oz|ml|l)\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' +'), lambda w: w <> '' AND w NOT IN ('new', 'the')), ' ') AS name
FROM (SELECT id, lower(trim(brand)) AS b, lower(trim(brand || ' ' || product_name || ' 12 x 400g')) AS x FROM catalogue)""", C))
def n6(s, d):
    return catalogue(s, d).select("id", t.match_name(q(F.col("brand"), " ", F.col("product_name"), " 12 x 400g"), F.col("brand"), ["new", "the"]).alias("name"))


@query("n7_tokenize", sql(r"""SELECT id, array_to_string(list_filter(list_transform(string_split_regex(lower('Meat (dried 4%), ' || product_name || ' 26%; Rice'), '[,;|]'), lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: length(x) >= 1), '/') AS plain,
  array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(lower('Meat (dried 4%), ' || product_name || ' 26%; Rice'), '\([^)]*\)', ' ', 'g'), '[0-9]+([.,][0-9]+)? *%?', ' ', 'g'), '[,;|]'), lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: length(x) >= 1), '/') AS bare FROM catalogue""", C))
def n7(s, d):
    text = q("Meat (dried 4%), ", F.col("product_name"), " 26%; Rice")
    return catalogue(s, d).select("id", F.array_join(t.tokenize(text), "/").alias("plain"), F.array_join(t.tokenize(text, drop_parens=True, strip_digits=True), "/").alias("bare"))


@query("n8_norm_tokens", sql("SELECT id, array_to_string(list_filter([lower(trim(form)), CASE WHEN lower(trim(product_name)) <> lower(trim(form)) THEN lower(trim(product_name)) END], lambda x: x IS NOT NULL), '/') AS tokens FROM catalogue", C))
def n8(s, d):
    return catalogue(s, d).select("id", F.array_join(t.norm_tokens(F.array(F.upper("form"), q(" ", F.col("product_name"), " "), F.col("product_name"), F.lit(""))), "/").alias("tokens"))


@query("n9_canonical_tokens", sql("""SELECT id, string_agg(coalesce(m.v, w), '/' ORDER BY i) AS tokens FROM (SELECT id, unnest(string_split(product_name, ' ')) AS w, generate_subscripts(string_split(product_name, ' '), 1) AS i FROM catalogue) LEFT JOIN (SELECT * FROM (VALUES ('red', 'colour'), ('blue', 'colour'), ('gizmo', 'gadget')) v(k, v)) m ON w = m.k GROUP BY id""", C))
def n9(s, d):
    rules = s.createDataFrame([("red", "colour"), ("blue", "colour"), ("gizmo", "gadget")], "token string, canonical string")
    got = o.canonical_tokens(catalogue(s, d).select("id", F.split("product_name", " ").alias("tokens")), "id", "tokens", rules)
    return got.select("id", F.array_join("tokens", "/").alias("tokens"))


@query("n10_tokens_any", sql("SELECT id, list_contains(string_split(product_name, ' '), 'ring') AS equal, len(list_filter(string_split(product_name, ' '), lambda x: starts_with(x, 'bl'))) > 0 AS prefix, len(list_filter(string_split(product_name, ' '), lambda x: contains(x, 'i'))) > 0 AS within FROM catalogue", C))
def n10(s, d):
    arr = F.split("product_name", " ")
    return catalogue(s, d).select("id", t.tokens_any(arr, ["ring"]).alias("equal"), t.tokens_any(arr, ["bl"], "prefix").alias("prefix"), t.tokens_any(arr, ["i"], "contains").alias("within"))


@query("n11_token_groups", sql("""SELECT id, coalesce(string_agg(DISTINCT g, ',' ORDER BY g), '') AS groups FROM catalogue LEFT JOIN (SELECT * FROM (VALUES ('metal', 'bolt'), ('metal', 'gear'), ('warm', 'red'), ('warm', 'hot'), ('round', 'ring')) v(g, k)) m ON list_contains(string_split(product_name, ' '), m.k) GROUP BY id""", C))
def n11(s, d):
    rules = s.createDataFrame([("metal", "bolt"), ("metal", "gear"), ("warm", "red"), ("warm", "hot"), ("round", "ring")], "grp string, token string")
    return o.token_groups(catalogue(s, d).select("id", F.split("product_name", " ").alias("tokens")), "id", "tokens", rules).select("id", F.array_join("groups", ",").alias("groups"))


@query("n12_first_keyword", sql("SELECT id, CASE WHEN contains(product_name, 'bolt') THEN 'bolt' WHEN contains(product_name, 'red') THEN 'red' WHEN contains(product_name, 'o') THEN 'o' END AS word FROM catalogue", C))
def n12(s, d):
    return catalogue(s, d).select("id", t.first_keyword(F.upper("product_name"), ["bolt", "red", "o"]).alias("word"))


@query("n13_parse_percent", sql("SELECT id, CASE WHEN size * 3 + 0.5 <= 100 THEN CAST(size * 3 + 0.5 AS DOUBLE) END AS pct FROM catalogue", C))
def n13(s, d):
    return catalogue(s, d).select("id", p.parse_percent(q("crude ", F.col("size") * 3, ",5 %")).alias("pct"))


@query("n14_parse_energy", sql("SELECT id, round(CASE id % 3 WHEN 0 THEN size * 30 / 4.184::DOUBLE WHEN 1 THEN (size * 30)::DOUBLE ELSE size * 30 / 10.0::DOUBLE END, 6) AS kcal FROM catalogue", C))
def n14(s, d):
    unit = F.when(F.col("id") % 3 == 0, " kJ/100g").when(F.col("id") % 3 == 1, " kcal/100g").otherwise(" kcal per kg")
    return catalogue(s, d).select("id", F.round(p.parse_energy(q(F.col("size") * 30, unit)), 6).alias("kcal"))


@query("n15_parse_weight", sql("SELECT id, round(CASE id % 4 WHEN 0 THEN 12 * size * 0.001::DOUBLE WHEN 1 THEN size + 0.5::DOUBLE WHEN 2 THEN size * 0.45359237::DOUBLE ELSE NULL END, 9) AS kg FROM catalogue", C))
def n15(s, d):
    text = F.when(F.col("id") % 4 == 0, q("tin 12 x ", F.col("size"), "g")).when(F.col("id") % 4 == 1, q(F.col("size"), ",5 kg bag")).when(F.col("id") % 4 == 2, q(F.col("size"), " lb")).otherwise(q(F.col("size"), " pieces"))
    return catalogue(s, d).select("id", F.round(p.parse_weight_kg(text), 9).alias("kg"))


@query("n16_pack_sizes", sql("SELECT id, size || 'kg/' || size || '.5l/400g' AS packs FROM catalogue", C))
def n16(s, d):
    return catalogue(s, d).select("id", F.array_join(p.pack_sizes(q(F.col("size"), " KG or ", F.col("size"), ",5l, 6 x 400g")), "/").alias("packs"))


@query("n17_money", sql("SELECT id, round((1000 + size + 0.25) * CASE id % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE END, 4) AS base FROM catalogue", C))
def n17(s, d):
    text = q(F.when(F.col("id") % 3 == 0, "€").when(F.col("id") % 3 == 1, "$").otherwise("£"), "1,", F.lpad((F.col("size")).cast("string"), 3, "0"), ".25")
    rates = s.createDataFrame([("EUR", 1.0), ("USD", 0.5)], "currency string, rate double")
    priced = catalogue(s, d).select("id", p.parse_money(text).alias("price"), p.currency_of(text, {"€": "EUR", "$": "USD", "£": "GBP"}, "EUR").alias("currency"))
    return o.to_base_currency(priced, "price", "currency", rates).select("id", F.round("base", 4).alias("base"))


@query("n18_unit_price", sql("SELECT id, round(price / size, 6) AS first_price, round(price / ((size + 0.4::DOUBLE) / 2), 6) AS mean_price FROM catalogue", C))
def n18(s, d):
    sizes = F.array(q(F.col("size"), "kg"), F.lit("400g"))
    return catalogue(s, d).select("id", F.round(p.unit_price(F.col("price"), sizes), 6).alias("first_price"), F.round(p.unit_price(F.col("price"), sizes, "mean"), 6).alias("mean_price"))


@query("n19_bucket", sql("SELECT id, CASE WHEN kcal IS NULL THEN 'unknown' WHEN kcal <= 300 THEN 'low' WHEN kcal <= 400 THEN 'mid' ELSE 'high' END AS bucket FROM catalogue", C))
def n19(s, d):
    return catalogue(s, d).select("id", p.bucket(F.col("kcal"), [(300, "low"), (400, "mid")], "high", "unknown").alias("bucket"))


@query("n20_estimate_energy", sql("SELECT id, round(protein * 3.5::DOUBLE + fat * 8.5::DOUBLE + greatest(0.0::DOUBLE, 100 - protein - fat - 0 - 8 - 10) * 3.5::DOUBLE, 6) AS kcal FROM catalogue", C))
def n20(s, d):
    none = F.lit(None).cast("double")
    return catalogue(s, d).select("id", F.round(p.estimate_energy(F.col("protein"), F.col("fat"), none, none, none), 6).alias("kcal"))


@query("n21_map_vocab", sql("SELECT id, CASE WHEN product_name = 'old rod' THEN 'antique' WHEN contains(product_name, 'rod') THEN 'stick' WHEN contains(product_name, 'old') THEN 'aged' END AS value FROM catalogue", C))
def n21(s, d):
    rules = s.createDataFrame([(1, "old rod", "antique", True), (2, "rod", "stick", False), (3, "old", "aged", False)], "ord int, pattern string, value string, exact boolean")
    return o.map_vocab(catalogue(s, d).select("id", "product_name"), "id", "product_name", rules).select("id", "value")


@query("n22_parse_range", sql("SELECT id, round(CASE WHEN id % 3 = 2 THEN size * 0.9::DOUBLE ELSE size::DOUBLE END, 6) AS low, round(CASE WHEN id % 3 = 2 THEN size * 1.1::DOUBLE ELSE size + 2::DOUBLE END, 6) AS high FROM catalogue", C))
def n22(s, d):
    text = F.when(F.col("id") % 3 == 0, q(F.col("size"), "-", F.col("size") + 2, " years")).when(F.col("id") % 3 == 1, q(F.col("size"), " to ", F.col("size") + 2, " kg")).otherwise(q("about ", F.col("size")))
    got = p.parse_range(text, spread=0.1)
    return catalogue(s, d).select("id", F.round(got["low"], 6).alias("low"), F.round(got["high"], 6).alias("high"))


@query("n23_ordinal", sql("SELECT id, CASE WHEN contains(product_name, 'cold') THEN 1 WHEN contains(product_name, 'old') THEN 2 WHEN contains(product_name, 'hot') THEN 5 END AS n FROM catalogue", C))
def n23(s, d):
    return catalogue(s, d).select("id", p.ordinal(F.col("product_name"), [("cold", 1), ("old", 2), ("hot", 5)]).alias("n"))


@query("n24_size_from_weight", sql("SELECT id, CASE WHEN kcal < 300 THEN 'S' WHEN kcal < 400 THEN 'M' WHEN kcal IS NOT NULL THEN 'L' END AS size_class, CASE WHEN kcal < 300 THEN 10 WHEN kcal < 400 THEN 12 WHEN kcal IS NOT NULL THEN 18 END AS months FROM catalogue", C))
def n24(s, d):
    k = F.col("kcal")
    return catalogue(s, d).select("id", p.step(k, [(300, "S"), (400, "M")], "L").alias("size_class"), p.step(k, [(300, 10), (400, 12)], 18).alias("months"))


@query("n25_label", sql("SELECT id, CASE form WHEN 'promo' THEN 'Promotion' WHEN 'economy' THEN 'Economy class' ELSE form END AS label FROM catalogue", C))
def n25(s, d):
    return catalogue(s, d).select("id", t.label(F.col("form"), {"promo": "Promotion", "economy": "Economy class"}).alias("label"))


@query("n26_word_count", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INT) AS words FROM documents")
def n26(s, d):
    return table(s, d, "documents").select("doc_id", t.word_count(F.col("text")).alias("words"))


@query("n27_normalize_url", r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^[a-z]+://(www\.)?', ''), '[?#].*$', ''), '/[0-9]+/*$', ''), '/+$', '') AS url FROM pages")
def n27(s, d):
    return table(s, d, "pages").select("page_id", t.normalize_url(F.col("url")).alias("url"))


@query("n28_url_flags", r"SELECT page_id, regexp_matches(regexp_replace(regexp_replace(lower(url), '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '(^|[/_.-])fr([/_.-]|$)') AS fr, regexp_matches(regexp_replace(regexp_replace(lower(url), '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '(^|[/_.-])en([/_.-]|$)') AS en FROM pages")
def n28(s, d):
    return table(s, d, "pages").select("page_id", *[c.alias(n) for n, c in t.url_flags(F.col("url"), ["fr", "en"]).items()])


@query("n29_extract_code", sql(r"SELECT id, CASE id % 3 WHEN 0 THEN lpad(CAST(id AS VARCHAR), 13, '4') WHEN 1 THEN lpad(CAST(id AS VARCHAR), 8, '2') END AS code FROM catalogue", C))
def n29(s, d):
    text = F.when(F.col("id") % 3 == 0, q("ean ", F.lpad(F.col("id").cast("string"), 13, "4"), ".")).when(F.col("id") % 3 == 1, q(F.lpad(F.col("id").cast("string"), 8, "2"), " code")).otherwise(q("no ", F.col("id")))
    return catalogue(s, d).select("id", t.extract_code(text).alias("code"))


@query("n30_guess_lang", "SELECT doc_id, CASE WHEN regexp_matches(' ' || lower(text) || ' ', ' (the|and|of) ') THEN 'en' WHEN regexp_matches(' ' || lower(text) || ' ', ' (der|und|die) ') THEN 'de' WHEN regexp_matches(' ' || lower(text) || ' ', ' (le|les|et) ') THEN 'fr' WHEN regexp_matches(' ' || lower(text) || ' ', ' (el|los|que) ') THEN 'es' END AS lang FROM documents")
def n30(s, d):
    return table(s, d, "documents").select("doc_id", t.guess_lang(F.col("text"), {"en": ["the", "and", "of"], "de": ["der", "und", "die"], "fr": ["le", "les", "et"], "es": ["el", "los", "que"]}).alias("lang"))


@query("n31_json_get", "SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), 'none') AS k, CAST(event_id AS VARCHAR) || '/x' AS labels FROM events")
def n31(s, d):
    made = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("event_id").cast("string").alias("label")), F.struct(F.lit("x").alias("label"))).alias("items")).alias("data")))
    return table(s, d, "events").select("event_id", p.json_get(F.col("props"), ["missing", "k"], "none").alias("k"), F.array_join(p.json_collect(made, "data.items", "label"), "/").alias("labels"))


@query("n32_casts", sql("SELECT id, CASE WHEN id % 2 = 0 THEN size + 0.5::DOUBLE END AS d, CASE WHEN id % 2 = 0 THEN size END AS i, CASE id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b FROM catalogue", C))
def n32(s, d):
    text = F.when(F.col("id") % 2 == 0, q(" ", F.col("size"), ",5")).otherwise(F.lit("n/a"))
    flag = F.when(F.col("id") % 3 == 0, "Yes").when(F.col("id") % 3 == 1, "off").otherwise("maybe")
    return catalogue(s, d).select("id", p.to_double(text).alias("d"), p.to_int(text).alias("i"), p.to_bool(flag).alias("b"))


@query("n33_parse_block", sql("SELECT id, product_name AS name, CASE WHEN id % 2 = 0 THEN form END AS form FROM catalogue", C))
def n33(s, d):
    text = q("Brand: x; Name : ", F.col("product_name"), "\n", F.when(F.col("id") % 2 == 0, q("FORM:", F.col("form"), ";")).otherwise(F.lit("Other: 1")))
    got = p.parse_block(text, ["Name", "Form"])
    return catalogue(s, d).select("id", got["Name"].alias("name"), got["Form"].alias("form"))


@query("n34_repair_array", sql("SELECT id, CASE WHEN id % 3 = 0 THEN 0 ELSE 2 END AS n FROM catalogue", C))
def n34(s, d):
    text = F.when(F.col("id") % 3 == 0, F.lit("[broken")).otherwise(q('["', F.col("product_name"), '","b"]'))
    return catalogue(s, d).select("id", F.size(p.repair_array(text)).alias("n"))
