"""Queries of ingest, sources and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary import sources, streaming
from granary.operators import ingest as g
from granary.operators.variants import variant_type

from .registry import ALLOW, CATALOGUE, FEED, SQL, allowlist, catalogue, feed, query, sql, table

C = CATALOGUE


def stored(s, d):
    e = table(s, d, "events").where("event_id % 3 = 0").withColumn("k", F.concat_ws("/", F.col("user_id").cast("string"), "event_type"))
    return e.groupBy("k").agg(F.max_by(F.col("props"), "event_id").alias("fingerprint"), F.min("event_id").alias("first_seen"), F.max("event_id").alias("last_seen"))


def incoming(s, d):
    e = table(s, d, "events").withColumn("k", F.concat_ws("/", F.col("user_id").cast("string"), "event_type"))
    return e.groupBy("k").agg(F.max_by("props", "event_id").alias("fingerprint"), F.max("event_id").alias("seen"))


@query("h1_detect_changes", """WITH e AS (SELECT *, CAST(user_id AS VARCHAR) || '/' || event_type AS k FROM events), c AS (SELECT k, arg_max(props, event_id) AS f, min(event_id) AS a, max(event_id) AS b FROM e WHERE event_id % 3 = 0 GROUP BY k), n AS (SELECT k, arg_max(props, event_id) AS f, max(event_id) AS s FROM e GROUP BY k)
SELECT k, fingerprint, coalesce(a, s) AS first_seen, CASE WHEN act IN ('new', 'updated') THEN s ELSE b END AS last_seen, act AS action FROM (SELECT coalesce(c.k, n.k) AS k, a, b, s, CASE WHEN b IS NULL THEN 'new' WHEN s <= b THEN 'skipped' WHEN c.f <> n.f THEN 'updated' ELSE 'skipped' END AS act, CASE WHEN b IS NULL OR (s > b AND c.f <> n.f) THEN n.f ELSE c.f END AS fingerprint FROM c FULL JOIN n ON c.k = n.k)""")
def h1(s, d):
    return g.detect_changes(stored(s, d), incoming(s, d), "k")


#: Staged rows: keys of the catalogue, keys that only match by brand and name, new ones; some twice.
STAGED = """staged AS (SELECT CASE WHEN id % 3 = 0 THEN id WHEN id % 3 = 1 THEN id + 5000000 ELSE id + 9000000 END AS id, brand, CASE WHEN id % 3 = 2 THEN product_name || ' plus' ELSE product_name || CASE WHEN id % 3 = 1 THEN '' ELSE '' END END AS product_name, CASE WHEN r = 0 THEN NULL ELSE size * 10.0::DOUBLE + r END AS kcal, id * 2 + r AS ord
  FROM catalogue, (SELECT unnest([0, 1]) AS r) WHERE id % 5 = 0)"""
CANON = "canon AS (SELECT min(id) AS id, brand, product_name, min(kcal) FILTER (id % 2 = 0) AS kcal FROM catalogue GROUP BY brand, product_name)"


def staged(s, d):
    rows = catalogue(s, d).where("id % 5 = 0").withColumn("r", F.explode(F.array(F.lit(0), F.lit(1))))
    i = F.col("id") % 3
    return rows.select(F.when(i == 0, F.col("id")).when(i == 1, F.col("id") + 5_000_000).otherwise(F.col("id") + 9_000_000).alias("id"), "brand", F.when(i == 2, F.concat("product_name", F.lit(" plus"))).otherwise(F.col("product_name")).alias("product_name"), F.when(F.col("r") == 1, F.col("size") * 10.0 + 1).alias("kcal"), (F.col("id") * 2 + F.col("r")).alias("ord"))


def canon(s, d):
    return catalogue(s, d).groupBy("brand", "product_name").agg(F.min("id").alias("id"), F.min(F.when(F.col("id") % 2 == 0, F.col("kcal"))).alias("kcal")).select("id", "brand", "product_name", "kcal")


MERGE = """one AS (SELECT id, arg_min(brand, ord) AS brand, arg_min(product_name, ord) AS product_name, arg_min(kcal, ord) FILTER (kcal IS NOT NULL) AS kcal FROM staged GROUP BY id),
known AS (SELECT * FROM one WHERE id IN (SELECT id FROM canon)), rest AS (SELECT * FROM one WHERE id NOT IN (SELECT id FROM canon)),
free AS (SELECT brand, product_name, min(id) AS target FROM canon WHERE id NOT IN (SELECT id FROM known) GROUP BY 1, 2),
rekey AS (SELECT r.*, f.target FROM rest r JOIN free f USING (brand, product_name) JOIN (SELECT f.target, min(r.id) AS id FROM rest r JOIN free f USING (brand, product_name) GROUP BY 1) t ON t.target = f.target AND t.id = r.id),
lefts AS (SELECT * FROM rest WHERE id NOT IN (SELECT id FROM rekey)), ins AS (SELECT * FROM lefts WHERE brand IN (SELECT brand FROM allowlist WHERE status IN ('ACTIVE', 'PENDING')))"""


@query("h2_merge_staged", sql("""SELECT coalesce(k.id, r.id, c.id) AS id, c.brand, c.product_name, coalesce(c.kcal, k.kcal, r.kcal) AS kcal FROM canon c LEFT JOIN known k ON c.id = k.id LEFT JOIN rekey r ON c.id = r.target UNION ALL SELECT id, brand, product_name, kcal FROM ins""", C, ALLOW, STAGED, CANON, MERGE))
def h2(s, d):
    return g.merge_staged(canon(s, d), staged(s, d), allowlist(s, d), "id", ["brand", "product_name"], ["kcal"], ["ord"])[0]


@query("t2_merge_stream", SQL["h2_merge_staged"])
def t2(s, d):
    """The staged rows as a stream of one micro-batch, merged into the stored table."""
    path = sources.scratch(s, "t2")
    sources.write(canon(s, d), f"{path}/table")
    sources.write(staged(s, d), f"{path}/in")
    stream = s.readStream.schema(s.read.parquet(f"{path}/in").schema).parquet(f"{path}/in")
    streaming.merge_stream(stream, f"{path}/table", allowlist(s, d), "id", ["brand", "product_name"], ["kcal"], ["ord"])(f"{path}/checkpoint").awaitTermination()
    return sources.current(s, f"{path}/table")


@query("t2_merge_twice", SQL["h2_merge_staged"])
def t2b(s, d):
    """The staged rows in two micro-batches, the second a repeat of the first, which is then run
    again under its number, as after a crash: the table is that of one merge."""
    path = sources.scratch(s, "t2")
    sources.write(canon(s, d), f"{path}/table")
    for _ in range(2):
        sources.write(staged(s, d).coalesce(1), f"{path}/in", "append")
    schema = s.read.parquet(f"{path}/in").schema
    stream = s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    how = (f"{path}/table", allowlist(s, d), "id", ["brand", "product_name"], ["kcal"], ["ord"])
    streaming.merge_stream(stream, *how)(f"{path}/checkpoint").awaitTermination()
    streaming.merge_batch(*how)(s.read.parquet(f"{path}/in"), sources.batches_done(s, f"{path}/table")["merge"])
    return sources.current(s, f"{path}/table")


@query("t1_snapshot_stream", SQL["h1_detect_changes"].replace(", act AS action FROM", " FROM"))
def t1b(s, d):
    """The incoming snapshots as a stream, merged into the stored table."""
    path = sources.scratch(s, "t1")
    sources.write(stored(s, d), f"{path}/table")
    sources.write(incoming(s, d), f"{path}/in")
    stream = s.readStream.schema(s.read.parquet(f"{path}/in").schema).parquet(f"{path}/in")
    streaming.snapshot_stream(stream, f"{path}/table", "k")(f"{path}/checkpoint").awaitTermination()
    return sources.current(s, f"{path}/table")


@query("h2_summary", sql("SELECT (SELECT count(*) FROM known) AS updated, (SELECT count(*) FROM rekey) AS rekeyed, (SELECT count(*) FROM ins) AS inserted, (SELECT count(*) FROM lefts) - (SELECT count(*) FROM ins) AS skipped, 'OK' AS health", C, ALLOW, STAGED, CANON, MERGE))
def h2b(s, d):
    return g.merge_staged(canon(s, d), staged(s, d), allowlist(s, d), "id", ["brand", "product_name"], ["kcal"], ["ord"])[1]


@query("h3_residuals", sql("SELECT o.id, o.brand, CASE WHEN a.status IS NULL THEN 'not on the list' WHEN a.status IN ('ACTIVE', 'PENDING') THEN 'not merged' ELSE 'status ' || a.status END AS reason FROM (SELECT id, min(brand) AS brand FROM staged GROUP BY id) o LEFT JOIN allowlist a ON a.brand = o.brand WHERE o.id NOT IN (SELECT id FROM canon)", C, ALLOW, STAGED, CANON))
def h3(s, d):
    return g.residuals(canon(s, d), staged(s, d), allowlist(s, d), "id", ["brand", "product_name"])


@query("h4_allow_status", sql("SELECT b.brand, coalesce(status, 'NOT_FOUND') AS status FROM (SELECT DISTINCT p_brand AS brand FROM part) b LEFT JOIN allowlist a ON a.brand = b.brand", ALLOW))
def h4(s, d):
    return g.allow_status(allowlist(s, d), table(s, d, "part").select(F.col("p_brand").alias("brand")).distinct(), "brand")


@query("h5_smart_import", sql("""SELECT f.id, CASE WHEN u.t IS NOT NULL THEN 'update' WHEN b.t IS NOT NULL THEN 'variant' ELSE 'insert' END AS how, coalesce(u.t, b.t) AS target FROM (SELECT id, 'u' || ((id - 1000000) // 2) AS url, lower(product_name) AS base FROM feed) f
LEFT JOIN (SELECT 'u' || id AS url, min(id) AS t FROM catalogue WHERE id % 4 = 0 GROUP BY 1) u ON f.url = u.url LEFT JOIN (SELECT product_name AS base, min(id) AS t FROM catalogue WHERE id % 4 = 0 AND size < 3 GROUP BY 1) b ON f.base = b.base""".replace("WHERE id % 4 = 0 GROUP", "WHERE id % 4 = 0 AND size < 3 GROUP"), C, FEED))
def h5(s, d):
    have = catalogue(s, d).where("id % 4 = 0 and size < 3").select("id", F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.col("product_name").alias("base"))
    new = feed(s, d).select("id", F.concat(F.lit("u"), F.expr("cast((id - 1000000) div 2 as string)")).alias("url"), F.lower("product_name").alias("base"))
    return g.smart_import(have, new, "id", "url", "base")


IMPORT = """have AS (SELECT id, product_name, kcal, fat, day, 'u' || id AS url, product_name AS base FROM catalogue WHERE size % 2 = 0),
new AS (SELECT id, lower(product_name) || CASE (id - 1000000) // 3 % 4 WHEN 0 THEN ' 400g' WHEN 2 THEN ' extra' ELSE '' END AS product_name, kcal, fat, day, 'u' || ((id - 1000000) // 2) AS url, lower(product_name) AS base FROM feed),
met AS (SELECT n.*, coalesce(u.t, b.t) AS parent, coalesce(u.name, b.name) AS parent_name FROM new n LEFT JOIN (SELECT url, min(id) AS t, arg_min(product_name, id) AS name FROM have GROUP BY url) u ON n.url = u.url LEFT JOIN (SELECT base, min(id) AS t, arg_min(product_name, id) AS name FROM have GROUP BY base) b ON n.base = b.base),
told AS (SELECT *, CASE WHEN parent IS NOT NULL AND product_name LIKE '%400g' THEN 'variant' WHEN product_name = parent_name THEN 'duplicate' ELSE 'imported' END AS status FROM met),
fills AS (SELECT parent, arg_min(kcal, id) FILTER (kcal IS NOT NULL) AS kcal, arg_min(fat, id) FILTER (fat IS NOT NULL) AS fat, arg_min(day, id) FILTER (fat IS NOT NULL) AS day FROM told WHERE status = 'variant' GROUP BY parent)"""


def imported(s, d):
    have = catalogue(s, d).where("size % 2 = 0").select("id", "product_name", "kcal", "fat", "day", F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.col("product_name").alias("base"))
    k = F.expr("(id - 1000000) div 3 % 4")
    name = F.concat(F.lower("product_name"), F.when(k == 0, F.lit(" 400g")).when(k == 2, F.lit(" extra")).otherwise(F.lit("")))
    new = feed(s, d).select("id", name.alias("product_name"), "kcal", "fat", "day", F.concat(F.lit("u"), F.expr("cast((id - 1000000) div 2 as string)")).alias("url"), F.lower("product_name").alias("base"))
    return g.import_products(have, new, "id", "product_name", "url", "base", variant_type(F.col("product_name")).isNotNull(), [["kcal"], ["fat", "day"]])


@query("h5_catalogue", sql("SELECT h.id, h.product_name, coalesce(h.kcal, f.kcal) AS kcal, coalesce(h.fat, f.fat) AS fat, CASE WHEN h.fat IS NULL THEN coalesce(f.day, h.day) ELSE h.day END AS day FROM have h LEFT JOIN fills f ON h.id = f.parent UNION ALL SELECT id, product_name, kcal, fat, day FROM told WHERE status = 'imported'", C, FEED, IMPORT))
def h5b(s, d):
    """The catalogue after the import: parents filled from their variants, and what is new."""
    return imported(s, d)[0].select("id", "product_name", "kcal", "fat", "day")


@query("h5_variants", sql("SELECT parent AS parent_id, id, product_name, kcal FROM told WHERE status = 'variant'", C, FEED, IMPORT))
def h5c(s, d):
    return imported(s, d)[1].select("parent_id", "id", "product_name", "kcal")


@query("h5_outcomes", sql("SELECT id, status, CASE WHEN status <> 'imported' THEN parent END AS parent_id FROM told", C, FEED, IMPORT))
def h5d(s, d):
    return imported(s, d)[2]


@query("h6_upsert", sql("SELECT coalesce(c.id, f.id) AS id, coalesce(f.kcal, c.kcal) AS kcal, 'update' AS mode FROM (SELECT id, kcal FROM catalogue WHERE id % 2 = 0) c FULL JOIN (SELECT id - 1000000 AS id, kcal FROM feed) f ON c.id = f.id UNION ALL SELECT coalesce(c.id, f.id), CASE WHEN c.id IS NOT NULL THEN c.kcal ELSE f.kcal END, 'nothing' FROM (SELECT id, kcal FROM catalogue WHERE id % 2 = 0) c FULL JOIN (SELECT id - 1000000 AS id, kcal FROM feed) f ON c.id = f.id", C, FEED))
def h6(s, d):
    base, new = catalogue(s, d).where("id % 2 = 0").select("id", "kcal"), feed(s, d).select((F.col("id") - 1_000_000).alias("id"), "kcal")
    return g.upsert(base, new, "id").withColumn("mode", F.lit("update")).unionByName(g.upsert(base, new, "id", "nothing").withColumn("mode", F.lit("nothing")))


def made_pages(s, d):
    """Pages with a nutrition table, a definition list or plain text, by rule from parts."""
    c = catalogue(s, d)
    z = F.col("size").cast("string")
    rows = F.concat(F.lit("<h2>Analysis</h2><table><tr><th>Crude Protein</th><td>"), z, F.lit(",5 %</td></tr><tr><td>Fat content</td><td>12%</td></tr><tr><td>Energy</td><td>1570 kJ/100g</td></tr></table>"))
    listed = F.concat(F.lit("<dl><dt>Protein</dt><dd>"), z, F.lit("%</dd><dt>Metabolizable energy</dt><dd>375 kcal/100g</dd></dl>"))
    plain = F.concat(F.lit("<h3>About</h3><p>Protein: "), z, F.lit("%, Oil &amp; Fat: 14,5%</p><p>Energy: 360 kcal per 100g</p><script type=\"application/ld+json\">{\"name\": \""), F.col("product_name"), F.lit("\", \"brand\": {\"name\": \"x\"}}</script>"))
    html = F.when(F.col("id") % 3 == 0, rows).when(F.col("id") % 3 == 1, listed).otherwise(plain)
    return c.select(F.col("id").alias("page_id"), F.concat(F.lit("<html><body>"), html, F.lit("</body></html>")).alias("html"))


@query("h7_nutrition", sql("SELECT id AS page_id, CASE WHEN id % 3 = 0 THEN size + 0.5::DOUBLE ELSE size END AS protein_percent, CASE id % 3 WHEN 0 THEN 12.0::DOUBLE WHEN 2 THEN 14.5::DOUBLE END AS fat_percent, CASE id % 3 WHEN 0 THEN round(1570 / 4.184::DOUBLE, 4) WHEN 1 THEN 375.0::DOUBLE ELSE 360.0::DOUBLE END AS kcal FROM catalogue", C))
def h7(s, d):
    return g.nutrition(g.extract_pairs(made_pages(s, d))).select("page_id", "protein_percent", "fat_percent", F.round("kcal_per_100g", 4).alias("kcal"))


PAIRS = """pairs AS (SELECT id, size, product_name, unnest(CASE id % 3
  WHEN 0 THEN [['heading', 'h2', 'Analysis'], ['row', 'Crude Protein', size || ',5 %'], ['row', 'Fat content', '12%'], ['row', 'Energy', '1570 kJ/100g']]
  WHEN 1 THEN [['definition', 'Protein', size || '%'], ['definition', 'Metabolizable energy', '375 kcal/100g']]
  ELSE [['heading', 'h3', 'About'], ['paragraph', 'About', 'Protein: ' || size || '%, Oil & Fat: 14,5%'], ['paragraph', 'About', 'Energy: 360 kcal per 100g'], ['json_ld', '', '{"name": "' || product_name || '", "brand": {"name": "x"}}']] END) AS p, unnest(range(CASE id % 3 WHEN 1 THEN 2 ELSE 4 END)) AS seq FROM catalogue)"""


@query("h7_pairs", sql("SELECT id AS page_id, CAST(seq AS INT) AS seq, p[1] AS kind, p[2] AS label, p[3] AS value FROM pairs", C, PAIRS))
def h7c(s, d):
    return g.extract_pairs(made_pages(s, d))


@query("h7_labels", sql("SELECT id AS page_id, CASE WHEN id % 2 = 0 THEN size * 1.0::DOUBLE END AS protein_percent, 10.5::DOUBLE AS fat_percent, CASE WHEN id % 2 = 0 THEN round(size * 3.5::DOUBLE + 10.5::DOUBLE * 8.5::DOUBLE + (100.0::DOUBLE - size - 10.5::DOUBLE - 8.0::DOUBLE) * 3.5::DOUBLE, 4) END AS kcal, CASE WHEN id % 2 = 0 THEN 'estimated' END AS basis FROM catalogue", C))
def h7d(s, d):
    """Spanish labels; energy is estimated where protein and fat are there."""
    c = catalogue(s, d)
    first = F.when(F.col("id") % 2 == 0, F.concat(F.lit("<tr><th>Proteínas</th><td>"), F.col("size").cast("string"), F.lit("%</td></tr>"))).otherwise(F.lit(""))
    rows = c.select(F.col("id").alias("page_id"), F.concat(F.lit("<table>"), first, F.lit("<tr><td>Grasas brutas</td><td>10,5%</td></tr><tr><td>Humedad</td><td>8 %</td></tr></table>")).alias("html"))
    return g.nutrition(g.extract_pairs(rows)).select("page_id", "protein_percent", "fat_percent", F.round("kcal_per_100g", 4).alias("kcal"), F.col("kcal_basis").alias("basis"))


@query("h7_extract_pairs")
def h7b(s, d):
    return g.extract_pairs(sources.read_pages(s, f"{d}/pages.parquet"))


@query("h8_infobox", sql("SELECT id AS page_id, CASE WHEN id % 3 = 0 THEN size + 0.5::DOUBLE ELSE size END AS protein FROM catalogue WHERE id % 3 < 2", C))
def h8(s, d):
    from granary.functions.parse import parse_percent

    return g.infobox(g.extract_pairs(made_pages(s, d)), {"protein": ("protein", parse_percent(F.col("value")))})


@query("h9_sections", sql("SELECT id AS page_id, 'Protein: ' || size || '%, Oil & Fat: 14,5%' AS about FROM catalogue WHERE id % 3 = 2", C))
def h9(s, d):
    return g.sections(g.extract_pairs(made_pages(s, d)), {"about": "^about"}, 1)


@query("h10_json_ld", sql("SELECT id AS page_id, product_name AS name, 'x' AS brand FROM catalogue WHERE id % 3 = 2", C))
def h10(s, d):
    got = g.json_ld(made_pages(s, d), "name string, brand struct<name: string>")
    return got.select("page_id", F.col("ld.name").alias("name"), F.col("ld.brand.name").alias("brand"))


@query("h11_extract_values", sql("SELECT id, size * 1.0::DOUBLE AS protein FROM catalogue", C))
def h11(s, d):
    names = F.when(F.col("id") % 3 == 0, "Protein").when(F.col("id") % 3 == 1, "Rohprotein").otherwise("Protéine brute")
    text = F.concat(F.lit("Fat 9%; "), names, F.lit(": "), F.col("size").cast("string"), F.lit(" %"))
    patterns = {"protein": [r"\bProtein: *([0-9]+)", r"Rohprotein: *([0-9]+)", r"Protéine brute: *([0-9]+)"]}
    return catalogue(s, d).select("id", *[c.alias(n) for n, c in g.extract_values(text, patterns).items()])


@query("h12_text_flags", sql("SELECT id, CASE WHEN contains(product_name, 'old') THEN false WHEN contains(product_name, 'red') OR contains(product_name, 'gizmo') THEN true END AS lively FROM catalogue", C))
def h12(s, d):
    return catalogue(s, d).select("id", *[c.alias(n) for n, c in g.text_flags(F.col("product_name"), {"lively": (["red", "gizmo"], ["old"])}).items()])


@query("s1_read_csv", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def s1(s, d):
    path = sources.scratch(s, "s1")
    sources.write(table(s, d, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice"), path, fmt="csv")
    return sources.read_csv(s, path, "p_partkey long, p_name string, p_brand string, p_retailprice double")


@query("s2_read_jsonl", "SELECT event_id, user_id, event_type, props FROM events WHERE event_id % 10 <> 0")
def s2(s, d):
    """Events as gzip JSON lines, every tenth line cut short."""
    path = sources.scratch(s, "s2")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "props"))
    cut = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 12)).otherwise(line)
    table(s, d, "events").select(cut.alias("value")).write.option("compression", "gzip").text(path)
    return sources.read_jsonl(s, path, "event_id long, user_id long, event_type string, props string")


@query("s2_quarantine", "SELECT 'good' AS kind, CAST(event_id AS VARCHAR) || '/' || event_type AS value FROM events WHERE event_id % 10 <> 0 UNION ALL SELECT 'bad', '{\"event_id\":' FROM events WHERE event_id % 10 = 0 UNION ALL SELECT 'n_good', CAST(count(*) AS VARCHAR) FROM events WHERE event_id % 10 <> 0 UNION ALL SELECT 'n_bad', CAST(count(*) AS VARCHAR) FROM events WHERE event_id % 10 = 0")
def s2b(s, d):
    """The same lines, with those that are cut short kept apart and counted."""
    path = sources.scratch(s, "s2")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "props"))
    cut = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 12)).otherwise(line)
    table(s, d, "events").select(cut.alias("value")).write.option("compression", "gzip").text(f"{path}/in")
    good, bad, counts = sources.quarantine_jsonl(s, f"{path}/in", "event_id long, user_id long, event_type string, props string", f"{path}/out")
    rows = good.select(F.lit("good").alias("kind"), F.concat_ws("/", F.col("event_id").cast("string"), "event_type").alias("value"))
    return rows.unionByName(bad.select(F.lit("bad").alias("kind"), F.col("line").alias("value"))).unionByName(s.createDataFrame([(f"n_{k}", str(v)) for k, v in counts.items()], "kind string, value string"))


@query("s3_read_json_array", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def s3(s, d):
    """Suppliers as JSON arrays, a file for a thousand keys."""
    path = sources.scratch(s, "s3")
    row = F.to_json(F.struct("s_suppkey", "s_name", "s_nationkey"))
    files = table(s, d, "supplier").groupBy(F.floor(F.col("s_suppkey") / 1000).alias("part")).agg(F.array_join(F.collect_list(row), ",").alias("_r"))
    files.select("part", F.concat(F.lit("["), "_r", F.lit("]")).alias("value")).write.partitionBy("part").text(path)
    return sources.read_json_array(s, path, "s_suppkey long, s_name string, s_nationkey long").drop("part")


@query("s4_read_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s4(s, d):
    return sources.read_table(s, f"{d}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


@query("s5_read_many", "SELECT CASE WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS kind, count(*) AS n, count(*) AS n_named FROM (SELECT p_partkey AS id FROM part) GROUP BY 1")
def s5(s, d):
    """Two folders of parts, one with a column more, read by a pattern; a file belongs to one."""
    path, p = sources.scratch(s, "s5"), table(s, d, "part").select(F.col("p_partkey").alias("id"))
    sources.write(p.where("id % 3 <> 0"), f"{path}/kind=a")
    sources.write(p.where("id % 3 = 0").withColumn("more", F.lit(1)), f"{path}/kind=b")
    rows = sources.read_many(s, f"{path}/*/*.parquet")
    files = rows.groupBy("file").agg(F.count("*").alias("n"), F.count("more").alias("more"), F.max(F.when(F.endswith("file", F.lit(".parquet")), F.col("file"))).alias("name"))
    return files.groupBy(F.when(F.col("more") == F.col("n"), "b").otherwise("a").alias("kind")).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("name") == F.col("file"), F.col("n"))).alias("n_named"))


@query("s7_rules", "SELECT r_name AS grp, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def s7(s, d):
    """Regions and their nations as a YAML rule file, and customers by its groups."""
    path = sources.scratch(s, "s7")
    nations = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    block = nations.groupBy("r_name").agg(F.sort_array(F.collect_list("n_name")).alias("t")).select(F.concat(F.lit("# a region\n"), "r_name", F.lit(":\n"), F.array_join(F.transform("t", lambda x: F.concat(F.lit("  - '"), x, F.lit("'"))), "\n")).alias("value"))
    block.write.text(path)
    named = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.join(sources.read_rules(s, path), F.col("n_name") == F.col("token")).groupBy("grp").agg(F.count("*").alias("n"))


@query("s8_write", sql("SELECT id, brand, price FROM catalogue", C))
def s8(s, d):
    """An overwrite that an append completes."""
    path, c = sources.scratch(s, "s8"), catalogue(s, d).select("id", "brand", "price")
    sources.write(c.where("id % 3 = 0"), path, fmt="csv")
    sources.write(c.where("id % 2 = 0"), path, fmt="csv")
    sources.write(c.where("id % 2 <> 0"), path, "append", "csv")
    return sources.read_csv(s, path, "id long, brand string, price double")


@query("s9_materialize", sql("SELECT brand, count(*) AS n, max(price) AS top FROM catalogue GROUP BY brand", C))
def s9(s, d):
    name = sources.scratch(s, "s9").rsplit("/", 1)[1].replace("-", "_")
    return sources.materialize(catalogue(s, d).groupBy("brand").agg(F.count("*").alias("n"), F.max("price").alias("top")), name)


@query("s10_refresh", sql("SELECT id, price + 2 AS price FROM catalogue WHERE size >= 10", C))
def s10(s, d):
    """A table that is recomputed from itself, twice."""
    path = sources.scratch(s, "s10")
    sources.write(catalogue(s, d).select("id", "size", "price"), path)
    sources.refresh(sources.current(s, path).where("size >= 10").withColumn("price", F.col("price") + 1), path)
    return sources.refresh(sources.current(s, path).select("id", (F.col("price") + 1).alias("price")), path)


@query("s11_snapshot", sql("SELECT id, kcal AS kept, coalesce(kcal, 0) + 1 AS now FROM catalogue", C))
def s11(s, d):
    """What a table held before it was changed, beside what it holds then."""
    path, rows = sources.scratch(s, "s11"), catalogue(s, d).select("id", "kcal")
    sources.write(rows, f"{path}/table")
    kept = sources.snapshot(sources.current(s, f"{path}/table"), path, "before")
    now = sources.refresh(sources.current(s, f"{path}/table").withColumn("kcal", F.coalesce("kcal", F.lit(0.0)) + 1), f"{path}/table")
    return s.read.parquet(kept).withColumnRenamed("kcal", "kept").join(now.withColumnRenamed("kcal", "now"), "id")


@query("s6_read_pages", "SELECT page_id, url, md5(html) AS fingerprint FROM pages")
def s6(s, d):
    return sources.read_pages(s, f"{d}/pages.parquet").select("page_id", "url", "fingerprint")


@query("s12_rollback", sql("SELECT c.id, CASE WHEN f.id IS NOT NULL THEN f.kcal ELSE c.kcal END AS kcal FROM catalogue c LEFT JOIN (SELECT id - 1000000 AS id, kcal FROM feed) f ON c.id = f.id", C, FEED))
def s12(s, d):
    kept = feed(s, d).select((F.col("id") - 1_000_000).alias("id"), "kcal")
    return sources.rollback(catalogue(s, d).select("id", "kcal"), kept, "id", ["kcal"])


@query("t1_keyed_state", "SELECT user_id, count(*) AS changes, arg_max(props, (ts, props)) AS fingerprint, min(ts) AS first_seen, max(ts) AS last_seen FROM (SELECT user_id, ts, props, lag(props) OVER (PARTITION BY user_id ORDER BY ts, props) AS before FROM (SELECT DISTINCT user_id, ts, props FROM events)) WHERE before IS NULL OR before <> props GROUP BY user_id")
def t1c(s, d):
    """The events in three micro-batches by time, through the keyed state: what changed, and each
    key's last change, from the appended rows."""
    path = sources.scratch(s, "t1")
    e = table(s, d, "events").select("user_id", F.col("ts").alias("seen"), F.col("props").alias("fingerprint"))
    first, last = e.agg(F.min("seen"), F.max("seen")).first()
    for i in range(3):
        low, high = (F.lit(first + (last - first) * x / 3) for x in (i, i + 1))
        part = e.where((F.col("seen") >= low) & ((F.col("seen") < high) | F.lit(i == 2)))
        sources.write(part.coalesce(1), f"{path}/in", "append")
    stream = s.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    streaming.append_changes(stream, f"{path}/out", "user_id")(f"{path}/checkpoint").awaitTermination()
    changes = s.read.parquet(f"{path}/out")
    return changes.groupBy("user_id").agg(F.count("*").alias("changes")).join(streaming.latest(changes, "user_id"), "user_id")


@query("t1_changed_within", "SELECT user_id, count(*) AS changes FROM (SELECT user_id, props, lag(props) OVER (PARTITION BY user_id ORDER BY ts, props) AS before FROM (SELECT DISTINCT user_id, ts, props FROM events)) WHERE before IS NULL OR before <> props GROUP BY user_id")
def t1(s, d):
    e = table(s, d, "events").select("user_id", F.col("ts").alias("seen"), F.col("props").alias("fingerprint"))
    return streaming.changed_within(e, "user_id").groupBy("user_id").agg(F.count("*").alias("changes"))
