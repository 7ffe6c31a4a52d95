"""The registered queries of this subpackage; SQL beside them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, lines, mixing, packing, private, quality, ranked, sharding, simhash, spelling, substrings, tiff, tokens

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_mixtures(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.placed(mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.interleave(documents(spark, sf_dir))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select("doc_id", *quality.BASE, "base_failed", "kept", "d2")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op9_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.stored_and_read(documents(spark, sf_dir))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private.find_private(documents(spark, sf_dir))
    counts = [F.size(F.filter("base", lambda x: x["kind"] == F.lit(private.KINDS.index(k)))).cast("long").alias(f"n_{k}") for k in private.KINDS]
    spans = private.written(F.array_sort(F.concat("base", "added")))
    return found.select("doc_id", *counts, F.sha2(private.written(F.col("base")), 256).alias("base_sha256"), spans.alias("spans"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_language": op1_language,
        "op2_packing": op2_packing,
        "op3_mixing": op3_mixing,
        "op4_sharding": op4_sharding,
        "op5_token_counts": op5_token_counts,
        "op6_quality": op6_quality,
        "op7_simhash": op7_simhash,
        "op8_lines": op8_lines,
        "op9_tiff": op9_tiff,
        "op10_substrings": op10_substrings,
        "op11_spelling": op11_spelling,
        "op12_private": op12_private,
        "op13_ranked": op13_ranked,
        "pipeline": pipeline,
    }


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rnk FROM s
), w AS (
  SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size::DOUBLE * 2 AS cap FROM r
), f AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, rnk) AS fill FROM w
), l AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level FROM f
), z AS (
  SELECT min(fill) AS first_open, arg_min(level, fill) AS open_level FROM l WHERE cap > weight * level
), t AS (
  SELECT source, source_size, CASE WHEN fill >= first_open THEN weight * open_level ELSE cap END AS target, rnk,
    CASE (rnk - 1) % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS ramp_from,
    CASE (rnk - 1) % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS ramp_to FROM l LEFT JOIN z ON true
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rnk, t.ramp_from, t.ramp_to, md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(d.text, '')) AS ord,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(d.text, '')), d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, CAST(greatest(0, least(size, floor(target) - (before + source_size * pass))) AS BIGINT) AS words FROM c, (VALUES (0), (1)) AS q(pass)
), u AS (
  SELECT *, least(greatest((before + source_size * pass + words / 2.0::DOUBLE) / target, 0.0::DOUBLE), 1.0::DOUBLE) AS u FROM p WHERE words > 0
), o AS (
  SELECT *, CASE WHEN ramp_from = ramp_to THEN u ELSE (sqrt(ramp_from * ramp_from + (ramp_to * ramp_to - ramp_from * ramp_from) * u) - ramp_from) / (ramp_to - ramp_from) END AS position FROM u
), g AS (
  SELECT *, CAST(sum(words) OVER (ORDER BY position, rnk, pass, ord ROWS UNBOUNDED PRECEDING) - words AS BIGINT) AS place FROM o
), a AS (
  SELECT doc_id, rnk, before, size, sum(words) AS taken, min(position) AS position, max(position) AS last_position, min(place) AS place, max(place) AS last_place FROM g GROUP BY ALL
)
SELECT c.doc_id, c.size, c.source_size, c.target, CAST(coalesce(a.taken, 0) AS BIGINT) AS taken, a.position, a.last_position, a.place, a.last_place
FROM c LEFT JOIN a ON c.doc_id IS NOT DISTINCT FROM a.doc_id AND c.rnk = a.rnk AND c.before = a.before AND c.size = a.size
"""


OP11_SQL = r"""
WITH p AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
), r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), u AS (
  SELECT id, run, count(*) AS times FROM r GROUP BY ALL
), b AS (
  SELECT *, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS bytes FROM u
), h AS (
  SELECT run, times, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(bytes, lambda x: x::BIGINT)), lambda c, x: xor(c // 256, steps[xor(c % 256, x) + 1]::BIGINT)), 4294967295) AS h FROM b, p
), w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n FROM h GROUP BY 1 HAVING sum(times) >= 3 AND length(word) >= 5
), d AS (
  SELECT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM w)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n FROM w LEFT JOIN best USING (word)
), t AS (
  WITH RECURSIVE t AS (
    SELECT word, word AS root, 0 AS step FROM f
    UNION ALL SELECT t.word, f.form, step + 1 FROM t JOIN f ON t.root = f.word WHERE f.form IS NOT NULL
  ) SELECT word, arg_max(root, step) AS root FROM t GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM f JOIN t USING (word)
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
  SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d
), s AS (
  SELECT count(DISTINCT r) AS n_docs, count(*) AS n_terms FROM t
), f AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term
), p AS (
  SELECT q.item_id, f.r, f.doc_id, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * f.n * s.n_docs) // s.n_terms)))) AS BIGINT) AS score
  FROM q JOIN w ON q.term = w.term JOIN f ON f.term = q.term JOIN s ON true GROUP BY ALL
), k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3_SQL, "op11_spelling": OP11_SQL, "op13_ranked": OP13_SQL}
