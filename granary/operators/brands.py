"""Brand resolution by alias, phrase and family rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import slug_hy, slug_us

from .relational import mode_by, rank_rows
from .rules import ranked_rules, with_phrase


def apply_alias(df: DataFrame, alias: DataFrame, col: str = "brand", out: str = "brand_canonical") -> DataFrame:
    """Canonical name by (alias, canonical), matched lowered and trimmed; unknown names stay."""
    one = alias.groupBy(F.lower(F.trim("alias")).alias("_alias")).agg(F.min("canonical").alias("_canonical"))
    joined = df.join(one, F.lower(F.trim(F.col(col))) == F.col("_alias"), "left")
    return joined.withColumn(out, F.coalesce("_canonical", F.col(col))).drop("_alias", "_canonical")


def apply_alias_phrase(df: DataFrame, key: str, alias: DataFrame, phrases: DataFrame, col: str = "brand", out: str = "brand_canonical") -> DataFrame:
    """Alias first, then the first phrase (ord, phrase, canonical) that the lowered name
    contains, else the name trimmed with its first letters in capitals."""
    one = alias.groupBy(F.lower(F.trim("alias")).alias("_alias")).agg(F.min("canonical").alias("_by_alias"))
    step = df.join(one, F.lower(F.trim(F.col(col))) == F.col("_alias"), "left").drop("_alias")
    found = with_phrase(step, F.lower(F.col(col)), phrases.select("ord", "phrase", F.col("canonical").alias("_by_phrase")), "phrase", ["_by_phrase"])
    return found.withColumn(out, F.coalesce("_by_alias", "_by_phrase", F.initcap(F.trim(F.col(col))))).drop("_by_alias", "_by_phrase")


def build_aliases(canon: DataFrame, observed: DataFrame) -> DataFrame:
    """(observed, canonical, how) of each distinct observed name: exact, lowered, slug, or
    unmapped (canonical null)."""
    names = observed.select(F.col("name").alias("observed")).where("observed is not null").distinct()
    tiers = (("exact", lambda c: c), ("lowered", lambda c: F.lower(F.trim(c))), ("slug", slug_hy))
    for how, make in tiers:
        side = canon.groupBy(make(F.col("canonical")).alias(f"_{how}")).agg(F.min("canonical").alias(f"_c_{how}"))
        names = names.join(side, make(F.col("observed")) == F.col(f"_{how}"), "left")
    found = F.coalesce(*[F.col(f"_c_{h}") for h, _ in tiers])
    how = F.when(F.col("_c_exact").isNotNull(), "exact").when(F.col("_c_lowered").isNotNull(), "lowered").when(F.col("_c_slug").isNotNull(), "slug").otherwise("unmapped")
    return names.select("observed", found.alias("canonical"), how.alias("how"))


def alias_impact(df: DataFrame, alias: DataFrame, by: str, col: str = "brand") -> DataFrame:
    mapped = apply_alias(df, alias, col, "_new")
    return mapped.groupBy(by).agg(F.countDistinct(col).alias("before"), F.countDistinct("_new").alias("after"), F.count_if(F.col("_new") != F.col(col)).alias("rows_changed"))


def repair_split(df: DataFrame, key: str, phrases: DataFrame) -> DataFrame:
    """Rows (brand, product_name) whose brand is a fragment and whose name starts with the rest:
    rules (source_brand, prefix, canonical).  Adds brand_fixed, name_fixed, brand_slug_fixed,
    key_fixed and split (whether a rule applied; the longest prefix wins)."""
    rules = phrases.select(F.lower("source_brand").alias("_b"), F.lower("prefix").alias("_p"), F.col("canonical").alias("_canonical"), F.length("prefix").alias("_n"))
    prefixes = rules.groupBy("_b").agg(F.collect_set(F.struct((-F.col("_n")).alias("o"), "_p", "_canonical", "_n")).alias("_rules"))
    fits = F.filter("_rules", lambda r: F.startswith(F.lower(F.col("product_name")), F.concat(r["_p"], F.lit(" "))))
    hit = df.join(prefixes, F.lower("brand") == F.col("_b"), "left").withColumn("_rule", F.array_min(fits)).select(*[F.col(f"`{c}`") for c in df.columns], "_rule._canonical", "_rule._n")
    name = F.coalesce(F.trim(F.substring("product_name", F.col("_n") + 1, F.length("product_name"))), F.col("product_name"))
    out = hit.withColumns({"brand_fixed": F.coalesce("_canonical", "brand"), "name_fixed": name, "split": F.col("_canonical").isNotNull()})
    out = out.withColumn("brand_slug_fixed", slug_us(F.col("brand_fixed")))
    return out.withColumn("key_fixed", F.concat_ws("|", "brand_slug_fixed", slug_us(F.col("name_fixed")))).drop("_canonical", "_n")


def find_splits(df: DataFrame, min_rows: int = 3) -> DataFrame:
    """Split candidates: the first word of the names of a brand, with the share of the brand's
    rows that start with it (consistency) and a confidence from share and count."""
    words = df.select("brand", F.split_part("product_name", F.lit(" "), F.lit(1)).alias("first_word"))
    counts = words.groupBy("brand", "first_word").agg(F.count("*").alias("n"))
    totals = counts.groupBy("brand").agg(F.sum("n").alias("total"))
    both = counts.join(totals, "brand").where(F.col("n") >= min_rows)
    share = F.col("n") / F.col("total")
    confidence = F.when(share >= 0.2, "high").when(share >= 0.1, "medium").otherwise("low")
    return both.select("brand", "first_word", "n", F.round(share, 4).alias("consistency"), confidence.alias("confidence"))


def screen_splits(candidates: DataFrame, generic: Sequence[str], min_len: int = 3) -> DataFrame:
    """Candidates that aren't generic words, too short or of low confidence."""
    return candidates.where(~F.col("first_word").isin(list(generic)) & (F.length("first_word") > min_len) & (F.col("confidence") != "low"))


def split_guards(df: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(guard, n, passed) rows: split brands left, repeated brand in names, blank brands, slugs
    that aren't slugs, and brands whose spellings differ; then one row for all."""
    low = F.lower(F.trim("brand"))
    frag = df.select(key, low.alias("_b"), F.lower("product_name").alias("_n"))
    split = frag.join(rules.select(F.lower("source_brand").alias("_b"), F.lower("prefix").alias("_p")), "_b").where(F.startswith("_n", F.concat("_p", F.lit(" "))))
    spell = df.groupBy(slug_hy(F.col("brand")).alias("s")).agg(F.countDistinct("brand").alias("k")).where("k > 1")
    one = df.agg(F.count_if(F.startswith(F.lower("product_name"), F.concat(low, F.lit(" ")))).alias("repeated"), F.count_if(F.coalesce(F.trim("brand"), F.lit("")) == "").alias("blank"), F.count_if(F.regexp_like(slug_us(F.col("brand")), F.lit("[^a-z0-9_]"))).alias("bad_slug"))
    counts = split.agg(F.count("*").alias("split")).crossJoin(one).crossJoin(spell.agg(F.count("*").alias("spellings")))
    names = ("split", "repeated", "blank", "bad_slug", "spellings")
    cells = [F.struct(F.lit(n).alias("guard"), F.col(n).alias("n")) for n in names]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return counts.select(F.inline(F.array(*cells, F.struct(F.lit("all").alias("guard"), total.alias("n"))))).withColumn("passed", F.col("n") == 0)


def assign_family(df: DataFrame, key: str, families: DataFrame, series: DataFrame, default: str = "other") -> DataFrame:
    """family by alias (families: ord, family, alias, pattern), else by pattern, else `default`;
    series by the first pattern (ord, family, series, pattern) of the family."""
    low, name = F.lower("brand"), F.lower("product_name")
    test = lambda r: (low == r["_alias"]) | F.regexp_like(name, r["_pattern"])
    rules = families.select("ord", F.col("family").alias("family"), F.col("alias").alias("_alias"), F.col("pattern").alias("_pattern"))
    got = ranked_rules(df, rules, test, lambda r: [F.when(low == r["_alias"], 0).otherwise(1), r["ord"]], ["family"])
    got = got.withColumn("family", F.coalesce("family", F.lit(default)))
    lines = series.select(F.col("ord").alias("_so"), F.col("family").alias("_sf"), "series", F.col("pattern").alias("_sp"))
    return ranked_rules(got, lines, lambda r: (F.col("family") == r["_sf"]) & F.regexp_like(name, r["_sp"]), lambda r: [r["_so"]], ["series"])


def brand_anomalies(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Brands that are numbers, with the name most often extracted from their product names by
    the first pattern that matches."""
    odd = df.where(F.regexp_like("brand", F.lit(r"^\d+$")))
    found = F.coalesce(*[F.nullif(F.regexp_extract("product_name", p, 1), F.lit("")) for p in patterns])
    return mode_by(odd.select("brand", found.alias("suggested")), ["brand"], "suggested")


def clean_names(df: DataFrame, key: str, rules: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """name_clean by the first rule (ord, brand or *, pattern, confidence) whose pattern is found:
    the match is removed.  `action`: safe, review (confidence too low, name kept) or none."""
    rule = rules.select("ord", F.lower("brand").alias("_b"), F.col("pattern").alias("_pattern"), F.col("confidence").alias("_conf"))
    test = lambda r: ((r["_b"] == "*") | (r["_b"] == F.lower("brand"))) & F.regexp_like("product_name", r["_pattern"])
    hit = ranked_rules(df, rule, test, lambda r: [r["ord"]], ["_pattern", "_conf"])
    action = F.when(F.col("_conf").isNull(), "none").when(F.col("_conf") >= min_confidence, "safe").otherwise("review")
    cleaned = F.trim(F.regexp_replace(F.expr("regexp_replace(product_name, _pattern, ' ')"), " +", " "))
    return hit.withColumn("action", action).withColumn("name_clean", F.when(F.col("action") == "safe", cleaned).otherwise(F.col("product_name"))).drop("_pattern", "_conf")


def brand_audit(df: DataFrame, key: str, canon: DataFrame, n: int, slug: Column | None = None) -> DataFrame:
    """Rows of each canonical slug and its first n witnesses by key."""
    made = df.select(F.col(key).alias("id"), (slug if slug is not None else slug_hy(F.col("brand"))).alias("slug"))
    joined = made.join(canon.select("slug"), "slug")
    top = rank_rows(joined, ["slug"], [F.col("id")]).where(F.col("rank") <= n).groupBy("slug").agg(F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("witnesses"))
    counts = joined.groupBy("slug").agg(F.count("*").alias("n"))
    return counts.join(top, "slug")
