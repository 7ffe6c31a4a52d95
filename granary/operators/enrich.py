"""Enrichment: classification with confidence, prices, outliers, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.parse import bucket, estimate_energy, json_get, parse_money, parse_weight_kg, to_double
from granary.functions.text import first_keyword, make_key, norm_tokens, slug_us

from .relational import best_per, median_by
from .rules import token_groups, with_phrase

#: Confidences of the classifier's stages, and the cut below which a class is dropped.
CONFIDENCE = {"existing": 0.3, "line": 0.85, "dictionary": 0.9, "numeric": 0.75, "numeric weak": 0.65, "package": 0.7}
CUT = 0.6


def classify(df: DataFrame, key: str, existing: str, text: Column, dictionary: DataFrame, lines: DataFrame, number: Column, bands: Sequence[tuple[float, float, str, bool]], packages: Sequence[tuple[str, str]]) -> DataFrame:
    """label, confidence, stage and mismatch of each row.

    Stages as the reference orders them: the existing value (weak); the brand line (brand,
    label) only where there is none; the first dictionary word (ord, word, label) wherever the
    text contains it, even over an existing value; the numeric bands (low, high, label, strong)
    where there is no class or its confidence is under .7; package words where there is none
    still.  A class under the cut is dropped; mismatch says that it differs from the existing.
    """
    rows = df.withColumns({"_text": F.lower(text), "_number": number})
    rows = rows.join(lines.select(F.col("brand").alias("_lb"), F.col("label").alias("_line")), F.col("brand") == F.col("_lb"), "left").drop("_lb")
    rows = with_phrase(rows, F.col("_text"), dictionary.select("ord", "word", F.col("label").alias("_dict")), "word", ["_dict"])
    step = F.struct(F.col(existing).alias("label"), F.lit(CONFIDENCE["existing"]).alias("confidence"), F.lit("existing").alias("stage"))
    make = lambda label, stage: F.struct(label.alias("label"), F.lit(CONFIDENCE[stage]).alias("confidence"), F.lit(stage).alias("stage"))
    rows = rows.withColumn("_c", F.when(F.col(existing).isNotNull(), step).when(F.col("_line").isNotNull(), make(F.col("_line"), "line")))
    rows = rows.withColumn("_c", F.when(F.col("_dict").isNotNull(), make(F.col("_dict"), "dictionary")).otherwise(F.col("_c")))
    band = F.lit(None)
    for low, high, label, strong in reversed(bands):
        band = F.when((F.col("_number") >= low) & (F.col("_number") < high), make(F.lit(label), "numeric" if strong else "numeric weak")).otherwise(band)
    rows = rows.withColumn("_c", F.when((F.col("_c").isNull() | (F.col("_c.confidence") < 0.7)) & band.isNotNull(), band).otherwise(F.col("_c")))
    pack = F.lit(None)
    for word, label in reversed(packages):
        pack = F.when(F.contains("_text", F.lit(word)), make(F.lit(label), "package")).otherwise(pack)
    rows = rows.withColumn("_c", F.when(F.col("_c").isNull(), pack).otherwise(F.col("_c")))
    sure = F.col("_c.confidence") >= CUT
    out = rows.withColumns({"label": F.when(sure, F.col("_c.label")), "confidence": F.coalesce(F.when(sure, F.col("_c.confidence")), F.lit(0.0)), "stage": F.when(sure, F.col("_c.stage"))})
    return out.withColumn("mismatch", F.coalesce(F.col("label") != F.col(existing), F.lit(False))).drop("_text", "_number", "_line", "_dict", "_c")


def derive_category(text: Column, ladder: Sequence[tuple[str, Sequence[str]]], default: str | None = None) -> Column:
    """First category of which the lowered text contains a word."""
    out = F.lit(default).cast("string")
    for name, words in reversed(ladder):
        out = F.when(first_keyword(text, words).isNotNull(), F.lit(name)).otherwise(out)
    return out


def enrich_price(df: DataFrame, key: str, given: str, price: str, weight: str, by: Sequence[str], edges: Sequence[tuple[float, str]], above: str) -> DataFrame:
    """price_per_kg from the source, else price by weight, else the median of the group's known
    ones; with price_source and price_bucket."""
    known = F.coalesce(F.col(given), F.col(price) / F.nullif(F.col(weight), F.lit(0.0)))
    rows = df.withColumn("_known", known)
    medians = median_by(rows.where(F.col("_known").isNotNull()), by, "_known", [0.5]).withColumnRenamed("q50", "_median")
    rows = rows.join(medians, list(by), "left")
    source = F.when(F.col(given).isNotNull(), "source").when(F.col("_known").isNotNull(), "computed").when(F.col("_median").isNotNull(), "median").otherwise("none")
    rows = rows.withColumns({"price_source": source, "price_per_kg": F.round(F.coalesce("_known", "_median"), 4)})
    return rows.withColumn("price_bucket", bucket(F.col("price_per_kg"), edges, above)).drop("_known", "_median")


def repair_outliers(df: DataFrame, value: str, bands: DataFrame, by: str, estimate: Column) -> DataFrame:
    """value_fixed and action: in band: kept; out of band: the estimate if that is in the band,
    else cleared; bands (by, low, high), rows without one are kept."""
    rows = df.join(bands, by, "left")
    out = F.col(value).isNotNull() & F.col("low").isNotNull() & ~F.col(value).between(F.col("low"), F.col("high"))
    good = F.coalesce(estimate.between(F.col("low"), F.col("high")), F.lit(False))
    action = F.when(~out, "kept").when(good, "estimated").otherwise("cleared")
    return rows.withColumn("action", action).withColumn("value_fixed", F.when(F.col("action") == "kept", F.col(value)).when(F.col("action") == "estimated", F.round(estimate, 4))).drop("low", "high")


def enrich_groups(df: DataFrame, key: str, tokens: str, rules: DataFrame, sure: float = 0.9, unsure: float = 0.5) -> DataFrame:
    """groups hit by the tokens, confidence, and whether nothing is known (no tokens)."""
    found = token_groups(df.select(key, tokens), key, tokens, rules)
    sizes = df.select(key, F.coalesce(F.size(tokens), F.lit(0)).alias("_n"))
    got = found.join(sizes, key)
    confidence = F.when(F.col("_n") <= 0, 0.0).when(F.size("groups") > 0, F.lit(sure)).otherwise(F.lit(unsure))
    return got.select(key, "groups", confidence.alias("confidence"), (F.col("_n") <= 0).alias("unknown"))


def reconcile(base: DataFrame, enrich: DataFrame, key: str, fields: Mapping[str, str], clear: Column | None = None) -> DataFrame:
    """Each field by its mode: fill (base first) or replace (enrichment first), with
    `<field>_origin`.  Where `clear` (over the enrichment) holds, the field is null."""
    e = enrich.select(key, *[F.col(f).alias(f"_e_{f}") for f in fields], (F.lit(False) if clear is None else F.coalesce(clear, F.lit(False))).alias("_clear"))
    rows = base.join(e, key, "left")
    for f, mode in fields.items():
        old, new = F.col(f), F.col(f"_e_{f}")
        first, second, names = (old, new, ("base", "enrichment")) if mode == "fill" else (new, old, ("enrichment", "base"))
        cleared = F.coalesce(F.col("_clear"), F.lit(False))
        rows = rows.withColumn(f"{f}_origin", F.when(cleared, "cleared").when(first.isNotNull(), names[0]).when(second.isNotNull(), names[1]).otherwise("none"))
        rows = rows.withColumn(f, F.when(~cleared, F.coalesce(first, second)))
    return rows.drop("_clear", *[f"_e_{f}" for f in fields])


def fill_missing(base: DataFrame, enrich: DataFrame, key: str, fields: Sequence[str], confidence: str, factor: float = 0.9, tag: str = "enrichment") -> DataFrame:
    """Only null fields are filled; `<field>_from` and `<field>_confidence` (times factor) say so."""
    e = enrich.select(key, *[F.col(f).alias(f"_e_{f}") for f in fields], F.col(confidence).alias("_conf"))
    rows = base.join(e, key, "left")
    for f in fields:
        take = F.col(f).isNull() & F.col(f"_e_{f}").isNotNull()
        rows = rows.withColumns({f"{f}_from": F.when(take, F.lit(tag)), f"{f}_confidence": F.when(take, F.round(F.col("_conf") * factor, 6)), f: F.coalesce(F.col(f), F.col(f"_e_{f}"))})
    return rows.drop("_conf", *[f"_e_{f}" for f in fields])


def extract_from_matches(matches: DataFrame, a: DataFrame, b: DataFrame, id_a: str, id_b: str, ranges: Mapping[str, tuple[float, float]], auto: float = 0.9, review: float = 0.85) -> DataFrame:
    """Long rows (id, field, value, confidence) of fields that a misses and its match has within
    range; the confidence is the score times `auto` or `review` by tier."""
    m = matches.where(F.col("tier").isin("auto", "review")).select("id", "match_id", "score", "tier")
    left = a.select(F.col(id_a).alias("id"), *[F.col(f).alias(f"_a_{f}") for f in ranges])
    right = b.select(F.col(id_b).alias("match_id"), *[F.col(f).alias(f"_b_{f}") for f in ranges])
    rows = m.join(left, "id").join(right, "match_id")
    sure = F.round(F.col("score") * F.when(F.col("tier") == "auto", F.lit(auto)).otherwise(F.lit(review)), 6)
    cells = [F.when(F.col(f"_a_{f}").isNull() & F.col(f"_b_{f}").between(lo, hi), F.struct("id", F.lit(f).alias("field"), F.col(f"_b_{f}").alias("value"), sure.alias("confidence"))) for f, (lo, hi) in ranges.items()]
    return rows.select(F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))


def normalize_open_data(df: DataFrame, json: str) -> DataFrame:
    """An open-data record in JSON to the canonical columns."""
    get = lambda *p: json_get(F.col(json), p)
    brand, name = F.split_part(get("brands"), F.lit(","), F.lit(1)), get("product_name", "product_name_en")
    tokens = norm_tokens(F.from_json(get("ingredients_tags"), "array<string>"))
    return df.withColumns({
        "product_key": make_key([brand, name, F.lit(None).cast("string")]), "brand": F.trim(brand), "brand_slug": slug_us(brand), "product_name": F.trim(name), "kcal_per_100g": to_double(get("nutriments.energy-kcal_100g")),
        "protein_percent": to_double(get("nutriments.proteins_100g")), "fat_percent": to_double(get("nutriments.fat_100g")), "ingredients_tokens": tokens, "weight_kg": parse_weight_kg(get("quantity")),
    }).drop(json)


def infer_from_name(df: DataFrame, col: str, name: str, ladder: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), derive_category(F.col(name), ladder)))


def replace_default(df: DataFrame, col: str, default: str, key: Column, direct: Mapping[str, str], patterns: Sequence[tuple[str, str]], number: Column, edges: Sequence[tuple[float, str]], above: str) -> DataFrame:
    """A default value gives way to the direct map, else the first pattern, else the ladder."""
    out = F.lit(None).cast("string")
    for k, v in direct.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    by_pattern = F.lit(None).cast("string")
    for p, v in reversed(patterns):
        by_pattern = F.when(F.regexp_like(key, F.lit(p)), F.lit(v)).otherwise(by_pattern)
    new = F.coalesce(out, by_pattern, bucket(number, edges, above), F.col(col))
    return df.withColumn(col, F.when(F.col(col) == default, new).otherwise(F.col(col)))


def apply_matches(df: DataFrame, matches: DataFrame, key: str, fields: Sequence[str], least: float) -> DataFrame:
    """The best match (confidence, then name) of each key fills its missing fields; provenance
    is a map of field to match name."""
    best = best_per(matches.where(F.col("confidence") >= least), [key], [-F.col("confidence"), F.col("name")])
    m = best.select(key, F.col("name").alias("_name"), *[F.col(f).alias(f"_m_{f}") for f in fields])
    rows = df.join(m, key, "left")
    cells = [F.when(F.col(f).isNull() & F.col(f"_m_{f}").isNotNull(), F.concat(F.lit(f"{f}="), F.col("_name"))) for f in fields]
    rows = rows.withColumn("provenance", F.concat_ws(";", *cells)).withColumns({f: F.coalesce(F.col(f), F.col(f"_m_{f}")) for f in fields})
    return rows.drop("_name", *[f"_m_{f}" for f in fields])


def normalize_offers(df: DataFrame, spec: Mapping[str, Column], forms: Sequence[tuple[str, Sequence[str]]], stages: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """A retailer's rows to offers: brand, product_name, key, form, stage, weight, price per kg."""
    made = df.select(*[c.alias(n) for n, c in spec.items()])
    made = made.withColumns({"form": derive_category(F.col("product_name"), forms), "life_stage": derive_category(F.col("product_name"), stages, "all"), "weight_kg": parse_weight_kg(F.col("product_name")), "price": parse_money(F.col("price_text"))})
    made = made.withColumn("product_key", make_key([F.col("brand"), F.col("product_name"), F.col("form")]))
    return made.withColumn("price_per_kg", F.round(F.col("price") / F.nullif("weight_kg", F.lit(0.0)), 4))


def energy_estimate(protein: str = "protein", fat: str = "fat") -> Column:
    none = F.lit(None).cast("double")
    return estimate_energy(F.col(protein), F.col(fat), none, none, none)
