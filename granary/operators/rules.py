"""Operators driven by rule tables: tokens, vocabularies, currencies, priorities."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .candidates import contained, stored
from .phrases import first_phrase, rule_array
from .relational import RULE_BYTES, RULE_ROWS


def _token_pairs(tokens: DataFrame, rules: DataFrame, either: bool) -> DataFrame:
    """(token, word): different tokens that contain a different rule word, or, with `either`, are
    contained in one.  Both are vocabularies; they meet by runs of letters."""
    side = lambda df, col, n: stored(df.where(F.col(col).isNotNull()).select(F.lit(0).alias("_block"), F.col(col).alias("_text")).distinct().withColumn(f"{n}_no", F.monotonically_increasing_id()), n)
    t, w = side(tokens, "token", "t"), side(rules, "token", "w")
    met = contained(w, t, "w", "t").select(F.col("needle_no").alias("w_no"), F.col("text_no").alias("t_no"))
    if either:
        met = met.unionByName(contained(t, w, "t", "w").select(F.col("text_no").alias("w_no"), F.col("needle_no").alias("t_no"))).distinct()
    return met.join(t.select("t_no", F.col("_text").alias("token")), "t_no").join(w.select("w_no", F.col("_text").alias("word")), "w_no").select("token", "word")


def canonical_tokens(df: DataFrame, key: str, arr: str, rules: DataFrame, mode: str = "exact") -> DataFrame:
    """key and the tokens of `arr`, in order, each mapped by rules (token, canonical): by
    equality, or by containment either way (first rule token by name)."""
    long = df.select(key, F.posexplode(arr).alias("_i", "token"))
    if mode == "exact":
        one = rules.groupBy("token").agg(F.min("canonical").alias("canonical"))
    else:
        pairs = _token_pairs(long.select("token").distinct(), rules, either=True)
        named = rules.select(F.col("token").alias("word"), "canonical")
        one = pairs.join(named, "word").groupBy("token").agg(F.min(F.struct("word", "canonical"))["canonical"].alias("canonical"))
    got = F.sort_array(F.collect_list(F.struct("_i", F.coalesce("canonical", "token").alias("t"))))
    return long.join(one, "token", "left").groupBy(key).agg(F.transform(got, lambda x: x["t"]).alias(arr))


def token_groups(df: DataFrame, key: str, arr: str, rules: DataFrame, mode: str = "equal") -> DataFrame:
    """key and the sorted set of rule groups (grp, token) that the tokens hit: equal, prefix or
    contains.  Rows without a hit get an empty array."""
    long = df.select(key, F.explode_outer(arr).alias("token"))
    if mode == "equal":
        groups = rules.select("token", "grp")
    else:
        pairs = _token_pairs(long.select("token").distinct(), rules, either=False)
        pairs = pairs.where(F.startswith("token", F.col("word"))) if mode == "prefix" else pairs
        groups = pairs.join(rules.select(F.col("token").alias("word"), "grp"), "word").select("token", "grp").distinct()
    return long.join(groups, "token", "left").groupBy(key).agg(F.sort_array(F.collect_set("grp")).alias("groups"))


def to_base_currency(df: DataFrame, price: str, currency: str, rates: DataFrame) -> DataFrame:
    """`base`: price times the rate of its currency; null without a rate."""
    return df.join(rates.withColumnRenamed("currency", "_c").withColumnRenamed("rate", "_rate"), F.col(currency) == F.col("_c"), "left").withColumn("base", F.col(price) * F.col("_rate")).drop("_c", "_rate")


def with_phrase(df: DataFrame, text: Column, rules: DataFrame, phrase: str, take: Sequence[str]) -> DataFrame:
    """`df` with `take` of the first rule by `ord` whose phrase the text contains; nulls without one.
    Of rules of equal `ord` the smaller phrase counts.  Each row finds its rule by itself: rows
    aren't shuffled, and neither repeated nor null keys matter."""
    numbered = rules.orderBy("ord", phrase).select(F.struct(phrase, *take).alias("r")).limit(RULE_NUMBERS)
    numbered = stored(numbered.coalesce(1).select(F.monotonically_increasing_id().cast("int").alias("_no"), "r.*"), "rules")
    found = df.withColumn("_hit", first_phrase(text, numbered, phrase, "_no"))
    return found.join(numbered.select("_no", *take), F.col("_hit") == F.col("_no"), "left").drop("_hit", "_no")


#: Rules are numbered by whole numbers of 32 bits.
RULE_NUMBERS = (1 << 31) - 1


def map_vocab(df: DataFrame, key: str, col: str, rules: DataFrame) -> DataFrame:
    """`value` of the first rule (ord, pattern, value, exact) that the lowered text equals, or
    contains where `exact` is false.  All equalities come before all containments."""
    low = F.lower(F.col(col))
    equal = rules.where("exact").groupBy(F.col("pattern").alias("_p")).agg(F.min(F.struct("ord", "value"))["value"].alias("_equal"), F.lit(True).alias("_is"))
    within = rules.where("not exact").select("ord", "pattern", F.col("value").alias("_within"))
    rows = with_phrase(df.join(equal, low == F.col("_p"), "left").drop("_p"), low, within, "pattern", ["_within"])
    return rows.withColumn("value", F.when(F.col("_is"), F.col("_equal")).otherwise(F.col("_within"))).drop("_equal", "_is", "_within")


def ranked_rules(df: DataFrame, rules: DataFrame, test: Callable[[Column], Column], order: Callable[[Column], Sequence[Column]], take: Sequence[str]) -> DataFrame:
    """`df` with `take` of the first rule by `order` that passes `test` (both over a rule's struct);
    nulls without one.  The rules are a short list, and each row tests them by itself."""
    every = rule_array(rules, RULE_ROWS, RULE_BYTES)
    ranked = F.transform(F.filter(every, test), lambda r: F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order(r))], *[r[t].alias(t) for t in take]))
    found = df.withColumn("_hit", F.array_min(ranked))
    return found.withColumns({t: F.col(f"_hit.{t}") for t in take}).drop("_hit")
