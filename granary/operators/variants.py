"""Duplicates and variants: groups, winners, gap filling, migration with a log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import PACK, match_name

from .consolidate import score
from .relational import best_per


def duplicate_groups(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """Keys that two rows or more share, with the count and the smallest id."""
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id")).where("n > 1")


def merge_duplicates(df: DataFrame, key: Column, id_col: str, weights: Mapping[str, float], fill: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(winners, log).  The winner of a key has the highest score (weights of present columns),
    smallest id of equals; its empty `fill` columns take the first value of the others in that
    order.  The log has a row for each filled cell: id, field, from_id."""
    order = F.struct((-score(weights)).alias("s"), F.col(id_col).alias("i"))
    rows = df.withColumns({"_key": key, "_order": order})
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct("_order", F.col(c).alias("v")))).alias(f"_f_{c}") for c in fill]
    rest = [c for c in df.columns if c not in fill]
    merged = rows.groupBy("_key").agg(F.min_by(F.struct(*df.columns), "_order").alias("_w"), F.count("*").alias("n_merged"), *first)
    winners = merged.select(*[F.col(f"_w.{c}").alias(c) for c in rest], *[F.coalesce(F.col(f"_w.{c}"), F.col(f"_f_{c}.v")).alias(c) for c in fill], "n_merged")
    cells = [F.when(F.col(f"_w.{c}").isNull() & F.col(f"_f_{c}").isNotNull(), F.struct(F.col(f"_w.{id_col}").alias("id"), F.lit(c).alias("field"), F.col(f"_f_{c}._order.i").alias("from_id"))) for c in fill]
    log = merged.select(F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))
    return winners, log


def keep_best(df: DataFrame, key: Sequence[str], weights: Mapping[str, float], tiebreak: Column) -> DataFrame:
    return best_per(df, key, [-score(weights), tiebreak])


def flag_suspicious(df: DataFrame, name: str, brand: str, generic: Sequence[str], min_len: int = 8) -> DataFrame:
    """`reason` (name is brand, too short, generic) and `decision` (delete, review, keep)."""
    low = F.lower(F.trim(name))
    reason = F.when(low == F.lower(F.trim(brand)), "name is brand").when(F.length(low) < min_len, "too short").when(low.isin(list(generic)), "generic")
    return df.withColumn("reason", reason).withColumn("decision", F.when(F.col("reason") == "name is brand", "delete").when(F.col("reason").isNotNull(), "review").otherwise("keep"))


def variant_type(col: Column) -> Column:
    """size, pack, size_and_pack or null, by a figure with a unit and a multiple or pack word."""
    low = F.lower(col)
    size = F.regexp_like(low, F.lit(r"[0-9]+([.,][0-9]+)? *(kg|g|lb|oz|ml|l)\b"))
    pack = F.regexp_like(low, F.lit(r"[0-9]+ *x *[0-9]|\b(pack|multipack|box) of [0-9]+|[0-9]+ ?-?pack\b"))
    return F.when(size & pack, "size_and_pack").when(size, "size").when(pack, "pack")


def base_name(col: Column, brand: Column | None = None) -> Column:
    """The name without sizes and packs."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(col), PACK, " "), r"\b(pack|multipack|box) of [0-9]+|[0-9]+ ?-?pack\b", " ")
    return match_name(bare, brand)


def variant_groups(df: DataFrame, name: str, brand: str, id_col: str) -> DataFrame:
    """Groups of two rows or more with one brand and base name, of which a row has a size or pack."""
    rows = df.select(F.col(brand).alias("brand"), base_name(F.col(name)).alias("base"), F.col(id_col).alias("id"), variant_type(F.col(name)).alias("kind"))
    groups = rows.groupBy("brand", "base").agg(F.count("*").alias("n"), F.count("kind").alias("n_variants"), F.min("id").alias("first_id"))
    return groups.where((F.col("n") > 1) & (F.col("n_variants") > 0))


def pick_parent(df: DataFrame, key: Sequence[str], weights: Mapping[str, float], name: str, id_col: str) -> DataFrame:
    """Best row of each key by score less a hundredth of the name's length; smallest id of equals."""
    return best_per(df, key, [F.round(F.length(name) * 0.01 - score(weights), 6), F.col(id_col)])


def group_consistency(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values of each column per group, and whether none has more than one."""
    got = df.groupBy(*key).agg(F.count("*").alias("n"), *[F.countDistinct(c).alias(f"n_{c}") for c in cols])
    fine = F.lit(True)
    for c in cols:
        fine = fine & (F.col(f"n_{c}") <= 1)
    return got.withColumn("consistent", fine)


def migrate_variants(df: DataFrame, key: Column, id_col: str, weights: Mapping[str, float], fill: Sequence[str], name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parents, variants, log): winners of each key with gaps filled; the other rows, with
    their parent, kind and the row as JSON; and the filled cells."""
    parents, log = merge_duplicates(df, key, id_col, weights, fill)
    of = parents.select(F.col(id_col).alias("parent_id"), key.alias("_key"))
    rows = df.withColumns({"_key": key, "original": F.to_json(F.struct(*df.columns))})
    variants = rows.join(of, "_key").where(F.col(id_col) != F.col("parent_id")).select("parent_id", F.col(id_col).alias("variant_id"), variant_type(F.col(name)).alias("kind"), "original")
    return parents, variants, log


def rollup_variants(df: DataFrame, key: Sequence[str], size: str, price: str, rating: str) -> DataFrame:
    """Sorted sizes, price range, upper median (element n // 2), counts and best rating."""
    prices = F.sort_array(F.collect_list(price))
    got = df.groupBy(*key).agg(F.count("*").alias("n"), F.sort_array(F.collect_set(size)).alias("sizes"), F.min(price).alias("min_price"), F.max(price).alias("max_price"), prices.alias("_p"), F.max(rating).alias("best_rating"))
    return got.withColumn("median_price", F.try_element_at("_p", (F.floor(F.size("_p") / 2) + 1).cast("int"))).drop("_p")


def verify_conservation(before: DataFrame, parents: DataFrame, variants: DataFrame, id_col: str) -> DataFrame:
    """(check, value, passed): rows before, parents, variants, and ids lost or doubled."""
    kept = parents.select(F.col(id_col).alias("id")).unionByName(variants.select(F.col("variant_id").alias("id")))
    lost = before.select(F.col(id_col).alias("id")).join(kept, "id", "left_anti").agg(F.count("*").alias("lost"))
    doubled = kept.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("doubled"))
    n = before.agg(F.count("*").alias("before")).crossJoin(parents.agg(F.count("*").alias("parents"))).crossJoin(variants.agg(F.count("*").alias("variants"))).crossJoin(lost).crossJoin(doubled)
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"), t.alias("passed")) for c, t in (("before", F.lit(True)), ("parents", F.lit(True)), ("variants", F.col("parents") + F.col("variants") == F.col("before")), ("lost", F.col("lost") == 0), ("doubled", F.col("doubled") == 0))]
    return n.select(F.inline(F.array(*cells)))


def variant_summary(parents: DataFrame, variants: DataFrame, id_col: str) -> DataFrame:
    """Each parent with its number of variants, whether it has any, and their ids."""
    per = variants.groupBy("parent_id").agg(F.count("*").alias("n_variants"), F.array_join(F.transform(F.sort_array(F.collect_list("variant_id")), lambda x: x.cast("string")), ",").alias("variant_ids"))
    joined = parents.select(F.col(id_col).alias("parent_id")).join(per, "parent_id", "left")
    return joined.select("parent_id", F.coalesce("n_variants", F.lit(0)).alias("n_variants"), F.col("n_variants").isNotNull().alias("has_variants"), "variant_ids")


def one_per_url(df: DataFrame, url: Column, prefer: str, id_col: str) -> DataFrame:
    """One row per base URL, first those that have `prefer`, then the smallest id; and its rows."""
    lead = F.min(F.struct(F.col(prefer).isNull().alias("o"), F.col(id_col).alias("id"), F.col(prefer).alias("value")))
    return df.groupBy(url.alias("base_url")).agg(F.count("*").alias("n"), lead.alias("_b")).select("base_url", "n", "_b.id", "_b.value")


def with_rules(df: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Left join to a small rule table (its size is checked before it is broadcast)."""
    return df.join(rules, key, "left")
