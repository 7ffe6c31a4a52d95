"""Consolidation: ranked merge with provenance, scores, overrides, profiles, environments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import best_per, block_pairs, of_rows, rank_rows, union_sources


def canonicalize(sources: Sequence[DataFrame], key: str, order: Sequence[Column], provenance: Sequence[str], fill: Sequence[str] = (), union: Sequence[str] = ()) -> DataFrame:
    """One row per key out of all sources.

    The winner is the first row by ascending `order` (end it with a unique column); `sources`
    is the array of all rows' `provenance` columns in that order.  `fill` columns take the first
    non-null value by the order, `union` columns (arrays) the sorted distinct elements of all
    rows.  One aggregation: structs are combined before the single shuffle.
    """
    rows = union_sources(sources)
    marks = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    rest = [c for c in rows.columns if c != key]
    keyed = rows.select(key, *rest, *marks)
    lead = F.struct(*[f"_o{i}" for i in range(len(order))])
    cells = [F.min_by(F.struct(*rest), lead).alias("_w"), F.sort_array(F.collect_list(F.struct(lead.alias("o"), F.struct(*provenance).alias("p")))).alias("_p")]
    cells += [F.min_by(c, F.when(F.col(c).isNotNull(), lead)).alias(f"_f_{c}") for c in fill]
    cells += [F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(f"_u_{c}") for c in union]
    out = keyed.groupBy(key).agg(*cells)
    made = [F.col(f"_f_{c}").alias(c) if c in fill else F.col(f"_u_{c}").alias(c) if c in union else F.col(f"_w.{c}").alias(c) for c in rest]
    return out.select(key, *made, F.transform("_p", lambda x: x["p"]).alias("sources"))


def score(weights: Mapping[str, float]) -> Column:
    """Sum of the weights of columns that are not null."""
    return reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(w * 0)) for c, w in weights.items()])


def publish(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def environment(df: DataFrame, allow: DataFrame, key: str, statuses: Sequence[str], keep_missing: bool = False) -> DataFrame:
    """Rows whose key has one of the statuses; with `keep_missing`, also those without one."""
    joined = df.join(allow.select(key, F.col("status").alias("_status")), key, "left")
    test = F.col("_status").isin(list(statuses))
    return joined.where(F.coalesce(test, F.lit(keep_missing))).drop("_status")


def label_environment(df: DataFrame, allow: DataFrame, key: str) -> DataFrame:
    joined = df.join(allow.select(key, F.col("status").alias("_status")), key, "left")
    name = F.when(F.col("_status") == "ACTIVE", "prod").when(F.col("_status") == "PENDING", "preview").when(F.col("_status").isNull(), "unlisted").otherwise("held")
    return joined.withColumn("environment", name).drop("_status")


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Each field from the override where it has one, and `<field>_from`: override, base or none."""
    over = overrides.select(key, *[F.col(f).alias(f"_v_{f}") for f in fields])
    joined = df.join(over, key, "left")
    cells = {}
    for f in fields:
        cells[f"{f}_from"] = F.when(F.col(f"_v_{f}").isNotNull(), "override").when(F.col(f).isNotNull(), "base").otherwise("none")
    joined = joined.withColumns(cells).withColumns({f: F.coalesce(F.col(f"_v_{f}"), F.col(f)) for f in fields})
    return joined.drop(*[f"_v_{f}" for f in fields])


def profile(tables: Sequence[DataFrame], key: str, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """Left joins of `tables` (key unique in each); each field is the first non-null of the
    columns that `spec` lists for it."""
    out = reduce(lambda a, b: a.join(b, key, "left"), tables)
    return out.select(key, *[F.coalesce(*[F.col(c) for c in cols]).alias(f) for f, cols in spec.items()])


def similar_to(df: DataFrame, key: str, value: object, weights: Mapping[str, float], k: int) -> DataFrame:
    """The k rows that agree most, by weight, with the row of `value`; ties by key."""
    one = df.where(F.col(key) == value).select(*[F.col(c).alias(f"_s_{c}") for c in weights]).limit(1)
    total = reduce(lambda a, b: a + b, [F.when(F.col(c) == F.col(f"_s_{c}"), F.lit(w)).otherwise(F.lit(w * 0)) for c, w in weights.items()])
    near = df.where(F.col(key) != value).join(F.broadcast(one)).select(key, total.alias("similarity"))
    return near.orderBy(F.desc("similarity"), key).limit(k)


def similar_all(df: DataFrame, key: str, block: str, weights: Mapping[str, float], k: int) -> DataFrame:
    """The same for every row at once, within blocks.

    Rows of equal attributes are as similar to any other, so the different combinations of a
    block are paired in their place, each with its k + 1 smallest keys (one may be the row
    itself); only the best of those meet the rows.
    """
    cols = list(weights)
    few = rank_rows(df.where(F.col(block).isNotNull()).select(block, key, *cols), [block, *cols], [F.asc(key)]).where(F.col("rank") <= k + 1)
    pairs = block_pairs(df, few, block, cols, F.array_sort(F.collect_list(key)))
    total = reduce(lambda x, y: x + y, [F.when(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(w)).otherwise(F.lit(w * 0)) for c, w in weights.items()])
    own = [f"a_{c}" for c in cols]
    near = pairs.select(block, *own, total.alias("similarity"), F.explode("match_id").alias("other"))
    best = rank_rows(near, [block, *own], [F.desc("similarity"), F.asc("other")]).where(F.col("rank") <= k + 1).drop("rank")
    found = of_rows(df, best, block, cols, key).where(F.col("id") != F.col("other"))
    return rank_rows(found, ["id"], [F.desc("similarity"), F.asc("other")]).where(F.col("rank") <= k)


def resolve_eav(eav: DataFrame, entity: str, field: str, value: str, order: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """Best value of each (entity, field) by `order`, one column per field."""
    best = best_per(eav.where(F.col(value).isNotNull()), [entity, field], order)
    return best.groupBy(entity).pivot(field, list(fields)).agg(F.first(value))


def resolve_conflict(df: DataFrame, current: str, current_source: str, new: str, new_source: str, authority: Mapping[str, int]) -> DataFrame:
    """`value` and `value_source`: the new one if its source has more authority, or there is no
    current one; equals keep the current one."""
    rank = F.create_map(*[F.lit(x) for kv in authority.items() for x in kv])
    of = lambda c: F.coalesce(F.try_element_at(rank, F.col(c)), F.lit(0))
    take = F.col(new).isNotNull() & (F.col(current).isNull() | (of(new_source) > of(current_source)))
    return df.withColumns({"value": F.when(take, F.col(new)).otherwise(F.col(current)), "value_source": F.when(take, F.col(new_source)).otherwise(F.col(current_source))})


def attach_published(df: DataFrame, versions: DataFrame, key: str, status: str, order: Sequence[Column], take: Sequence[str]) -> DataFrame:
    """`take` columns of the first published version of each key; null without one."""
    live = best_per(versions.where(F.col(status) == "published").select(key, *take, *[o.alias(f"_k{i}") for i, o in enumerate(order)]), [key], [F.col(f"_k{i}") for i in range(len(order))])
    return df.join(live.select(key, *take), key, "left")


def offer_summary(df: DataFrame, by: Sequence[str], retailer: str, price: str, stock: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("n_offers"), F.countDistinct(retailer).alias("n_retailers"), F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.array_join(F.sort_array(F.collect_set(F.col(retailer).cast("string"))), ",").alias("retailers"), F.bool_or(F.col(stock) > 0).alias("in_stock"),
    )
