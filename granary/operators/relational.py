"""Projection, filters, joins, aggregation, ranking and set operations by parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.text import is_present

from .candidates import contained, numbered, stored
from .phrases import phrase_hits, rule_array

#: Rows and bytes up to which each row tests every rule of a list.
RULE_ROWS, RULE_BYTES = 100_000, 16 << 20


# Projection and filters


def to_canonical(df: DataFrame, mapping: Mapping[str, Column | None], types: Mapping[str, str]) -> DataFrame:
    """`types`' columns in order: mapped ones cast, others typed nulls."""
    cells = []
    for name, kind in types.items():
        col = mapping.get(name)
        cells.append((F.lit(None) if col is None else col).cast(kind).alias(name))
    return df.select(*cells)


def facet_filter(df: DataFrame, **options: object) -> DataFrame:
    """Rows that meet each option that isn't None: lists by membership, pairs `(low, high)` by
    range (either may be None), other values by equality."""
    for name, want in options.items():
        if want is None:
            continue
        if isinstance(want, list):
            df = df.where(F.col(name).isin(want))
        elif isinstance(want, tuple):
            low, high = want
            df = df if low is None else df.where(F.col(name) >= low)
            df = df if high is None else df.where(F.col(name) <= high)
        else:
            df = df.where(F.col(name) == want)
    return df


def get_one(df: DataFrame, **key: object) -> DataFrame:
    """At most one row with the key; the smallest of all columns in order if there are more."""
    return facet_filter(df, **key).orderBy(*df.columns).limit(1)


def complete_only(df: DataFrame, cols: Sequence[str], arrays: Sequence[str] = ()) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [is_present(F.col(c), "array" if c in arrays else "any") for c in cols]))


def ready_rows(df: DataFrame, confidence: str, least: float, state: str, approved: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return complete_only(df.where((F.col(confidence) >= least) & F.col(state).isin(list(approved))), cols)


# Joins


def left_chain(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Left joins on one key; each table must have a key once, so no row is repeated: rows of a
    table beyond the first of a key (by all columns) are not joined."""
    for table in tables:
        rest = [c for c in table.columns if c != key]
        one = table.groupBy(key).agg(F.min(F.struct(*rest)).alias("_one")).select(key, "_one.*")
        base = base.join(one, key, "left")
    return base


def left_where(a: DataFrame, b: DataFrame, key: str, keep_b: Column) -> DataFrame:
    """Left join with further predicates on b in the ON clause: b is filtered first."""
    return a.join(b.where(keep_b), key, "left")


def cross_source_pairs(df: DataFrame, keys: Sequence[str], source: str, columns: Sequence[str]) -> DataFrame:
    """Pairs of rows with equal keys from two different sources, each pair once."""
    a = df.select(*keys, *[F.col(c).alias(f"{c}_a") for c in columns])
    b = df.select(*keys, *[F.col(c).alias(f"{c}_b") for c in columns])
    return a.join(b, list(keys)).where(F.col(f"{source}_a") < F.col(f"{source}_b"))


#: Parts that the pairs of a block are dealt to.
SALT = 8


def block_pairs(a: DataFrame, b: DataFrame, block: str, cols: Sequence[str], b_id: Column) -> DataFrame:
    """Pairs in a block of the different values of `cols` on either side (a_*, b_*), with `match_id`,
    an aggregate of the right side's rows.

    What a pair scores depends on `cols` alone, so equal rows are combined before they are
    paired.  A block's left values are dealt to SALT parts, each of which meets all of its
    right ones: a hot block is not one task's.
    """
    left = a.select(block, *[F.col(c).alias(f"a_{c}") for c in cols]).where(F.col(block).isNotNull()).distinct()
    right = b.groupBy(block, *cols).agg(b_id.alias("match_id")).select(block, "match_id", *[F.col(c).alias(f"b_{c}") for c in cols])
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*[f"a_{c}" for c in cols]), F.lit(SALT)).cast("int"))
    return left.join(right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), [block, "_salt"]).drop("_salt")


def of_rows(a: DataFrame, found: DataFrame, block: str, cols: Sequence[str], id_a: str) -> DataFrame:
    """`found` (block, a_* and others) for each row of `a`: id and the others."""
    rows = a.select(F.col(block).alias("_block"), F.col(id_a).alias("id"), *[F.col(c).alias(f"_r_{c}") for c in cols])
    on = [F.col("_block") == F.col(block)] + [F.col(f"_r_{c}").eqNullSafe(F.col(f"a_{c}")) for c in cols]
    rest = [c for c in found.columns if c != block and c not in {f"a_{x}" for x in cols}]
    return rows.join(found, reduce(lambda x, y: x & y, on)).select("id", *rest)


#: Rows of a value in one of its lists, about; pairs of rows that a task makes, and such tasks at most.
LISTED, PAIRS, TASKS = 256, 1 << 21, 10_000


def listed(rows: DataFrame, values: DataFrame, side: str, block: str, name: str, key: str) -> DataFrame:
    """`side`_no, `side`_part, `side`_ids: the keys (nulls too) of the rows of each of `values`, about LISTED in a part."""
    own = rows.select(F.col(block).alias("_in"), F.col(name).alias("_name"), F.col(key).alias("_id"), F.monotonically_increasing_id().alias("_at"))
    own = stored(own.where(F.col("_in").isNotNull() & F.col("_name").isNotNull()), f"rows_{side}")
    of = values.select("_block", f"{side}_no", F.col(f"{side}_{name}").alias("_value"), F.ceil(F.col("_rows") / LISTED).alias("_parts"))
    own = own.join(of, (F.col("_in") == F.col("_block")) & (F.col("_name") == F.col("_value")))
    nulls = F.array_repeat(F.lit(None).cast(own.schema["_id"].dataType), F.count_if(F.col("_id").isNull()).cast("int"))
    return own.groupBy(f"{side}_no", F.pmod(F.xxhash64("_at"), "_parts").alias(f"{side}_part")).agg(F.concat(F.collect_list("_id"), nulls).alias(f"{side}_ids"))


def list_pairs(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """For `pairs` of values (a_no, a_rows, b_no, b_rows and others), each two of their lists: a_ids,
    b_ids and the others.  Lists are joined and shuffled, not rows, so that a value's many rows
    don't meet in one task: they are dealt to tasks of about PAIRS pairs of rows."""
    made = pairs.agg(F.sum(F.col("a_rows") * F.col("b_rows"))).first()[0] or 0
    for side, lists in (("a", a), ("b", b)):
        last = F.ceil(F.col(f"{side}_rows") / LISTED) - 1
        pairs = pairs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias(f"{side}_part"))
    cells = pairs.join(a, ["a_no", "a_part"]).join(b, ["b_no", "b_part"])
    cells = cells.repartition(min(TASKS, made // PAIRS + 1), "a_no", "a_part", "b_no", "b_part")
    return cells.drop("a_no", "a_rows", "a_part", "b_no", "b_rows", "b_part")


def block_contains_match(a: DataFrame, b: DataFrame, block: str, name: str, id_a: str, id_b: str, exact: float = 0.95, within: float = 0.8) -> DataFrame:
    """Pairs in a block whose names are equal (confidence `exact`) or contain one another
    (`within`).  Different names meet by the rarest run of letters of the one that is within the
    other; rows come after, as lists of the ids of a name."""
    left, right = (numbered(x, block, [name], n).withColumn("_text", F.col(f"{n}_{name}")) for x, n in ((a, "a"), (b, "b")))
    met = contained(right, left, "b", "a").select(F.col("text_no").alias("a_no"), F.col("needle_no").alias("b_no"))
    met = met.unionByName(contained(left, right, "a", "b").select(F.col("needle_no").alias("a_no"), F.col("text_no").alias("b_no"))).distinct()
    pairs = met.join(left.select("a_no", f"a_{name}", F.col("_rows").alias("a_rows")), "a_no").join(right.select("b_no", f"b_{name}", F.col("_rows").alias("b_rows")), "b_no")
    sure = F.when(F.col(f"a_{name}") == F.col(f"b_{name}"), F.lit(exact)).otherwise(F.lit(within))
    pairs = stored(pairs.select("a_no", "a_rows", "b_no", "b_rows", sure.alias("confidence")), "pairs")
    cells = list_pairs(pairs, listed(a, left, "a", block, name, id_a), listed(b, right, "b", block, name, id_b))
    return cells.select(F.explode("a_ids").alias("id_a"), "b_ids", "confidence").select("id_a", F.explode("b_ids").alias("id_b"), "confidence")


def rule_cross(df: DataFrame, rules: DataFrame, text: str, pattern: str, literal: str | None = None) -> DataFrame:
    """Pairs of rows and rules whose pattern is found in the text.

    With `literal`, a column of text that any match of the pattern contains, one automaton of all
    literals finds the few rules that a row has to test, so rules may be many.  Without it each
    row tests a short list (checked).  No row is shuffled and no product formed.
    """
    if literal is None:
        hits = F.filter(rule_array(rules, 10_000, RULE_BYTES), lambda r: F.regexp_like(F.col(text), r[pattern]))
        return df.withColumn("_rule", F.explode(hits)).select("*", *[F.col(f"_rule.`{c}`").alias(c) for c in rules.columns]).drop("_rule")
    numbered = stored(rules.coalesce(1).withColumn("_no", F.monotonically_increasing_id().cast("int")), "rules")
    hits = df.withColumn("_hit", F.explode(phrase_hits(F.col(text), numbered, literal, "_no")))
    return hits.join(numbered, F.col("_hit") == F.col("_no")).where(F.expr(f"`{text}` rlike `{pattern}`")).drop("_hit", "_no")


def semi_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), list(keys), "left_semi")


def anti_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a without a partner in b; null keys never have one, so they stay."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def anti_within(a: DataFrame, b: DataFrame, key: str, time_a: str, time_b: str, gap: Column) -> DataFrame:
    """Rows of a for which b has no row of the key later than its own time less `gap`; only the
    latest time of each key matters, so b is aggregated first."""
    last = b.groupBy(key).agg(F.max(time_b).alias("_last"))
    return a.join(last, key, "left").where(F.col("_last").isNull() | (F.col("_last") <= F.col(time_a) - gap)).drop("_last")


def either_key_join(a: DataFrame, b: DataFrame, first: Sequence[str], second: Sequence[str], id_a: str, value_b: str) -> DataFrame:
    """Partner of each row of a by the first key, else by the second: two equi joins in place
    of an OR join.  Columns: id, value, by (1 or 2); one row for each row of a that has one."""
    found = []
    for n, keys in enumerate((first, second), 1):
        best = b.groupBy(*keys).agg(F.min(value_b).alias("value"))
        found.append(a.join(best, list(keys)).select(F.col(id_a).alias("id"), "value", F.lit(n).alias("by")))
    both = found[0].unionByName(found[1])
    return both.groupBy("id").agg(F.min_by("value", "by").alias("value"), F.min("by").alias("by"))


def cascade_match(a: DataFrame, b: DataFrame, tiers: Sequence[tuple[str, Sequence[str], float]], id_a: str, id_b: str) -> DataFrame:
    """First tier (name, keys, confidence) that finds a partner, smallest id of b in it; rows
    without one are `new` with confidence 0.  A row for each row of a."""
    out = a
    for i, (_, keys, _c) in enumerate(tiers):
        best = b.groupBy(*keys).agg(F.min(id_b).alias(f"_t{i}"))
        out = out.join(best, list(keys), "left")
    tests = [F.col(f"_t{i}").isNotNull() for i in range(len(tiers))]
    kind, sure = F.lit("new"), F.lit(0.0)
    for test, (name, _, confidence) in reversed(list(zip(tests, tiers, strict=True))):
        kind, sure = F.when(test, F.lit(name)).otherwise(kind), F.when(test, F.lit(confidence)).otherwise(sure)
    return out.select(F.col(id_a).alias("id"), F.coalesce(*[F.col(f"_t{i}") for i in range(len(tiers))]).alias("match_id"), kind.alias("match_type"), sure.alias("confidence"))


# Aggregation


def conditional_counts(df: DataFrame, by: Sequence[str], specs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(n) for n, c in specs.items()])


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(part * 100.0 / F.nullif(whole, F.lit(0)), places)


def coverage_pct(df: DataFrame, by: Sequence[str], cols: Mapping[str, Column]) -> DataFrame:
    """Share of rows with each column present, in per cent; an empty group gives null."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[percent(F.count_if(is_present(c, "any")), F.count("*")).alias(f"{n}_pct") for n, c in cols.items()])


def mean_coverage(cols: Sequence[str], places: int = 2) -> Column:
    return F.round(reduce(lambda a, b: a + b, [F.col(c) for c in cols]) / len(cols), places)


def collect_ordered(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: Sequence[str], out: str) -> DataFrame:
    """Array of structs of `value` columns, ordered: order keys lead the sorted structs."""
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    gathered = F.sort_array(F.collect_list(F.struct(*keys, *value)))
    return df.groupBy(*by).agg(F.transform(gathered, lambda x: F.struct(*[x[v].alias(v) for v in value])).alias(out))


def collect_distinct(df: DataFrame, by: Sequence[str], col: str, sep: str = ", ") -> DataFrame:
    return df.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_set(col)), sep).alias(col))


def first_present(df: DataFrame, by: Sequence[str], cols: Sequence[str], order: Column) -> DataFrame:
    """First non-null value of each column by `order`; ties by the smaller value."""
    return df.groupBy(*by).agg(*[F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))["v"].alias(c) for c in cols])


def union_arrays(df: DataFrame, by: Sequence[str], arr: str) -> DataFrame:
    """Sorted distinct elements of a group's arrays; combined before the shuffle."""
    return df.select(*by, F.explode_outer(arr).alias("_x")).groupBy(*by).agg(F.sort_array(F.collect_set("_x")).alias(arr))


def distinct_sketches(df: DataFrame, by: Sequence[str], col: str, lg_k: int = 14) -> DataFrame:
    """`by`, sketch, n: a HyperLogLog sketch of the different values of `col` for each group, to be
    stored and united; its error is about 1.04 / sqrt(2 ** lg_k), 0.8 % for 14."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, F.lit(lg_k)).alias("sketch"), F.count(col).alias("n"))


def united(sketches: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """`by`, n_distinct, n: estimates of coarser groups from stored sketches, without the rows."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"), F.sum("n").alias("n"))


def median_by(df: DataFrame, by: Sequence[str], col: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75), exact: bool = True) -> DataFrame:
    """Quantiles; exact ones come from counts of values, approximate ones from sketches."""
    if not exact:
        got = F.percentile_approx(col, list(quantiles), 10_000)
        return df.groupBy(*by).agg(*[got[i].alias(f"q{round(q * 100)}") for i, q in enumerate(quantiles)])
    return df.groupBy(*by).agg(*[F.percentile(col, q).alias(f"q{round(q * 100)}") for q in quantiles])


def share_by(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Group counts and their share of all; the total is over groups, not rows."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


def mode_by(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Most common value of a group, the smallest of equals, and its count."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("o"), F.col(col).alias("v")))
    return counts.groupBy(*by).agg(best.alias("_b")).select(*by, F.col("_b.v").alias(col), (-F.col("_b.o")).alias("n"))


def token_freq(df: DataFrame, arr: Column, n: int | None = None) -> DataFrame:
    counts = df.select(F.explode(arr).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counts if n is None else counts.orderBy(F.desc("n"), "token").limit(n)


def counts_as_rows(df: DataFrame, specs: Mapping[str, Column]) -> DataFrame:
    """(check, value) rows out of one aggregation in place of a scan for each."""
    names = list(specs)
    one = df.agg(*[F.count_if(specs[n]).alias(f"_{i}") for i, n in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"_{i}").alias("value")) for i, n in enumerate(names)])
    return one.select(F.inline(cells))


def bin_counts(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Counts by right-closed bins; values outside them (and nulls) under null."""
    name = F.lit(None).cast("string")
    for low, high, text in zip(edges[:-1], edges[1:], labels, strict=True):
        name = F.when((F.col(col) > low) & (F.col(col) <= high), F.lit(text)).otherwise(name)
    return df.groupBy(name.alias("bin")).agg(F.count("*").alias("n"))


def delta_stats(before: DataFrame, after: DataFrame, by: str, specs: Mapping[str, Column]) -> DataFrame:
    """Counts of each spec before, after and their difference, a row per group."""
    sides = []
    for name, df in (("before", before), ("after", after)):
        sides.append(df.groupBy(by).agg(*[F.count_if(c).alias(f"{n}_{name}") for n, c in specs.items()]))
    both = sides[0].join(sides[1], by, "full_outer")
    cells = []
    for n in specs:
        b, a = (F.coalesce(F.col(f"{n}_{s}"), F.lit(0)) for s in ("before", "after"))
        cells += [b.alias(f"{n}_before"), a.alias(f"{n}_after"), (a - b).alias(f"{n}_delta")]
    return both.select(by, *cells)


# Ranking, ordering, sampling


def rank_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def best_per(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ascending `order` (nulls first) - one partial aggregation,
    so a large group is not gathered."""
    rest = [c for c in df.columns if c not in key]
    lead = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *rest))
    return df.groupBy(*key).agg(lead.alias("_b")).select(*key, *[F.col(f"_b.{c}").alias(c) for c in rest])


def with_total(df: DataFrame, col: str, out: str = "total") -> DataFrame:
    return df.crossJoin(F.broadcast(df.agg(F.sum(col).alias(out))))


def order_custom(df: DataFrame, col: str, ranks: Sequence[str], then: Sequence[str] = ()) -> DataFrame:
    rank = F.lit(len(ranks))
    for i, v in reversed(list(enumerate(ranks))):
        rank = F.when(F.col(col) == v, F.lit(i)).otherwise(rank)
    return df.orderBy(rank, *then)


def page(df: DataFrame, order: Sequence[Column | str], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def top_bottom(df: DataFrame, metric: str, key: str, n: int) -> DataFrame:
    top = df.orderBy(F.desc_nulls_last(metric), key).limit(n).withColumn("side", F.lit("top"))
    return top.unionByName(df.orderBy(F.asc_nulls_last(metric), key).limit(n).withColumn("side", F.lit("bottom")))


def rows_of_top_groups(df: DataFrame, by: str, k: int) -> DataFrame:
    top = df.groupBy(by).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), by).limit(k)
    return df.join(F.broadcast(top.select(by)), by, "left_semi")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows of smallest md5 of seed and key: the same rows in every run and plan."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


# Sets


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Each key of either side with where it is: both, left or right."""
    left = a.select(key).distinct().withColumn("_l", F.lit(1))
    right = b.select(key).distinct().withColumn("_r", F.lit(1))
    side = F.when(F.col("_l").isNull(), F.lit("right")).when(F.col("_r").isNull(), F.lit("left")).otherwise(F.lit("both"))
    return left.join(right, key, "full_outer").select(key, side.alias("side"))
