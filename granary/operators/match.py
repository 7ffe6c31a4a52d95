"""Blocked entity matching: signatures, weighted similarity, tiers."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import match_name

from .candidates import SLACK, Candidates, best_by_rounds, edit_candidates, letter_counts, numbered, pair_candidates, shared_letters
from .relational import block_pairs, of_rows, percent, seeded_sample


def block_overlap(a: DataFrame, b: DataFrame, block: str) -> DataFrame:
    """Rows of each side per block, the pairs a join on it would make, and which side has it.
    Run it before a match: it shows the blocks that are too large to pair."""
    left, right = (x.groupBy(block).agg(F.count("*").alias(n)) for x, n in ((a, "n_left"), (b, "n_right")))
    both = left.join(right, block, "full_outer").na.fill(0, ["n_left", "n_right"])
    side = F.when(F.col("n_right") == 0, "left").when(F.col("n_left") == 0, "right").otherwise("both")
    return both.withColumns({"pairs": F.col("n_left") * F.col("n_right"), "side": side})


def signature(df: DataFrame, key: str, name: str, brand: str, stopwords: Sequence[str] = ()) -> DataFrame:
    """key, brand, clean name and its sorted distinct tokens."""
    clean = match_name(F.col(name), F.col(brand), stopwords)
    tokens = F.array_sort(F.array_distinct(F.filter(F.split(clean, " "), lambda w: w != "")))
    return df.withColumns({"clean_name": clean, "tokens": tokens})


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; 0 where both are empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    """Shared over the longer one's elements; 0 where both are empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.greatest(F.size(a), F.size(b)), F.lit(0)), F.lit(0.0))


def edit_similarity(a: str | Column, b: str | Column) -> Column:
    """1 - Levenshtein distance over the longer length; a null text counts as empty, two empty
    texts are equal."""
    x, y = (F.coalesce(c, F.lit("")) for c in (a, b))
    return F.coalesce(F.lit(1.0) - F.levenshtein(x, y) / F.nullif(F.greatest(F.length(x), F.length(y)), F.lit(0)), F.lit(1.0))


def char_ratio(a: str | Column, b: str | Column) -> Column:
    """The standard library's sequence ratio, where its exact value is wanted (Arrow batches)."""

    @F.pandas_udf("double")
    def ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            yield pd.Series([SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x, y, strict=True)])

    return ratio(a, b)


def ratio_bound(a: Column, b: Column, counts_a: Column, counts_b: Column) -> Column:
    """Upper bound of `char_ratio`: twice the letters that both have over all letters."""
    total = F.length(a) + F.length(b)
    return F.coalesce(F.lit(2.0) * shared_letters(counts_a, counts_b) / F.nullif(total, F.lit(0)), F.lit(1.0))


def match_ratio(a: DataFrame, b: DataFrame, block: str, name: str, id_a: str, id_b: str, least: float = 0.8) -> DataFrame:
    """id, match_id, score: the best partner in the block by the exact `char_ratio`, of at least `least`.

    A ratio of r means that the longer text has at most (2 - r) / r times the letters of the
    shorter, and that r of both texts' letters are shared: pairs meet by length, fail the bound
    by letters natively, and only the rest goes to Python, each pair of different names once.
    """
    return _of_values(a, ratio_pairs(a, b, block, name, id_b, least).withColumn("score", F.round(char_ratio(f"a_{name}", f"b_{name}"), 6)).where(F.col("score") >= least), block, [name], id_a)


def ratio_pairs(a: DataFrame, b: DataFrame, block: str, name: str, id_b: str, least: float) -> DataFrame:
    """_block, a_*, b_*, match_id: the pairs that the bounds leave for the exact ratio."""
    left, right = numbered(a, block, [name], "a"), numbered(b, block, [name], "b", F.min(id_b).alias("match_id"))
    text = lambda side: F.coalesce(F.col(f"{side}_{name}"), F.lit(""))
    x = left.select("_block", f"a_{name}", letter_counts(text("a")).alias("_c"), F.explode(F.sequence(F.ceil(F.length(text("a")) * (least / (2 - least)) - SLACK).cast("int"), F.floor(F.length(text("a")) * ((2 - least) / least) + SLACK).cast("int"))).alias("_n"))
    y = right.select("_block", f"b_{name}", "match_id", letter_counts(text("b")).alias("_d"), F.length(text("b")).alias("_n"))
    return x.join(y, ["_block", "_n"]).where(ratio_bound(text("a"), text("b"), F.col("_c"), F.col("_d")) >= least - SLACK).drop("_n", "_c", "_d")


def tier(score: Column, tiers: Sequence[tuple[str, float]], otherwise: str) -> Column:
    """Name of the first tier whose bound the score reaches."""
    out = F.lit(otherwise)
    for name, least in reversed(tiers):
        out = F.when(score >= least, F.lit(name)).otherwise(out)
    return out


def _best(a: DataFrame, b: DataFrame, block: str, id_a: str, id_b: str, cols: Sequence[str], score: Column, keep: Column | None = None) -> DataFrame:
    """id, match_id, score: highest score of each row of a in its block, smallest match_id of
    equals; pairs that fail `keep` (over score) don't count."""
    pairs = block_pairs(a, b, block, cols, F.min(id_b)).withColumn("score", score)
    pairs = pairs if keep is None else pairs.where(keep)
    own = [f"a_{c}" for c in cols]
    lead = pairs.groupBy(block, *own).agg(F.min(F.struct((-F.col("score")).alias("o"), "match_id")).alias("_b"))
    return of_rows(a, lead.select(block, *own, F.col("_b.match_id").alias("match_id"), (-F.col("_b.o")).alias("score")), block, cols, id_a)


def _of_values(a: DataFrame, pairs: DataFrame, block: str, cols: Sequence[str], id_a: str) -> DataFrame:
    """id, match_id, score of the best of scored `pairs` of values (_block, a_*, match_id, score)."""
    own = [f"a_{c}" for c in cols]
    lead = pairs.groupBy("_block", *own).agg(F.min(F.struct((-F.col("score")).alias("o"), "match_id")).alias("_b"))
    return of_rows(a, lead.select(F.col("_block").alias(block), *own, F.col("_b.match_id").alias("match_id"), (-F.col("_b.o")).alias("score")), block, cols, id_a)


#: Scores of the rounds of a search for the best partner; a part's bound below LOW parts too little.
ROUNDS, LOW = (0.95, 0.8, 0.65, 0.5), 0.3


def _by_rounds(a: DataFrame, b: DataFrame, block: str, id_a: str, id_b: str, cols: Sequence[str], score: Column, asks: Sequence[tuple[float, float]], candidates: Candidates, least: float | None = None, strictly: bool = False) -> DataFrame:
    """As `_best`, by rounds of (score, what the candidates are asked for)."""
    left, right = numbered(a, block, cols, "a"), numbered(b, block, cols, "b", F.min(id_b).alias("match_id"))
    best = best_by_rounds(left, right, score, [(bound, candidates, ask) for bound, ask in asks], least, strictly)
    found = best.join(left, "a_no").select(F.col("_block").alias(block), *[f"a_{c}" for c in cols], "match_id", "score")
    return of_rows(a, found, block, cols, id_a)


def match(a: DataFrame, b: DataFrame, block: str, id_a: str, id_b: str, parts: Mapping[str, tuple[float, Column]], cols: Sequence[str], tiers: Sequence[tuple[str, float]], otherwise: str = "rejected", places: int = 6, by: tuple[str, Candidates] | None = None) -> DataFrame:
    """Best partner of each row of a within its block by a weighted sum of similarity columns
    over `a_*` and `b_*` columns, each 1 at most, and its tier.  Rows without a partner are
    `otherwise`.

    `by` names a part and finds the pairs that reach a bound of it: a score can't be reached
    unless that part makes up for what the others can't give, so rounds of falling scores end
    with a proof.  Without it every pair of a block's different values is scored.
    """
    total = F.round(sum((F.lit(w) * c for w, c in parts.values()), F.lit(0.0)), places)
    if by is None:
        best = _best(a, b, block, id_a, id_b, cols, total)
    else:
        weight, rest = parts[by[0]][0], sum(w for n, (w, _) in parts.items() if n != by[0])
        asks = [(r, (r - rest) / weight - 2 * SLACK) for r in ROUNDS if LOW <= (r - rest) / weight <= 1]
        best = _by_rounds(a, b, block, id_a, id_b, cols, total, asks, by[1])
    every = a.select(F.col(id_a).alias("id")).join(best, "id", "left")
    return every.withColumn("tier", F.coalesce(tier(F.col("score"), tiers, otherwise), F.lit(otherwise)))


def match_exact_then_fuzzy(a: DataFrame, b: DataFrame, block: str, name: str, form: str, id_a: str, id_b: str, boost: float = 1.1, least: float = 0.5) -> DataFrame:
    """Equal block and name first (score 1, exact); the rest by edit similarity in the block,
    times `boost` where forms agree, at most 1, at least `least`."""
    exact = a.select(block, name, F.col(id_a).alias("id")).join(b.groupBy(block, name).agg(F.min(id_b).alias("match_id")), [block, name]).select("id", "match_id", F.lit(1.0).alias("score"), F.lit("exact").alias("how"))
    rest = a.join(exact.select(F.col("id").alias(id_a)), id_a, "left_anti")
    near = edit_similarity(F.col(f"a_{name}"), F.col(f"b_{name}"))
    raised = F.when(F.col(f"a_{form}") == F.col(f"b_{form}"), F.least(near * boost, F.lit(1.0))).otherwise(near)
    asks = [(r, r / boost) for r in (*[x for x in ROUNDS if x > least], least)]
    near_pairs = edit_candidates(F.col(f"a_{name}"), F.col(f"b_{name}"))
    fuzzy = _by_rounds(rest, b, block, id_a, id_b, [name, form], F.round(raised, 6), asks, near_pairs, least).withColumn("how", F.lit("fuzzy"))
    return exact.unionByName(fuzzy)


def match_tokens(a: DataFrame, b: DataFrame, block: str, tokens: str, id_a: str, id_b: str, least: int = 2) -> DataFrame:
    """Partner with most shared tokens, at least `least`; smallest id of equals.  Where two are
    asked for, pairs meet by two of their tokens."""
    shared = F.size(F.array_intersect(f"a_{tokens}", f"b_{tokens}")).cast("double")
    if least < 2:
        return _best(a, b, block, id_a, id_b, [tokens], shared, F.col("score") >= least)
    return _by_rounds(a, b, block, id_a, id_b, [tokens], shared, [(float(least), 0.0)], pair_candidates(F.col(f"a_{tokens}"), F.col(f"b_{tokens}")), float(least))


def match_variants(a: DataFrame, b: DataFrame, keys_a: Column, keys_b: Column, block: str, name: str, id_a: str, id_b: str, least: float = 0.8) -> DataFrame:
    """Any common key variation first (smallest id), then the best edit similarity over `least`
    in the block for the rest."""
    left = a.select(F.col(id_a).alias("id"), F.explode(F.array_distinct(keys_a)).alias("_k"))
    right = b.select(F.col(id_b).alias("match_id"), F.explode(F.array_distinct(keys_b)).alias("_k"))
    exact = left.join(right.groupBy("_k").agg(F.min("match_id").alias("match_id")), "_k").groupBy("id").agg(F.min("match_id").alias("match_id")).select("id", "match_id", F.lit(1.0).alias("score"), F.lit("key").alias("how"))
    rest = a.join(exact.select(F.col("id").alias(id_a)), id_a, "left_anti")
    near = F.round(edit_similarity(F.col(f"a_{name}"), F.col(f"b_{name}")), 6)
    near_pairs = edit_candidates(F.col(f"a_{name}"), F.col(f"b_{name}"))
    fuzzy = _by_rounds(rest, b, block, id_a, id_b, [name], near, [(least, least)], near_pairs, least, strictly=True)
    return exact.unionByName(fuzzy.withColumn("how", F.lit("fuzzy")))


def catalogue_overlap(a: DataFrame, b: DataFrame, block: str, name: str, id_a: str, improvable: Column) -> DataFrame:
    """Each row of a: exact (block and name known), new product of a known block, or new block;
    and whether the known row could be improved (`improvable`, over b)."""
    known = b.groupBy(block, name).agg(F.bool_or(improvable).alias("improvable"))
    blocks = b.select(block).distinct().withColumn("_known", F.lit(True))
    out = a.select(F.col(id_a).alias("id"), block, name).join(known, [block, name], "left").join(blocks, block, "left")
    kind = F.when(F.col("improvable").isNotNull(), "exact").when(F.col("_known"), "new product").otherwise("new brand")
    return out.select("id", kind.alias("kind"), F.coalesce("improvable", F.lit(False)).alias("improvable"))


def match_precision(matches: DataFrame, labels: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Share of a seeded sample of matches that is labelled right, per tier."""
    picked = seeded_sample(matches, key, n, seed).join(labels, key)
    return picked.groupBy("tier").agg(F.count("*").alias("n"), F.count_if("right").alias("n_right"), percent(F.count_if("right"), F.count("*")).alias("precision"))


def benchmark_accuracy(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows matched by the first of `keys` that finds a partner: how many, how many agree on
    `value`, and the rate."""
    value_b = b
    out = a
    for k in keys:
        out = out.join(value_b.groupBy(k).agg(F.min(value).alias(f"_{k}")), k, "left")
    theirs = F.coalesce(*[F.col(f"_{k}") for k in keys])
    met = out.select(F.col(value).alias("ours"), theirs.alias("theirs")).where(theirs.isNotNull())
    return met.agg(F.count("*").alias("matched"), F.count_if(F.col("ours") == F.col("theirs")).alias("agreed"), percent(F.count_if(F.col("ours") == F.col("theirs")), F.count("*")).alias("accuracy"))


def benchmark_mismatches(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, id_a: str) -> DataFrame:
    """id, by, ours, theirs: the rows that `benchmark_accuracy` counts as matched but not agreed,
    with the key that matched them.  A null on either side is no agreement."""
    out = a
    for k in keys:
        out = out.join(b.groupBy(k).agg(F.min(value).alias(f"_{k}")), k, "left")
    theirs = F.coalesce(*[F.col(f"_{k}") for k in keys])
    by = F.coalesce(*[F.when(F.col(f"_{k}").isNotNull(), F.lit(k)) for k in keys])
    met = out.select(F.col(id_a).alias("id"), by.alias("by"), F.col(value).alias("ours"), theirs.alias("theirs")).where(theirs.isNotNull())
    return met.where(~F.coalesce(F.col("ours") == F.col("theirs"), F.lit(False)))
