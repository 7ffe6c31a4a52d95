"""Pairs of a block that can reach a least similarity, by equi joins on what such pairs must share.

Both kinds are complete: a pair that reaches the bound is among the candidates, and those that
can't share a key are never formed.  `best_by_rounds` turns them into a search for the best
partner with a proof: a value whose best candidate reaches the bound of a round has its best
partner, since every pair at or above that bound was a candidate; only the others go on to
the next, lower bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.sources.files import scratch

#: What rounding may take from a similarity.
SLACK = 1e-6

#: Bound of an edit similarity below which texts meet by length.
BY_LENGTH = 0.6
#: Characters that are counted apart; all others together.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "

Candidates = Callable[[DataFrame, DataFrame, float], DataFrame]


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: of a known size, and computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, block: str, cols: Sequence[str], side: str, *more: Column) -> DataFrame:
    """block, `side`_no and `side`_* of the different values of `cols`, with aggregates `more`; numbers
    are those of a stored table, so they stay."""
    rows = df.where(F.col(block).isNotNull()).groupBy(block, *cols).agg(F.count("*").alias("_rows"), *more)
    return stored(rows.select(F.col(block).alias("_block"), F.monotonically_increasing_id().alias(f"{side}_no"), *[F.col(c).alias(f"{side}_{c}") for c in cols], *[c for c in rows.columns if c not in (block, *cols)]), f"values_{side}")


def letter_counts(text: Column) -> Column:
    """How often each of LETTERS occurs, and how many characters are none of them."""
    each = [F.length(text) - F.length(F.translate(text, c, "")) for c in LETTERS]
    return F.array(*each, F.length(F.translate(text, LETTERS, "")))


def shared_letters(a: Column, b: Column) -> Column:
    """Upper bound of the characters that two texts have in common, from their `letter_counts`."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, v: s + v)


def token_candidates(tokens_a: Column, tokens_b: Column) -> Candidates:
    """Pairs with a Jaccard similarity of at least the bound: they share one of the left side's
    rarest tokens, all but as many as they must share less one, and their sizes are near."""

    def find(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
        post = right.select("_block", "b_no", F.array_distinct(F.array_compact(tokens_b)).alias("_t")).select("_block", "b_no", F.size("_t").alias("_m"), F.explode("_t").alias("_token"))
        often = post.groupBy("_block", "_token").agg(F.count("*").alias("_n"))
        own = left.select("_block", "a_no", F.array_distinct(F.array_compact(tokens_a)).alias("_t")).select("_block", "a_no", F.size("_t").alias("_k"), F.explode("_t").alias("_token"))
        rank = F.row_number().over(Window.partitionBy("_block", "a_no").orderBy(F.coalesce("_n", F.lit(0)), "_token"))  # a name's tokens
        must = F.ceil(F.col("_k") * (least - SLACK))
        keys = own.join(often, ["_block", "_token"], "left").withColumn("_rank", rank).where(F.col("_n").isNotNull() & (F.col("_rank") <= F.col("_k") - F.greatest(must, F.lit(1)) + 1))
        near = (F.col("_m") >= F.col("_k") * (least - SLACK)) & (F.col("_k") >= F.col("_m") * (least - SLACK))
        return keys.join(post, ["_block", "_token"]).where(near).select("a_no", "b_no").distinct()

    return find


def edit_candidates(text_a: Column, text_b: Column) -> Candidates:
    """Pairs with an edit similarity (1 - distance over the longer length) of at least the bound.

    Within k edits one of k + 1 segments of the right text is found unchanged in the left one, at
    most k places away, so both sides meet by right length, k, number and text of the segment.
    Pairs of empty texts are equal.  Below BY_LENGTH segments are single letters and part nothing:
    there, values meet by length, and those that share too few letters are left out.
    """

    def find(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
        least = max(least - SLACK, 0.05)
        edits = lambda x, y: F.floor(F.greatest(x, y) * (1 - least)).cast("int")
        lengths = lambda n: F.sequence(F.ceil(n * least).cast("int"), F.floor(n / least).cast("int"))
        begin = lambda i, n, k: F.floor(i * n / (F.coalesce(k, F.lit(0)) + 1)).cast("int")
        cut = lambda t, p, n: F.substring(t, p + 1, n)
        b = right.select("_block", "b_no", F.coalesce(text_b, F.lit("")).alias("_t")).withColumn("_n", F.length("_t"))
        if least < BY_LENGTH:
            a = left.select("_block", "a_no", F.coalesce(text_a, F.lit("")).alias("_u"))
            a = a.select("*", letter_counts(F.col("_u")).alias("_c"), F.explode(lengths(F.length("_u"))).alias("_n"))
            both = a.join(b.withColumn("_d", letter_counts(F.col("_t"))), ["_block", "_n"])
            longer = F.greatest(F.length("_u"), F.col("_n"))
            return both.where(longer - shared_letters(F.col("_c"), F.col("_d")) <= F.floor(longer * (1 - least))).select("a_no", "b_no")
        b = b.withColumn("_k", F.explode(F.array_distinct(F.transform(lengths(F.col("_n")), lambda m: edits(m, F.col("_n"))))))
        b = b.select("_block", "b_no", "_t", "_n", "_k", F.explode(F.sequence(F.lit(0), F.col("_k"))).alias("_i"))
        at = begin(F.col("_i"), F.col("_n"), F.col("_k"))
        b = b.select("_block", "b_no", "_n", "_k", "_i", cut(F.col("_t"), at, begin(F.col("_i") + 1, F.col("_n"), F.col("_k")) - at).alias("_s"))
        a = left.select("_block", "a_no", F.coalesce(text_a, F.lit("")).alias("_t")).withColumn("_m", F.length("_t"))
        a = a.select("_block", "a_no", "_t", "_m", F.explode(lengths(F.col("_m"))).alias("_n")).withColumn("_k", edits(F.col("_m"), F.col("_n")))
        a = a.select("*", F.explode(F.sequence(F.lit(0), F.col("_k"))).alias("_i"))
        at = begin(F.col("_i"), F.col("_n"), F.col("_k"))
        size = begin(F.col("_i") + 1, F.col("_n"), F.col("_k")) - at
        starts = F.sequence(F.greatest(F.lit(0), at - F.col("_k")), F.least(F.col("_m") - size, at + F.col("_k")))
        some = F.greatest(F.lit(0), at - F.col("_k")) <= F.least(F.col("_m") - size, at + F.col("_k"))
        seen = F.array_distinct(F.transform(starts, lambda s: cut(F.col("_t"), s, size)))
        a = a.where(some).select("_block", "a_no", "_n", "_k", "_i", F.explode(seen).alias("_s"))
        return a.join(b, ["_block", "_n", "_k", "_i", "_s"]).select("a_no", "b_no").distinct()

    return find


def scored(pairs: DataFrame, left: DataFrame, right: DataFrame, score: Column) -> DataFrame:
    """`pairs` (a_no, b_no) with the values of both sides and `score`."""
    return pairs.join(left.drop("_rows"), "a_no").join(right.drop("_block", "_rows"), "b_no").withColumn("score", score)


def best_by_rounds(left: DataFrame, right: DataFrame, score: Column, rounds: Sequence[tuple[float, Candidates, float]], least: float | None = None, strictly: bool = False) -> DataFrame:
    """a_no, score, match_id: each left value's highest score in its block, smallest match_id of equals.

    `rounds`: falling scores, each with the candidates that contain every pair at or above it,
    and the bound to ask them for.  With `least` (a bound that counts, `strictly` above it), the
    rounds end there.  Otherwise values that no round settles meet their whole block: nothing
    bounds their best from below, so there is no other proof.
    """
    found = None
    open_ = left
    lead = F.min(F.struct((-F.col("score")).alias("o"), "match_id")).alias("_b")
    flat = lambda df: df.select("a_no", (-F.col("_b.o")).alias("score"), F.col("_b.match_id").alias("match_id"))
    for bound, candidates, ask in rounds:
        got = stored(flat(scored(candidates(open_, right, ask), open_, right, score).where(F.col("score") >= bound).groupBy("a_no").agg(lead)), "settled")
        found = got if found is None else found.unionByName(got)
        open_ = stored(open_.join(got.select("a_no"), "a_no", "left_anti"), "open")
    if least is None:
        whole = open_.drop("_rows").join(right.drop("_rows"), "_block").withColumn("score", score).groupBy("a_no").agg(lead)
        return found.unionByName(flat(whole)) if found is not None else flat(whole)
    return found.where(F.col("score") > least if strictly else F.col("score") >= least)


def pair_candidates(tokens_a: Column, tokens_b: Column) -> Candidates:
    """Pairs that share two tokens at least: they meet by each two of their tokens."""

    def keys(rows: DataFrame, no: str, tokens: Column) -> DataFrame:
        sorted_ = F.array_sort(F.array_distinct(F.array_compact(tokens)))
        each = rows.select("_block", no, sorted_.alias("_t")).select("_block", no, "_t", F.posexplode("_t").alias("_i", "_x"))
        return each.select("_block", no, "_x", F.explode(F.slice("_t", F.col("_i") + 2, F.size("_t"))).alias("_y"))

    def find(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
        return keys(left, "a_no", tokens_a).join(keys(right, "b_no", tokens_b), ["_block", "_x", "_y"]).select("a_no", "b_no").distinct()

    return find


GRAM = 3


def contained(needles: DataFrame, texts: DataFrame, needle: str, text: str) -> DataFrame:
    """needle_no, text_no of values whose text contains the needle's, in a block.

    A needle looks for its rarest run of GRAM characters (all of it, if shorter) among the runs
    of the texts; an empty needle is in every text and looks for the empty run.
    """
    sizes = F.sequence(F.lit(0), F.lit(GRAM))
    runs = lambda t, n: F.when(n == 0, F.array(F.lit(""))).when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda p: F.substring(t, p, n))).otherwise(F.array().cast("array<string>"))
    post = texts.select("_block", F.col(f"{text}_no").alias("text_no"), F.explode(F.array_distinct(F.flatten(F.transform(sizes, lambda n: runs(F.col("_text"), n))))).alias("_run"))
    often = post.groupBy("_block", "_run").agg(F.count("*").alias("_n"))
    own = needles.select("_block", F.col(f"{needle}_no").alias("needle_no"), F.col("_text").alias("_needle"), F.explode(F.array_distinct(runs(F.col("_text"), F.least(F.length("_text"), F.lit(GRAM))))).alias("_run"))
    rarest = own.join(often, ["_block", "_run"], "left").groupBy("_block", "needle_no").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_run")).alias("_r"), F.first("_needle").alias("_needle"))
    met = rarest.where(F.col("_r.n") > 0).select("_block", "needle_no", "_needle", F.col("_r._run").alias("_run")).join(post, ["_block", "_run"])
    return met.join(texts.select(F.col(f"{text}_no").alias("text_no"), "_text"), "text_no").where(F.contains("_text", F.col("_needle"))).select("needle_no", "text_no")
