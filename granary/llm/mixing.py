"""Mixing sources to target weights along a time-varying curriculum.

Each source's target comes from its weight by water filling under a repeat cap.  Its weight
schedule, a ramp over training time t in [0, 1], is integrated to a cumulative demand of
words; the words of the source, laid out in a seeded order, are cut at the target, and each
document's position is the time at which the demand reaches its middle.  Range-sorted by
position, the uses of all sources are the training order; the place of a use is the number of
words before it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import RANK_ROWS, WORD, materialize, two_level

WEIGHTS = (5, 2, 1)
#: Start and end of the weight ramps, dealt to sources in turn.
RAMPS = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
SHARE = 1.5
REPEATS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _cycle(rank: Column, values: tuple) -> Column:
    out = F.lit(values[-1])
    for i, v in enumerate(values[:-1]):
        out = F.when((rank - 1) % len(values) == i, F.lit(v)).otherwise(out)
    return out


def source_targets(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, n_rows, source_size, rank, weight, target from rows (source, size).

    Sources by code point, null last.  With caps sorted by cap per weight, a source is capped
    while its share of what the capped ones before it leave exceeds its cap.  One row per
    source: windows over them are small.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    every = Window.partitionBy()
    named = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    cap = F.col("source_size").cast("double") * repeats
    named = named.withColumn("weight", _cycle(F.col("rank"), weights).cast("double")).withColumn("cap", cap)
    named = named.withColumn("fill", F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), "rank")))
    before = Window.orderBy("fill").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.col("source_size").cast("double")).over(every) * F.lit(share)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    named = named.withColumn("level", level)
    open_at = F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct("fill", "level"))).over(every)
    named = named.withColumn("open", open_at)
    target = F.when(F.col("fill") >= F.col("open.fill"), F.col("weight") * F.col("open.level")).otherwise(F.col("cap"))
    return named.select("source", "n_rows", "source_size", "rank", "weight", target.alias("target"))


def position(words: Column, target: Column, start: Column, end: Column) -> Column:
    """Time at which a source's cumulative demand, the integral of its ramp, reaches `words`."""
    u = F.least(F.greatest(words / target, F.lit(0.0)), F.lit(1.0))
    curved = (F.sqrt(start * start + (end * end - start * start) * u) - start) / (end - start)
    return F.when(start == end, u).otherwise(curved)


def mix(
    docs: DataFrame,
    seed: int = 7,
    weights: tuple = WEIGHTS,
    ramps: tuple = RAMPS,
    share: float = SHARE,
    repeats: int = REPEATS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: `row` (all input columns as a struct), doc_id, source, source_rank,
    size, source_size, target, taken, uses (array of (pass, words, position), empty if not
    taken), at (words of its source before it), order_key, text_hash, n_all (documents).

    Null text: size 0, never taken.  Null source: a source of its own, last.  The order in a
    source is md5(seed:doc_id:text), then size and a hash of the text, so reruns agree; rows equal
    in all of them are interchangeable.  Clashing input names stay inside `row`.
    No rows in, no rows out.
    """
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))).cast("binary"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), hashed.alias("_order"), F.xxhash64(text).alias("_text"))
    targets = source_targets(rows.select("source", "size"), weights, share, repeats)
    targets = materialize(targets.select(F.col("source").alias("_source"), "n_rows", "source_size", "target", F.col("rank").alias("source_rank"), F.sum("n_rows").over(Window.partitionBy()).alias("n_all"), _cycle(F.col("rank"), tuple(r[0] for r in ramps)).alias("_from"), _cycle(F.col("rank"), tuple(r[1] for r in ramps)).alias("_to")), "targets")  # of a known size: a few sources need no shuffle of the rows
    buckets = F.ceil(F.col("n_rows") / RANK_ROWS)
    spread = F.conv(F.substring("_order", 1, 7), 16, 10).cast("long")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_bucket", F.shiftright(spread * buckets, 28))
    laid = two_level(rows, ["source"], "_bucket", [F.col("_order"), F.col("size"), F.col("_text")], weight="size", out="at")
    wanted = F.floor("target")
    uses = []
    for i in range(repeats):
        begin = F.col("at") + F.col("source_size") * i
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), wanted - begin))
        uses.append(F.struct(F.lit(i).alias("pass"), words.alias("words"), position(begin + words / 2, F.col("target"), F.col("_from"), F.col("_to")).alias("position")))
    laid = laid.withColumn("uses", F.filter(F.array(*uses), lambda u: u["words"] > 0))
    taken = F.aggregate("uses", F.lit(0).cast("long"), lambda s, u: s + u["words"])
    return laid.select("row", "doc_id", "source", "source_rank", "size", "source_size", "target", taken.alias("taken"), "uses", "at", F.col("_order").alias("order_key"), F.col("_text").alias("text_hash"), "n_all")


def training_order(mixed: DataFrame) -> DataFrame:
    """A row per use of a document, range-sorted by position: row, words, position, pass."""
    used = mixed.select("row", "size", "source_rank", "order_key", "text_hash", F.explode("uses").alias("use")).select("*", "use.*")
    return used.orderBy("position", "source_rank", "pass", "order_key", "size", "text_hash").select("row", "size", "words", "position", "pass")


def placed(mixed: DataFrame) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, and of its first and last
    use position and place (null where it isn't taken).

    The order is that of `training_order`: uses are dealt to ranges of positions, whose words
    are summed along, and sorted within.
    """
    same = ["doc_id", "size", "source_size", "target", "taken"]
    mixed = materialize(mixed.select("source_rank", "at", *same, "order_key", "text_hash", "n_all", "uses"), "mixed")
    used = mixed.select("source_rank", "at", *same, "order_key", "text_hash", "n_all", F.explode("uses").alias("use")).select("*", "use.*").drop("use")
    used = used.withColumn("_bucket", F.floor(F.col("position") * F.ceil(F.col("n_all") / RANK_ROWS)))
    order = [F.col(c) for c in ("position", "source_rank", "pass", "order_key", "size", "text_hash")]
    ranked = two_level(used, [], "_bucket", order, weight="words", out="place")
    ends = [f(c).alias(n) for c in ("position", "place") for f, n in ((F.min, c), (F.max, f"last_{c}"))]
    taken = ranked.groupBy("source_rank", "at").agg(*[F.first(c).alias(c) for c in same], *ends).drop("source_rank", "at")  # a taken document has words, so its place in its source is its own
    none = mixed.where(F.size("uses") == 0).select(*same, *[F.lit(None).cast(k).alias(c) for c, k in (("position", "double"), ("last_position", "double"), ("place", "long"), ("last_place", "long"))])
    return taken.unionByName(none)
