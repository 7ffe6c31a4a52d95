"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Each text gives counts, and the counts a vector of four transformed statistics: log mean word
length, log share of characters in words that aren't letters, log symbols per word, and
log distinct words over log words.  The first two are drawn to a usual value by pseudo-counts,
so that very short texts do not stray.  Vectors are whole thousandths; sums of them are exact,
so reruns agree bit by bit.

Per language and source, a minimum-covariance-determinant estimate by concentration steps from
several deterministic starts: the medians and quartiles, the covariance of all rows, that of
their hyperbolic tangents and that of their directions.  A step takes the H share of rows with
the smallest distances and estimates mean and covariance from them; after FIRST_STEPS steps the
BEST starts of smallest determinant go on until the determinant no longer falls.  The smallest
determinant wins; mean and covariance are then estimated again from all rows within the
chi-squared quantile of that estimate (reweighting).  A row whose squared Mahalanobis distance
is over CUTOFF is rejected.

A step is one aggregation by group, start and distance bin; running sums along the bins give
both the H quantile (as a bin edge, so that equal rows are treated alike) and the moments below
it, so no task ever sees a whole group: windows run over bins (some thousands at most) and, for
the medians, over the distinct thousandths of a statistic, whose logarithms span under 40,000.

The vectors and what each step estimates are written and read back, so that a step's plan is that
of one step: the driver's memory grows with the plans, which it copies while it plans and runs them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
GRAM = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
H, CUTOFF = 0.75, 30.0
#: Steps for all starts, starts that go on, steps between two looks at the determinant, looks at
#: most, least fall of the log determinant.
FIRST_STEPS, BEST, STEPS, MOST_LOOKS, FALL = 2, 2, 2, 15, 1e-4
#: h / F(chi2 with d + 2 degrees at the h quantile of chi2 with d), d = 4, for h = 0.75 and for
#: the rows of the reweighted estimate (0.975, whose quantile is WITHIN).
CONSISTENCY, WITHIN, CONSISTENCY_WITHIN = 1.487, 11.143, 1.0645
#: Least standard deviation of each statistic, in thousandths: less is not told apart.
FLOOR = (60.0, 300.0, 300.0, 25.0)
#: Rows from which a group has an estimate of its own; rows of smaller groups are judged by that
#: of their language, or, where that has fewer rows, by that of all rows.
GROUP_MIN = 20
#: Bins for each doubling of 1 + squared distance.
BINS = 64
D = len(FLOOR)
X = [f"x{j}" for j in range(D)]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """`rows` without `text`, with BASE, n_letters and n_distinct; a null text counts 0."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(c) for c in rows.columns if c != text]
    has_word = F.lit(r"[^\x20\x09-\x0D]")
    a = rows.select(
        *kept,
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(t, "\n"), lambda line: F.regexp_like(line, has_word)).alias("_lines"),
        F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(t, r"\P{L}+", "")).cast("long").alias("n_letters"),
    )
    kept += [F.col(c) for c in ("word_chars", "n_symbols", "n_letters")]
    b = a.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashed"),
    )
    kept += [F.col(c) for c in ("n_words", "n_dup_lines", "n_distinct")]
    at = F.sequence(F.lit(0), (F.col("n_words") - GRAM).cast("int"))
    grams = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("_hashed"), i + k) for k in range(GRAM)]))
    c = b.select(*kept, F.when(F.col("n_words") >= GRAM, grams).otherwise(F.array().cast("array<bigint>")).alias("_grams"))
    twice = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = c.select(*kept, F.when(twice, placed).alias("_sorted"))
    near = lambda j, k: F.get(F.col("_sorted"), j + k)["h"]
    again = F.filter("_sorted", lambda x, j: near(j, -1).eqNullSafe(x["h"]) | near(j, 1).eqNullSafe(x["h"]))
    e = d.select(*kept, F.array_sort(F.transform(again, lambda x: x["i"])).alias("_at"))
    step = F.transform("_at", lambda x, j: F.least(F.lit(GRAM), F.coalesce(F.get(F.col("_at"), j + 1) - x, F.lit(GRAM))))
    covered = F.coalesce(F.aggregate(step, F.lit(0), lambda s, v: s + v), F.lit(0)).cast("long")
    return e.select(*kept, covered.alias("n_repeat_words"))


def vector() -> list[Column]:
    """The transformed statistics, in thousandths."""
    n, chars = F.col("n_words"), F.col("word_chars")
    values = [
        F.log((chars + 50) / (n + 10)),
        F.log((chars - F.col("n_letters") + 2) / (chars + 60)),
        F.log2(F.lit(1) + F.lit(10) * F.col("n_symbols") / F.greatest(n, F.lit(1))),
        F.log(F.greatest(F.col("n_distinct"), F.lit(1))) / F.log(F.greatest(n, F.lit(2))),
    ]
    return [F.round(v * 1000).cast("long").alias(x) for v, x in zip(values, X, strict=True)]


def _same(left: str, right: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


GROUP = ["_lang", "_source", "_level"]
EACH = [*GROUP, "_start"]
MEANS = [f"m{j}" for j in range(D)]
LOWER = [f"l{j}{k}" for j in range(D) for k in range(j + 1)]
SUMS = ["_n"] + [f"s{j}" for j in range(D)] + [f"p{j}{k}" for j in range(D) for k in range(j + 1)]


def _binned(squared: Column) -> Column:
    return F.floor(F.log2(F.lit(1.0) + squared) * BINS).cast("long")


def _sums(x: list[Column], names: list[str]) -> list[Column]:
    """Count, sums and sums of products of whole numbers."""
    every = [F.count("*")] + [F.sum(v) for v in x] + [F.sum(x[j] * x[k]) for j in range(D) for k in range(j + 1)]
    return [c.alias(n) for c, n in zip(every, names, strict=True)]


def _factor(rows: DataFrame, names: list[str], factor: float, floor: tuple, means: bool = True) -> DataFrame:
    """`rows` with MEANS and LOWER, the triangle of covariance * `factor` + diag(`floor` squared),
    from sums called `names`."""
    n, s, p = names[0], names[1 : D + 1], dict(zip([(j, k) for j in range(D) for k in range(j + 1)], names[D + 1 :], strict=True))
    mean = [F.col(c) / F.col(n) for c in s]

    def spread(j: int, k: int) -> Column:
        out = (F.col(p[j, k]) / F.col(n) - mean[j] * mean[k]) * factor
        for i in range(k):
            out = out - F.col(f"l{j}{i}") * F.col(f"l{k}{i}")
        return out

    if means:
        rows = rows.withColumns(dict(zip(MEANS, mean, strict=True)))
    for k in range(D):  # by columns: what is below a diagonal cell needs no more than it and the columns before
        rows = rows.withColumn(f"l{k}{k}", F.sqrt(F.greatest(spread(k, k), F.lit(0.0)) + floor[k] ** 2))
        if k + 1 < D:
            rows = rows.withColumns({f"l{j}{k}": spread(j, k) / F.col(f"l{k}{k}") for j in range(k + 1, D)})
    return rows


def _medians(rows: DataFrame) -> DataFrame:
    """Median m and scale s of each statistic per group, from exact counts of its values."""
    long = rows.select(*GROUP, F.posexplode(F.array(*X)).alias("_j", "_x")).groupBy(*GROUP, "_j", "_x").agg(F.count("*").alias("_n"))
    per = Window.partitionBy(*GROUP, "_j")
    run = per.orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long = long.withColumn("_run", F.sum("_n").over(run)).withColumn("_all", F.sum("_n").over(per))
    at = lambda q: F.min(F.when(F.col("_run") >= F.col("_all") * q, F.col("_x")))
    table = long.groupBy(*GROUP, "_j").agg(at(0.5).alias("_m"), ((at(0.75) - at(0.25)) / 1.349).alias("_s"))
    pick = lambda j, c: F.max(F.when(F.col("_j") == j, F.col(c)))
    cells = [pick(j, "_m").cast("double").alias(f"m{j}") for j in range(D)]
    return table.groupBy(*GROUP).agg(*cells, *[F.greatest(pick(j, "_s"), F.lit(FLOOR[j])).alias(f"s{j}") for j in range(D)])


def first_estimates(rows: DataFrame) -> DataFrame:
    """EACH, MEANS, LOWER of the starts 0 to 3; only their shapes matter for the first step."""
    middle = materialize(_medians(rows), "medians")
    both = rows.alias("r").join(middle.alias("e"), _same("r", "e", GROUP))
    z = [(F.col(f"r.{X[j]}") - F.col(f"e.m{j}")) / F.col(f"e.s{j}") for j in range(D)]
    length = F.sqrt(sum((v * v for v in z), F.lit(0.0)))
    whole = lambda v: F.round(v * 1000).cast("long")
    bent = [whole(F.tanh(v)) for v in z]
    turned = [F.when(length > 0, whole(v / length)).otherwise(F.lit(0).cast("long")) for v in z]
    names = {i: [f"_{i}{c}" for c in SUMS] for i in (1, 2, 3)}
    took = both.select(*[F.col(f"r.{c}") for c in (*GROUP, *X)], *[c.alias(f"_b{j}") for j, c in enumerate(bent)], *[c.alias(f"_t{j}") for j, c in enumerate(turned)])
    sums = materialize(took.groupBy(*GROUP).agg(*[c for i, x in ((1, X), (2, [f"_b{j}" for j in range(D)]), (3, [f"_t{j}" for j in range(D)])) for c in _sums([F.col(v) for v in x], names[i])]), "sums")
    out = middle.select(*GROUP, F.lit(0).alias("_start"), *MEANS, *[(F.col(f"s{j}") if j == k else F.lit(0.0)).alias(f"l{j}{k}") for j in range(D) for k in range(j + 1)])
    out = out.unionByName(_factor(sums, names[1], 1.0, FLOOR).select(*GROUP, F.lit(1).alias("_start"), *MEANS, *LOWER))
    for i in (2, 3):
        made = _factor(sums, names[i], 1.0, (30.0,) * D, means=False).alias("r").join(middle.alias("e"), _same("r", "e", GROUP))
        cells = [(F.col(f"r.l{j}{k}") * F.col(f"e.s{j}") / 1000).alias(f"l{j}{k}") for j in range(D) for k in range(j + 1)]
        out = out.unionByName(made.select(*[F.col(f"r.{c}") for c in GROUP], F.lit(i).alias("_start"), *[F.col(f"e.{c}") for c in MEANS], *cells))
    return out


def distance(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` by estimates of their group, with squared Mahalanobis distances `d2` and _start."""
    both = rows.alias("r").join(estimate.alias("e"), _same("r", "e", GROUP), how)
    out = both.select(*[F.col(f"r.{c}").alias(c) for c in rows.columns], *[F.col(f"e.{c}").alias(c) for c in ("_start", *MEANS, *LOWER)])
    for j in range(D):
        rest = F.col(X[j]) - F.col(f"m{j}")
        for k in range(j):
            rest = rest - F.col(f"l{j}{k}") * F.col(f"_y{k}")
        out = out.withColumn(f"_y{j}", rest / F.col(f"l{j}{j}"))
    squared = F.lit(0.0)
    for j in range(D):
        squared = squared + F.col(f"_y{j}") * F.col(f"_y{j}")
    return out.withColumn("d2", squared).drop(*MEANS, *LOWER, *[f"_y{j}" for j in range(D)])


def concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step for each estimate: that of the H share of rows nearest to it, with
    `size`, the logarithm of its determinant."""
    bins = distance(rows, estimate).withColumn("_bin", _binned(F.col("d2"))).groupBy(*EACH, "_bin").agg(*_sums([F.col(x) for x in X], SUMS))
    per = Window.partitionBy(*EACH)
    run = per.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.select(*EACH, "_bin", F.sum("_n").over(per).alias("_all"), *[F.sum(c).over(run).alias(c) for c in SUMS])
    enough = bins.where(F.col("_n") >= F.col("_all") * H)
    got = enough.groupBy(*EACH).agg(F.min_by(F.struct(*SUMS), F.col("_bin")).alias("_t")).select(*EACH, "_t.*")
    size = sum((F.log(F.col(f"l{j}{j}")) * 2 for j in range(D)), F.lit(0.0))
    return _factor(got, SUMS, CONSISTENCY, FLOOR).select(*EACH, *MEANS, *LOWER, size.alias("size"))


def concentrated(rows: DataFrame, estimate: DataFrame, steps: int) -> DataFrame:
    return reduce(lambda e, _: materialize(concentrate(rows, e), "estimate"), range(steps), estimate)


def smallest_determinant(rows: DataFrame) -> DataFrame:
    """GROUP, _start, MEANS, LOWER: the estimate of smallest determinant of each group."""
    now = concentrated(rows, materialize(first_estimates(rows), "estimate"), FIRST_STEPS)
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy("size", "_start"))  # four rows a group
    now = now.withColumn("_rank", rank).where(F.col("_rank") <= BEST).drop("_rank").withColumn("_on", F.lit(True))
    cells = [*MEANS, *LOWER, "size"]
    for _ in range(MOST_LOOKS):
        now = materialize(now, "estimate")
        if not now.where("_on").head(1):
            break
        new = concentrated(rows, now.where("_on"), STEPS)
        both = now.alias("r").join(new.alias("e"), _same("r", "e", EACH), "left")
        falls = F.coalesce(F.col("e.size") < F.col("r.size") - FALL, F.lit(False))
        now = both.select(*[F.col(f"r.{c}").alias(c) for c in EACH], *[F.when(falls, F.col(f"e.{c}")).otherwise(F.col(f"r.{c}")).alias(c) for c in cells], falls.alias("_on"))
    best = now.groupBy(*GROUP).agg(F.min_by(F.struct("_start", *MEANS, *LOWER), F.struct("size", "_start")).alias("_t"))
    return best.select(*GROUP, "_t.*")


def reweighted(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The estimate from all rows within the chi-squared quantile of `estimate`."""
    near = distance(rows, estimate).where(F.col("d2") <= WITHIN).groupBy(*EACH).agg(*_sums([F.col(x) for x in X], SUMS))
    made = _factor(near, SUMS, CONSISTENCY_WITHIN, FLOOR).alias("e")
    both = estimate.alias("r").join(made, _same("r", "e", EACH), "left")
    return both.select(*[F.col(f"r.{c}").alias(c) for c in EACH], *[F.coalesce(F.col(f"e.{c}"), F.col(f"r.{c}")).alias(c) for c in (*MEANS, *LOWER)])


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, text_hash, lang, source, BASE, base_failed, d2, kept; a row per input row.

    A null or empty text has no words and fails the base rules (d2 null).  Null languages and
    sources are values of their own.  Rows of groups under GROUP_MIN rows are judged by the
    estimate over all rows of their language, where that is under GROUP_MIN rows too by the
    one over all rows, however few: a least spread is part of every covariance.  Repeated rows
    count as often as they occur.  Other columns are not carried; clashing names don't matter.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("_lang"), F.col(source).alias("_from"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    counted = text_counts(rows)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    counted = materialize(counted.withColumn("base_failed", failed).select("doc_id", "_lang", "_from", "text_hash", *BASE, "base_failed", *vector()), "statistics")
    sizes = counted.where(~F.col("base_failed")).groupBy("_lang", "_from").agg(F.count("*").alias("_n"))
    of_lang = F.sum("_n").over(Window.partitionBy("_lang"))
    level = F.when(F.col("_n") >= GROUP_MIN, 0).when(of_lang >= GROUP_MIN, 1).otherwise(2)
    sizes = sizes.withColumn("_level", level)
    by_lang = F.max(F.when(F.col("_level") == 1, True).otherwise(False)).over(Window.partitionBy("_lang"))
    sizes = materialize(sizes.withColumn("_by_lang", by_lang), "sizes")
    by_all = bool(sizes.where("_level = 2").head(1))
    good = counted.where(~F.col("base_failed"))
    sized = good.alias("r").join(sizes.alias("e"), _same("r", "e", ["_lang", "_from"]))
    sized = sized.select("r.*", "e._level", "e._by_lang")
    own = lambda n: F.struct(F.when(F.lit(n < 2), F.col("_lang")).alias("_lang"), F.when(F.lit(n < 1), F.col("_from")).alias("_source"), F.lit(n).alias("_level"))
    part = [F.when(F.col("_level") == 0, own(0)), F.when(F.col("_by_lang"), own(1)), F.when(F.lit(by_all), own(2))]
    used = materialize(sized.select(F.explode(F.array_compact(F.array(*part))).alias("_g"), *X).select("_g.*", *X), "vectors")
    estimate = materialize(smallest_determinant(used), "estimate")
    estimate = materialize(reweighted(used, estimate), "estimate")
    mine = F.when(F.col("_level") == 0, own(0)).when(F.col("_level") == 1, own(1)).otherwise(own(2))
    hers = [F.col("_lang").alias("lang"), F.col("_from").alias("source")]
    judged = sized.select("doc_id", "text_hash", *hers, *BASE, "base_failed", *X, mine.alias("_g")).select("*", "_g._lang", "_g._source", "_g._level").drop("_g")
    judged = distance(judged, estimate, "left")
    names = ["doc_id", "text_hash", "lang", "source", *BASE, "base_failed"]
    out = judged.select(*names, "d2", (F.col("d2") <= cutoff).alias("kept"))
    return out.unionByName(counted.where("base_failed").select("doc_id", "text_hash", *hers, *BASE, "base_failed", F.lit(None).cast("double").alias("d2"), F.lit(False).alias("kept")))


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with their columns.

    A rejected row is known by key, text hash, language and source; rows equal in these are
    judged alike.
    """
    judged = judge(docs, key, text, lang, source, cutoff)
    bad = judged.where(~F.col("kept")).select("doc_id", "text_hash", "lang", "source").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    return rows.alias("r").join(bad.alias("e"), _same("r", "e", ["doc_id", "text_hash", "lang", "source"]), "left_anti").select("row.*")
