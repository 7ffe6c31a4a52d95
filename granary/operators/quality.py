"""Coverage, gates, grades, gaps, audits: every table comes from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.text import is_present

from .consolidate import score
from .relational import percent


@dataclass(frozen=True)
class Profile:
    """What a coverage table counts: columns, arrays, the outlier band, and pass marks."""

    columns: tuple[str, ...]
    arrays: tuple[str, ...] = ()
    band: tuple[str, float, float] | None = None
    marks: Mapping[str, float] = field(default_factory=dict)
    near: float = 0.9


def quality_table(df: DataFrame, by: Sequence[str], p: Profile) -> DataFrame:
    """Per group: rows, `<column>_pct`, completion (their mean), outliers, a flag for each mark
    and status: PASS (all marks met, no outliers), NEAR (all within the `near` share), TODO."""
    cols = [*p.columns, *p.arrays]
    cells = [percent(F.count_if(is_present(F.col(c), "array" if c in p.arrays else "any")), F.count("*")).alias(f"{c}_pct") for c in cols]
    if p.band:
        name, low, high = p.band
        cells.append(F.count_if(F.coalesce((F.col(name) < low) | (F.col(name) > high), F.lit(False))).alias("outliers"))
    out = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *cells)
    total = sum((F.col(f"{c}_pct") for c in cols), F.lit(0.0))
    out = out.withColumn("completion", F.round(total / len(cols), 3))
    return with_status(out, p)


def with_status(table: DataFrame, p: Profile) -> DataFrame:
    if not p.marks:
        return table
    table = table.withColumns({f"{c}_ok": F.col(f"{c}_pct") >= m for c, m in p.marks.items()})
    clean = F.col("outliers") == 0 if p.band else F.lit(True)
    met, near = clean, F.lit(True)
    for c, m in p.marks.items():
        met = met & F.col(f"{c}_ok")
        near = near & (F.col(f"{c}_pct") >= m * p.near)
    return table.withColumn("status", F.when(met, "PASS").when(near, "NEAR").otherwise("TODO"))


def quality_prod(df: DataFrame, allow: DataFrame, key: str, p: Profile, enriched: Column) -> DataFrame:
    """The same over allowlisted groups, with their status and the share of enriched rows."""
    joined = df.join(allow.select(key, F.col("status").alias("allow_status")), key).withColumn("_e", enriched)
    rate = joined.groupBy(key, "allow_status").agg(percent(F.count_if("_e"), F.count("*")).alias("enriched_pct"))
    return quality_table(joined, [key], p).join(rate, key)


def ready_groups(table: DataFrame, key: str, marks: Mapping[str, float], least_rows: int) -> DataFrame:
    """Groups of enough rows that meet all marks."""
    out = table.where(F.col("n_rows") >= least_rows)
    for c, m in marks.items():
        out = out.where(F.col(f"{c}_pct") >= m)
    return out.select(key)


def gate_table(df: DataFrame, gates: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """(gate, target, actual, passed): share of rows that meet each predicate, in per cent."""
    one = df.agg(*[percent(F.count_if(c), F.count("*")).alias(f"_{i}") for i, (c, _) in enumerate(gates.values())])
    cells = [F.struct(F.lit(n).alias("gate"), F.lit(float(t)).alias("target"), F.col(f"_{i}").alias("actual"), F.coalesce(F.col(f"_{i}") >= t, F.lit(False)).alias("passed")) for i, (n, (_, t)) in enumerate(gates.items())]
    return one.select(F.inline(F.array(*cells)))


def coverage_delta(before: DataFrame, after: DataFrame, cols: Sequence[str], lifts: Mapping[str, float]) -> DataFrame:
    """(field, before, after, delta, passed): percentage points, and whether the lift is met."""
    sides = [df.agg(*[percent(F.count(c), F.count("*")).alias(f"{side}_{c}") for c in cols]) for side, df in (("b", before), ("a", after))]
    both = sides[0].crossJoin(sides[1])
    delta = lambda c: F.round(F.col(f"a_{c}") - F.col(f"b_{c}"), 2)
    cells = [F.struct(F.lit(c).alias("field"), F.col(f"b_{c}").alias("before"), F.col(f"a_{c}").alias("after"), delta(c).alias("delta"), (delta(c) >= lifts.get(c, 0.0)).alias("passed")) for c in cols]
    return both.select(F.inline(F.array(*cells)))


def admit(allow: DataFrame, changes: DataFrame, key: str, actor: str) -> tuple[DataFrame, DataFrame]:
    """(allowlist, audit): wanted statuses (key, status) over the present ones; an audit row for
    each key whose status changes or appears."""
    new = changes.select(key, F.col("status").alias("_new"))
    both = allow.select(key, F.col("status").alias("_old")).join(new, key, "full_outer")
    merged = both.select(key, F.coalesce("_new", "_old").alias("status"))
    changed = both.where(F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old")))
    return merged, changed.select(key, F.col("_old").alias("old_status"), F.col("_new").alias("new_status"), F.lit(actor).alias("actor"))


def gaps_to_target(table: DataFrame, key: str, targets: Mapping[str, float], validated: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Percentage points each coverage lacks of its target, the largest, and days since validation."""
    gaps = {f"{c}_gap": F.round(F.greatest(F.lit(0.0), F.lit(float(t)) - F.col(f"{c}_pct")), 2) for c, t in targets.items()}
    out = table.withColumns(gaps)
    out = out.withColumn("largest_gap", F.greatest(*[F.col(g) for g in gaps]) if len(gaps) > 1 else F.col(next(iter(gaps))))
    if validated:
        out = out.withColumn("days_since", F.datediff(as_of, F.col(validated)))
    return out.select(key, *gaps, "largest_gap", *(["days_since"] if validated else []))


def field_coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, n_present, n_null, pct) rows from one scan."""
    one = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(f"_{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("n_present"), (F.col("_n") - F.col(f"_{i}")).alias("n_null"), percent(F.col(f"_{i}"), F.col("_n")).alias("pct")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*cells)))


def distribution(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.round(F.avg(col), 4).alias("mean"), F.max(col).alias("hi"))


def outliers(df: DataFrame, key: str, bands: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(key, field, value, reason) of values under or over their band."""
    cells = [F.when(F.col(c) < lo, F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value"), F.lit("low").alias("reason"))).when(F.col(c) > hi, F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value"), F.lit("high").alias("reason"))) for c, (lo, hi) in bands.items()]
    return df.select(key, F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))


def consistency_issues(df: DataFrame, key: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """(key, issue) for each rule that holds."""
    cells = [F.when(test, F.lit(name)) for name, test in rules]
    return df.select(key, F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("issue"))


GRADES = ((95, "A+"), (90, "A"), (85, "A-"), (80, "B+"), (70, "B"), (60, "C"), (50, "D"))


def grade(weights: Mapping[str, float], ladder: Sequence[tuple[float, str]] = GRADES, last: str = "F") -> tuple[Column, Column]:
    """(points of 100, grade) by weighted presence."""
    points = F.round(score(weights) * 100.0 / sum(weights.values()), 2)
    out = F.lit(last)
    for least, name in reversed(ladder):
        out = F.when(points >= least, F.lit(name)).otherwise(out)
    return points, out


def weighted_quality(importance: Mapping[str, float], authority: Mapping[str, float], source: str) -> Column:
    """0 to 1: importance-weighted presence times the source's authority (0 if unknown)."""
    trust = F.lit(0.0)
    for name, a in authority.items():
        trust = F.when(F.col(source) == name, F.lit(a)).otherwise(trust)
    return F.round(score(importance) / sum(importance.values()) * trust, 6)


def leaderboard(table: DataFrame, key: str, weights: Mapping[str, float]) -> DataFrame:
    """Groups by weighted coverage, best first, with their place.  Places are counted from those
    of each whole percent (101 rows at most), so that no task sorts all groups."""
    total = sum((F.col(f"{c}_pct") * w for c, w in weights.items()), F.lit(0.0)) / sum(weights.values())
    scored = table.select(key, F.round(total, 4).alias("points")).withColumn("_part", F.coalesce(F.floor("points"), F.lit(-1)))
    above = F.sum("_n").over(Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1))
    parts = scored.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(above, F.lit(0)).alias("_above"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc("points"), key))
    return scored.join(parts, "_part").select(key, "points", (F.col("_above") + within).cast("int").alias("place"))


def impact_queue(table: DataFrame, key: str) -> DataFrame:
    """Groups by rows times the gap of their completion to 100."""
    return table.select(key, "n_rows", F.round(F.lit(100.0) - F.col("completion"), 3).alias("gap"), F.round(F.col("n_rows") * (F.lit(100.0) - F.col("completion")), 2).alias("impact")).orderBy(F.desc("impact"), key)


def row_gaps(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Number of missing columns of each row and the first of them in the given order."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in cols]
    return df.select(key, sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0)).alias("n_gaps"), F.coalesce(*missing).alias("primary_gap"))


def freshness(age: Column, edges: Sequence[tuple[int, str]], last: str) -> Column:
    """Label of the first edge (in days) that the age is not over."""
    out = F.lit(last)
    for days, name in reversed(edges):
        out = F.when(age <= days, F.lit(name)).otherwise(out)
    return F.when(age.isNotNull(), out)


def stale_reasons(tests: Sequence[tuple[str, Column]]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in tests]), lambda x: x.isNotNull())


def provenance_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, origin, n, pct) of several origin columns, from one scan."""
    cells = [F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("none")).alias("origin")) for c in cols]
    n = df.select(F.inline(F.array(*cells))).groupBy("field", "origin").agg(F.count("*").alias("n"))
    return n.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy("field"))))


def price_report(df: DataFrame, by: Sequence[str], price: str, bucket: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), percent(F.count(price), F.count("*")).alias("priced_pct"), F.min(price).alias("lo"), F.max(price).alias("hi"), F.count_if(F.col(price).isNotNull() & F.col(bucket).isNull()).alias("unbucketed"))


def availability(df: DataFrame, arr: Column) -> DataFrame:
    return df.select(F.explode(F.array_distinct(arr)).alias("country")).groupBy("country").agg(F.count("*").alias("n"))


def table_health(df: DataFrame, key: str, slugs: Sequence[str], arrays: Sequence[str], flags: Mapping[str, Column], coverage: Sequence[str] = ()) -> DataFrame:
    """(metric, value): rows, distinct and repeated keys, bad slugs, array texts, flag counts, and
    how many rows have each column of `coverage`."""
    flags = {**flags, **{f"present {c}": F.col(c).isNotNull() for c in coverage}}
    bad = [F.count_if(F.regexp_like(F.col(c), F.lit("[^a-z0-9_-]"))).alias(f"bad slug {c}") for c in slugs]
    text = [F.count_if(F.startswith(F.trim(c), F.lit("["))).alias(f"array as text {c}") for c in arrays]
    one = df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct keys"), *bad, *text, *[F.count_if(c).alias(n) for n, c in flags.items()])
    names = one.columns
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n in names])))


def repair_slugs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    fixed = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9_-]+", "-"), "-+", "-"), "^-|-$", "")
    return df.withColumns({c: fixed(F.col(c)) for c in cols})


def array_validity(df: DataFrame, cols: Sequence[str], gate: float = 99.0) -> DataFrame:
    """(field, n, valid_pct, passed): share of texts that read as arrays of strings."""
    one = df.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)], *[F.count(F.from_json(c, "array<string>")).alias(f"v_{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("field"), F.col(f"n_{i}").alias("n"), percent(F.col(f"v_{i}"), F.col(f"n_{i}")).alias("valid_pct"), F.coalesce(percent(F.col(f"v_{i}"), F.col(f"n_{i}")) >= gate, F.lit(False)).alias("passed")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*cells)))


def compare_env(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(metric, a, b): rows, rows on one side only, and rows whose `cols` differ."""
    left = a.select(key, F.struct(*cols).alias("_a"))
    right = b.select(key, F.struct(*cols).alias("_b"))
    both = left.join(right, key, "full_outer").agg(F.count("_a").alias("na"), F.count("_b").alias("nb"), F.count_if(F.col("_b").isNull()).alias("oa"), F.count_if(F.col("_a").isNull()).alias("ob"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("df"))
    cells = [F.struct(F.lit(n).alias("metric"), F.col(x).alias("a"), F.col(y).alias("b")) for n, x, y in (("rows", "na", "nb"), ("only here", "oa", "ob"), ("differ", "df", "df"))]
    return both.select(F.inline(F.array(*cells)))


def health_status(gates: DataFrame) -> DataFrame:
    """Number of gates, failing ones and their names, and OK, LOW or CRITICAL (half or more fail)."""
    failing = F.filter(F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("gate")))), lambda x: x.isNotNull())
    one = gates.agg(F.count("*").alias("n_gates"), F.count_if(~F.col("passed")).alias("n_failing"), F.array_join(failing, ",").alias("failing"))
    return one.withColumn("status", F.when(F.col("n_failing") == 0, "OK").when(F.col("n_failing") * 2 < F.col("n_gates"), "LOW").otherwise("CRITICAL"))


def recency_metrics(df: DataFrame, by: Sequence[str], key: str, age: Column, windows: Sequence[int]) -> DataFrame:
    """Rows, distinct keys, and rows no older than each number of days."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct(key).alias("n_keys"), *[F.count_if(age <= w).alias(f"last_{w}d") for w in windows])


def content_completeness(df: DataFrame, groups: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """(part, pct): share of cells of each part that are present and not their default."""
    names, cells = list(groups), []
    for i, n in enumerate(names):
        good = sum((F.coalesce(F.col(c).isNotNull() & (F.col(c) != d if d is not None else F.lit(True)), F.lit(False)).cast("int") for c, d in groups[n].items()), F.lit(0))
        cells.append(percent(F.sum(good), F.count("*") * len(groups[n])).alias(f"_{i}"))
    one = df.agg(*cells)
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("part"), F.col(f"_{i}").alias("pct")) for i, n in enumerate(names)])))


def check_contract(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """(column, expected, found, state) of a schema, then a row `*` for all: success, partial, fail."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, t, have.get(c), "ok" if have.get(c) == t else "missing" if c not in have else "type") for c, t in expected.items()]
    good = sum(r[3] == "ok" for r in rows)
    rows.append(("*", None, None, "success" if good == len(rows) else "partial" if good else "fail"))
    return df.sparkSession.createDataFrame(rows, "column string, expected string, found string, state string")


def auto_approve(df: DataFrame, key: str, state: str, rules: Mapping[str, Column]) -> DataFrame:
    """state_new of pending rows (approved if all rules hold) and what is missing."""
    missing = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    new = F.when((F.col(state) == "pending") & (F.size(missing) == 0), "approved").otherwise(F.col(state))
    return df.select(key, new.alias("state_new"), F.when(F.col(state) == "pending", F.array_join(missing, ",")).alias("missing"))


def compare_tables(a: DataFrame, b: DataFrame, key: str, col_a: str, col_b: str, names: Mapping[str, str]) -> DataFrame:
    """Rows whose mapped values differ, or that one side misses: key, ours, theirs, kind."""
    ours = F.col("_a")
    for k, v in names.items():
        ours = F.when(F.col("_a") == k, F.lit(v)).otherwise(ours)
    both = a.select(key, F.col(col_a).alias("_a"), F.lit(True).alias("_in_a")).join(b.select(key, F.col(col_b).alias("theirs"), F.lit(True).alias("_in_b")), key, "full_outer").withColumn("ours", ours)
    kind = F.when(F.col("_in_b").isNull(), "missing there").when(F.col("_in_a").isNull(), "missing here").when(~F.col("ours").eqNullSafe(F.col("theirs")), "differs")
    return both.select(key, "ours", "theirs", kind.alias("kind")).where("kind is not null")


def work_list(df: DataFrame, staging: DataFrame, key: str, url: str, col: str) -> DataFrame:
    """(key, domain, why): rows without `col`, and staged rows whose URL the table hasn't."""
    host = lambda: F.regexp_extract(url, "^[a-z]+://([^/]+)", 1)
    lacking = df.where(F.col(col).isNull()).select(key, host().alias("domain"), F.lit("missing").alias("why"))
    new = staging.join(df.select(url).distinct(), url, "left_anti").select(key, host().alias("domain"), F.lit("unmatched").alias("why"))
    return lacking.unionByName(new)


def work_counts(work: DataFrame) -> DataFrame:
    """(domain, why, n): how much of a work list each domain has."""
    return work.groupBy("domain", "why").agg(F.count("*").alias("n"))


def missing_fields(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, n_missing, percent): how often each column is missing, in one pass."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    cells = [F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("n_missing"), percent(F.col(f"`{c}`"), F.col("_n")).alias("percent")) for c in cols]
    return one.select(F.inline(F.array(*cells)))


def completeness_tiers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows by share of present columns: low (under 40 %), mid (under 70 %), high."""
    share = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0)) * 100 / len(cols)
    return df.groupBy(F.when(share < 40, "low").when(share < 70, "mid").otherwise("high").alias("tier")).agg(F.count("*").alias("n"))
