"""Best partners, edit joins and containment against all pairs, and how few pairs they form."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from granary.operators import candidates, match, relational

A, B = "a_name", "b_name"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdelmnorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def changed(rng: random.Random, s: str) -> str:
    for _ in range(rng.randint(0, 3)):
        i = rng.randrange(len(s) + 1)
        s = rng.choice((s[:i] + s[i + 1 :], s[:i] + rng.choice("abc ") + s[i:], s[:i] + "x" + s[i + 1 :]))
    return s


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    left = [(i, rng.choice("pq"), words(rng, rng.randint(1, 4)), rng.choice("uv")) for i in range(150)]
    right = [(1000 + i, r[1] if rng.random() < 0.9 else "p", changed(rng, r[2]), rng.choice("uv")) for i, r in enumerate(left)]
    right += [(2000 + i, rng.choice("pq"), words(rng, 2), "u") for i in range(60)] + [(3000, "p", left[0][2], "u"), (2999, "p", left[0][2], "u")]
    left += [(500, "p", "", "u"), (501, "p", None, "u"), (502, None, "abc", "u"), (503, "z", "abc", "u"), (504, "p", left[0][2], "v"), (505, "q", "ab ab ab", "u")]
    right += [(4000, "p", "", "v"), (4001, "q", None, "u"), (4002, None, "abc", "u"), (4003, "q", "x", "u")]
    schema = "id long, brand string, name string, form string"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), left, right


def lev(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def near(a: str | None, b: str | None) -> float:
    a, b = a or "", b or ""
    return 1 - lev(a, b) / max(len(a), len(b)) if a or b else 1.0


def best(left, right, score, least=None, strictly=False):
    out = {}
    for i, block, *rest in left:
        each = [(-round(score(rest, r[2:]), 6), r[0]) for r in right if block is not None and r[1] == block]
        if least is not None:
            each = [x for x in each if (-x[0] > least if strictly else -x[0] >= least)]
        if each:
            out[i] = (min(each)[1], -min(each)[0])
    return out


def as_dict(df):
    return {r["id"]: (r["match_id"], r["score"]) for r in df.collect() if r["match_id"] is not None}


def test_best_partner_by_edits_equals_all_pairs(sides):
    a, b, left, right = sides
    got = match.match(a, b, "brand", "id", "id", {"n": (1.0, match.edit_similarity(A, B))}, ["name"], [("high", 0.8)], by=("n", candidates.edit_candidates(A, B)))
    assert as_dict(got) == best(left, right, lambda x, y: near(x[0], y[0]))
    assert got.count() == len(left)


def test_best_partner_by_tokens_equals_all_pairs(sides):
    a, b, left, right = sides
    split = lambda c: F.split(c, " ")
    form = F.when(F.col("a_form") == F.col("b_form"), 1.0).otherwise(0.0)
    parts = {"tokens": (0.6, match.jaccard(split(A), split(B))), "chars": (0.3, match.edit_similarity(A, B)), "form": (0.1, form)}

    def score(x, y):
        s, t = (set((z[0] or "").split(" ")) if z[0] is not None else set() for z in (x, y))
        shared = len(s & t) / len(s | t) if x[0] is not None and y[0] is not None else 0.0
        return 0.6 * shared + 0.3 * near(x[0], y[0]) + 0.1 * (x[1] == y[1])

    got = match.match(a, b, "brand", "id", "id", parts, ["name", "form"], [("high", 0.8)], by=("tokens", candidates.token_candidates(split(A), split(B))))
    want = best(left, right, score)
    found = as_dict(got)
    assert found.keys() == want.keys()
    assert {k: v for k, v in found.items() if v[0] != want[k][0] or abs(v[1] - want[k][1]) > 2e-6} == {}


@pytest.mark.parametrize("least", [0.4, 0.7, 0.8])
def test_edit_candidates_are_complete(sides, least):
    a, b, left, right = sides
    x, y = candidates.numbered(a, "brand", ["name"], "a"), candidates.numbered(b, "brand", ["name"], "b")
    found = candidates.edit_candidates(A, B)(x, y, least)
    got = {(r["a_name"], r["b_name"], r["_block"]) for r in candidates.scored(found, x, y, F.lit(0)).collect()}
    want = {(p[2], q[2], p[1]) for p in left for q in right if p[1] is not None and p[1] == q[1] and p[2] is not None and q[2] is not None and near(p[2], q[2]) >= least}
    assert want <= got


def test_thresholds_equal_all_pairs(sides):
    a, b, left, right = sides
    none = F.array().cast("array<string>")
    got = match.match_variants(a, b, none, none, "brand", "name", "id", "id", 0.8)
    assert as_dict(got) == best(left, right, lambda x, y: near(x[0], y[0]), 0.8, True)
    exact = match.match_exact_then_fuzzy(a, b, "brand", "name", "form", "id", "id").where("how = 'fuzzy'")
    known = {(r[1], r[2]) for r in right}
    rest = [r for r in left if (r[1], r[2]) not in known or r[1] is None or r[2] is None]
    boosted = lambda x, y: min(near(x[0], y[0]) * 1.1, 1.0) if x[1] == y[1] else near(x[0], y[0])
    assert as_dict(exact) == best(rest, right, boosted, 0.5)


def test_two_tokens_equal_all_pairs(sides):
    a, b, left, right = sides
    cut = lambda df: df.withColumn("tokens", F.split("name", " "))
    sets = lambda z: set(z[0].split(" ")) if z[0] is not None else set()
    got = match.match_tokens(cut(a), cut(b), "brand", "tokens", "id", "id")
    assert as_dict(got) == best(left, right, lambda x, y: float(len(sets(x) & sets(y))), 2.0)


def test_containment_equals_all_pairs(spark, sides):
    a, b, left, right = sides
    extra = spark.createDataFrame([(9000 + i, "p", t, "u") for i, t in enumerate(["a", "ab", "e", left[0][2][1:4], left[1][2] + " more"])], a.schema)
    b = b.unionByName(extra)
    right = [*right, *[tuple(r) for r in extra.collect()]]
    got = {(r["id_a"], r["id_b"], r["confidence"]) for r in relational.block_contains_match(a, b, "brand", "name", "id", "id").collect()}
    want = {(p[0], q[0], 0.95 if p[2] == q[2] else 0.8) for p in left for q in right if p[1] is not None and p[1] == q[1] and p[2] is not None and q[2] is not None and (p[2] in q[2] or q[2] in p[2])}
    assert got == want


def test_pairs_of_equal_rows_are_dealt_to_tasks(spark):
    """One name's rows on both sides, and rows without an id: all pairs, which no task makes most of."""
    rows = lambda n, name: spark.range(n).select(F.when(F.col("id") % 500 != 0, F.col("id")).alias("id"), F.lit("p").alias("brand"), F.lit(name).alias("name"))
    got = relational.block_contains_match(rows(4_000, "new bolt"), rows(1_500, "bolt"), "brand", "name", "id", "id")
    each = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("id_a").alias("a"), F.count("id_b").alias("b"), F.sum("id_a").alias("s"), F.sum("id_b").alias("t"), F.max("confidence").alias("c")).collect()
    ids = lambda n: [i for i in range(n) if i % 500]
    assert [sum(r[c] for r in each) for c in "nabst"] == [6_000_000, len(ids(4_000)) * 1_500, len(ids(1_500)) * 4_000, sum(ids(4_000)) * 1_500, sum(ids(1_500)) * 4_000]
    assert max(r["n"] for r in each) < 4_500_000 and {r["c"] for r in each} == {0.8}


def test_exact_ratio_and_how_few_pairs_reach_python(sides):
    a, b, left, right = sides
    ratio = lambda x, y: SequenceMatcher(None, x[0] or "", y[0] or "").ratio()
    assert as_dict(match.match_ratio(a, b, "brand", "name", "id", "id", 0.8)) == best(left, right, ratio, 0.8)
    pairs = match.ratio_pairs(a, b, "brand", "name", "id", 0.8).count()
    names = lambda rows, x: {r[2] for r in rows if r[1] == x}
    assert pairs <= sum(len(names(left, x)) * len(names(right, x)) for x in "pqz") / 20


def test_pairs_grow_below_the_square_of_a_block(spark):
    """Different names in one block: four times the names make far less than sixteen times the pairs."""
    made = {}
    for n in (250, 1_000):
        rng = random.Random(n)
        rows = [(i, "p", words(rng, 3)) for i in range(n)]
        a = spark.createDataFrame(rows, "id long, brand string, name string")
        x, y = candidates.numbered(a, "brand", ["name"], "a"), candidates.numbered(a, "brand", ["name"], "b")
        made[n] = [f(x, y, 0.8).count() for f in (candidates.edit_candidates(A, B), candidates.token_candidates(F.split(A, " "), F.split(B, " ")))]
    assert all(q <= 8 * p and q < 1_000 * 1_000 / 20 for p, q in zip(made[250], made[1_000], strict=True)), made
