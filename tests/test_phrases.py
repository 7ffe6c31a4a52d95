"""Rule lists: within the row, by automaton and by runs, against plain loops."""

from __future__ import annotations

import random

import pytest

from granary.operators import brands, phrases, relational, rules

TEXTS = [(1, "old red rod"), (1, "old red rod"), (None, "a rodeo"), (2, ""), (3, None), (4, "RING of fire"), (5, "x" * 5_000 + "rod")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(TEXTS, "id long, name string")


def test_vocabulary_of_many_rules(spark, rows):
    """100,000 phrases and more, no nested loop, no shuffle of rows; repeated and null keys each get theirs."""
    rng = random.Random(1)
    many = [(i + 10, "".join(rng.choice("abcdefghij") for _ in range(9)), f"v{i}", i % 50 == 0) for i in range(100_000)]
    few = [(1, "old red rod", "exact", True), (5, "rod", "stick", False), (4, "red", "colour", False), (3, "ring", "ring", False), (4, "old", "aged", False)]
    table = spark.createDataFrame(many + few, "ord int, pattern string, value string, exact boolean")
    got = rules.map_vocab(rows, "id", "name", table)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"] or 0, r["value"] or "") for r in got.collect()) == [(0, "stick"), (1, "exact"), (1, "exact"), (2, ""), (3, ""), (4, "ring"), (5, "stick")]


def test_smaller_phrase_of_equal_order(spark, rows):
    table = spark.createDataFrame([(1, "rod", "b"), (1, "old", "a"), (2, "", "c")], "ord int, phrase string, canonical string")
    got = rules.with_phrase(rows, rows["name"], table, "phrase", ["canonical"])
    assert sorted((r["id"] or 0, r["canonical"] or "") for r in got.collect()) == [(0, "b"), (1, "a"), (1, "a"), (2, "c"), (3, ""), (4, "c"), (5, "b")]


def test_phrases_go_by_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 12)
    table = spark.createDataFrame([(i, p) for i, p in enumerate(["rod", "red", "old", "ring", "od", "fire", "zzz"])], "no int, p string")
    got = {(r["name"] or "")[-4:]: sorted(r["h"]) for r in rows.select("name", phrases.phrase_hits(rows["name"], table, "p", "no").alias("h")).collect()}
    assert got[" rod"] == [0, 1, 2, 4] and got["fire"] == [5] and got[""] == [] and got["xrod"] == [0, 4]
    first = {(r["name"] or "")[-4:]: r["f"] for r in rows.select("name", phrases.first_phrase(rows["name"], table, "p", "no").alias("f")).collect()}
    assert first[" rod"] == 0 and first["fire"] == 5 and first[""] is None


@pytest.mark.parametrize("literal", [None, "lit"])
def test_patterns_of_a_column(spark, rows, literal):
    table = spark.createDataFrame([("a", r"\brod\b", "rod"), ("b", "r.d", "r"), ("c", "^x+rod$", "rod"), ("d", "nothing", "nothing")], "rule string, pattern string, lit string")
    got = relational.rule_cross(rows, table, "name", "pattern", literal)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"] or 0, r["rule"]) for r in got.collect()) == [(0, "b"), (1, "a"), (1, "a"), (1, "b"), (1, "b"), (5, "b"), (5, "c")]


@pytest.mark.parametrize("mode", ["prefix", "contains"])
def test_token_groups_by_containment(spark, mode):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 5)))
    tokens = [(i, [word() for _ in range(rng.randint(0, 4))]) for i in range(60)] + [(60, None)]
    table = [(f"g{i % 5}", word()) for i in range(25)]
    df = spark.createDataFrame(tokens, "id long, tokens array<string>")
    got = {r["id"]: r["groups"] for r in rules.token_groups(df, "id", "tokens", spark.createDataFrame(table, "grp string, token string"), mode).collect()}
    hit = (lambda t, w: t.startswith(w)) if mode == "prefix" else (lambda t, w: w in t)
    assert got == {i: sorted({g for g, w in table for t in ts or () if hit(t, w)}) for i, ts in tokens}


def test_canonical_tokens_by_containment(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 6)))
    tokens = [(i, [word() for _ in range(rng.randint(1, 4))]) for i in range(60)]
    table = [(w, w.upper()) for w in {word() + "d" for _ in range(20)}]
    got = {r["id"]: r["tokens"] for r in rules.canonical_tokens(spark.createDataFrame(tokens, "id long, tokens array<string>"), "id", "tokens", spark.createDataFrame(table, "token string, canonical string"), "contains").collect()}
    assert got == {i: [min(((w, c) for w, c in table if w in t or t in w), default=(t, t))[1] for t in ts] for i, ts in tokens}


def test_ranked_rules_within_the_row(spark):
    """Repeated and null keys get their rule; lists that are too long are refused."""
    rows = spark.createDataFrame([(1, "A", "new gizmo"), (1, "A", "old gizmo"), (None, "b", "new thing"), (2, None, None)], "id long, brand string, product_name string")
    table = spark.createDataFrame([(1, "A", "^new ", 0.95), (2, "*", "gizmo$", 0.5)], "ord int, brand string, pattern string, confidence double")
    got = [(r["id"], r["name_clean"], r["action"]) for r in brands.clean_names(rows, "id", table).collect()]
    assert sorted(got, key=str) == sorted([(1, "gizmo", "safe"), (1, "old gizmo", "review"), (None, "new thing", "none"), (2, None, "none")], key=str)
    with pytest.raises(ValueError, match="over 1 rules"):
        phrases.rule_array(table, 1, 1 << 20)
