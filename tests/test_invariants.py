"""Invariants: one row per key, conservation, idempotence, disjoint tiers, percent bounds."""

from __future__ import annotations

from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from granary import sources, streaming
from granary.operators import consolidate, ingest, match, phrases, quality, relational, variants
from granary.plans import consolidate as consolidate_plans
from granary.plans import ingest as ingest_plans
from granary.plans import matching as matching_plans
from granary.plans.registry import allowlist, catalogue, feed


def rows(df):
    return sorted(map(str, df.collect()))


def test_merge_keeps_one_row_per_key_and_all_sources(spark, sf):
    made = [consolidate_plans.keyed(x(spark, sf)) for x in (catalogue, feed)]
    got = consolidate.canonicalize(made, "product_key", consolidate_plans.order(), ["source", "id"])
    n = sum(x.count() for x in made)
    total = got.agg(F.count("*").alias("n"), F.countDistinct("product_key").alias("k"), F.sum(F.size("sources")).alias("s")).first()
    assert total["n"] == total["k"] and total["s"] == n
    assert got.where(F.col("sources")[0]["id"] != F.col("id")).count() == 0


def test_tied_rows_have_one_winner(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("k", 1, "a"), (None, 3, None)], "k string, id int, v string")
    got = consolidate.canonicalize([df], "k", [F.col("id")], ["v"])
    assert got.count() == 2 and got.where("k = 'k'").first()["id"] == 1


def test_migration_conserves_rows(spark, sf):
    parents, moved, log = variants.migrate_variants(matching_plans.sized(spark, sf), matching_plans.key(), "id", matching_plans.WEIGHTS, ["kcal"], "sized_name")
    assert parents.count() + moved.count() == catalogue(spark, sf).count()
    assert log.where("field <> 'kcal'").count() == 0


def test_staged_merge_is_idempotent(spark, sf):
    args = (allowlist(spark, sf), "id", ["brand", "product_name"], ["kcal"], ["ord"])
    staged = ingest_plans.staged(spark, sf)
    once, summary = ingest.merge_staged(ingest_plans.canon(spark, sf), staged, *args)
    twice, again = ingest.merge_staged(once, staged, *args)
    assert rows(once) == rows(twice)
    assert again.first()["inserted"] == 0 and again.first()["rekeyed"] == 0
    assert summary.first()["inserted"] > 0 and summary.first()["rekeyed"] > 0


def test_changes_are_idempotent_and_late_rows_are_dropped(spark):
    stored = spark.createDataFrame([("a", "1", 5, 9), ("b", "1", 5, 9)], "k string, fingerprint string, first_seen int, last_seen int")
    new = spark.createDataFrame([("a", "2", 10), ("b", "2", 8), ("c", "1", 10)], "k string, fingerprint string, seen int")
    got = {r["k"]: r for r in ingest.detect_changes(stored, new, "k").collect()}
    assert [got[k]["action"] for k in "abc"] == ["updated", "skipped", "new"]
    assert got["b"]["fingerprint"] == "1" and got["b"]["last_seen"] == 9
    again = ingest.detect_changes(ingest.detect_changes(stored, new, "k").drop("action"), new, "k")
    assert {r["action"] for r in again.collect()} == {"skipped"}


def test_upsert_modes(spark):
    base, new = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string"), spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "zz")], "k int, v string")
    assert {(r["k"], r["v"]) for r in ingest.upsert(base, new, "k").collect()} == {(1, "x"), (2, "y"), (3, "z")}
    assert {(r["k"], r["v"]) for r in ingest.upsert(base, new, "k", "nothing").collect()} == {(1, "a"), (2, None), (3, "z")}


def test_char_ratio_is_the_standard_library_s(spark):
    pairs = [("red ring", "red rings"), ("", ""), ("abc", "xyz"), (None, "a")]
    got = spark.createDataFrame(pairs, "a string, b string").select(match.char_ratio("a", "b").alias("r")).collect()
    assert [r["r"] for r in got] == [SequenceMatcher(None, a or "", b or "").ratio() for a, b in pairs]


def test_jaccard_is_symmetric_and_bounded(spark):
    df = spark.createDataFrame([(["a", "b"], ["b"]), ([], []), (["a"], ["a"])], "x array<string>, y array<string>")
    for r in df.select(match.jaccard(F.col("x"), F.col("y")).alias("p"), match.jaccard(F.col("y"), F.col("x")).alias("q")).collect():
        assert r["p"] == r["q"] and 0 <= r["p"] <= 1


def test_percent_columns_are_bounded(spark, sf):
    table = quality.quality_table(catalogue(spark, sf), ["brand"], quality.Profile(("kcal", "fat"), band=("kcal", 1, 2), marks={"kcal": 50}))
    assert table.where((F.col("kcal_pct") < 0) | (F.col("kcal_pct") > 100)).count() == 0
    assert table.where("status = 'PASS' and outliers > 0").count() == 0


def test_empty_tables(spark, sf):
    none = catalogue(spark, sf).where("false")
    assert relational.coverage_pct(none, ["brand"], {"kcal": F.col("kcal")}).count() == 0
    assert quality.gate_table(none, {"g": (F.col("kcal") > 1, 5)}).first()["passed"] is False
    assert consolidate.canonicalize([none], "brand", [F.col("id")], ["id"]).count() == 0
    assert quality.field_coverage(none, ["kcal"]).first()["n_present"] == 0


def test_anti_join_keeps_null_keys(spark):
    a, b = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int")
    assert [r["k"] for r in relational.anti_on(a, b, ["k"]).collect()] == [None]


def test_duplicates_fill_in_score_order(spark):
    df = spark.createDataFrame([(1, "k", None, "x"), (2, "k", 5, None), (3, "k", 7, "y")], "id int, k string, a int, b string")
    winners, log = variants.merge_duplicates(df, F.col("k"), "id", {"a": 1, "b": 1}, ["a", "b"])
    assert winners.first()["id"] == 3 and log.count() == 0
    winners, log = variants.merge_duplicates(df.where("id < 3"), F.col("k"), "id", {"a": 3, "b": 1}, ["a", "b"])
    w = winners.first()
    assert (w["id"], w["a"], w["b"]) == (2, 5, "x")
    assert [tuple(r) for r in log.collect()] == [(2, "b", 1)]


def test_pages_give_pairs(spark):
    html = "<table><tr><th>Crude Protein</th><td>28%</td></tr><tr><th>Crude Fat</th><td>18%</td></tr><tr><th>Metabolizable Energy</th><td>1570 kJ/100g</td></tr></table><nav><p>no</p></nav><h3>Analytical</h3><p>Fibre 3%, Ash: 7,2%"
    page = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id long, html string")
    pairs = ingest.extract_pairs(page)
    assert pairs.where("value = 'no'").count() == 0
    got = ingest.nutrition(pairs).first()
    assert (got["protein_percent"], got["fat_percent"], got["fiber_percent"], got["ash_percent"]) == (28.0, 18.0, 3.0, 7.2)
    assert abs(got["kcal_per_100g"] - 375.2) < 0.5
    assert ingest.sections(pairs, {"analysis": "analytical"}, 2).first()["analysis"].startswith("Fibre")


def test_files_round_trip(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,\n")
    assert [(r["k"], r["v"]) for r in sources.read_csv(spark, str(tmp_path / "a.csv"), "k int, v string").collect()] == [(1, "x"), (2, None)]
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"k": 1}\nnot json\n{"k": 2}\n')
    assert sorted(r["k"] for r in sources.read_jsonl(spark, str(tmp_path / "a.jsonl.gz"), "k int", 2).collect()) == [1, 2]
    (tmp_path / "b.json").write_text('[{"k": 1}, {"k": 2}]')
    assert sources.read_json_array(spark, str(tmp_path / "b.json"), "k int").count() == 2
    df = spark.range(5)
    path = sources.snapshot(df, str(tmp_path), "before")
    with pytest.raises(Exception, match="(?i)exist"):
        sources.snapshot(df, str(tmp_path), "before")
    stored = sources.read_table(spark, path, ["id"])
    fresh = sources.refresh(stored.where("id < 3"), path)
    assert fresh.count() == 3
    sources.write(fresh, str(tmp_path / "out"), fmt="csv")
    assert sources.read_many(spark, f"{path}/*.parquet").select("file").distinct().count() >= 1
    assert sources.materialize(fresh, "kept_table").count() == 3
    assert sources.load_rules(spark, [("a", 1)], "k string, v int").count() == 1


def test_a_refresh_that_dies_leaves_the_table(spark, tmp_path):
    """At any moment `current` reads a whole table: before, after, and with a half-written version."""
    path = str(tmp_path / "table")
    sources.write(spark.range(10), path)
    broken = spark.range(10).select(F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sources.refresh(broken, path)
    assert sources.current(spark, path).count() == 10
    (tmp_path / "table.versions" / "v000000001" / "part-0.parquet").parent.mkdir(parents=True, exist_ok=True)
    (tmp_path / "table.versions" / "v000000001" / "part-0.parquet").write_bytes(b"half")
    assert sources.current(spark, path).count() == 10
    held = sources.current(spark, path)
    for n in (8, 6, 4):
        before = sources.current(spark, path)
        assert sources.refresh(before.where(F.col("id") < n), path).count() == n == sources.current(spark, path).count()
        assert before.count() == n + 2
    assert held.count() == 10 and len(list((tmp_path / "table.versions").iterdir())) == 2


def test_rules_are_few_or_refused(spark, monkeypatch, tmp_path):
    assert spark.range(1).select(F.size(phrases.rule_array(spark.range(3), 3, 1_000)).alias("n")).first()["n"] == 3
    with pytest.raises(ValueError, match="over 3 rules"):
        phrases.rule_array(spark.range(4), 3, 1_000)
    (tmp_path / "rules.yaml").write_text("# rules\nmeat:\n  - beef\n  - 'lamb'\nfish:\n  - \"cod\"\nnone:\n")
    assert sorted(map(tuple, sources.read_rules(spark, str(tmp_path / "rules.yaml")).collect())) == [("fish", "cod"), ("meat", "beef"), ("meat", "lamb")]


def test_pairs_of_a_block_are_of_different_values(spark):
    """Ten thousand copies of five names make 25 pairs, in several parts; the best of each row is right."""
    a = spark.range(10_000).select("id", F.lit("b").alias("block"), F.concat(F.lit("name "), (F.col("id") % 5).cast("string")).alias("name"))
    pairs = relational.block_pairs(a, a, "block", ["name"], F.min("id"))
    assert pairs.count() == 25
    got = match.match(a, a.withColumnRenamed("id", "ref"), "block", "id", "ref", {"n": (1.0, match.edit_similarity(F.col("a_name"), F.col("b_name")))}, ["name"], [("same", 1.0)])
    assert got.where("match_id = id % 5 and score = 1 and tier = 'same'").count() == 10_000


def test_reverting_snapshots_are_changes(spark):
    df = spark.createDataFrame([("k", "A", 1), ("k", "B", 2), ("k", "A", 3), ("k", "A", 4)], "k string, fingerprint string, seen int")
    assert sorted((r["fingerprint"], r["seen"]) for r in streaming.changed_within(df, "k").collect()) == [("A", 1), ("A", 3), ("B", 2)]


def test_snapshot_stream(spark, tmp_path):
    path, source = str(tmp_path / "table"), str(tmp_path / "in")
    spark.createDataFrame([("a", "1", 1, 1)], "k string, fingerprint string, first_seen int, last_seen int").write.parquet(path)
    spark.createDataFrame([("a", "2", 5), ("b", "1", 5), ("b", "2", 6)], "k string, fingerprint string, seen int").write.parquet(source)
    stream = spark.readStream.schema("k string, fingerprint string, seen int").parquet(source)
    start = streaming.snapshot_stream(stream, path, "k")
    start(str(tmp_path / "checkpoint")).awaitTermination()
    got = {r["k"]: (r["fingerprint"], r["last_seen"]) for r in sources.current(spark, path).collect()}
    assert got == {"a": ("2", 5), "b": ("2", 6)}


def test_merge_stream(spark, tmp_path):
    path, source = str(tmp_path / "table"), str(tmp_path / "in")
    spark.createDataFrame([(1, "b1", "n1", None)], "id long, brand string, name string, kcal double").write.parquet(path)
    spark.createDataFrame([(1, "b1", "n1", 5.0, 1), (2, "b1", "n2", 6.0, 2), (3, "b9", "n3", 7.0, 3)], "id long, brand string, name string, kcal double, ord int").write.parquet(source)
    allow = spark.createDataFrame([("b1", "ACTIVE")], "brand string, status string")
    stream = spark.readStream.schema("id long, brand string, name string, kcal double, ord int").parquet(source)
    streaming.merge_stream(stream, path, allow, "id", ["brand", "name"], ["kcal"], ["ord"])(str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted((r["id"], r["kcal"]) for r in sources.current(spark, path).collect()) == [(1, 5.0), (2, 6.0)]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
