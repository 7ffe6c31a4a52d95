"""Golden cases of the scalar transforms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.functions import parse as p
from granary.functions import text as t


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("25%", 25.0), ("25.5 %", 25.5), ("25,5", 25.5), ("140 %", None), ("none", None), (None, None)])
def test_percent(spark, text, want):
    assert one(spark, p.parse_percent, text) == want


@pytest.mark.parametrize(("text", "want"), [("2kg", 2.0), ("400g", 0.4), ("12 x 400g", 4.8), ("1,5 kg", 1.5), ("6 pieces", None), (None, None)])
def test_weight(spark, text, want):
    got = one(spark, p.parse_weight_kg, text)
    assert got == want if want is None else abs(got - want) < 1e-9


@pytest.mark.parametrize(("text", "want"), [("375 kcal/100g", 375.0), ("1570 kJ/100g", 375.239), ("3600 kcal/kg", 360.0), (None, None)])
def test_energy(spark, text, want):
    got = one(spark, p.parse_energy, text)
    assert got == want if want is None else abs(got - want) < 0.01


@pytest.mark.parametrize(("text", "want"), [("10-12 years", (10.0, 12.0)), ("10 to 12", (10.0, 12.0)), ("10–12", (10.0, 12.0)), ("11", (11.0, 11.0)), ("-", (None, None))])
def test_range(spark, text, want):
    assert tuple(one(spark, p.parse_range, text)) == want


def test_json(spark):
    doc = '{"data": {"brand": {"name": "Acme"}, "variations": [{"weight_label": "1kg"}, {"weight_label": "5kg"}]}}'
    assert one(spark, lambda c: p.json_get(c, ["data.none", "data.brand.name"]), doc) == "Acme"
    assert one(spark, lambda c: p.json_get(c, ["data.none"], "default"), doc) == "default"
    assert one(spark, lambda c: p.json_collect(c, "data.variations", "weight_label"), doc) == ["1kg", "5kg"]
    assert one(spark, lambda c: p.json_collect(c, "data.nothing", "weight_label"), doc) == []


def test_keys_have_defaults(spark):
    row = spark.createDataFrame([("A B", None)], "a string, b string").select(t.make_key([F.col("a"), F.col("b")]).alias("k"), t.fingerprint([F.col("a"), F.col("b")]).alias("f")).first()
    assert row["k"] == "a_b|unknown"
    assert len(row["f"]) == 32


def test_presence_is_never_null(spark):
    rows = spark.createDataFrame([(None, None), ("", []), (" ", ["x"]), ("a", ["x"])], "s string, a array<string>")
    got = rows.select(t.is_present(F.col("s")).alias("s"), t.is_present(F.col("a"), "array").alias("a")).collect()
    assert [(r["s"], r["a"]) for r in got] == [(False, False), (False, False), (False, True), (True, True)]


def test_arrays_are_repaired(spark):
    assert one(spark, p.repair_array, '["a","b"]') == ["a", "b"]
    assert one(spark, p.repair_array, "[broken") == []
    assert one(spark, p.repair_array, None) == []


def test_ladders_keep_their_order(spark):
    assert one(spark, lambda c: p.ordinal(c, [("friendly", 4), ("very friendly", 5)]), "Very friendly") == 4
    assert one(spark, lambda c: t.first_keyword(c, ["can", "canine"]), "canine") == "can"
