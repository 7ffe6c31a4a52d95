"""Many rows of one id and one text, with ids and without: whole results, linear work."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from made_texts import prose

from granary.llm import common, lines, mixing, sharding, substrings

N = 5_000


@pytest.fixture(scope="module")
def repeated(spark):
    """An earlier document with the passage, then N equal rows with an id and N without."""
    rng = random.Random(6)
    passage = prose(rng, "en", 40)
    a, b, c = (f"{prose(rng, 'en', 12)} {passage} {prose(rng, 'en', 9)}" for _ in range(3))
    ones = spark.createDataFrame([(1, a, "s"), (9, prose(rng, "en", 60), "t")], "doc_id long, text string, source string")
    many = spark.range(N).select(F.lit(5).cast("long").alias("doc_id"), F.lit(b).alias("text"), F.lit("s").alias("source"))
    null = spark.range(N).select(F.lit(None).cast("long").alias("doc_id"), F.lit(c).alias("text"), F.lit(None).cast("string").alias("source"))
    return ones.unionByName(many).unionByName(null).repartition(8).persist(), (a, b, c)


def test_substrings_of_repeated_rows(repeated):
    docs, (a, b, c) = repeated
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in substrings.remove_repeats(docs).collect())

    def left(text: str, before: list[str]) -> tuple[int, int, int, bytes]:
        data = text.encode()
        seen = {o[i : i + 50] for o in (x.encode() for x in before) for i in range(len(o) - 49)}
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            if data[i : i + 50] in seen:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        return len(data), sum(gone), spans, bytes(x for x, g in zip(data, gone, strict=True) if not g)

    assert got[5, *left(b, [a])] == N and got[None, *left(c, [a, b])] == N and got[1, *left(a, [])] == 1
    assert sum(got.values()) == 2 * N + 2


def test_lines_of_repeated_rows(spark, monkeypatch):
    """Twelve documents share a line, two of them N times over: each loses it but the first."""
    line = "the same footer stands below every page here"
    ones = spark.createDataFrame([(i, f"words of {chr(97 + i) * 3}\n{line}") for i in range(10)], "doc_id long, text string")
    many = spark.range(N).select(F.lit(20).cast("long").alias("doc_id"), F.lit(f"one more\n{line}").alias("text"))
    null = spark.range(N).select(F.lit(None).cast("long").alias("doc_id"), F.lit(f"no id\n{line}").alias("text"))
    docs = ones.unionByName(many).unionByName(null).repartition(8)
    found = []
    monkeypatch.setattr(lines, "_candidates", lambda *a, f=lines._candidates: found.append(f(*a)) or found[-1])
    got = Counter((r["row"]["doc_id"], r["kept"], r["n_dropped"]) for r in lines.drop_lines(docs).collect())
    assert got == Counter({(0, f"words of aaa\n{line}", 0): 1, **{(i, f"words of {chr(97 + i) * 3}", 1): 1 for i in range(1, 10)}, (20, "one more", 1): N, (None, "no id", 1): N})
    assert found[0].count() <= 24  # lines of different documents


def test_once_keeps_one_of_each(spark):
    rows = spark.createDataFrame([(1, 1, "a")] * 3 + [(1, 2, "b"), (2, 1, "c"), (3, 3, "d"), (3, 3, "d")], "doc long, tag long, text string")
    assert sorted(tuple(r) for r in common.once(rows, "doc", ["tag"]).collect()) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 3, "d")]


@pytest.mark.parametrize("kind", ["shards", "mix"])
def test_rows_without_ids_spread_over_windows(spark, monkeypatch, kind):
    """A third of the rows has no id: no window of a rank holds twice the mean."""
    docs = spark.range(30_000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.concat(F.lit("w "), F.col("id")).alias("text"), F.lit("s").alias("source"))
    module = sharding if kind == "shards" else mixing
    monkeypatch.setattr(module, "RANK_ROWS", 3_000)
    sizes = []

    def watched(df, by, bucket, *a, f=common.two_level, **b):
        sizes.append([r["count"] for r in df.groupBy(*by, bucket).count().collect()])
        return f(df, by, bucket, *a, **b)

    monkeypatch.setattr(module, "two_level", watched)
    out = sharding.interleave(docs) if kind == "shards" else mixing.mix(docs)
    assert out.count() == 30_000
    assert len(sizes[0]) == 10 and max(sizes[0]) < 2 * 3_000
