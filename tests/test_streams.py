"""Streams: keyed state, batches that repeat or crash, refreshes that meet."""

from __future__ import annotations

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from granary import sources, streaming
from granary.operators import ingest, relational

CANON = "id long, brand string, name string, kcal double"
STAGED = "id long, brand string, name string, kcal double, ord long"
HOW = ("id", ["brand", "name"], ["kcal"], ["ord"])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def allow(spark):
    return spark.createDataFrame([("L", "ACTIVE")], "brand string, status string")


def test_a_repeated_merge_changes_nothing(spark, allow):
    """Two rows and two staged keys of one pair that isn't listed: the first key takes a row, the
    second is skipped, now and whenever the stage is run again."""
    canon = spark.createDataFrame([(10, "X", "foo", None), (20, "X", "foo", None), (50, "L", "bar", None)], CANON)
    staged = spark.createDataFrame([(30, "X", "foo", 1.0, 1), (40, "X", "foo", 2.0, 2), (60, "L", "bar", 3.0, 3), (70, "L", "bar", 4.0, 4), (80, "L", "new", 5.0, 5)], STAGED)
    want = [(20, "X", "foo", None), (30, "X", "foo", 1.0), (60, "L", "bar", 3.0), (70, "L", "bar", 4.0), (80, "L", "new", 5.0)]
    for _ in range(3):
        canon, summary = ingest.merge_staged(canon, staged, allow, *HOW)
        canon = spark.createDataFrame(canon.collect(), CANON)
        assert rows(canon) == want
    assert summary.first()["skipped"] == 1


def test_a_batch_that_crashed_is_merged_once(spark, allow, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sources.write(spark.createDataFrame([(10, "X", "foo", None)], CANON), path)
    batch = streaming.merge_batch(path, allow, *HOW)
    one = spark.createDataFrame([(30, "X", "foo", 1.0, 1)], STAGED)
    two = spark.createDataFrame([(31, "L", "new", 2.0, 1)], STAGED)
    batch(one, 0)
    real = streaming.ingest.refresh

    def dies_before(df, path, how):
        raise RuntimeError("before the commit")

    def dies_after(df, path, how):
        real(df, path, how)
        raise RuntimeError("after the commit")

    for dies in (dies_before, dies_after):
        monkeypatch.setattr(streaming.ingest, "refresh", dies)
        with pytest.raises(RuntimeError):
            batch(two, 1)
    monkeypatch.setattr(streaming.ingest, "refresh", lambda *a: pytest.fail("merged again"))
    batch(two, 1)
    batch(spark.createDataFrame([(99, "L", "other", 2.0, 1)], STAGED), 0)
    monkeypatch.setattr(streaming.ingest, "refresh", real)
    assert rows(sources.current(spark, path)) == [(30, "X", "foo", 1.0), (31, "L", "new", 2.0)]
    assert sources.batches_done(spark, path) == {"merge": 1}
    sources.refresh(sources.current(spark, path).where("id = 31"), path)
    assert sources.batches_done(spark, path) == {"merge": 1} and sources.current(spark, path).count() == 1


def test_two_refreshes_that_meet(spark, tmp_path, monkeypatch):
    """Both write at once; one commits, the other gets an error and leaves nothing behind."""
    path = str(tmp_path / "table")
    sources.write(spark.range(10), path)
    gate, got = threading.Barrier(2), []
    real = sources.files._commits

    def together(*a):
        out = real(*a)
        gate.wait(60)  # both have seen the same last commit
        return out

    monkeypatch.setattr(sources.files, "_commits", together)

    def write(n):
        try:
            sources.refresh(spark.range(n), path)
            got.append(n)
        except Exception as e:  # noqa: BLE001
            got.append(str(e))

    both = [threading.Thread(target=write, args=(n,)) for n in (3, 4)]
    [t.start() for t in both]
    [t.join(120) for t in both]
    monkeypatch.setattr(sources.files, "_commits", real)
    won = [n for n in got if isinstance(n, int)]
    assert len(got) == 2 and len(won) == 1
    assert sources.current(spark, path).count() == won[0]
    assert len(list((tmp_path / "table.versions").iterdir())) == 1
    assert [x.name for x in (tmp_path / "table.commits").iterdir() if x.name[0] not in "._"] == ["000000001"]


def test_keyed_state_over_batches_and_a_restart(spark, tmp_path):
    """A, B, A over three micro-batches are three changes; late rows are skipped; a restart from
    the checkpoint goes on where it was; no batch reads what older ones wrote."""
    schema = "k string, seen long, fingerprint string"

    def put(made):
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = streaming.append_changes(stream, str(tmp_path / "out"), "k")(str(tmp_path / "checkpoint"))
        query.awaitTermination()
        return query

    put([("a", 1, "A"), ("b", 1, "X"), ("b", 2, "X"), (None, 5, "N")])
    go()
    put([("a", 2, "B"), ("a", 2, "B"), ("b", 3, "X")])
    put([("a", 3, "A"), ("a", 1, "late"), ("b", 3, "same time"), (None, 6, "N"), ("c", 9, "Z"), ("c", None, "no time"), ("c", 10, None)])
    second = go()
    assert len([p for p in second.recentProgress if p["numInputRows"]]) == 2
    put([("a", 4, "A"), ("a", 6, "D"), ("a", 5, "C"), ("c", 9, "Z")])
    go()
    out = rows(spark.read.parquet(str(tmp_path / "out")))
    want = [("a", "A", 1, "new"), ("a", "B", 2, "updated"), ("a", "A", 3, "updated"), ("a", "C", 5, "updated"), ("a", "D", 6, "updated"), ("b", "X", 1, "new"), (None, "N", 5, "new"), ("c", "Z", 9, "new")]
    assert out == sorted(want, key=str)
    assert rows(streaming.latest(spark.read.parquet(str(tmp_path / "out")), "k")) == sorted([("a", "D", 1, 6), ("b", "X", 1, 1), (None, "N", 5, 5), ("c", "Z", 9, 9)], key=str)


def test_a_timer_forgets_a_key(spark, tmp_path):
    """After an hour without a snapshot a key's next one is new, though nothing has changed."""
    schema = "k string, seen timestamp, fingerprint string"
    at = lambda m: datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(minutes=m)
    for made in ([("a", at(0), "A"), ("b", at(0), "B")], [("b", at(50), "B")], [("b", at(100), "B")], [("a", at(110), "A"), ("b", at(120), "B")]):
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streaming.append_changes(stream, str(tmp_path / "out"), "k", expire_ms=3_600_000, late="0 seconds")(str(tmp_path / "checkpoint")).awaitTermination(100)
    got = [(r["k"], r["action"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == [("a", "new"), ("a", "new"), ("b", "new")]
    with pytest.raises(ValueError, match="timestamps"):
        streaming.fingerprint_changes(stream.withColumn("seen", stream["seen"].cast("long")), "k", 1)


def test_keyed_state_equals_the_batch_operator(spark, tmp_path):
    made = [(f"k{i * 7 % 11}", i, f"f{i * i % 3}") for i in range(200)]
    schema = "k string, seen long, fingerprint string"
    for i in range(3):
        spark.createDataFrame(made[i * 70 : (i + 1) * 70], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streaming.append_changes(stream, str(tmp_path / "out"), "k")(str(tmp_path / "checkpoint")).awaitTermination()
    want = streaming.changed_within(spark.createDataFrame(made, schema), "k").select("k", "fingerprint", "seen")
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop("action")) == rows(want)


def test_sketches_are_within_their_bound(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user"))
    kept = relational.distinct_sketches(rows, ["day"], "user")
    exact = {r["day"]: r["n"] for r in rows.groupBy("day").agg(F.countDistinct("user").alias("n")).collect()}
    assert all(abs(r["n_distinct"] - exact[r["day"]]) <= 0.03 * exact[r["day"]] and r["n"] == 2_000 for r in relational.united(kept, ["day"]).collect())
    whole = relational.united(kept, [F.lit("all").alias("all")]).first()
    n = rows.select("user").distinct().count()
    assert abs(whole["n_distinct"] - n) <= 0.03 * n and whole["n"] == 60_000


def test_bad_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\nnot json\n{"k": "text"}\n{"k": 2}\n\n{"k"\n')
    good, bad, counts = sources.quarantine_jsonl(spark, str(tmp_path / "a.jsonl"), "k long", str(tmp_path / "out"))
    assert sorted(r["k"] for r in good.collect()) == [1, 2]
    assert sorted(r["line"] for r in bad.collect()) == ["not json", '{"k"', '{"k": "text"}'] and bad.first()["file"] == "a.jsonl"
    assert counts == {"good": 2, "bad": 3}
