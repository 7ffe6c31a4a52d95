"""The pipeline's stages, each against its own input."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from granary.llm import mixing, packing, quality, simhash
from test_llm import WORD, brute_lines, jaccard


@pytest.fixture(scope="module")
def stages(spark, docs, sf):
    out, now = {"": docs.select(*corpus_pipeline.COLUMNS)}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf).persist()
        out[name] = now
    return {k: v.collect() for k, v in out.items()}


def test_columns(stages):
    names = ["", *[n for n, _ in corpus_pipeline.STAGES]]
    for n in names[:-1]:
        assert stages[n] and list(stages[n][0].asDict()) == list(corpus_pipeline.COLUMNS)


def test_quality_stage(stages, docs):
    kept = quality.judge(docs).where("kept").collect()
    assert Counter(r["doc_id"] for r in stages["quality_rules"]) == Counter(r["doc_id"] for r in kept)


def test_line_stage(stages):
    want = brute_lines([(r["doc_id"], r["text"]) for r in stages["quality_rules"]])
    assert Counter((r["doc_id"], r["text"]) for r in stages["line_dedup"]) == Counter({k[:2]: sum(n for x, n in want.items() if x[:2] == k[:2]) for k in want})
    assert sum(k[3] * n for k, n in want.items()) > 0


def test_near_stage(stages, spark, docs):
    rows = spark.createDataFrame(stages["line_dedup"], docs.select(*corpus_pipeline.COLUMNS).schema)
    groups = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(rows).collect()}
    assert Counter(r["doc_id"] for r in stages["near_dedup"]) == Counter(set(groups.values()))
    texts = {r["doc_id"]: r["text"] or "" for r in stages["line_dedup"]}
    ids = [k for k in texts if len(texts[k].split()) >= 5]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if jaccard(texts[a], texts[b]) >= 0.95:
                assert groups[a] == groups[b]


def test_mix_stage(stages, spark, docs):
    before = {r["doc_id"]: r for r in stages["near_dedup"]}
    used = Counter(r["doc_id"] for r in stages["mix_sources"])
    assert set(used) <= set(before) and max(used.values()) <= mixing.REPEATS
    rows = spark.createDataFrame(stages["near_dedup"], docs.select(*corpus_pipeline.COLUMNS).schema)
    want = {r["doc_id"]: sum(u["words"] * 2 >= r["size"] for u in r["uses"]) for r in mixing.mix(rows).collect()}
    assert used == Counter({k: n for k, n in want.items() if n})
    size = {k: len(WORD.findall(r["text"] or "")) for k, r in before.items()}
    for source in {r["source"] for r in before.values()}:
        mine = [k for k, r in before.items() if r["source"] == source]
        target = next(r["target"] for r in mixing.mix(rows).collect() if r["source"] == source)
        assert abs(sum(size[k] * used[k] for k in mine) - target) <= max(size[k] for k in mine) / 2 + 1


def test_pack_stage(stages):
    pieces = stages["pack_sequences"]
    whole = Counter()
    for r in pieces:
        whole[r["doc_id"]] += r["length"]
    used = Counter(r["doc_id"] for r in stages["mix_sources"])
    tokens_of = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert whole == Counter({k: n * tokens_of[k] for k, n in used.items()})


def test_sequences_follow_the_training_order(spark, sf, tmp_path):
    """Over the files of the written mix, sequence numbers rise from range to range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = corpus_pipeline.mix_sources(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
        mixed.write.parquet(str(tmp_path / "mix"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    again = spark.read.parquet(str(tmp_path / "mix"))
    assert again.select(F.input_file_name()).distinct().count() > 2
    out = packing.pack(again.withColumn("doc_id", F.struct(F.input_file_name().alias("file"), "doc_id")), order=F.input_file_name())
    spans = {r["file"]: (r["a"], r["b"]) for r in out.groupBy("doc_id.file").agg(F.min("sequence_id").alias("a"), F.max("sequence_id").alias("b")).collect()}
    order = [spans[f] for f in sorted(spans)]
    assert order[0][0] == 0 and order[0][1] < order[-1][0]
    assert not any(later[1] < early[0] for i, early in enumerate(order) for later in order[i:])
    pieces = corpus_pipeline.pack_sequences(spark, again, sf)
    assert pieces.agg(F.sum("length")).first()[0] == out.agg(F.sum("length")).first()[0]


def test_run_is_the_stages(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in entry.queries()
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [n for n, _ in corpus_pipeline.STAGES]
    assert simhash.BITS_APART == 2


def test_sql_of_mixing(spark, sf, duck):
    ours = entry.queries()["op3_mixing"](spark, sf).toPandas().sort_values("doc_id").reset_index(drop=True)
    theirs = duck.sql(entry.oracle_sql()["op3_mixing"]).df().sort_values("doc_id").reset_index(drop=True)
    assert ours[sorted(ours)].astype(float).fillna(-1).equals(theirs[sorted(theirs)].astype(float).fillna(-1))


def test_near_stage_is_brute_force(stages):
    """Groups by links of five-word shingle sets at 0.8, in both directions; documents without
    an id stay where no document with one is in their group."""
    rows = [(r["doc_id"], r["text"] or "") for r in stages["line_dedup"]]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if not a.split() and not b.split() or a.split() and b.split() and jaccard(a, b) >= 0.8:
                root[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    want = Counter(min(ks, key=lambda k: (k is None, k)) for ks in groups.values())
    assert Counter(r["doc_id"] for r in stages["near_dedup"]) == want
