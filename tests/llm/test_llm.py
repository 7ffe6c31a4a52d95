"""The training-data operators against brute force, on rows with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from made_texts import prose

from granary.llm import common, language, lines, mixing, packing, quality, sharding, simhash, substrings, tiff, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def got(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# 1 language


def test_language_beats_chance_by_far(docs, docs_rows):
    out = language.language_mixtures(docs).collect()
    assert len(out) == len(docs_rows)
    right = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 120 and r["held_out"]]
    want = {r[0]: r[2] for r in docs_rows}
    assert right and sum(r["lang_pred"] == want[r["doc_id"]] for r in right) / len(right) >= 0.95
    for r in out:
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (141, 142, 143, 144):
            assert r["lang_pred"] == "und" and r["score"] == 0


def test_mixtures_are_recovered(spark, docs):
    rng = random.Random(9)
    langs, logp = language.learn(docs.where("doc_id < 120").select("lang", "text"))
    text = prose(rng, "en", 60) + " . " + prose(rng, "de", 40)
    share = dict(zip(langs, language.mixtures([text], logp)[0], strict=True))
    assert abs(share["en"] - 0.6) < 0.12 and abs(share["de"] - 0.4) < 0.12 and share["fr"] == 0
    alone = language.mixtures([prose(rng, "fr", 50)], logp)[0]
    assert alone.max() == 1 and (alone > 0).sum() == 1


def plain_em(text, logp):
    """The mixture by loops over words, from the definitions."""
    import unicodedata

    letter = lambda c: unicodedata.category(c)[0] == "L"
    low, words = "\0" + text.lower() + "\0", []
    for i, c in enumerate(low):
        if letter(c):
            if not letter(low[i - 1]):
                words.append(np.zeros(logp.shape[1]))
            a, b, d = (ord(x) if letter(x) else 0 for x in low[i - 1 : i + 2])
            h = (a * 0x9E3779B1 + b * 0x85EBCA77 + d * 0xC2B2AE3D) % 2**32
            h ^= h >> 15
            h = h * 0x2C1B3C6D % 2**32
            words[-1] = words[-1] + logp[(h >> 16) & (language.BUCKETS - 1)].astype(np.float64)
    k = logp.shape[1]
    if not words:
        return np.zeros(k)
    peak = [w.max() for w in words]
    p = [np.exp(w - m) for w, m in zip(words, peak, strict=True)]

    def em(theta, steps):
        for _ in range(steps):
            theta = sum(theta * x / (theta * x).sum() for x in p) / len(p)
        return theta, sum(np.log((theta * x).sum()) for x in p)

    alone = sum(words)
    best, value = np.eye(k)[alone.argmax()], alone.max() - sum(peak)
    theta, full = em(np.full(k, 1 / k), language.STEPS)
    price = language.PENALTY * np.log(max(len(words), 2))
    if full - value > price:
        rank = np.argsort(np.argsort(-theta, kind="stable"))
        for size in range(2, min(k, language.SET_MOST) + 1):
            part = np.where(rank < size, theta + 1e-6, 0)
            fit, got_ = em(part / part.sum(), language.STEPS_SET)
            if got_ - price * (size - 1) > value:
                best, value = fit, got_ - price * (size - 1)
    return best


def test_mixtures_are_those_of_plain_em(docs, docs_rows, monkeypatch):
    rng = random.Random(19)
    langs, logp = language.learn(docs.where("doc_id < 120").select("lang", "text"))
    texts = [r[1] or "" for r in docs_rows[:30] + docs_rows[140:150] if len(r[1] or "") < 5000]
    for _ in range(20):
        texts.append(" ".join(prose(rng, rng.choice(["en", "fr", "de"]), rng.randint(1, 30)) for _ in range(3)))
    want = np.array([plain_em(x, logp) for x in texts])
    assert np.allclose(language.mixtures(texts, logp), want, atol=1e-4) and ((want > 0).sum(axis=1) > 1).sum() > 5
    monkeypatch.setattr(language, "CHUNK", 50)
    assert np.allclose(language.mixtures(texts, logp), want, atol=1e-4)


def test_too_many_languages_are_refused(docs, monkeypatch):
    monkeypatch.setattr(language, "LANGS_MOST", 2)
    with pytest.raises(ValueError, match="over 2"):
        language.language_mixtures(docs)


def test_language_without_learning_rows(docs, no_docs):
    assert language.language_mixtures(no_docs).count() == 0
    assert {r["lang_pred"] for r in language.language_mixtures(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# 2 packing, 5 token counts


@pytest.fixture(scope="module")
def encoded(docs_rows):
    t = tokens.load()
    return [t.encode(r[1] or "", add_special_tokens=False).ids for r in docs_rows]


def test_token_counts(docs, docs_rows, encoded):
    want = Counter((r[0], len((r[1] or "").encode()), len(ids), len(ids) > 512) for r, ids in zip(docs_rows, encoded, strict=True))
    assert got(tokens.token_counts(docs), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_tokenizers(docs, docs_rows, name):
    t = tokens.load(name)
    n = [len(t.encode(r[1] or "", add_special_tokens=False).ids if name.endswith("json") else t.encode(r[1] or "")) for r in docs_rows]
    assert got(tokens.token_counts(docs, tokenizer=name), "doc_id", "n_tokens") == Counter((r[0], k) for r, k in zip(docs_rows, n, strict=True))


def test_safe_cuts_keep_the_ids():
    rng, t = random.Random(3), tokens.load()
    alphabet = [*"ab Z'\n\t  \r\x0b\x1c\x85\xa0é中日ñ1½!#<|>,._-😀　​", "<|endoftext|>", "'s", "n't", "  ", "\n\n", " the", *"。，、？(（）)?:；한あЖΩ\u2028"]
    encode = tokens.Encoder()
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode([text])[0], dtype="<u4").tolist() == want
        parts = tokens.split_long(text, 9)
        assert "".join(parts) == text and sum((t.encode(p, add_special_tokens=False).ids for p in parts), []) == want


def test_long_texts_are_cut_and_batches_hold_bytes():
    cjk = "这是一个没有空格的句子。" * 4000
    odd = "word\u00a0word and more, " * 4000
    for text in (cjk, odd):
        parts = tokens.split_long(text, 1000)
        assert "".join(parts) == text and max(map(len, parts)) < 1100
    assert tokens.split_long("a" * 5000, 1000) == ["a" * 5000]
    runs = list(tokens.by_bytes(["é" * 300] * 10 + [None, "x" * 5000], 1000))
    assert [sum(map(tokens.n_bytes, r)) for r in runs] == [600] * 10 + [5000]
    t = tokens.load()
    assert sum(tokens.Encoder(lengths=True)(tokens.split_long(cjk, 1000))) == len(t.encode(cjk, add_special_tokens=False).ids)


def test_packing_is_whole_and_tight(docs, docs_rows, encoded):
    out = packing.pack(docs).collect()
    by_doc = defaultdict(list)
    for r, ids in zip(docs_rows, encoded, strict=True):
        by_doc[r[0]].append([*ids, 1])
    pieces = defaultdict(Counter)
    for r in out:
        pieces[r["doc_id"]][r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    for k, all_ids in by_doc.items():
        want = Counter()
        for ids in all_ids:
            for s in range(0, len(ids), 2048):
                want[s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], dtype="<u4").tobytes()), len(ids)] += 1
        assert pieces[k] == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in out)
    assert len(sequences) <= -(-total // 2048) * 1.15 + 1


def test_sequences_follow_the_order(spark, docs, docs_rows):
    """Documents in five files of a training order: sequences come by quarters of it."""
    many = docs.where("doc_id < 140").unionByName(docs.where("doc_id < 140")).unionByName(docs.where("doc_id = 140"))
    rank = F.concat(F.lit("part-"), F.col("doc_id") % 5)
    out = packing.pack(many.withColumn("file", rank), order=F.col("file")).withColumn("file", F.col("doc_id") % 5).collect()
    assert sum(r["length"] for r in out) == sum(r["length"] for r in packing.pack(many).collect())
    total, at, part = sum(r["length"] for r in out), 0, {}
    for f in range(5):
        n = sum(r["length"] for r in out if r["file"] == f)
        part[f] = int((at + n / 2) / total * packing.RANGES)
        at += n
    assert len(set(part.values())) == 4
    ids = {q: {r["sequence_id"] for r in out if part[r["file"]] == q} for q in set(part.values())}
    edges = [(min(v), max(v)) for _, v in sorted(ids.items())]
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:], strict=False)) and edges[0][0] == 0
    assert sorted(set().union(*ids.values())) == list(range(edges[-1][1] + 1))
    filled = defaultdict(int)
    for r in out:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048


def test_plan_uses_each_piece_once():
    rng = random.Random(1)
    for hist in ({}, {5: 3}, {2048: 4, 1024: 3, 700: 50, 30: 9}, {rng.randint(1, 2048): rng.randint(1, 40) for _ in range(300)}):
        used = Counter()
        for lengths, n in packing.plan(hist):
            assert n > 0 and 0 < sum(lengths) <= 2048
            for x in lengths:
                used[x] += n
        assert used == Counter(hist)


def test_nnls_meets_a_histogram_that_combinations_make():
    hist = np.zeros(2049)
    hist[[1000, 548, 500]] = 100
    combos = packing.combinations(np.flatnonzero(hist), 2048)
    assert [1000, 548, 500] in combos.tolist()
    x = packing.solve_nnls(combos, hist)
    assert abs(x.sum() - 100) < 1


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0 and tokens.token_counts(no_docs).count() == 0


# 3 mixing, 4 sharding


def test_mix_meets_targets(docs, docs_rows):
    out = mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "uses").collect()
    sizes = [len(WORD.findall(r[1] or "")) for r in docs_rows]
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r[0], n) for r, n in zip(docs_rows, sizes, strict=True))
    per = Counter()
    for r, n in zip(docs_rows, sizes, strict=True):
        per[r[3]] += n
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(per.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * per[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * per[s] for s in full}
        open_ -= full
    taken = Counter()
    for r in out:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == per[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(u["words"] for u in r["uses"])
        assert all(0 <= u["position"] <= 1 for u in r["uses"])
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(target[s] + 1e-9) for s in names)
    again = mixing.mix(docs.repartition(5)).select("doc_id", "taken").collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in out)


def test_places_are_those_of_the_training_order(docs):
    mixed = mixing.mix(docs)
    at, want = 0, defaultdict(list)
    for r in mixing.training_order(mixed).select("row.doc_id", "row.text", "words", "position", "pass").collect():
        want[r["doc_id"], r["text"], r["pass"]].append((r["position"], at))
        at += r["words"]
    out = mixing.placed(mixed).collect()
    ours = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["position"], r["place"]) for r in out if r["place"] is not None)
    theirs = sorted((k[0] is None, k[0] or 0, p, a) for k, v in want.items() if k[2] == 0 for p, a in v)
    assert ours == theirs
    lasts = Counter(r["last_place"] for r in out if r["place"] is not None)
    assert set(lasts) <= {a for v in want.values() for _, a in v} and max(lasts.values()) == 1
    assert len(out) == docs.count() and all((r["taken"] == 0) == (r["place"] is None) for r in out)


def test_training_order_is_sorted_and_carries_rows(docs):
    mixed = mixing.mix(docs)
    order = mixing.training_order(mixed).select("position", "row.*").collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    assert order[0]["shard"] == "x" and order[0]["size"] == 7


def test_position_inverts_the_ramp(spark):
    for a, b in ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0)):
        df = spark.createDataFrame([(i / 10,) for i in range(11)], "t double")
        cum = (F.lit(a) * F.col("t") + (b - a) * F.col("t") ** 2 / 2) / ((a + b) / 2)
        rows = df.select("t", mixing.position(cum * 50, F.lit(50.0), F.lit(a), F.lit(b)).alias("p")).collect()
        assert all(abs(r["t"] - r["p"]) < 1e-9 for r in rows)


def test_shards_are_even_and_proportional(docs, docs_rows):
    out = sharding.interleave(docs).collect()
    clean = [(r[1] or "").encode() for r in docs_rows]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((r[0], len(t) + 1, zlib.crc32(t)) for r, t in zip(docs_rows, clean, strict=True))
    shards = defaultdict(list)
    for r in out:
        shards[r["shard"]].append(r)
    counts = [len(shards[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for rows in shards.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    for source, n in Counter(r["source"] for r in out).items():
        each = [sum(r["source"] == source for r in rows) for rows in shards.values()]
        assert max(each) - min(each) <= 2 and sum(each) == n


def test_shards_are_the_exact_cut_of_the_fractional_order(docs, docs_rows):
    """Every row's shard and slot, from the seeded hashes and plain sorts."""
    cols = [F.xxhash64(F.lit(11), F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("h"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "source"]
    rows = [(r["h"], (r["doc_id"] is not None, r["doc_id"] or 0), r["t"], r["source"]) for r in docs.select(*cols).collect()]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    order = []
    for i, s in enumerate(names):
        mine = sorted(r[:3] for r in rows if r[3] == s)
        order += [((2 * k + 1) / (2 * len(mine)), i, *r) for k, r in enumerate(mine)]
    want, n = Counter(), len(rows)
    for g, r in enumerate(sorted(order)):
        shard = g * 8 // n
        want[r[3][1] if r[3][0] else None, names[r[1]], shard, g - -(-shard * n // 8)] += 1
    assert got(sharding.interleave(docs), "doc_id", "source", "shard", "slot") == want


def test_mixing_and_sharding_of_nothing(no_docs):
    assert mixing.mix(no_docs).count() == 0 and sharding.interleave(no_docs).count() == 0


def test_ranks_cross_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANK_ROWS", 7)
    monkeypatch.setattr(mixing, "RANK_ROWS", 7)
    monkeypatch.setattr(common, "RUN", 3)
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b "), F.col("id").cast("string")).alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    out = sharding.interleave(df).collect()
    assert Counter(r["shard"] for r in out) == Counter({s: 25 for s in range(8)})
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(25)) for s in range(8))
    places = sorted((r["place"], r["taken"]) for r in mixing.placed(mixing.mix(df)).where("position = last_position").collect())
    assert len(places) > 20 and len({p for p, _ in places}) == len(places)
    mixed = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(r["n"] == int(r["t"] + 1e-9) for r in mixed)


# 6 quality


def counts_of(text):
    w = WORD.findall(text or "")
    seen = defaultdict(list)
    for i in range(len(w) - 4):
        seen[tuple(w[i : i + 5])].append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    full = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), len(covered)


def test_quality_counts(spark, docs, docs_rows):
    rng = random.Random(2)
    more = [(200 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))), "en", "s", 1, 7, "x", "y", "z", 1) for i in range(150)]
    more.append((400, "x y\nx y\n\n  \nx y\nz", "en", "s", 1, 7, "x", "y", "z", 1))
    every = docs_rows + more
    out = quality.judge(spark.createDataFrame(every, docs.schema))
    want = Counter()
    for r in every:
        c = counts_of(r[1])
        want[(r[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert got(out, "doc_id", *quality.BASE, "base_failed") == want


def mcd_steps(x, mean, inverse):
    """Mean, inverse covariance and log determinant of the nearest H share, by bins."""
    dist = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
    bins = np.floor(np.log2(1 + dist) * quality.BINS)
    sub = x[bins <= np.sort(bins)[int(np.ceil(len(x) * quality.H)) - 1]]
    cov = np.cov(sub.T, bias=True) * quality.CONSISTENCY + np.diag(np.array(quality.FLOOR) ** 2)
    return sub.mean(axis=0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1]


def mcd(x):
    """Mean, inverse covariance and log determinant of the raw estimate, from plain numpy."""
    ordered, n, floor = np.sort(x, axis=0), len(x), np.array(quality.FLOOR)
    q = lambda p: ordered[int(np.ceil(n * p)) - 1]
    median, scale = q(0.5), np.maximum((q(0.75) - q(0.25)) / 1.349, floor)
    z = (x - median) / scale
    length = np.sqrt((z * z).sum(axis=1, keepdims=True))
    whole = lambda v: np.floor(np.abs(v * 1000) + 0.5) * np.sign(v)
    starts = [(median, np.diag(scale**2)), (x.mean(axis=0), np.cov(x.T, bias=True) + np.diag(floor**2))]
    for u in (whole(np.tanh(z)), whole(np.divide(z, length, out=np.zeros_like(z), where=length > 0))):
        starts.append((median, (np.cov(u.T, bias=True) + 900 * np.eye(4)) * np.outer(scale, scale) / 1e6))
    now = []
    for mean, cov in starts:
        state = mean, np.linalg.inv(cov), None
        for _ in range(quality.FIRST_STEPS):
            state = mcd_steps(x, *state[:2])
        now.append(state)
    best = []
    for state in sorted(now, key=lambda s: s[2])[: quality.BEST]:
        while True:
            new = state
            for _ in range(quality.STEPS):
                new = mcd_steps(x, *new[:2])
            if new[2] >= state[2] - quality.FALL:
                break
            state = new
        best.append(state)
    return min(best, key=lambda s: s[2])


def brute_mcd(rows):
    """Distances from plain numpy, of rows ((lang, source), number, vector)."""
    sizes, langs = Counter(k for k, _, _ in rows), Counter(k[0] for k, _, _ in rows)
    level = lambda k: 0 if sizes[k] >= quality.GROUP_MIN else 1 if langs[k[0]] >= quality.GROUP_MIN else 2
    d2 = {}
    for own in {(*k, 0) if level(k) == 0 else (k[0], None, 1) if level(k) == 1 else (None, None, 2) for k in sizes}:
        x = np.array([v for k, _, v in rows if own[2] == 2 or k[0] == own[0] and (own[2] == 1 or k[1] == own[1])], dtype=float)
        mean, inverse, _ = mcd(x)
        dist = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        near = x[dist <= quality.WITHIN]
        mean = near.mean(axis=0)
        inverse = np.linalg.inv(np.cov(near.T, bias=True) * quality.CONSISTENCY_WITHIN + np.diag(np.array(quality.FLOOR) ** 2))
        for k, i, v in rows:
            if level(k) == own[2] and (own[2] == 2 or k[0] == own[0]) and (own[2] > 0 or k[1] == own[1]):
                d2[i] = float((v - mean) @ inverse @ (v - mean))
    return d2


def test_the_estimate_has_the_smallest_determinant_of_all_subsets():
    """Against all subsets of twelve rows, a quarter of them far away."""
    from itertools import combinations

    rng, found = np.random.default_rng(17), 0
    for _ in range(20):
        x = np.round(rng.normal(0, [90, 400, 350, 60], (12, 4)))
        x[:3] += rng.normal([2000, -3000, 2500, 900], 100, (3, 4))
        h = int(np.ceil(12 * quality.H))
        floor = np.diag(np.array(quality.FLOOR) ** 2)
        every = [(np.linalg.slogdet(np.cov(x[list(c)].T, bias=True) * quality.CONSISTENCY + floor)[1], c) for c in combinations(range(12), h)]
        least, rows = min(every)
        mean, inverse, size = mcd(x)
        assert size >= least - 1e-9
        found += abs(size - least) < 1e-9
        assert np.argsort(np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean))[-3:].max() < 3 or size > least
    assert found >= 16


def test_outliers_are_those_of_brute_force(docs, docs_rows):
    rows = []
    for i, r in enumerate(docs_rows):
        n, chars, symbols, _, repeats = counts_of(r[1])
        if n < 10 or 100 * repeats > 20 * n:
            continue
        letters, distinct = sum(c.isalpha() for c in r[1]), len(set(WORD.findall(r[1])))
        half = lambda v: int(np.floor(abs(v) + 0.5) * np.sign(v))
        x = [np.log((chars + 50) / (n + 10)), np.log((chars - letters + 2) / (chars + 60)), np.log2(1 + 10 * symbols / n), np.log(distinct) / np.log(n)]
        rows.append(((r[2], r[3]), i, np.array([half(v * 1000) for v in x], dtype=float)))
    want = brute_mcd(rows)
    by_key = defaultdict(list)
    for i, r in enumerate(docs_rows):
        by_key[r[0]].append(want.get(i))
    out = quality.judge(docs).collect()
    assert len(out) == len(docs_rows)
    judged = defaultdict(list)
    for r in out:
        judged[r["doc_id"]].append(r["d2"])
        assert (r["d2"] is None) == r["base_failed"] and r["kept"] == (r["d2"] is not None and r["d2"] <= quality.CUTOFF)
    for k, d in by_key.items():
        fill = lambda v: sorted(-1.0 if x is None else x for x in v)
        assert np.allclose(fill(d), fill(judged[k]), rtol=1e-6, atol=1e-6), k
    assert any(v is not None and v > quality.CUTOFF for d in by_key.values() for v in d)


def test_a_step_of_the_estimate_has_a_plan_of_its_own(docs, monkeypatch):
    joins = []

    def spy(df, name):
        joins.append(str(df._jdf.queryExecution().optimizedPlan()).count("Join "))
        return common.materialize(df, name)

    monkeypatch.setattr(quality, "materialize", spy)
    quality.judge(docs.limit(200))
    assert len(joins) > quality.FIRST_STEPS and max(joins) <= 2  # whatever the number of steps


def test_one_text_in_two_groups_has_two_verdicts(spark):
    """Rows of equal key and text, an outlier in one source only."""
    rng = random.Random(41)
    plain = [(i, prose(rng, "en", 60), "en", "a") for i in range(60)]
    odd = [(100 + i, " ".join(w + "#$%" for w in prose(rng, "en", 60).split()), "en", "b") for i in range(60)]
    both = [(500, odd[0][1], "en", "a"), (500, odd[0][1], "en", "b")]
    df = spark.createDataFrame(plain + odd + both, "doc_id long, text string, lang string, source string")
    verdict = {(r["doc_id"], r["source"]): r["kept"] for r in quality.judge(df).collect()}
    assert not verdict[500, "a"] and verdict[500, "b"]
    assert [r["source"] for r in quality.keep_good(df).where("doc_id = 500").collect()] == ["b"]


def test_keep_good_keeps_columns(docs, no_docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    assert quality.judge(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0


# 7 SimHash


def brute_fingerprint(text, k):
    w = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    grams = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    low = {}
    for i, k in enumerate(ids):
        r = find(i)
        if k is not None:
            low[r] = min(low.get(r, k), k)
    return [low.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("k", [3, 5])
def test_simhash(docs, docs_rows, k):
    prints = [brute_fingerprint(r[1], k) for r in docs_rows]
    roots = brute_components([r[0] for r in docs_rows], prints)
    want = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(docs_rows, prints, roots, strict=True))
    assert got(simhash.near_duplicates(docs, shingle=k), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_links_are_whole_for_every_block_size(spark, monkeypatch, block):
    """Clouds of near fingerprints, linked by pairs, by balls, or by both."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng, prints = random.Random(4), set()
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(25):
            prints.add(p)
            if rng.random() < 0.7:
                p ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                p ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")))
    root = {r["node"]: r["root"] for r in found.collect()}
    ours = defaultdict(set)
    for p in signed:
        ours[root.get(p, p)].add(p)
    theirs = defaultdict(set)
    for p, c in zip(signed, brute_components(signed, prints), strict=True):
        theirs[c].add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_pivots_never_discard_a_link(spark):
    rng, rows = random.Random(8), []
    for _ in range(300):
        p = rng.getrandbits(64)
        q = p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (p, q)))
    df = spark.createDataFrame(rows, "p long, q long")
    side = lambda c: df.select("p", "q", *[x.alias(f"_t{i}") for i, x in enumerate(simhash.distance_table(F.col(c)))])
    joined = side("p").alias("a").join(side("q").alias("b"), ["p", "q"])
    assert joined.where(~simhash.within_table("a", "b")).count() == 0


def jaccard(a, b, k=5):
    x, y = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def test_similar_documents_are_found_and_others_left_alone(spark):
    rng, rows, of = random.Random(12), [], {}
    for base in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        for copy in range(150 if base == 0 else 6):
            text = list(words)
            for _ in range(0 if copy == 0 else rng.randint(0, max(1, len(words) // 45))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(5000)}"
            of[len(rows)] = (base, jaccard(" ".join(text), " ".join(words)))
            rows.append((len(rows), " ".join(text)))
    first = {b: min(i for i, (c, _) in of.items() if c == b) for b in range(40)}
    got_ = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(of[c][0] == of[i][0] for i, c in got_.items())
    near = [i for i, (_, j) in of.items() if j >= 0.8]
    assert len(near) > 250 and sum(got_[i] == first[of[i][0]] for i in near) / len(near) >= 0.97


def brute_similar(rows, similarity=0.8):
    """The groups that links at `similarity` or more of five-word shingle sets make."""
    parent = {k: k for k, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {}
    for k, text in rows:
        w = text.split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    for a, _ in rows:
        for b in range(a):
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= similarity * max(len(x), len(y)) and len(x & y) / len(x | y) >= similarity:
                parent[find(a)] = find(b)
    low = {}
    for k, _ in rows:
        low.setdefault(find(k), k)
    return {k: low[find(k)] for k, _ in rows}


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(5, len(out) - 5), n):
        out[i] = f"y{rng.randrange(1 << 30)}"
    return " ".join(out)


@pytest.mark.parametrize("part", [1 << 30, 200_000])
def test_star_of_near_copies_is_one_group(spark, monkeypatch, part):
    """1,000 edits at about 0.85 of one original, some 0.72 to each other."""
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(21)
    words = [f"w{rng.randrange(5000)}" for _ in range(190)]
    rows = [(i, " ".join(words) if i == 500 else edited(rng, words, 3)) for i in range(1001)]
    want = brute_similar(rows)
    assert set(want.values()) == {0}
    out = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_similarity_is_that_of_the_shingle_sets(spark):
    """Pairs on both sides of 0.8, each near it."""
    rng, rows = random.Random(22), []
    for k in range(300):
        words = [f"w{rng.randrange(5000)}" for _ in range(110 + k % 90)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, edited(rng, words, 2 + k % 5))]
    want = brute_similar(rows)
    near = sum(v != k for k, v in want.items())
    assert 50 < near < 250
    out = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_a_common_passage_makes_no_groups(spark, monkeypatch):
    """80 words of a document's own and 40 that all have, 0.18 alike: pivot distances part them
    before groups are made; 30 near copies among them are found all the same."""
    seen, real = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda e: (seen.append({x for r in e.collect() for x in r}), real(e))[1])
    rng = random.Random(51)
    passage = " ".join(f"c{i}" for i in range(40))
    rows = [(i, " ".join(f"w{rng.randrange(1 << 30)}" for _ in range(80)) + " " + passage) for i in range(600)]
    rows += [(600 + i, edited(rng, rows[i][1].split(), 1)) for i in range(30)]
    out = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {i: i - 600 if i >= 600 else i for i, _ in rows}
    assert len(seen[0]) == 60


def test_no_similar_pair_is_missed(spark):
    """200 words that two texts share, and 13 chosen so that 32 bands of four minima had none in common."""
    own = [288, 1803, 319, 668, 781, 936, 202, 907, 1147, 1812, 1820, 217, 504]
    texts = [" ".join(f"w{i}" for i in [*range(200), *some]) for some in (own[::2], own[1::2])]
    out = simhash.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shingle=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {0: 0, 1: 0}


def test_first_shingles_meet():
    """Sets at a similarity share one of their first shingles, whatever comes last."""
    rng = np.random.default_rng(54)
    for n in (1, 4, 5, 9, 45, 300):
        for _ in range(50):
            pool = rng.permutation(np.unique(rng.integers(1 << 63, size=n + n // 8, dtype=np.uint64)))
            a, b = np.unique(pool[:n]), np.unique(pool[n // 8 :])
            both = len(np.intersect1d(a, b))
            for last in (pool[:0], np.unique(pool[: n // 2]), np.unique(pool)):
                x, y = (simhash.first_shingles(h, both / (len(a) + len(b) - both), last) for h in (a, b))
                assert len(np.intersect1d(x, y))


@pytest.mark.parametrize(("tables", "lanes"), [(20, 1 << 13), (1 << 16, 7)])
def test_large_bands_lose_no_link(spark, monkeypatch, tables, lanes):
    monkeypatch.setattr(simhash, "TABLES", tables)
    monkeypatch.setattr(simhash, "LANES", lanes)
    rng, rows = random.Random(52), []
    for base in range(4):
        words = [f"w{rng.randrange(5000)}" for _ in range(150)]
        rows += [(40 * base + i, edited(rng, words, i % 5)) for i in range(40)]
    out = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == brute_similar(rows)


def test_tables_differ_by_no_more_than_the_sets():
    """Also where a pivot has over 255 of a set's shingles; and sets at 0.8 are always linked."""
    rng = np.random.default_rng(53)
    for n in (1, 9, 45, 900, 36_000):
        for _ in range(20):
            pool = rng.integers(1 << 63, size=n + n // 8, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[n // 8 :])
            apart, both = len(np.setxor1d(a, b)), len(np.intersect1d(a, b))
            x, y = (np.frombuffer(simhash.cell_table(h), dtype=np.uint8) for h in (a, b))
            assert np.abs(x.astype(int) - y).sum() <= apart
            assert both / (len(a) + len(b) - both) < 0.77 or simhash.near_tables(np.stack([x, y]), np.array([len(a), len(b)]), both / (len(a) + len(b) - both)) == [(0, 1)]
    far = [np.frombuffer(simhash.cell_table(rng.integers(1 << 63, size=100, dtype=np.uint64)), dtype=np.uint8) for _ in range(50)]
    assert simhash.near_tables(np.stack(far), np.full(50, 100), 0.8) == []


def test_accepted_distance():
    assert simhash.most_apart(1.0) == simhash.SLACK
    assert simhash.most_apart(0.8) == 77 + simhash.SLACK
    assert simhash.wide_fingerprint("  ", 5) == simhash.wide_fingerprint(None, 5) == bytes(64)


def test_one_of_each(docs, docs_rows, no_docs):
    kept = simhash.one_of_each(docs).collect()
    groups = simhash.similar_documents(docs).collect()
    assert len(groups) == len(docs_rows)
    assert sorted(r["doc_id"] for r in kept) == sorted({r["component_id"] for r in groups})
    same = defaultdict(set)
    for i, r in enumerate(docs_rows):
        if r[0] is not None:
            same[r[1]].add(i)
    by_id = {r["doc_id"]: r["component_id"] for r in groups}
    assert all(len({by_id[docs_rows[i][0]] for i in where}) == 1 for where in same.values())
    assert simhash.one_of_each(docs).columns == docs.columns
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_one_of_each_group_stays_without_ids_and_with_repeated_ones(spark):
    """Groups with null ids only, or with one smallest id between them, are groups of their own."""
    words = lambda k: " ".join(f"{k}{i}" for i in range(30))
    rows = [(None, "a"), (None, "b"), (None, "b"), (7, "c"), (7, "d"), (9, "d"), (8, "e"), (8, "c"), (None, None)]
    docs = spark.createDataFrame([(k, x and words(x)) for k, x in rows], "doc_id long, text string")
    kept = Counter((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect())
    assert kept == Counter([(None, words("a")), (None, words("b")), (7, words("c")), (7, words("d")), (8, words("e")), (None, None)])


# 8 lines


def brute_lines(rows):
    """(kept text, lines, dropped) of each row, by the module's definitions in plain Python."""
    docs = {}
    for r in rows:
        docs.setdefault((lines.LAST if r[0] is None else r[0], r[1]), r[1])
    leaf_lines, order = defaultdict(dict), {}
    for (d, t), text in docs.items():
        for i, line in enumerate((text or "").split("\n")):
            tok = lines.tokens_of(line)
            if tok:
                leaf = (len(tok), tuple(tok[: lines.DEPTH]))
                leaf_lines[leaf].setdefault(tuple(tok), set()).add((d, t))
                order.setdefault((leaf, tuple(tok)), []).append((d, t, i))
    template_docs, of = Counter(), {}
    for leaf, found in leaf_lines.items():
        if len(set().union(*found.values())) < lines.MIN_DOCS:
            continue
        place = Counter()
        for tok, where in found.items():
            for p, w in enumerate(tok):
                place[p, w] += len(where)
        for tok, where in found.items():
            kept = tuple((p, w) for p, w in enumerate(tok) if w != lines.WILD and place[p, w] >= lines.MIN_DOCS)
            if len(kept) >= lines.SOLID * len(tok):
                of[leaf, tok] = (leaf, kept)
                template_docs[leaf, kept] += len(where)
    hits = defaultdict(list)
    for key, template in of.items():
        if template_docs[template] >= lines.MIN_DOCS:
            hits[template] += order[key]
    gone = defaultdict(set)
    for where in hits.values():
        first = min((d, xxh(t), i) for d, t, i in where)
        for d, t, i in where:
            if (d, xxh(t), i) != first:
                gone[d, t].add(i)
    out = []
    for r in rows:
        d = lines.LAST if r[0] is None else r[0]
        parts = (r[1] or "").split("\n")
        drop = gone.get((d, r[1]), set())
        kept = r[1] if not drop else "\n".join(x for i, x in enumerate(parts) if i not in drop)
        out.append((r[0], kept, sum(bool(WORD.search(x)) for x in parts), len(drop)))
    return Counter(out)


def xxh(text):
    return int.from_bytes(xxhash.xxh64_digest((text or "").encode(), 42), "big", signed=True)


def test_template_lines_are_dropped(docs, docs_rows, no_docs):
    out = lines.drop_lines(docs).select("row.doc_id", "kept", "n_lines", "n_dropped")
    want = brute_lines(docs_rows)
    assert got(out, "doc_id", "kept", "n_lines", "n_dropped") == want
    assert sum(k[3] * n for k, n in want.items()) >= 20
    assert lines.drop_lines(docs).select("row.*").columns == docs.columns
    assert lines.drop_lines(no_docs).count() == 0


def test_a_document_counts_once_for_a_template(spark):
    """Ten alike lines of one document aren't ten documents, though ten documents are in the leaf."""
    listed = "\n".join(f"the list of goods item {w} in stock now" for w in "red blue green black white grey pink gold brown teal".split())
    rows = [(0, listed)] + [(i, " ".join(["the list of", *(f"w{chr(97 + i)}{chr(97 + j)}" for j in range(6))])) for i in range(1, 12)]
    shared = [(20 + i, f"one more line of the shop {w} for all to read\nand {w} alone") for i, w in enumerate("a b c d e f g h i j".split())]
    out = {r["doc_id"]: r["n_dropped"] for r in lines.drop_lines(spark.createDataFrame(rows + shared, "doc_id long, text string")).select("row.doc_id", "n_dropped").collect()}
    assert all(out[k] == 0 for k, _ in rows)
    assert [out[k] for k, _ in shared] == [0] + [1] * 9
    twice = [(k, f"{t}\n{t.replace('the shop', 'the store')}") for k, t in shared]
    out = {r["doc_id"]: r["n_dropped"] for r in lines.drop_lines(spark.createDataFrame(twice, "doc_id long, text string")).select("row.doc_id", "n_dropped").collect()}
    assert [out[k] for k, _ in twice] == [0] + [2] * 9


# 9 TIFF


@pytest.mark.parametrize("layout", tiff.LAYOUTS + (tiff.Layout(tiff.NONE), tiff.Layout(tiff.NONE, True, True)))
@pytest.mark.parametrize("size", [64, 640, 64 * 1024, 64 * 2500])
def test_tiff_round_trip(layout, size):
    rng = random.Random(size)
    payload = bytes(rng.choice(b"aab \xff\0") if i % 3 else 32 for i in range(size))
    data = tiff.encode(payload, layout)
    found = [tiff.decode_page(data, tags) for tags in tiff.directories(data)]
    assert len(found) == -(-size // (64 * tiff.PAGE_ROWS))
    assert b"".join(p.tobytes() for p in found) == payload


def plain_lzw(data):
    """Codes as text of bits, by a table of strings."""
    table, bits, word, width = {bytes([i]): i for i in range(256)}, "100000000", b"", 9
    free = 258
    for i in range(len(data)):
        byte = data[i : i + 1]
        if word + byte in table:
            word += byte
            continue
        bits += format(table[word], f"0{width}b")
        table[word + byte] = free
        free += 1
        word = byte
        if free == 4095:
            bits += format(256, "012b")
            table, free, width = {bytes([i]): i for i in range(256)}, 258, 9
        elif free in (512, 1024, 2048):
            width += 1
    if word:
        bits += format(table[word], f"0{width}b")
        width += free + 1 in (512, 1024, 2048)
    bits += format(257, f"0{width}b")
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


def test_codecs():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.choice([0, 1, 2, 127, 128, 129, 400, 9000])
        data = bytes(rng.randrange(rng.choice([1, 2, 256])) for _ in range(n))
        assert tiff.unpackbits(tiff.packbits(data), n) == data
        assert tiff.unlzw(tiff.lzw(data), n) == data == tiff.unlzw(plain_lzw(data), n)
        assert tiff.lzw(data) == plain_lzw(data)
    data = bytes(rng.randrange(256) for _ in range(60000))
    assert tiff.unlzw(tiff.lzw(data), len(data)) == data and tiff.lzw(data) == plain_lzw(data)
    assert tiff.unpackbits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA]), 99).hex() == "aaaaaa80002aaaaaaaaa80002a22aaaaaaaaaaaaaaaaaaaa"


def test_big_endian_rgb_and_broken_files(spark):
    import struct

    pixels = bytes(range(12))
    tags = [(256, 3, 2), (257, 3, 2), (258, 3, 8), (259, 3, 1), (262, 3, 2), (273, 4, 8), (277, 3, 3), (278, 3, 2), (279, 4, 12)]
    body = b"".join(struct.pack(">HHI", t, k, 1) + (struct.pack(">I", v) if k == 4 else struct.pack(">HH", v, 0)) for t, k, v in tags)
    data = b"MM" + struct.pack(">HI", 42, 20) + pixels + struct.pack(">H", len(tags)) + body + struct.pack(">I", 0)
    rows = [(1, data, "a"), (2, b"MM", "b"), (3, None, "c"), (4, b"", "d"), (5, data[:40], "e")]
    out = {(r["id"], r["page"]): r for r in tiff.pages(spark.createDataFrame(rows, "id int, media binary, width string")).collect()}
    assert bytes(out[1, 0]["pixels"]) == pixels and out[1, 0]["samples"] == 3 and out[1, 0]["width"] == 2
    assert all(out[i, None]["error"] for i in (2, 4, 5)) and out[3, None]["error"] is None


def test_no_fault_of_a_directory_ends_the_job(spark):
    """Every field of every entry of the directory, and every byte of the head, set to bad values."""
    import struct

    files = []
    for layout in tiff.LAYOUTS[::2] + (tiff.Layout(tiff.NONE, True, True),):
        good = tiff.encode(bytes(range(256)) * 4, layout)
        (at,) = struct.unpack_from("<I", good, 4)
        (n,) = struct.unpack_from("<H", good, at)
        for i in range(n):
            for where, form in ((0, "H"), (2, "H"), (4, "I"), (8, "I")):
                for bad in (0, 1, 3, 0x7FFF, 0xFFFF, *((0x7FFFFFFF, 0xFFFFFFFF) if form == "I" else ())):
                    data = bytearray(good)
                    struct.pack_into(f"<{form}", data, at + 2 + 12 * i + where, bad)
                    files.append(bytes(data))
        files += [good[:k] for k in range(0, len(good), 7)]
        files += [good[:k] + bytes([good[k] ^ 0x55]) + good[k + 1 :] for k in range(0, len(good), 5)]
        files.append(good)
    rows = [(i, f) for i, f in enumerate(files)]
    out = defaultdict(list)
    for r in tiff.pages(spark.createDataFrame(rows, "id int, media binary")).collect():
        out[r["id"]].append(r)
    assert sorted(out) == list(range(len(files)))
    assert all((r["page"] is None) != (r["error"] is None) for x in out.values() for r in x)
    assert [len(bytes(r["pixels"])) for r in out[len(files) - 1]] == [1024]


def plain_feature(payload):
    """The feature string by counting."""
    import math

    n, many = len(payload), Counter(payload)
    mean = sum(payload) / n
    spread = math.sqrt(max(0.0, sum(k * k * c for k, c in many.items()) / n - mean * mean))
    entropy = -sum(c / n * math.log2(c / n) for c in many.values()) + 0.0
    mode = min(k for k, c in many.items() if c == max(many.values()))
    return f"mean={mean:.4f};std={spread:.4f};entropy={entropy:.4f};levels={len(many)};mode={mode}"


def test_media_and_features_are_those_of_the_payload(docs, docs_rows):
    want = Counter()
    for r in docs_rows:
        t = (r[1] or "").encode()
        p = t + b"\0" * (-len(t) % 64 or (0 if t else 64))
        media = tiff.encode(p, tiff.LAYOUTS[zlib.crc32(p) % 8])
        want[r[0], len(media), hashlib.sha256(media).hexdigest(), plain_feature(p)] += 1
        assert int.from_bytes(media[-4:], "little") == 0 and media[:4] == b"II*\0"
    assert got(tiff.stored_and_read(docs), "doc_id", "media_bytes", "media_sha256", "feature") == want


def test_stored_texts_read_back(docs, docs_rows, no_docs):
    want = Counter()
    for r in docs_rows:
        t = (r[1] or "").encode()
        p = t + b"\0" * (-len(t) % 64 or (0 if t else 64))
        want[r[0], len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    out = tiff.stored_and_read(docs)
    assert got(out, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == want
    same = out.groupBy("payload_sha256").agg(F.countDistinct("media_sha256", "media_bytes", "feature").alias("n"))
    assert same.where("n <> 1").count() == 0
    assert tiff.stored_and_read(no_docs).count() == 0


# 10 substrings


def brute_repeats(rows):
    first = {}
    keyed = [(substrings.LAST if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for k, t in keyed:
        for i in range(len(t) - 49):
            w = t[i : i + 50]
            first[w] = min(first.get(w, k), k)
    out = []
    for r, (k, t) in zip(rows, keyed, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < k:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((r[0], len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("crowd", "text", "block", "fold"), [(4096, 1 << 19, 1 << 18, 1 << 21), (2, 1 << 19, 1 << 18, 1), (4096, 300, 900, 50), (3, 300, 900, 200), (0, 1 << 19, 900, 1000)])
def test_repeats_are_removed(docs, docs_rows, monkeypatch, crowd, text, block, fold):
    for name, value in (("CROWD", crowd), ("TEXT", text), ("BLOCK", block), ("FOLD", fold)):
        monkeypatch.setattr(substrings, name, value)
    assert got(substrings.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(docs_rows)


def test_hot_anchor_and_ids_at_shipped_settings(spark):
    """A phrase with 9,000 different surroundings, a passage in 3,000 documents, 5,000 rows without
    an id and 2,000 with the same one."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    phrase, passage = "and so on, for all that we know of it, ", " ".join(word() for _ in range(30))
    rows = []
    for i in range(9000):
        middle = rng.choice(["", passage]) if i % 3 == 0 else ""
        text = f"{word()} {word()} {phrase}{word()} {word()} {middle} {word()}"
        rows.append((None if i < 5000 else 7 if i < 7000 else i, text if i % 10 else rows[rng.randrange(i)][1] + word() if i else text))
    rng.shuffle(rows)
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = brute_repeats(rows)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert sum(n for k, n in want.items() if k[2]) > 1000


def test_crowded_snippets_give_a_span_each(spark):
    """A passage with 40 different ends before and after it: no row for each of a snippet's windows."""
    rng = random.Random(41)
    end = lambda: bytes(rng.choice(b"abc") for _ in range(5))
    passage, texts = bytes(rng.choice(b"abcdefgh") for _ in range(50)), []
    for _ in range(40):
        texts.append(end() + passage + end())
    rows = [(1, i // 2, i % 2, 100 * i, bytearray(t)) for i, t in enumerate(texts + texts[:20])]
    spans = substrings._by_window(spark.createDataFrame(rows, substrings.FOUND_SCHEMA)).collect()
    least = {}
    for _, doc, _, _, t in rows:
        for i in range(len(t) - 49):
            least[bytes(t[i : i + 50])] = min(doc, least.get(bytes(t[i : i + 50]), doc))
    gone = {(doc, tag, begin + i + j) for _, doc, tag, begin, t in rows for i in range(len(t) - 49) if least[bytes(t[i : i + 50])] < doc for j in range(50)}
    assert {(r["doc"], r["tag"], b) for r in spans for b in range(r["start"], r["end"])} == gone and len(gone) > 2000
    assert len(spans) == len({(r["doc"], r["tag"]) for r in spans}) <= len(rows)


def test_repeats_in_periodic_texts(spark):
    rng, rows = random.Random(7), []
    for i in range(60):
        unit = rng.choice(["a", "ab", "abc", "the ", "xyz" * 9])
        rows.append((i, (unit * 80)[rng.randint(0, 5) :][: rng.randint(20, 160)] + rng.choice(["", "q", "end of it all"])))
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows)


def test_texts_of_one_id_are_told_apart(spark):
    """Two texts under one id whose hashes agree in 20 bits."""
    rng, seen, pair = random.Random(13), {}, None
    while not pair:
        text = " ".join(f"w{rng.randrange(1 << 40)}" for _ in range(10))
        if (other := seen.setdefault(xxh(text) & 0xFFFFF, text)) != text:
            pair = other, text
    extra = " ".join(f"w{rng.randrange(1 << 40)}" for _ in range(10))
    rows = [(1, pair[0]), (2, pair[0]), (2, pair[1]), (None, extra), (None, pair[1]), (None, pair[0])]
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows)


def test_windows_by_transform():
    rng = random.Random(11)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 90))) for _ in range(50)]
    owner = np.array([rng.randrange(9) for _ in texts])
    for window in (4, 9):
        count, least = Counter(), {}
        for t, o in zip(texts, owner.tolist(), strict=True):
            for i in range(len(t) - window + 1):
                w = t[i : i + window]
                count[w] += 1
                least[w] = min(least.get(w, o), o)
        want = {(k, i): least[t[i : i + window]] for k, t in enumerate(texts) for i in range(len(t) - window + 1) if count[t[i : i + window]] > 1}
        sizes = np.array([len(x) for x in texts])
        text, offset, low = substrings.repeated_windows(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes, owner, window)
        assert dict(zip(zip(text.tolist(), offset.tolist(), strict=True), low.tolist(), strict=True)) == want


def test_ids_have_to_be_whole_numbers(spark):
    named = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for f in (substrings.remove_repeats, lines.drop_lines):
        with pytest.raises(TypeError, match="whole number"):
            f(named)


def test_nothing_to_remove(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
