"""Ranked search and spelling variants against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from made_texts import prose

from granary.llm import ranked, spelling

ITEMS = "item_id long, text string, doc_id long, score long"


@pytest.fixture(scope="module")
def items_rows(docs_rows):
    rng = random.Random(3)
    rows = [(i, " ".join(docs_rows[i * 3][1].split()[:25]) + " " + prose(rng, "en", 5), 1, 2) for i in range(25)]
    return [*rows, (30, None, 1, 2), (31, "", 1, 2), (32, "?! ...", 1, 2), (33, "nowhere0 nowhere1", 1, 2), (34, "ONE one É", 1, 2), (35, "the", 1, 2), (36, "a b", 1, 2), (36, "b c the", 1, 2), (None, "the and", 1, 2)]


def plain_ranks(docs_rows, items_rows, k):
    """The definition, by loops over all documents and items."""
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(t))
    docs = [(r[0], Counter(terms(r[1]))) for r in docs_rows]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked: dict = {}
    for r in items_rows:
        asked.setdefault(r[0], set()).update(terms(r[1]))
    out = Counter()
    for item, wanted in asked.items():
        scored = []
        for d, c in docs:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out[item, rank, d, -score] += 1
    return out


@pytest.mark.parametrize(("k", "seeds", "block"), [(50, 200, None), (3, 0, None), (5, 1, 2_500)])
def test_ranked_equals_scoring_everything(docs, docs_rows, items_rows, spark, monkeypatch, k, seeds, block):
    monkeypatch.setattr(ranked, "SEEDS", seeds)
    if block:
        monkeypatch.setattr(ranked, "BLOCK_BYTES", block)  # many blocks of items, some empty
    items = spark.createDataFrame(items_rows, ITEMS)
    out = ranked.ranked(docs, items, k=k).collect()
    assert Counter(tuple(r) for r in out) == plain_ranks(docs_rows, items_rows, k)


def test_ranked_on_empty_tables(docs, no_docs, items_rows, spark):
    items = spark.createDataFrame(items_rows, ITEMS)
    assert ranked.ranked(no_docs, items).collect() == []
    out = ranked.ranked(docs, items.limit(0))
    assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_a_bound_prunes_and_loses_nothing():
    """Of random vectors few are scored exactly once the bound is known; the best are the same."""
    rng = np.random.default_rng(4)
    n, vocabulary, k = 4_000, 500, 10
    weights = np.sort(rng.integers(300, 9_000, vocabulary))
    items = [np.sort(rng.choice(vocabulary, 12, replace=False)) for _ in range(20)]
    rows = [np.unique(rng.zipf(1.4, 60) % vocabulary) for _ in range(n)]
    for i in range(400):  # twenty documents hold each item's terms
        rows[i] = np.union1d(rows[i], items[i % 20])
    sizes = np.array([len(r) for r in rows])
    terms = np.concatenate(rows)
    impacts = weights[terms] * rng.integers(200_000, 900_000, len(terms))
    squares = np.add.reduceat(impacts.astype(float) ** 2, np.cumsum(sizes) - sizes)
    order = np.argsort(-squares, kind="stable")
    starts = np.cumsum(sizes) - sizes
    entries = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in order])
    bucket = ranked.Bucket(terms[entries], impacts[entries], sizes[order], np.sqrt(squares[order]), np.zeros(n, bool), order)
    for item in items:
        score = np.array([impacts[starts[i] : starts[i] + sizes[i]][np.isin(rows[i], item)].sum() for i in range(n)])
        want = sorted((-int(s), i) for i, s in enumerate(score) if s > 0)[:k]
        open_, closed = ranked.Best(k, 0), ranked.Best(k, -want[-1][0] if len(want) == k else 0)
        wanted = np.zeros(vocabulary, bool)
        bucket.search(item, open_, wanted)
        scored = bucket.search(item, closed, wanted)
        for best in (open_, closed):
            assert [(-int(s), int(d)) for s, d in zip(best.score, best.doc, strict=True)] == want
        assert scored <= n / 4 and not wanted.any()


def test_terms():
    assert ranked.terms_of("Aé-b_c 中文x\x7fÀÉ9") == ["aé", "b", "c", "中文x", "ÀÉ9"]
    assert pa.array(ranked.terms_of(None)).null_count == 0 and ranked.terms_of(None) == []


# 11 spelling variants


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(docs_rows):
    """The definition, by loops over all pairs of words."""
    found = Counter()
    for r in docs_rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", r[1] or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    words = {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}
    by_size: dict = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    form, near = {}, {}
    for w, n in words.items():
        close = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, ()) if one_edit(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = Counter()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, form[w], root, n, near[w], words.get(form[w])] += 1
    return out


@pytest.fixture(scope="module")
def misspelt_rows(docs_rows):
    """The awkward rows, with words of one half, of repeated letters, of long runs and of chains."""
    rng = random.Random(8)
    made = ["aaaaa", "aaaaaa", "aaaaaaa", "abaaa", "aabaa", "stone", "stones", "stonee", "sstone", "tone", "stine", "\u00e9clair", "eclair", "\u00c9clair", "z" * 300, "z" * 301, "z" * 150 + "y" + "z" * 150]
    made += ["prefix" + "".join(rng.choice("abc") for _ in range(6)) for _ in range(120)] + ["".join(rng.choice("ab") for _ in range(5)) for _ in range(60)]
    text = " ".join(w for i, w in enumerate(made) for _ in range(3 * 2 ** (i % 4)))
    chain = " ".join(w for i, w in enumerate(["linka", "linkb", "linkbb", "inkbb", "inkbc", "inkbcc"]) for _ in range(3 * 2**i))
    return [*docs_rows, (1000, text, "en", "src0", 1, 7, "x", "y", "z", 1), (1001, chain, "en", "src0", 1, 7, "x", "y", "z", 1)]


@pytest.mark.parametrize(("cell", "chars"), [(50_000, 1 << 17), (20, 1 << 10), (1, 1 << 30)])
def test_variants_equal_all_pairs(docs, misspelt_rows, spark, monkeypatch, cell, chars):
    monkeypatch.setattr(spelling, "CELL", cell)  # so that halves are cut into parts
    monkeypatch.setattr(spelling, "CHARS", chars)
    rows = spark.createDataFrame(misspelt_rows, docs.schema)
    want = plain_variants(misspelt_rows)
    assert Counter(tuple(r) for r in spelling.spelling_variants(rows).collect()) == want
    assert sum(r[1] is not None for r in want) > 30 and any(r[1] != r[2] for r in want if r[1])


def test_variants_of_an_empty_table(no_docs):
    out = spelling.spelling_variants(no_docs)
    assert out.collect() == [] and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_index_order_is_that_of_suffixes():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(200)})
    index = spelling.Index(words)
    text = "\x01" + "\x01".join(words) + "\x01\x00"
    assert index.order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    for q, w in enumerate(words):
        pairs = spelling.one_error(index, [w], [len(w) // 2])
        end = w[len(w) - len(w) // 2 :]
        want = [i for i, v in enumerate(words) if v.endswith(end) and one_edit(w[: len(w) - len(end)], v[: len(v) - len(end)])]
        assert pairs[1].tolist() == want, q
