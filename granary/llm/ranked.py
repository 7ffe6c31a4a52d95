"""Ranked lexical search with buckets of impact vectors by length.

A document's impact of a term is its share of the score if an item asks for it: the term's weight
times its integer frequency part, so an item's score is the product of the document's impact
vector with the item's 0/1 vector.  Only coordinates that an item of the block asks for are kept.
Inside a task vectors are ordered by length, longest first, and cut into buckets.  An item skips
a bucket, and the tail of one, whose lengths cannot reach its K-th best score so far by the
Cauchy-Schwarz inequality.  Inside a bucket the coordinates of the item's heaviest terms are read
from lists by coordinate; with the inequality on the rest of the vector they bound each
document's score.  Survivors are scored again exactly in integers.

The longest vectors are searched first and give each item a bound to start from; a task raises it
by what it finds.  Nothing is dropped by these bounds that could be among an item's K best: they
are exact, with a margin for the rounding of doubles, and equal scores are kept.

Items are taken in blocks of BLOCK_BYTES of terms at most (one larger item is a block of its
own); all documents are read for each block, and a block's terms, weights and bounds are what the
driver holds and sends.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 50
#: A term: letters and digits of ASCII, and anything beyond it.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLOCK_BYTES = 16 << 20
#: Documents of a bucket; coordinates whose lists bound a score; vector entries held at once.
BUCKET, FOCUS, ENTRIES = 2_048, 8, 2_000_000
#: Documents, at least, of the longest vectors that are searched first, for each of the K.
SEEDS = 200
#: Classes of length for each doubling.
CLASSES = 8
#: Share by which a bound may be too low through rounding.
MARGIN = 1e-9


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


@dataclass
class Block:
    """A block's items: for each a sorted array of term numbers; and the terms' numbers."""

    items: list[np.ndarray]
    number: dict[str, int]


@dataclass
class Corpus:
    """N, L and the terms' integer weights, by number."""

    n_docs: int
    n_terms: int
    weights: np.ndarray


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """item, term: an item's different terms; rows of one key are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t) for i, text in enumerate(batch.column(1).to_pylist()) for t in dict.fromkeys(terms_of(text))]
            which = pa.array([i for i, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(which), pa.array([t for _, t in found], pa.string())], names=["item", "term"])

    rows = items.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"item {rows.schema['item'].dataType.simpleString()}, term string").distinct()


def counted(docs: DataFrame, block: Broadcast) -> DataFrame:
    """doc_id, n, terms, tf: documents with a term, and which of the block's terms they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = block.value.number
        for batch in batches:
            keep, n, offsets, terms, tf = [], [], [0], [], []
            for i, text in enumerate(batch.column(1)):
                all_terms = terms_of(text.as_py())
                if not all_terms:
                    continue
                for term, times in Counter(all_terms).items():
                    if (t := number.get(term)) is not None:
                        terms.append(t)
                        tf.append(times)
                keep.append(i)
                n.append(len(all_terms))
                offsets.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, tf array<int>")


def _vectors(batch: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers, impacts, where each document's begin (and the end), and lengths."""
    n, lists, tfs = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
    sizes = lists.value_lengths().to_numpy()
    ends = np.append(0, np.cumsum(sizes))
    terms, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
    m = 50 + (50 * n * corpus.n_docs) // max(corpus.n_terms, 1)
    impacts = corpus.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)))
    squares = np.append(0.0, np.cumsum(impacts.astype(np.float64) ** 2))
    return terms, impacts, ends, np.sqrt(np.maximum(squares[ends[1:]] - squares[ends[:-1]], 0.0) + squares[ends[1:]] * 1e-13)


def length_class(lengths: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(1.0 + lengths) * CLASSES).astype(np.int32)


def by_class(vectors: DataFrame, corpus: Broadcast) -> DataFrame:
    """class, n: documents by class of length, a row for each class that a task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            found.update(dict(zip(*(x.tolist() for x in np.unique(length_class(_vectors(batch, corpus.value)[3]), return_counts=True)), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["class", "n"])

    return vectors.mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))


class Best:
    """The K best of an item, by score and then by id; ids that are null come last."""

    def __init__(self, k: int, bound: int) -> None:
        self.k, self.bound = k, bound
        self.score = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)
        self.doc = np.zeros(0, dtype=np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        score, null, doc = np.append(self.score, score), np.append(self.null, null), np.append(self.doc, doc)
        best = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.null, self.doc = score[best], null[best], doc[best]
        if len(best) == self.k:
            self.bound = max(self.bound, int(self.score[-1]))


class Bucket:
    """Documents of similar length, by descending length, with lists by coordinate."""

    def __init__(self, terms: np.ndarray, impacts: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        self.terms, self.impacts, self.lengths, self.null, self.doc = terms, impacts, lengths, null, doc
        self.first, self.sizes = np.cumsum(sizes) - sizes, sizes
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.row, self.impact = rows[order], impacts[order]
        self.coordinate, self.begin = np.unique(terms[order], return_index=True)
        self.end = np.append(self.begin[1:], len(order))

    def search(self, item: np.ndarray, best: Best, wanted: np.ndarray) -> int:
        """Adds to `best`; returns how many documents were scored exactly."""
        at = np.searchsorted(self.coordinate, item)
        at = at[(at < len(self.coordinate)) & (self.coordinate[np.minimum(at, len(self.coordinate) - 1)] == item)]
        least = best.bound * (1 - MARGIN)
        near = np.searchsorted(-self.lengths, -least / np.sqrt(max(len(at), 1)), "right")  # Cauchy-Schwarz
        if not len(at) or not near:
            return 0
        peaks = np.array([self.impact[self.begin[c] : self.end[c]].max() for c in at])
        focus = at[np.argsort(-peaks, kind="stable")[:FOCUS]]
        known, square = np.zeros(near), np.zeros(near)
        for c in focus:
            rows, impact = self.row[self.begin[c] : self.end[c]], self.impact[self.begin[c] : self.end[c]].astype(np.float64)
            upto = np.searchsorted(rows, near)
            known[rows[:upto]] += impact[:upto]
            square[rows[:upto]] += impact[:upto] ** 2
        length = self.lengths[:near] ** 2
        rest = np.sqrt((len(at) - len(focus)) * np.maximum(length * (1 + MARGIN) - square, 0.0))
        left = np.flatnonzero((known + rest >= least) & (known + rest > 0))
        if len(left):
            sizes = self.sizes[left]
            ends = np.cumsum(sizes)
            entries = np.repeat(self.first[left] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
            wanted[item] = True
            sums = np.append(0, np.cumsum(self.impacts[entries] * wanted[self.terms[entries]]))
            wanted[item] = False
            score = sums[ends] - sums[ends - sizes]
            good = (score >= max(best.bound, 1))
            best.add(score[good], self.null[left[good]], self.doc[left[good]])
        return len(left)


def buckets(batch: pa.RecordBatch, corpus: Corpus, classes: tuple[int, int]) -> Iterator[Bucket]:
    """The documents of a batch whose class of length is within `classes`, longest first."""
    terms, impacts, ends, lengths = _vectors(batch, corpus)
    kinds = length_class(lengths)
    order = np.argsort(-lengths, kind="stable")
    order = order[(kinds[order] >= classes[0]) & (kinds[order] < classes[1]) & (lengths[order] > 0)]
    sizes = np.diff(ends)
    null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
    doc = batch.column(0).fill_null(0).to_numpy()
    done = 0
    while done < len(order):
        upto = done + max(1, min(BUCKET, int(np.searchsorted(np.cumsum(sizes[order[done : done + BUCKET]]), ENTRIES))))
        part = order[done:upto]
        n = np.cumsum(sizes[part])
        entries = np.repeat(ends[part] - (n - sizes[part]), sizes[part]) + np.arange(int(n[-1]))
        yield Bucket(terms[entries], impacts[entries], sizes[part], lengths[part], null[part], doc[part])
        done = upto


def search(vectors: DataFrame, block: Broadcast, corpus: Broadcast, bounds: Broadcast, classes: tuple[int, int], k: int) -> DataFrame:
    """number, doc_id, score: the K best of a task for each item, from documents within `classes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, wanted = block.value.items, np.zeros(len(block.value.number), dtype=bool)
        best = [Best(k, b) for b in bounds.value]
        for batch in batches:
            for bucket in buckets(batch, corpus.value, classes):
                for item, found in zip(items, best, strict=True):
                    bucket.search(item, found, wanted)
        for first in range(0, len(items), 1_000):
            part = best[first : first + 1_000]
            number = np.repeat(np.arange(first, first + len(part)), [len(b.score) for b in part])
            doc, null, score = (np.concatenate([getattr(b, x) for b in part]) for x in ("doc", "null", "score"))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(doc, pa.int64(), mask=null), pa.array(score, pa.int64())], names=["number", "doc_id", "score"])

    return vectors.mapInArrow(run, "number int, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    """A task sends its K best of an item only; the window's limit is applied before its shuffle too."""
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """`items`: item and terms, of one block."""
    spark = docs.sparkSession
    rows = items.collect()
    number: dict[str, int] = {}
    for r in rows:
        for t in r["terms"]:
            number.setdefault(t, len(number))
    block = spark.sparkContext.broadcast(Block([np.sort(np.array([number[t] for t in r["terms"]], dtype=np.int64)) for r in rows], number))
    vectors = materialize(counted(docs, block), "vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)))
    weights = np.zeros(len(number), dtype=np.int64)
    for term, w in held.select("term", weight.cast("long")).collect():  # the block's terms at most
        weights[term] = w
    corpus = spark.sparkContext.broadcast(Corpus(n_docs, n_terms, weights))
    cut, seen = 0, 0
    for kind, n in sorted(by_class(vectors, corpus).collect(), reverse=True):  # some hundreds at most
        cut, seen = kind, seen + n
        if seen >= SEEDS * k:
            break
    none = spark.sparkContext.broadcast(np.zeros(len(rows), dtype=np.int64))
    seeds = materialize(_top(search(vectors, block, corpus, none, (cut, 1 << 30), k), k).select("number", "doc_id", "score"), "seeds")
    bounds = np.zeros(len(rows), dtype=np.int64)
    for at, score in seeds.groupBy("number").agg(F.min("score"), F.count("*").alias("n")).where(F.col("n") == k).drop("n").collect():
        bounds[at] = score
    others = search(vectors, block, corpus, spark.sparkContext.broadcast(bounds), (-1, cut), k)
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"_at int, item_id {items.schema['item'].dataType.simpleString()}")
    found = _top(seeds.unionByName(others), k).join(names, F.col("number") == F.col("_at"))
    return found.select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = K) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: the `k` best documents of each item.

    Documents with a score above 0; equal scores by ascending id, null ids last, repeated rows one
    after the other.  A null or empty text has no terms: such documents count for nothing and such
    items have no rows.  Rows of one item key are one item with the terms of all; a null key is a
    key.  Ids are whole numbers.  Other columns aren't read, so clashing names don't matter.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    terms = item_terms(items, item_key, item_text).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    terms = materialize(terms.withColumn("n_bytes", F.octet_length(F.array_join("terms", " ")).cast("long")), "items")
    total = terms.agg(F.sum("n_bytes")).first()[0]
    if not total:
        return terms.select(F.col("item").alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    n_blocks = -(-2 * total // BLOCK_BYTES) if total > BLOCK_BYTES else 1
    block = lambda i: terms.where(F.pmod(F.xxhash64("terms"), F.lit(n_blocks)) == i)
    return reduce(DataFrame.unionByName, [_search_block(docs, block(i), k) for i in range(n_blocks)])
