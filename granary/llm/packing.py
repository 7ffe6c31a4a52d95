"""Packing by non-negative least squares over a length histogram.

1. Whole texts become ids (plus an end id), cut into windows of 2048 and one remainder.
2. The histogram of piece lengths (at most 2048 numbers, whatever the input) goes to the
   driver.  All combinations of up to three lengths that fill a window exactly are columns of
   a matrix; projected gradients solve min |A x - h|, x >= 0 for their repeat counts.
3. The counts are rounded along their running sum and clipped to what the histogram has;
   the residual histogram is packed greedily, largest length first, best fit into the gap.
4. The plan says, for the k-th piece of each length, its sequence and offset.  Pieces get k
   from counts per (input task, length), so no task holds all pieces of one length.

Where documents come in a training order (`order`, a column of few values along it, such as the
sorted files they are in), it is cut into RANGES of about equal tokens; each is packed by a
histogram and a plan of its own, and its sequences follow those of the range before.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .tokens import BATCH_BYTES, TOKENIZER, Encoder, by_bytes

WINDOW = 2048
END_ID = 1
#: Gradient steps of the solver; the histogram's size is fixed, so is their cost.
STEPS = 200
#: Parts of a training order that are packed apart.
RANGES = 4


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """All multisets of one to three present lengths that sum to `window`, as rows (0: none)."""
    have = np.zeros(window + 1, dtype=bool)
    have[present] = True
    have[0] = True
    a = np.arange(window, -1, -1)
    a, b = np.meshgrid(a[have[a]], a[have[a]], indexing="ij")
    c = window - a - b
    ok = (a >= b) & (c >= 0) & (b >= c)
    a, b, c = a[ok], b[ok], c[ok]
    ok = have[c]
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def solve_nnls(combos: np.ndarray, hist: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - hist| by accelerated projected gradients."""
    n = len(combos)
    if not n:
        return np.zeros(0)
    size = len(hist)

    def forward(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(combos[:, j], weights=x, minlength=size) for j in range(3))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        r = r.copy()
        r[0] = 0
        return r[combos[:, 0]] + r[combos[:, 1]] + r[combos[:, 2]]

    v = np.ones(n)
    for _ in range(12):
        v = back(forward(v))
        top = np.linalg.norm(v)
        v /= top
    top *= 1.05
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(forward(y) - hist) / top)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(hist: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences); uses every piece exactly once."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in hist.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], most: int | None = None) -> int:
        need = defaultdict(int)
        for x in lengths:
            need[x] += 1
        n = min(int(left[x]) // k for x, k in need.items())
        n = n if most is None else min(n, most)
        if n > 0:
            for x, k in need.items():
                left[x] -= n * k
            out.append((lengths, n))
        return n

    take((window,))
    combos = combinations(np.flatnonzero(left), window)
    combos = combos[combos[:, 0] < window]
    x = solve_nnls(combos, left.astype(float))
    order = np.argsort(-x, kind="stable")
    whole = np.diff(np.floor(np.concatenate([[0.0], np.cumsum(x[order])]) + 1e-9)).astype(np.int64)
    for i in np.flatnonzero(whole):
        take(tuple(int(v) for v in combos[order[i]] if v), int(whole[i]))
    while (present := np.flatnonzero(left)).size:
        lengths, gap, used = [], window, defaultdict(int)
        while gap and (fits := [v for v in present[: np.searchsorted(present, gap, "right")][::-1] if left[v] > used[v]][:1]):
            n = min(gap // fits[0], int(left[fits[0]]) - used[fits[0]])
            lengths += [int(fits[0])] * n
            used[fits[0]] += n
            gap -= n * int(fits[0])
        take(tuple(lengths))
    return out


def lookup(packed: list[tuple[tuple[int, ...], int]], part: int = 0, first: int = 0) -> tuple[list[int], list[tuple[int, int, int]], int]:
    """Keys (part << 56 | length << 44 | first rank) and rows (first sequence, pieces of that
    length in a sequence, their first offset) for `place`, and the number after the last sequence."""
    keys, rows, ranks, sequence = [], [], defaultdict(int), first
    for lengths, n in packed:
        at, seen = 0, {}
        for x in lengths:
            seen.setdefault(x, [at, 0])[1] += 1
            at += x
        for x, (start, k) in seen.items():
            keys.append((part << 56) + (x << 44) + ranks[x])
            rows.append((sequence, k, start))
            ranks[x] += n * k
        sequence += n
    return keys, rows, sequence


def cut_tokens(docs: DataFrame, key: str, text: str, tokenizer: str, window: int, end_id: int, order: Column | None = None) -> DataFrame:
    """A row per piece: key, start, length, ids_crc32, doc_tokens, its task and rank there among
    those of its length and order, and the order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = Encoder(tokenizer), TaskContext.get().partitionId()
        seen: dict[str, np.ndarray] = {}
        end = np.asarray([end_id], dtype="<u4").tobytes()
        names = ["_row", "start", "length", "ids_crc32", "doc_tokens", "_rank"]
        for batch in batches:
            rows, at, orders = [], 0, batch.column(2).to_pylist()
            for run in by_bytes(batch.column(1).to_pylist(), BATCH_BYTES):
                for ids in encode(run):
                    ids += end
                    ranks = seen.setdefault(orders[at], np.zeros(window + 1, dtype=np.int64))
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        length = min(window, n - start)
                        rows.append((at, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, ranks[length]))
                        ranks[length] += 1
                    at += 1
            found = np.array(rows, dtype=np.int64).reshape(-1, 6)
            columns = [pa.array(found[:, j]) for j in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(columns[0]), *columns[1:], pa.array(np.full(len(found), task, dtype=np.int64)), batch.column(2).take(columns[0])], names=[key, *names[1:], "_task", "_order"])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"), (F.lit("") if order is None else F.coalesce(order, F.lit(""))).alias("_order"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(cut, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, _rank long, _task long, _order string")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, window: int = WINDOW, end_id: int = END_ID, order: Column | None = None) -> DataFrame:
    """`key`, start, length, ids_crc32, doc_tokens, sequence_id, offset; a row per piece.

    A null or empty text is the end id alone.  Equal keys and repeated rows are packed as
    separate documents.  No rows in, no rows out.  Other columns are not carried.
    Only histograms reach the driver: one of at most `window` lengths, or RANGES of them where
    `order` (text, few values) is given.
    """
    cut = materialize(cut_tokens(docs, key, text, tokenizer, window, end_id, order), "pieces")
    per = cut.groupBy("_order").agg(F.sum("length").alias("_n"))
    along = Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row for each value of the order
    middle = (F.sum("_n").over(along) - F.col("_n") / 2) / F.sum("_n").over(Window.partitionBy())
    part = F.floor(middle * RANGES).cast("long") if order is not None else F.lit(0).cast("long")
    parts = materialize(per.select("_order", part.alias("_part")), "parts")
    per_task = cut.groupBy("_order", "_task", "length").agg(F.count("*").alias("_n")).join(parts, "_order")
    hists: dict[int, dict[int, int]] = defaultdict(dict)
    for r in per_task.groupBy("_part", "length").agg(F.sum("_n").alias("n")).collect():
        hists[r["_part"]][r["length"]] = r["n"]
    keys, rows, sequence = [], [], 0
    for i in sorted(hists):
        more, places, sequence = lookup(plan(hists[i], window), i, sequence)
        keys, rows = keys + more, rows + places
    by_key = np.argsort(np.array(keys, dtype=np.int64))
    keys, rows = np.array(keys, dtype=np.int64)[by_key], np.array(rows, dtype=np.int64).reshape(-1, 3)[by_key]
    before = Window.partitionBy("_part", "length").orderBy("_order", "_task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("_order", "_part", "_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = cut.join(first, ["_order", "_task", "length"]).withColumn("_rank", F.col("_first") + F.col("_rank")).drop("_first", "_task", "_order")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            length, rank = f["length"].to_numpy(), f["_rank"].to_numpy()
            wanted = (f["_part"].to_numpy() << 56) + (length << 44) + rank
            at = np.searchsorted(keys, wanted, "right") - 1
            base, many, start = rows[at].T if len(rows) else np.zeros((3, len(f)), dtype=np.int64)
            local = wanted - keys[at] if len(rows) else wanted
            many = np.maximum(many, 1)
            yield f.drop(columns=["_rank", "_part"]).assign(sequence_id=base + local // many, offset=start + local % many * length)

    kind = ranked.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "_rank", "_part"]
    return ranked.select(*names).mapInPandas(place, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
