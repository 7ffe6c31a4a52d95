"""Repeated substrings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Removed is each byte covered by a WINDOW-byte string that also starts in a document with a
smaller id.

1. Anchors.  In every window of WINDOW bytes the K-byte strings of smallest hash are anchors,
   so equal windows have equal anchors at equal offsets.  What surrounds an anchor, up to
   WINDOW - K bytes on either side, is its snippet; each window lies in a snippet of each of
   its anchors.  Where the same anchor has the same full snippet in two documents of a block
   of input, the later one is resolved at once (all of it is removed) and only the first goes
   on: a passage that many documents share is combined before anything is shuffled.
2. Anchors are dealt by hash to buckets, as packed arrays sorted by hash (the shuffle then
   carries some sixteen bytes for each).  Buckets are folded as they arrive: of equal snippets
   (by a 48-bit anchor and a 56-bit snippet hash) only that of the smallest document is held, the
   others are resolved; what no second document has ends there.
3. The snippets of a run of anchors form one text; breadth-first backward extension on its
   transform derives common prefixes by increasing length and stops at WINDOW: what is not
   parted by then are windows that occur more than once, and each class yields its smallest id.
4. A window is removed where that smallest id is below the document's own.

An anchor with more than CROWD different snippets isn't held by any task: its snippets are cut
anew at anchors of K_LONG bytes, which parts them over many tasks, and go through the same
transform; what is still crowded there (one passage in very many documents) is grouped by its
windows, which combines copies before the shuffle.  Results don't depend on these bounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, once, whole_ids

WINDOW, K = 50, 20
SIDE = WINDOW - K
SNIPPET = K + 2 * SIDE
#: Bytes of anchors that part crowded snippets.
K_LONG = 40
#: Bytes of text that anchors are sought in at once, and that one transform is made of.
BLOCK, TEXT = 1 << 18, 1 << 18
#: Blocks whose anchors are combined before they are dealt out.
COMBINE = 8
#: Different snippets of an anchor that one transform takes, and anchors of a bucket that are folded at once.
CROWD, FOLD = 4_096, 1_000_000
#: Stands for a null id: larger than all others.
LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_MARGIN = 2 * WINDOW


def _rolling(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Polynomial hashes (mod 2^64) of the strings of each length at every position."""
    size, power, parts = 1, np.uint64(_BASE), {1: (data.astype(np.uint64) + np.uint64(1), np.uint64(_BASE))}
    while size * 2 <= max(lengths):
        h, power = parts[size]
        with np.errstate(over="ignore"):
            parts[size * 2] = (h[: len(h) - size] * power + h[size:], power * power)
        size *= 2
    out = []
    for length in lengths:
        h, done = None, 0
        for bit in sorted(parts, reverse=True):
            if length - done >= bit:
                p, power = parts[bit]
                if h is None:
                    h = p
                else:
                    n = len(p) - done
                    with np.errstate(over="ignore"):
                        h = h[:n] * power + p[done : done + n]
                done += bit
        out.append(h)
    return out


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over each run of `width` values."""
    size, out = 1, values
    while size * 2 <= width:
        out = pick(out[: len(out) - size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(29))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def find_anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of anchors in `data`, texts that end at `ends` one after another; the anchors'
    hashes; the hashes of SNIPPET bytes from SIDE before each (0 where those leave the data)."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    if len(data) < WINDOW:
        return none
    grams, snippets = _rolling(data, K, min(SNIPPET, len(data)))
    grams = _mixed(grams)
    low = _slide(grams, SIDE + 1, np.minimum)  # of each window
    starts = np.arange(len(low))
    inside = starts + WINDOW <= ends[np.searchsorted(ends, starts, "right")]
    low = np.where(inside, low, np.uint64(0))
    around = np.concatenate([np.zeros(SIDE, dtype=np.uint64), low, np.zeros(SIDE, dtype=np.uint64)])
    high = _slide(around, SIDE + 1, np.maximum)  # over the windows that hold each gram
    at = np.flatnonzero((high == grams) & (high > 0))
    snip = np.zeros(len(at), dtype=np.uint64)
    full = (at >= SIDE) & (at - SIDE < len(snippets)) & (len(data) >= SNIPPET)
    snip[full] = _mixed(snippets[at[full] - SIDE])
    return at, grams[at], snip


def _runs(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of half-open spans as maximal runs."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[new].tolist(), end[np.append(new[1:], len(start)) - 1].tolist(), strict=True))


def _block(docs: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """Anchors of some documents (doc, tag, text bytes): hash, snippet hash (0: cut off by an
    end of the text), position, index of the document."""
    parts, origin, who = [], [], []
    for i, (_, _, text) in enumerate(docs):
        for first in range(0, len(text), BLOCK):
            part = text[max(0, first - _MARGIN) : first + BLOCK + _MARGIN]
            parts.append(part)
            origin.append((max(0, first - _MARGIN), first, first + BLOCK))
            who.append(i)
    ends = np.cumsum([len(p) for p in parts])
    at, gram, snip = find_anchors(np.frombuffer(b"".join(parts), dtype=np.uint8), np.append(ends, ends[-1:] + WINDOW))
    part = np.searchsorted(ends, at, "right")
    origin, who = np.array(origin, dtype=np.int64).reshape(-1, 3), np.array(who, dtype=np.int64)
    pos = at - (ends - [len(p) for p in parts])[part] + origin[part, 0]
    mine = (pos >= origin[part, 1]) & (pos < origin[part, 2])
    pos, gram, snip, index = pos[mine], gram[mine], snip[mine], who[part[mine]]
    size = np.array([len(d[2]) for d in docs], dtype=np.int64)[index]
    return gram, np.where((pos >= SIDE) & (pos + K + SIDE <= size), snip, np.uint64(0)), pos, index


def _planes(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, byte by byte and compressed: high bytes that are zero take no room."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays))


def _arrays(data: bytes, n: int) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(data)
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(n, 8, -1).transpose(0, 2, 1)).view("<i8")[:, :, 0]


def _parcels(gram: np.ndarray, snip: np.ndarray, pos: np.ndarray, doc: np.ndarray, tag: np.ndarray, buckets: int) -> Iterator[tuple[int, bool, bytes, bytes, int]]:
    """(bucket, resolved, documents, rows, n): n anchors that go on, and spans resolved here.

    An anchor's hash is the smallest of a window's, so it is mixed once more: buckets by the
    hash itself would hold ever more towards zero.
    """
    gram = _mixed(gram ^ np.uint64(_BASE))
    order = np.lexsort((pos, doc, snip, gram))
    gram, snip, pos, doc, tag = (x[order] for x in (gram, snip, pos, doc, tag))
    new = np.ones(len(gram), dtype=bool)
    new[1:] = (gram[1:] != gram[:-1]) | (snip[1:] != snip[:-1]) | (snip[1:] == 0)
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(gram) else order
    later = doc > doc[lead]
    if later.any():
        at = np.flatnonzero(later)
        at = at[np.lexsort((pos[at], tag[at], doc[at]))]
        edges = np.flatnonzero(np.concatenate([[True], (doc[at][1:] != doc[at][:-1]) | (tag[at][1:] != tag[at][:-1])]))
        for s, e in zip(edges, np.append(edges[1:], len(at)), strict=True):
            spans = np.array(_runs(pos[at[s:e]] - SIDE, pos[at[s:e]] + K + SIDE), dtype=np.int64)
            yield int(doc[at[s]] % buckets), True, _planes(doc[at[s : s + 1]], tag[at[s : s + 1]]), _planes(spans[:, 0], spans[:, 1]), len(spans)
    on = ~later
    gram, pos, doc, tag, snip = (x[on] for x in (gram, pos, doc, tag, snip))
    short, snip = (gram >> np.uint64(16)).astype(np.int64), (snip >> np.uint64(8)).astype(np.int64)
    bucket = (short.astype(np.float64) * (buckets / 2.0**48)).astype(np.int64)  # monotone in the hash
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(short) else short
    for s, e in zip(cuts, np.append(cuts[1:], len(short)), strict=True) if len(short) else ():
        keys, which = _distinct(doc[s:e], tag[s:e])
        yield int(bucket[s]), False, _planes(keys[0], keys[1]), _planes(np.diff(short[s:e], prepend=0), which, pos[s:e], snip[s:e]), int(e - s)


def _distinct(doc: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((tag, doc))
    d, t = doc[order], tag[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])
    which = np.empty(len(doc), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return np.stack([d[new], t[new]]), which


def bucket_count(texts: DataFrame) -> int:
    return max(32, 4 * texts.rdd.getNumPartitions())


def anchors(texts: DataFrame) -> DataFrame:
    """bucket, resolved, documents, rows, n: packed anchors of rows (doc, tag, text)."""
    buckets = bucket_count(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.int64()]

        def seek(held: list) -> tuple[np.ndarray, ...]:
            gram, snip, pos, index = _block(held)
            key = np.array([d[:2] for d in held], dtype=np.int64)
            return gram, snip, pos, key[index, 0], key[index, 1]

        def done(found: list) -> pa.RecordBatch:
            out = list(_parcels(*(np.concatenate(x) for x in zip(*found, strict=True)), buckets))
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], names=["bucket", "resolved", "documents", "rows", "n"])

        for batch in batches:
            found, held, size = [], [], 0
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                if len(data) >= WINDOW:
                    held.append((doc, tag, data))
                    size += len(data)
                if size >= BLOCK:
                    found.append(seek(held))
                    held, size = [], 0
                if len(found) >= COMBINE:
                    yield done(found)
                    found = []
            if held:
                found.append(seek(held))
            if found:
                yield done(found)

    return texts.select("doc", "tag", "text").mapInArrow(run, "bucket int, resolved boolean, documents binary, rows binary, n long")


def _fold(a: np.ndarray, doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, snip: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The anchors in order, and which of them have the snippet of a smaller document."""
    order = np.lexsort((doc, snip, a))
    a, doc, tag, pos, snip = (x[order] for x in (a, doc, tag, pos, snip))
    same = np.zeros(len(a), dtype=bool)
    same[1:] = (a[1:] == a[:-1]) & (snip[1:] == snip[:-1]) & (snip[1:] != 0)
    lead = np.flatnonzero(~same)[np.cumsum(~same) - 1]
    return [a, doc, tag, pos, snip], doc > doc[lead]


def shared_anchors(packed: DataFrame, buckets: int) -> DataFrame:
    """a, doc, tag, pos, end, crowd: anchors that two documents have (end -1), resolved spans.

    A bucket's anchors stay packed until there are FOLD of them, and are then folded: one is held
    for each different snippet, and none for crowded anchors, so neither copies nor a common
    anchor add up in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "doc", "tag", "pos", "end", "crowd"]

        def out(a: np.ndarray, doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, end: np.ndarray, crowd: bool) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(a), 50_000):
                part = [pa.array(x[i : i + 50_000]) for x in (a, doc, tag, pos, end)]
                yield pa.RecordBatch.from_arrays([*part, pa.array(np.full(len(part[0]), crowd))], names=names)

        def fold(bucket: int) -> Iterator[pa.RecordBatch]:
            parts = [kept.pop(bucket, [none] * 5)]
            for documents, rows in held.pop(bucket, []):
                keys, (step, which, pos, snip) = _arrays(documents, 2), _arrays(rows, 4)
                parts.append([np.cumsum(step), keys[0][which], keys[1][which], pos, snip])
            size[bucket] = 0
            now, later = _fold(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            parts.clear()
            _, doc, tag, pos, _ = (x[later] for x in now)
            yield from out(np.zeros(len(doc), dtype=np.int64), doc, tag, pos - SIDE, pos + K + SIDE, False)
            now = [x[~later] for x in now]
            value, n = np.unique(now[0], return_counts=True)
            crowded[bucket] = np.union1d(crowded.get(bucket, none), value[n > CROWD])
            many = np.isin(now[0], crowded[bucket])
            a, doc, tag, pos, _ = (x[many] for x in now)
            yield from out(a, doc, tag, pos, np.full(len(a), -1), True)
            kept[bucket] = [x[~many] for x in now]

        none = np.zeros(0, dtype=np.int64)
        kept: dict[int, list[np.ndarray]] = {}
        held: dict[int, list[tuple[bytes, bytes]]] = {}
        crowded: dict[int, np.ndarray] = {}
        size: dict[int, int] = {}
        for batch in batches:
            for bucket, resolved, documents, rows, n in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if resolved:
                    (doc,), (tag,) = _arrays(documents, 2)
                    start, end = _arrays(rows, 2)
                    yield from out(np.zeros(len(start), dtype=np.int64), np.full(len(start), doc), np.full(len(start), tag), start, end, False)
                    continue
                held.setdefault(bucket, []).append((documents, rows))
                size[bucket] = size.get(bucket, 0) + n
                if size[bucket] >= max(FOLD, len(kept.get(bucket, [none])[0])):
                    yield from fold(bucket)
        for bucket in sorted(size):
            yield from fold(bucket)
            a, doc, tag, pos, _ = kept.pop(bucket)
            if len(a):
                starts = np.flatnonzero(_changes(a))
                n = np.diff(np.append(starts, len(a)))
                met = np.repeat(np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts), n)
                yield from out(a[met], doc[met], tag[met], pos[met], np.full(int(met.sum()), -1), False)

    rows = packed.repartition(buckets, "bucket")
    return rows.mapInArrow(run, "a long, doc long, tag long, pos long, end long, crowd boolean")


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, where each value begins in them, and its size."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), offsets[:-1], np.diff(offsets)


def _cuts(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column of the strings of `sizes` bytes that begin at `first`."""
    ends = np.cumsum(sizes)
    taken = data[np.repeat(first - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(taken)])


FOUND = ["a", "doc", "tag", "begin", "snippet"]
FOUND_SCHEMA = "a long, doc long, tag long, begin long, snippet binary"


def snippets(shared: DataFrame, texts: DataFrame) -> DataFrame:
    """FOUND: the snippets of the shared anchors and where they begin."""
    wanted = shared.groupBy("doc", "tag").agg(F.collect_list(F.struct("a", "pos")).alias("_at"))
    rows = texts.select("doc", "tag", "text").join(wanted, ["doc", "tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag = (batch.column(i).to_numpy() for i in (0, 1))
            data, first, sizes = _bytes_of(batch.column(2))
            which = np.repeat(np.arange(len(doc)), pc.list_value_length(batch.column(3)).to_numpy())
            a, pos = (x.to_numpy() for x in batch.column(3).flatten().flatten())
            for i in range(0, len(a), 50_000):
                w, p = which[i : i + 50_000], pos[i : i + 50_000]
                begin = np.maximum(0, p - SIDE)
                cut = _cuts(data, first[w] + begin, np.minimum(sizes[w], p + K + SIDE) - begin)
                yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 50_000]), pa.array(doc[w]), pa.array(tag[w]), pa.array(begin), cut], names=FOUND)

    return rows.mapInArrow(run, FOUND_SCHEMA)


def cut_anew(found: DataFrame, k: int = K_LONG) -> DataFrame:
    """FOUND with snippets cut at anchors of `k` bytes: runs of windows with one smallest `k`-byte
    string, under another hash.  Each window lies in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, doc, tag, begin = (batch.column(i).to_numpy() for i in range(4))
            data, first, sizes = _bytes_of(batch.column(4))
            if int(sizes.sum()) < WINDOW:
                continue
            data, first = data[first[0] : first[-1] + sizes[-1]], first - first[0]
            grams = _mixed(_rolling(data, k)[0] ^ np.uint64(_BASE))
            low = _slide(grams, WINDOW - k + 1, np.minimum)
            which = np.searchsorted(first + sizes, np.arange(len(low)), "right")
            inside = np.arange(len(low)) + WINDOW <= (first + sizes)[which]
            new = inside & (_changes(low) | _changes(which))
            new[1:] |= inside[1:] & ~inside[:-1]
            at = np.flatnonzero(new)
            run_of = np.cumsum(new)[inside] - 1
            size = np.bincount(run_of, minlength=len(at)) + WINDOW - 1
            w = which[at]
            yield pa.RecordBatch.from_arrays([pa.array(low[at].view(np.int64)), pa.array(doc[w]), pa.array(tag[w]), pa.array(begin[w] + at - first[w]), _cuts(data, at, size)], names=FOUND)

    return found.select(*FOUND).mapInArrow(run, FOUND_SCHEMA)


def _by_key(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys of up to 63 - `bits` bits, and the keys so ordered, by one sort of words that
    hold key and position."""
    words = (keys << bits) | np.arange(len(keys), dtype=np.int64)
    words.sort()
    return words & ((1 << bits) - 1), words >> bits


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it; the first does."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions ordered by their first `depth` symbols at least (what is beyond the end counts
    as symbol 0), where the first `size` symbols change along that order, and this size."""
    n = len(data)
    bits, width = max(1, n.bit_length()), max(1, int(data.max(initial=0)).bit_length())
    if 3 * bits > 63:
        raise ValueError("a text for one transform has to be shorter than 2 MB")
    size = first = min((63 - bits) // width, depth)
    key = np.zeros(n, dtype=np.int64)
    for i in range(size):
        key[: max(0, n - i)] |= data[i:].astype(np.int64) << (width * (size - 1 - i))
    order, key = _by_key(key, bits)
    seed = new = _changes(key)
    rank = np.empty(n, dtype=np.int64)
    while size < depth:
        rank[order] = np.cumsum(new)
        key = rank << bits
        key[: max(0, n - size)] |= rank[size:]
        order, key = _by_key(key, bits)
        new = _changes(key)
        size *= 2
    return order, seed, first


def window_classes(data: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of `data` (symbol 0 separates texts), and where along it the first `window`
    symbols change, for suffixes that have so many before a separator.

    Breadth-first backward extension on the transform: the interval of a string w gives, for
    each symbol c that stands before w, the interval of cw.  The end of that interval is where
    cw is left, so where no shorter string was left there, the common prefix is as long as w;
    only such intervals go on (others end where a shorter one did, and so would all that
    extends them).  Lengths come in increasing order, from the intervals of the first symbols
    that the sort began with, and the search stops at `window`.
    """
    order, left, size = suffix_order(data, window)
    n = len(data)
    left = np.append(left, True)
    if size >= window:
        return order, left[:n]
    bwt = data[order - 1].astype(np.int64)
    bwt[order == 0] = 0
    by_symbol, symbol = _by_key(bwt, max(1, n.bit_length()))
    step = np.empty(n, dtype=np.int64)  # row of the suffix one symbol longer
    step[by_symbol] = np.arange(n)
    same = np.zeros(n + 1, dtype=bool)
    np.equal(symbol[1:], symbol[:-1], out=same[1:n])
    before, after = np.full(n, -1), np.full(n, n)  # rows with the same symbol
    before[by_symbol[1:]] = np.where(same[1:n], by_symbol[:-1], -1)
    after[by_symbol[:-1]] = np.where(same[1:n], by_symbol[1:], n)
    low = np.flatnonzero(left[:n])
    high = np.append(low[1:], n) - 1
    for _ in range(size, window):
        alone = low == high
        row = low[alone]
        row = row[bwt[row] > 0]
        ends = [step[row]]
        starts = [ends[0]]
        low, high = low[~alone], high[~alone]
        if len(low):
            many = high - low + 1
            row = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            low, high = np.repeat(low, many), np.repeat(high, many)
            open_ = bwt[row] > 0
            starts.append(np.sort(step[row[open_ & (before[row] < low)]]))
            ends.append(np.sort(step[row[open_ & (after[row] > high)]]))
        low, high = np.concatenate(starts), np.concatenate(ends)
        new = ~left[high + 1]
        low, high = low[new], high[new]
        if not len(low):
            break
        left[high + 1] = True
    return order, left[:n]


def repeated_windows(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, offset, smallest owner) of each window that occurs more than once in the texts of
    `sizes` bytes that begin at `first` in `data`, sorted by text and offset."""
    which = np.repeat(np.arange(len(sizes)), sizes + 1)
    start = np.cumsum(sizes + 1) - sizes - 1
    filled = np.ones(len(which), dtype=bool)
    filled[start + sizes] = False
    symbols = np.zeros(256, dtype=np.int64)
    raw = data[(np.arange(len(which)) + np.repeat(first - start, sizes + 1))[filled]]
    symbols[raw] = 1
    symbols = np.cumsum(symbols)  # those that occur, from 1 on
    text = np.zeros(len(which), dtype=np.int64)
    text[filled] = symbols[raw]
    order, left = window_classes(text, window)
    room = np.repeat(start + sizes, sizes + 1) - np.arange(len(which)) >= window
    rows = np.flatnonzero(room[order])
    cls = np.cumsum(left)[rows]
    starts = np.flatnonzero(_changes(cls)) if len(cls) else rows
    many = np.diff(np.append(starts, len(cls)))
    at = order[rows]
    least = np.repeat(np.minimum.reduceat(owner[which[at]], starts), many) if len(rows) else at
    again = np.repeat(many > 1, many)
    found = np.zeros(len(which), dtype=bool)
    low = np.zeros(len(which), dtype=np.int64)
    found[at[again]] = True
    low[at[again]] = least[again]
    at = np.flatnonzero(found)
    return which[at], at - start[which[at]], low[at]


SPANS = "doc long, tag long, start long, end long"


def _removed(a: np.ndarray, doc: np.ndarray, tag: np.ndarray, begin: np.ndarray, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """SPANS of the windows of some snippets that are in a smaller document's among them."""
    text, offset, low = repeated_windows(data, first, sizes, doc)
    hit = low < doc[text]
    text, offset = text[hit], offset[hit]
    start = _changes(text)
    start[1:] |= offset[1:] > offset[:-1] + WINDOW
    end = np.append(start[1:], True)[: len(text)]
    text, lead = text[start], offset[start]
    columns = (doc[text], tag[text], begin[text] + lead, begin[text] + offset[end] + WINDOW)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "tag", "start", "end"])


def _by_transform(found: DataFrame) -> DataFrame:
    """SPANS of the removed windows; each anchor's snippets are in one task, in one transform."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            a, doc, tag, begin, sizes = (np.concatenate([h[i] for h in held]) for i in range(5))
            data = np.concatenate([h[5] for h in held])
            ends = np.cumsum(sizes)
            cuts, low = np.append(np.flatnonzero(_changes(a)), len(a)), 0
            if not last:
                cuts = cuts[:-1]  # the last anchor may go on
            while low < cuts[-1]:
                base = ends[low] - sizes[low]
                high = int(cuts[min(np.searchsorted(cuts, np.searchsorted(ends, base + TEXT) + 1), len(cuts) - 1)])
                yield _removed(a[low:high], doc[low:high], tag[low:high], begin[low:high], data, (ends - sizes)[low:high], sizes[low:high])
                low = high
            base = int(ends[low - 1]) if low else 0
            held = [(a[low:], doc[low:], tag[low:], begin[low:], sizes[low:], data[base:])]
            size = len(data) - base

        held, size = [], 0
        for batch in batches:
            data, first, sizes = _bytes_of(batch.column(4))
            if not len(sizes):
                continue
            held.append((*(batch.column(i).to_numpy() for i in range(4)), sizes, data[first[0] : first[-1] + sizes[-1]]))
            size += int(sizes.sum())
            if size >= 4 * TEXT:
                yield from done(False)
        if held:
            yield from done(True)

    return found.select(*FOUND).repartition("a").sortWithinPartitions("a").mapInArrow(run, SPANS)


def _by_window(found: DataFrame) -> DataFrame:
    """The same for anchors with very many snippets of few different windows: equal snippets are
    combined, and their windows grouped.  A snippet is shorter than two windows, so its removed
    windows overlap: they are one span, and a row here."""
    found = found.withColumn("h", F.xxhash64("snippet"))
    distinct = found.groupBy("a", "h", "snippet").agg(F.min("doc").alias("low")).where(F.octet_length("snippet") >= WINDOW)
    rows = distinct.select("a", "h", "low", "snippet", F.explode(F.sequence(F.lit(0), F.octet_length("snippet") - WINDOW)).alias("offset"))
    rows = rows.select("a", "h", "low", "offset", F.expr(f"substring(snippet, offset + 1, {WINDOW})").alias("w"))
    least = rows.groupBy("w").agg(F.min("low").alias("m"))
    least = rows.join(least, "w").groupBy("a", "h").agg(F.collect_list(F.struct("offset", "m")).alias("least"))
    hits = found.select("a", "h", "doc", "tag", "begin").join(least, ["a", "h"])
    gone = F.transform(F.filter("least", lambda x: x.m < F.col("doc")), lambda x: x.offset)
    hits = hits.select("doc", "tag", "begin", gone.alias("gone")).where(F.size("gone") > 0)
    return hits.select("doc", "tag", (F.col("begin") + F.array_min("gone")).alias("start"), (F.col("begin") + F.array_max("gone") + WINDOW).alias("end"))


def _crowded(found: DataFrame) -> DataFrame:
    """SPANS from the snippets of crowded anchors, cut at longer ones."""
    parts = materialize(cut_anew(found), "crowded")
    many = parts.groupBy("a").agg(F.count("*").alias("_n")).where(F.col("_n") > CROWD).select("a", F.lit(True).alias("_many"))
    parts = materialize(parts.join(materialize(many, "many"), "a", "left"), "crowded")
    return _by_transform(parts.where(F.col("_many").isNull()).drop("_many")).unionByName(_by_window(parts.where("_many").drop("_many")))


def removed_spans(texts: DataFrame) -> DataFrame:
    """doc, tag, spans (array of (start, end), may overlap) from rows (doc, tag, text)."""
    met = materialize(shared_anchors(anchors(texts), bucket_count(texts)), "anchors")
    spans = _by_transform(snippets(met.where((F.col("end") < 0) & ~F.col("crowd")), texts))
    if met.where("crowd").head(1):
        spans = spans.unionByName(_crowded(snippets(met.where((F.col("end") < 0) & F.col("crowd")), texts)))
    resolved = met.where(F.col("end") >= 0).select("doc", "tag", F.col("pos").alias("start"), "end")
    return spans.unionByName(resolved).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_bytes, n_removed, n_spans, kept_sha256, kept (binary: what is left).

    A null or empty text has nothing to remove.  A null id counts as larger than all others.
    Rows of equal id never remove from each other; they are told apart by 64-bit hashes of their
    texts, and rows of equal id and text are one document, however many.  Ids of another type than whole numbers are a TypeError.  Other columns are not carried.
    """
    texts = whole_ids(docs, key).select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("tag"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    spans = removed_spans(once(texts.select("doc", "tag", "text"), "doc", ["tag"]))
    rows = texts.join(spans, ["doc", "tag"], "left").select("key", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, spans in zip(batch.column(1), batch.column(2), strict=True):
                data, runs = (value.as_py() or "").encode(), []
                if spans.is_valid:
                    start, end = spans.values.flatten()
                    runs = _runs(start.to_numpy(), end.to_numpy())
                kept, at = [], 0
                for s, e in runs:
                    kept.append(data[at:s])
                    at = e
                left = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[j] for r in out], t) for j, t in enumerate(types))], names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(cut, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
