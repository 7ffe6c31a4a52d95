"""SimHash near-duplicates with pivot distance tables.

Every distinct fingerprint gets its Hamming distances to a table of reference fingerprints
(the pivots).  Two fingerprints within t bits differ by at most t in every coordinate of the
table.  The first coordinate is part of the key that forms candidate pairs: a fingerprint meets
those at the same distance from the first pivot and at one to t more.  Of these pairs, those whose
largest coordinate difference is over t are discarded before their bits are compared.

A coordinate of random fingerprints lies within a few of 32, so no number of them parts a large
table well.  The key therefore also holds two of four segments of 16 bits: with t <= 2 two
segments at least are equal, so the six tables keyed by two segments hold every linked pair.
A block of more than BLOCK members of one key is a dense cloud, whose pairs are too many to form;
there each member is filed under itself and its 64 one-bit neighbours, and all members filed
under one value are linked to the smallest of them (two fingerprints are within two bits of each
other just if they share such a value) - exact, and linear in the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, once

BITS_APART = 2
SHINGLE = 3
SEED = 42
#: Reference fingerprints, eight to a 64-bit word of distances.
PIVOTS = 16
#: Largest block whose pairs are compared.
BLOCK = 32
#: Shingles that are worked on at once.
CHUNK = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of XXH64 over the word shingles, signed; 0 without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    hashed, votes = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), CHUNK):
        raw = b"".join([hashed(line[s:e], seed) for s, e in zip(starts[i : i + CHUNK], ends[i : i + CHUNK], strict=True)])
        votes += np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed), text_hash; a row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), dtype=np.int64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of their own numbers."""
    return [int.from_bytes(xxhash.xxh64_digest(i.to_bytes(8, "big"), SEED), "big", signed=True) for i in range(n)]


def distance_table(fp: Column) -> list[Column]:
    """Hamming distances to the pivots, eight to a long."""
    near = [F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long") for p in pivots()]
    return [reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(d, 8 * j) for j, d in enumerate(near[i : i + 8])]) for i in range(0, PIVOTS, 8)]


def within_table(left: str, right: str, apart: int = BITS_APART) -> Column:
    """Whether no coordinate of two distance tables differs by more than `apart`."""
    lanes = [(f"_t{i}", 8 * j) for i in range(PIVOTS // 8) for j in range(8)]

    def lane(side: str, word: str, shift: int) -> Column:
        return F.shiftright(F.col(f"{side}.{word}"), shift).bitwiseAND(F.lit(255))

    return reduce(lambda a, b: a & b, [F.abs(lane(left, w, s) - lane(right, w, s)) <= apart for w, s in lanes])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints `fp`; their components are those of all pairs
    within BITS_APART bits."""
    segment = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    pairs = [(i, j) for i in range(4) for j in range(i)]
    keys = F.array(*[F.shiftleft(segment[i], 16).bitwiseOR(segment[j]) for i, j in pairs])
    filed = distinct.select("fp", F.posexplode(keys).alias("_table", "_key"))
    counted = filed.groupBy("_table", "_key").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    met = materialize(filed.join(counted, ["_table", "_key"]).select("_table", "_key", "_n", "fp"), "blocks")
    tabled = met.where(F.col("_n") <= BLOCK).select("_table", "_key", "fp", *[c.alias(f"_t{i}") for i, c in enumerate(distance_table(F.col("fp")))])
    first = F.col("_t0").bitwiseAND(F.lit(255))
    a = tabled.withColumn("_c", first).alias("a")
    b = tabled.withColumn("_c", F.explode(F.array(*[first - i for i in range(BITS_APART + 1)]))).alias("b")
    same = (F.col("a._table") == F.col("b._table")) & (F.col("a._key") == F.col("b._key")) & (F.col("a._c") == F.col("b._c"))
    once = (F.col("a.fp") < F.col("b.fp")) | (F.col("b._t0").bitwiseAND(F.lit(255)) > F.col("b._c"))
    near = a.join(b, same & once & within_table("a", "b")).where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= BITS_APART)
    near = near.select(F.least("a.fp", "b.fp").alias("u"), F.greatest("a.fp", "b.fp").alias("v"))
    crowd = met.where(F.col("_n") > BLOCK).select("fp").distinct()
    balls = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(64)])
    balls = crowd.select("fp", F.explode(balls).alias("_ball"))
    first = balls.groupBy("_ball").agg(F.min("fp").alias("u"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    far = balls.join(first, "_ball").where(F.col("u") < F.col("fp")).select("u", F.col("fp").alias("v"))
    return near.unionByName(far).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, by alternating large and small stars.

    Edges are written to the shared folder between rounds; the driver sees two numbers a round.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("_m", "u").alias("m"))
        joined = both.join(least, F.col("u") == F.col("_u"))
        if large:
            moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        return moved.where(F.col("u") != F.col("v")).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialize(edges, "links")
    before = state(now)
    while before[0]:
        now = materialize(star(star(now, True), False), "links")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(marked: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """`marked` (doc_id, `node`, ...) with component_id from edges between nodes, and root, the
    component's smallest node: unlike an id, which may be null or repeated, no two share it."""
    distinct = marked.groupBy(node).agg(F.min("doc_id").alias("first"))
    found = components(edges).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    nodes = found.unionByName(found.select(F.col("_root").alias("_node"), "_root").distinct())
    named = nodes.join(distinct, F.col("_node") == F.col(node))
    lowest = named.groupBy("_root").agg(F.min("first").alias("component_id"))
    of = nodes.join(lowest, "_root").select(F.col("_node").alias(node), "component_id", "_root")
    ids = distinct.join(of, node, "left").select(node, F.coalesce("component_id", "first").alias("component_id"), F.coalesce("_root", node).alias("root"))
    return marked.join(materialize(ids, "ids"), node)  # a join of two plain shuffles: Spark splits a hot node's rows


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits), component_id; a row per input row.

    component_id is the smallest key among all documents reachable over links of at most
    BITS_APART bits, itself included; null only where a whole component has null keys.  Null and
    empty texts have fingerprint zero and link like any other.  Other columns are not carried.
    """
    marked = materialize(fingerprints(docs, key, text, shingle), "fingerprints")
    grouped = _grouped(marked, links(marked.select("fp").distinct()), "fp")
    return grouped.select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Looser similarity.  Two texts that share 0.8 of their shingles differ in a seventh of all
# bits; within 64 bits that is too near to chance.  So the distance is that of the shingle sets:
# the number of shingles that one of two has and the other hasn't.  The pivots are reference sets
# for it: the empty set, whose distance is a set's size, and CELLS sets that part all possible
# shingles by hash.  A set A is |A| + |P| - 2 |A & P| from pivot P, so its table holds |A & P|.
# As the pivots are disjoint, the differences of two tables add up to at most the distance.
# Texts meet by the first shingles of their sets in an order of all shingles: the first one that
# two similar sets share is so early in both that no pair is missed.  Of those that meet, pairs whose
# tables differ by more than similar sets can are discarded, and the rest are decided by the sets.

#: Words of a wide fingerprint.
WIDE = 8
#: Widening of the accepted distance: one and a half standard deviations of 512 bits at 0.8.
SLACK = 12
#: Shingles that OFTEN texts hold, of every SAMPLE-th different one, come last in the order; COMMON at most.
SAMPLE, OFTEN, COMMON = 64, 4, 1 << 17
#: Disjoint pivots, a byte each; shared shingles over 255 count as 255.
CELLS = 64
#: Members of a band whose tables are compared in one task, and tables that are held against one at once.
TABLES, LANES = 1 << 16, 1 << 13
#: Bytes of text of the parts that a large group is compared in, two at a time.
PART = 8 << 20


def _mix(h: np.ndarray) -> np.ndarray:
    """WIDE hashes of each hash, a column each."""
    with np.errstate(over="ignore"):
        z = h[:, None] + np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; the whole text where it has fewer words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(line[s:e], SEED) for s, e in zip(starts, ends, strict=True)]), dtype=">u8").astype(np.uint64))


def wide_fingerprint(text: str | None, shingle: int) -> bytes:
    """Majority bits over the distinct word shingles; zero without words."""
    hashed = shingle_set(text, shingle)
    votes = np.zeros(64 * WIDE, dtype=np.int64)
    for i in range(0, len(hashed), 255):
        votes += np.unpackbits(_mix(hashed[i : i + 255]).view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * votes > len(hashed)).tobytes()


def most_apart(similarity: float) -> int:
    """Largest accepted distance at a Jaccard similarity of shingle sets of about equal size."""
    return int(64 * WIDE * np.arccos(2 * similarity / (1 + similarity)) / np.pi) + SLACK


def common_shingles(docs: DataFrame, text: str, shingle: int) -> np.ndarray:
    """Sorted hashes of shingles that many texts hold, as a sample shows.  It is for the order alone:
    whatever it finds, no pair is missed, but common passages are not what texts meet by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]).view(np.int64))], names=["shingle"])

    texts = docs.select(F.col(text).cast("string").alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).distinct()
    counted = texts.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN)
    found = counted.orderBy(F.desc("n"), "shingle").limit(COMMON).select("shingle").toArrow()
    return np.sort(found.column(0).to_numpy().astype(np.int64).view(np.uint64))


def first_shingles(hashed: np.ndarray, similarity: float, common: np.ndarray) -> np.ndarray:
    """The shingles of a set that it meets others by: of n, all but as many as it shares at least
    with a similar set, less one.  Common ones come last, others by hash."""
    if len(common):
        often = common[np.minimum(np.searchsorted(common, hashed), len(common) - 1)] == hashed
        hashed = np.concatenate([hashed[~often], hashed[often]])
    return hashed[: len(hashed) - int(np.ceil(similarity * len(hashed) - 1e-6)) + 1].view(np.int64)


def cell_table(hashed: np.ndarray) -> bytes:
    """How many shingles of a set each disjoint pivot has."""
    return np.minimum(np.bincount((hashed >> np.uint64(32)).astype(np.int64) % CELLS, minlength=CELLS), 255).astype(np.uint8).tobytes()


def may_be_near(tables: np.ndarray, size: np.ndarray, i: np.ndarray | int, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the pivot distances of sets i and j allow `similarity`."""
    apart = np.maximum(np.abs(tables[j].astype(np.int16) - tables[i]).sum(axis=1), np.abs(size[j] - size[i]))
    return apart <= (1 - similarity) / (1 + similarity) * (size[j] + size[i]) + 1e-6


def near_tables(tables: np.ndarray, size: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) of sets whose pivot distances (`tables` to the disjoint ones, `size` to the
    empty one) allow `similarity`; their components are those of all such pairs: each set that is
    reached is held against all that aren't yet."""
    out, rest = [], np.arange(len(size))
    while len(rest):
        reached, rest = [int(rest[0])], rest[1:]
        while reached and len(rest):
            i = reached.pop()
            hit = np.concatenate([may_be_near(tables, size, i, rest[k : k + LANES], similarity) for k in range(0, len(rest), LANES)])
            near, rest = rest[hit].tolist(), rest[~hit]
            out += [(i, j) for j in near]
            reached += near
    return out


def _banded(docs: DataFrame, key: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """doc_id, text_hash, node (a hash of the shingle set, 0 of an empty one), bands (its first
    shingles), and the set's pivot distances: size, cells."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(2)]
            nodes = pa.array([int.from_bytes(xxhash.xxh64_digest(h.tobytes(), SEED), "big", signed=True) if len(h) else 0 for h in sets], pa.int64())
            bands = pa.array([first_shingles(h, similarity, common.value) if len(h) else [] for h in sets], pa.list_(pa.int64()))
            size, cells = pa.array([len(h) for h in sets], pa.int64()), pa.array([cell_table(h) for h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nodes, bands, size, cells], names=["doc_id", "text_hash", "node", "bands", "size", "cells"])

    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, node long, bands array<long>, size long, cells binary")


def similar_sets(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) of pairs of sets at `similarity` or more, whose components are those of all
    such pairs: each set that is reached is compared with all that aren't yet, by its elements'
    postings."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    element = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) else owner
    by = np.argsort(element, kind="stable")
    posting, count = owner[by], np.bincount(element)
    begin, first = np.cumsum(count) - count, np.cumsum(size) - size
    out, rest = [], np.ones(len(sets), dtype=bool)
    for lead in range(len(sets)):
        if not rest[lead]:
            continue
        rest[lead], reached = False, [lead]
        while reached:
            i = reached.pop()
            mine = element[first[i] : first[i] + size[i]]
            mine = mine[count[mine] > 1]
            n = count[mine]
            met = posting[np.repeat(begin[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            other, both = np.unique(met[rest[met]], return_counts=True)
            other = other[both / (size[i] + size[other] - both) >= similarity].tolist()
            rest[other] = False
            out += [(i, j) for j in other]
            reached += other
    return out


def band_links(marked: DataFrame, similarity: float) -> DataFrame:
    """Edges (u, v) between nodes that share a band and whose pivot distances allow `similarity`,
    directly or over others of the band.

    A band's tables meet in one task, once where several bands have the same members.  The members
    of a band with more than TABLES are all linked to its smallest, which holds the same links and more.
    """
    filed = once(marked.select("node", "bands"), "node", []).select("node", F.explode("bands").alias("band"))
    own = Window.partitionBy("band")  # shuffled once; nearly all bands have one member
    shared = filed.select("band", "node", F.min("node").over(own).alias("low"), F.count("*").over(own).alias("_n"), F.bit_xor("node").over(own).alias("_all"))
    shared = materialize(shared.where(F.col("_n") > 1), "shared")
    one = shared.groupBy("low", "_n", "_all").agg(F.min("band").alias("band"))
    met = materialize(shared.join(one, ["low", "_n", "_all", "band"]).drop("_all"), "met")
    table = marked.groupBy("node").agg(F.first("size").alias("size"), F.first("cells").alias("cells"))
    rows = met.where(F.col("_n") <= TABLES).select("band", "node").join(table, "node").select("band", "node", "size", "cells")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(band: np.ndarray, node: np.ndarray, size: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
            many = np.diff(np.append(cuts, len(band)))
            two = cuts[many == 2]  # most
            two = two[may_be_near(cells, size, two, two + 1, similarity)].tolist()
            found = [(i, i + 1) for i in two] + [(a + i, a + j) for a, n in zip(cuts[many > 2].tolist(), many[many > 2].tolist(), strict=True) for i, j in near_tables(cells[a : a + n], size[a : a + n], similarity)]
            u, v = (node[[p[k] for p in found]] if found else node[:0] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(3)]
            now.append(np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, CELLS))
            held = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
            at = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last band may go on
            if at:
                yield done(*(x[:at] for x in held))
                held = [x[at:] for x in held]
        if held and len(held[0]):
            yield done(*held)

    near = rows.repartition("band").sortWithinPartitions("band").mapInArrow(run, "u long, v long")
    large = met.where((F.col("_n") > TABLES) & (F.col("low") < F.col("node"))).select(F.col("low").alias("u"), F.col("node").alias("v"))
    return near.unionByName(large).distinct()


def similar_links(marked: DataFrame, docs: DataFrame, text: str, shingle: int, similarity: float) -> DataFrame:
    """Edges (u, v) between nodes whose shingle sets are at `similarity` or more; their
    components are those of all such pairs.

    Nodes that share a band and that their pivot distances don't part form a group, directly or
    over others.  A group's texts meet in one task and are compared by their shingle
    sets; of a group of more than twice PART bytes any two parts meet in one.
    """
    node = marked.groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    found = components(band_links(marked, similarity))
    of = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    wanted = of.join(node.select("node", "text_hash"), "node").select("node", "root", "text_hash")
    texts = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    rows = texts.join(wanted, "text_hash").groupBy("node", "root").agg(F.first("text").alias("text"))
    rows = materialize(rows, "groups")
    total = rows.groupBy("root").agg(F.sum(F.octet_length("text").cast("long")).alias("_bytes"))
    parts = total.select("root", F.when(F.col("_bytes") <= 2 * PART, 1).otherwise(F.ceil(F.col("_bytes") / PART)).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda q: F.struct(F.least("_part", q).alias("i"), F.greatest("_part", q).alias("j")))
    rows = rows.join(parts, "root").withColumn("_part", part).select("root", F.explode(cells).alias("_cell"), "node", "text")
    rows = rows.select(F.xxhash64("root", "_cell.i", "_cell.j").alias("cell"), "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            pairs = [sorted((held[i][0], held[j][0])) for i, j in similar_sets([h for _, h in held], similarity)]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])

        held, last = [], None
        for batch in batches:
            for cell, number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if held and cell != last:
                    yield done(held)
                    held = []
                last = cell
                held.append((number, shingle_set(text.as_py(), shingle)))
        if held:
            yield done(held)

    rows = rows.repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(run, "u long, v long").distinct()


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, text_hash, component_id, root; a row per input row.

    Components over links of texts whose shingle sets have a Jaccard similarity of `similarity`
    or more.  Texts without words link to each other; other cases are as in `near_duplicates`.
    Components whose documents have no ids, or the same smallest one, differ in root.
    """
    marked = materialize(_banded(docs, key, text, shingle, similarity), "bands")
    edges = similar_links(marked, docs, text, shingle, similarity)
    return _grouped(marked.drop("bands", "size", "cells"), edges, "node").select("doc_id", "text_hash", "component_id", "root")


def one_of_each(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay when one document of each component of similar documents
    is kept: the one with the smallest key (nulls last), then text hash; of fully repeated rows
    one stays."""
    groups = similar_documents(docs, key, text, shingle, similarity)
    each = groups.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "n")).alias("lead")
    stay = each.groupBy("root").agg(lead).select(F.col("lead.doc_id").alias("_id"), F.col("lead.text_hash").alias("_th"), F.col("lead.n").alias("_n"))
    stay = materialize(stay, "stay")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("_key"), F.xxhash64(text).alias("_text"))
    kept = rows.join(stay, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_th")))
    again = F.row_number().over(Window.partitionBy("_key", "_text").orderBy(F.xxhash64("row")))  # of repeated rows alone
    first = kept.where(F.col("_n") > 1).withColumn("_again", again).where(F.col("_again") == 1)
    return kept.where(F.col("_n") == 1).select("row").unionByName(first.select("row")).select("row.*")
