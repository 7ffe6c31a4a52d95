"""Line dedup with a fixed-depth template tree.

A line's tokens are masked (a token with a digit becomes the wildcard) and the line is filed
in the tree by its token count and its first DEPTH masked tokens; that path is its leaf.
Within a leaf, a token is part of the template if it stands at its place in MIN_DOCS
documents or more, else the wildcard takes its place.  A template that keeps SOLID of its
tokens or more and occurs in MIN_DOCS documents or more is dropped wherever it occurs but the
first time (smallest id, then line), so no content leaves the corpus altogether.

Only hashes of paths are shuffled for all lines; texts meet the lines of leaves with enough
documents in one exchange by document, which the final rewrite uses again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, once, whole_ids

DEPTH, MIN_DOCS, SOLID = 3, 10, 0.6
WILD = "<*>"
_DIGIT = re.compile(r"\d")
#: Stands for a null id: larger than all others.
LAST = (1 << 63) - 1


def tokens_of(line: str) -> list[str]:
    """Masked tokens of a line, cut at ASCII white space."""
    words = re.split(r"[ \t-\r]+", line.strip(" \t\n\x0b\x0c\r"))
    return [WILD if _DIGIT.search(w) else w for w in words if w]


def leaf_of(tokens: list[str], depth: int = DEPTH) -> int:
    path = "\x1f".join([str(len(tokens)), *tokens[:depth]])
    return int.from_bytes(xxhash.xxh64_digest(path.encode("utf-8", "surrogatepass"), 0), "big", signed=True)


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("tag"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def leaves(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc, tag, leaf, lines (numbers of the lines there), a row for each leaf of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag, leaf, at = [], [], [], []
            for d, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                here: dict[int, list[int]] = {}
                for i, line in enumerate(lines_of(text.as_py())):
                    if tokens := tokens_of(line):
                        here.setdefault(leaf_of(tokens, depth), []).append(i)
                doc += [d] * len(here)
                tag += [t] * len(here)
                leaf += here.keys()
                at += here.values()
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(tag, pa.int64()), pa.array(leaf, pa.int64()), pa.array(at, pa.list_(pa.int32()))], names=["doc", "tag", "leaf", "lines"])

    return texts.select("doc", "tag", "text").mapInArrow(run, "doc long, tag long, leaf long, lines array<int>")


def _candidates(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, tag, line, leaf, tokens of the lines in `wanted` (doc, tag, at: leaf and lines), with
    `alone` (the document's lines in the leaf are all equal) and, where not, `fresh`: the places
    of the line whose token no line before it has there, in this leaf of the document."""
    rows = texts.select("doc", "tag", "text").join(wanted, ["doc", "tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.list_(pa.int32())]
        for batch in batches:
            out = []
            for doc, tag, text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                lines = lines_of(text.as_py())
                for x in at.as_py():
                    own = [tokens_of(lines[i]) for i in x["lines"]]
                    fresh: dict[tuple, list[int]] = {}
                    seen: set[tuple[int, str]] = set()
                    for tokens in map(tuple, own):
                        if tokens not in fresh:
                            fresh[tokens] = [p for p, w in enumerate(tokens) if (p, w) not in seen]
                            seen.update(enumerate(tokens))
                    alone = len(fresh) == 1
                    out += [(doc, tag, i, x["leaf"], tokens, alone, None if alone else fresh[tuple(tokens)]) for i, tokens in zip(x["lines"], own, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], names=["doc", "tag", "line", "leaf", "tokens", "alone", "fresh"])

    return rows.mapInArrow(run, "doc long, tag long, line int, leaf long, tokens array<string>, alone boolean, fresh array<int>")


def templates(found: DataFrame, min_docs: int = MIN_DOCS, solid: float = SOLID) -> DataFrame:
    """leaf, tokens_hash, template, of the distinct lines whose template is to be dropped.

    Equal lines of a leaf are combined first; then each (place, token) is counted over
    documents, and the distinct lines get back the tokens that are common.  A document counts
    once for a token or a template: those with several different lines in the leaf are counted
    apart, by the places that are new in the document and by distinct templates.
    """
    hashed = found.withColumn("tokens_hash", F.xxhash64("tokens"))
    once = hashed.groupBy("doc", "tag", "leaf", "tokens_hash").agg(F.first("tokens").alias("tokens"), F.first("alone").cast("long").alias("alone"))
    distinct = once.groupBy("leaf", "tokens_hash").agg(F.sum("alone").alias("n_alone"), F.first("tokens").alias("tokens"))
    several = materialize(hashed.where(~F.col("alone")).groupBy("doc", "tag", "leaf", "tokens_hash").agg(F.first(F.transform("fresh", lambda p: F.struct(p.alias("place"), F.get("tokens", p).alias("token")))).alias("fresh")), "several")
    spread = distinct.select("leaf", "tokens_hash", "n_alone", F.posexplode("tokens").alias("place", "token"))
    fresh = several.select("leaf", F.explode("fresh").alias("x")).select("leaf", "x.place", "x.token", F.lit(1).cast("long").alias("n_alone"))
    counts = spread.select("leaf", "place", "token", "n_alone").unionByName(fresh)
    common = counts.groupBy("leaf", "place", "token").agg(F.sum("n_alone").alias("_n")).where((F.col("_n") >= min_docs) & (F.col("token") != WILD)).select("leaf", "place", "token")
    stays = spread.join(common, ["leaf", "place", "token"], "left_semi")
    kept = stays.groupBy("leaf", "tokens_hash", "n_alone").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("template"))
    sizes = distinct.select("leaf", "tokens_hash", F.size("tokens").alias("n_tokens"))
    kept = kept.join(sizes, ["leaf", "tokens_hash"]).where(F.size("template") >= F.col("n_tokens") * solid)
    kept = materialize(kept.select("leaf", "tokens_hash", "n_alone", F.xxhash64("leaf", "template").alias("template")), "kept")
    more = several.select("doc", "tag", "leaf", "tokens_hash").join(kept, ["leaf", "tokens_hash"]).select("template", "doc", "tag").distinct()
    docs = kept.select("template", F.col("n_alone").alias("_n")).unionByName(more.groupBy("template").agg(F.count("*").alias("_n")))
    often = docs.groupBy("template").agg(F.sum("_n").alias("_docs")).where(F.col("_docs") >= min_docs).select("template")
    return kept.join(materialize(often, "often"), "template").select("leaf", "tokens_hash", "template")


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS, solid: float = SOLID) -> DataFrame:
    """The rows of `docs` as `row`, with `kept` (the text without its dropped lines), n_lines
    (lines with a word) and n_dropped.

    A null text stays null, an empty one empty; lines without a word always stay.  Rows of
    equal key and text are one document, told and cut alike, however many.  A null key counts as the largest; keys of another type
    than whole numbers are a TypeError.
    """
    texts = once(_texts(whole_ids(docs, key), key, text).select("doc", "tag", "text"), "doc", ["tag"])
    filed = materialize(leaves(texts, depth), "leaves")
    met = materialize(filed.groupBy("leaf").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_docs).select("leaf"), "leaves")  # so that a hot leaf's rows are split
    wanted = filed.join(met, "leaf").groupBy("doc", "tag").agg(F.collect_list(F.struct("leaf", "lines")).alias("at"))
    found = _candidates(texts, wanted).withColumn("tokens_hash", F.xxhash64("tokens"))
    dropped = templates(found.drop("tokens_hash"), min_docs, solid)
    hits = materialize(found.select("doc", "tag", "line", "leaf", "tokens_hash").join(dropped, ["leaf", "tokens_hash"]).select("doc", "tag", "line", "template"), "dropped")
    first = materialize(hits.groupBy("template").agg(F.min(F.struct("doc", "tag", "line")).alias("_first")), "first")
    gone = hits.join(first, "template").where(F.struct("doc", "tag", "line") != F.col("_first"))
    gone = gone.groupBy("doc", "tag").agg(F.collect_set("line").alias("_gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("tag"))
    rows = rows.join(gone, ["doc", "tag"], "left")
    whole = F.col("row").getField(text).cast("string")
    lines = F.split(whole, "\n")
    left = F.filter(lines, lambda x, i: ~F.array_contains(F.col("_gone"), i))
    has_word = F.lit(r"[^\x20\x09-\x0D]")
    return rows.select(
        "row",
        F.when(F.col("_gone").isNull(), whole).otherwise(F.array_join(left, "\n")).alias("kept"),
        F.coalesce(F.size(F.filter(lines, lambda x: F.regexp_like(x, has_word))).cast("long"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
