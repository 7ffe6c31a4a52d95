"""Multilingual mixture inference by expectation-maximisation over n-gram likelihoods.

Training counts character trigrams (hashed to a fixed number of buckets, centred on a letter)
per language over all learning documents.  A document is a bag of words, each word drawn from
one language with the product of its trigram probabilities; EM estimates the document's
language proportions.  The language set is the one of highest penalised likelihood among
the nested sets of the largest proportions: each language beyond the first costs
`penalty * log(words)`.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trigram buckets; the model has so many numbers for each language.
BUCKETS = 1 << 16
#: EM steps over all languages, and over each smaller set.
STEPS, STEPS_SET = 12, 6
#: Price of a language in units of log(words).
PENALTY = 1.0
#: Largest language set that is tried.
SET_MOST = 4
#: Characters that are worked on at once.
CHUNK = 1 << 20
SMOOTHING = 0.5
#: Languages that a model may have: it reaches the driver and every worker.
LANGS_MOST = 128

_LETTERS: list[np.ndarray] = []
_SPACE = re.compile(r"\s")


def letters() -> np.ndarray:
    """Whether each code point is a letter; built once per worker from the Unicode tables."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter, whether the letter starts a word, its text."""
    lowered = [t.lower() for t in texts]
    code = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[code]
    seen = np.where(is_letter, code, 0).astype(np.uint32)
    at = np.flatnonzero(is_letter)
    mixed = seen[at - 1] * np.uint32(0x9E3779B1) + seen[at] * np.uint32(0x85EBCA77) + seen[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return (mixed >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1), ~is_letter[at - 1], np.searchsorted(ends, at, "right")


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """(first index, run of texts of about `limit` characters)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def count_trigrams(rows: DataFrame) -> DataFrame:
    """lang, bucket, n from rows (lang, text): counted per task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, run in chunks(texts):
                found, _, doc = trigrams(run)
                names = langs[first : first + len(run)]
                for lang in set(names):
                    mine = np.fromiter((x == lang for x in names), dtype=bool, count=len(names))
                    total.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    total[lang] += np.bincount(found[mine[doc]], minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at])], names=["lang", "bucket", "n"])

    parts = rows.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and log P(trigram | language), buckets x languages.

    At most BUCKETS numbers for each language reach the driver, whatever the input; over
    LANGS_MOST languages are a ValueError.
    """
    n = rows.select("lang").distinct().limit(LANGS_MOST + 1).count()
    if n > LANGS_MOST:
        raise ValueError(f"over {LANGS_MOST} different languages: clean the labels first")
    per = count_trigrams(rows).groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    found = sorted(per.toArrow().to_pylist(), key=lambda r: r["lang"])
    langs, table = [r["lang"] for r in found], np.full((BUCKETS, len(found)), SMOOTHING)
    for i, r in enumerate(found):
        table[r["at"], i] += r["n"]
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32) if langs else table.astype(np.float32)


def _normal(p: np.ndarray) -> np.ndarray:
    return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300)


def _em(p: np.ndarray, doc: np.ndarray, starts: np.ndarray, theta: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after `steps` and the likelihood (log, relative) of each document."""
    n = np.diff(np.append(starts, len(doc)))[:, None]
    for _ in range(steps):
        share = _normal(theta[doc] * p)
        theta = np.add.reduceat(share, starts, axis=0) / n
    return theta, np.add.reduceat(np.log(np.maximum((theta[doc] * p).sum(axis=1), 1e-300)), starts)


def parts_of(text: str, limit: int = CHUNK) -> Iterator[str]:
    """`text` cut at white space from `limit` characters on: no word spans two parts."""
    at = 0
    while len(text) - at > limit and (m := _SPACE.search(text, at + limit)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def word_likelihoods(texts: list[str], logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods of each word in each language, and the text it is in.  Texts are worked
    on in parts of CHUNK characters; what is kept is a row of numbers for each word."""
    parts = [(i, p) for i, t in enumerate(texts) for p in parts_of(t)]
    words, of = [np.zeros((0, logp.shape[1]), dtype=logp.dtype)], [np.zeros(0, dtype=np.int64)]
    for first, run in chunks([p for _, p in parts]):
        found, start, doc = trigrams(run)
        if len(found):
            at = np.flatnonzero(start)
            words.append(np.add.reduceat(logp[found], at, axis=0))
            of.append(np.array([i for i, _ in parts[first : first + len(run)]])[doc[at]])
    return np.concatenate(words), np.concatenate(of)


def mixtures(texts: list[str], logp: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Proportion of each language in each text (rows of zeros: no letter)."""
    out = np.zeros((len(texts), logp.shape[1]))
    words, doc_word = word_likelihoods(texts, logp)
    if not len(words):
        return out
    docs, starts = np.unique(doc_word, return_index=True)
    doc = np.repeat(np.arange(len(docs)), np.diff(np.append(starts, len(doc_word))))
    alone = np.add.reduceat(words, starts, axis=0, dtype=np.float64)
    top = words.max(axis=1, keepdims=True)
    base = np.add.reduceat(top[:, 0], starts, dtype=np.float64)
    p = np.exp((words - top).astype(np.float64))
    k = logp.shape[1]
    best = np.zeros((len(docs), k))
    best[np.arange(len(docs)), alone.argmax(axis=1)] = 1
    value = alone.max(axis=1) - base
    if k > 1:
        n = np.diff(np.append(starts, len(doc)))
        price = penalty * np.log(np.maximum(n, 2))
        theta, full = _em(p, doc, starts, np.full((len(docs), k), 1 / k), STEPS)
        more = np.flatnonzero(full - value > price)  # no set can gain more than all languages do
        if len(more):
            keep = np.isin(doc, more)
            new_doc = np.searchsorted(more, doc[keep])
            new_starts = np.searchsorted(new_doc, np.arange(len(more)))
            rank = np.argsort(np.argsort(-theta[more], axis=1, kind="stable"), axis=1)
            for size in range(2, min(k, SET_MOST) + 1):
                part = _normal(np.where(rank < size, theta[more] + 1e-6, 0))
                fit, got = _em(p[keep], new_doc, new_starts, part, STEPS_SET)
                got = got - price[more] * (size - 1)
                win = got > value[more]
                best[more[win]] = fit[win]
                value[more[win]] = got[win]
    out[docs] = best
    return out


def is_held_out(key: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == 0


def identify(docs: DataFrame, langs: list[str], logp: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, held_out, lang_pred, score, langs, shares; a row per input row.

    lang_pred is the language of the largest share in the chosen set (ties: the first by
    name), score that share.  A null text, one without a letter, or a model without languages
    gives `und`, score 0 and no languages.  Other columns are not carried.
    """
    model = docs.sparkSession.sparkContext.broadcast(logp)  # BUCKETS numbers per language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            share = np.zeros((len(texts), len(langs)))
            for first, run in chunks(texts) if langs else ():
                share[first : first + len(run)] = mixtures(run, table)
            top = share.argmax(axis=1) if langs else np.zeros(len(texts), dtype=int)
            score = share.max(axis=1) if langs else np.zeros(len(texts))
            names = [langs[i] if s > 0 else "und" for i, s in zip(top, score, strict=True)]
            sets = [np.flatnonzero(s >= 0.005)[np.argsort(-s[s >= 0.005], kind="stable")] for s in share]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0)), pa.array([[langs[i] for i in s] for s in sets], pa.list_(pa.string())), pa.array([[float(v[i]) for i in s] for s, v in zip(sets, share, strict=True)], pa.list_(pa.float64()))],
                names=[key, "held_out", "lang_pred", "score", "langs", "shares"],
            )

    rows = docs.select(F.col(key), is_held_out(key).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(predict, f"`{key}` {kind}, held_out boolean, lang_pred string, score double, langs array<string>, shares array<double>")


def language_mixtures(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out and have text and language; predict all."""
    rows = docs.where(~is_held_out(key)).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return identify(docs, *learn(rows), key=key, text=text)
