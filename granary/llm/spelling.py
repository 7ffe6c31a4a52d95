"""Spelling variants: words one edit apart, by FM-index search schemes over both directions.

If one edit parts two words, either half of the one is found unchanged at its end of the other.
So a word is searched twice: its first half exactly and on to the right with one error, and its
second half exactly and on to the left with one error.  Both are backward searches, in an index
of the reversed and of the plain words, delimited: a state is an interval of suffix ranks, and a
symbol narrows it by two counts in the Burrows-Wheeler transform.  Each of the two searches goes
one way only, so the intervals of the two directions need no synchronising.  A pair whose first
halves agree is left to the first search.

The vocabulary is dealt by the exact half: a word is held for each half that a word one edit away
could ask for (two lengths in either direction) and asks for its own.  Words of many halves share
an index of about CHARS symbols.  Words of a half with more than CELL are cut into parts, and
each part that asks meets each part that is held, so no task depends on the size of a half.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .ranked import LOWER

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_CHARS, MIN_TIMES, LOSES = 5, 3, 97
#: Symbols of one index on average; words of one half in one index at most; words searched at once.
CHARS, CELL, SEARCHED = 1 << 17, 50_000, 8_192
END, DELIMITER, FIRST_LETTER = 0, 1, 2


def misspelt(doc_id: str, run: str) -> str:
    """The lower-cased run, without one code point where its checksum says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % LOSES:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_times: int = MIN_TIMES) -> DataFrame:
    """word, n: the words of all texts; counted within a batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for low, times in Counter(RUN.findall((text.as_py() or "").translate(LOWER))).items():
                    if len(low) >= min_chars and len(word := misspelt(doc_id, low)) >= min_chars:
                        found[word] += times
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_times)


def dealt(words: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, forwards, word, n, holds, asks: where the halves of each word are held and asked for."""
    size = F.length("word")
    half = lambda forwards, at: F.struct(F.lit(forwards).alias("forwards"), (F.substring("word", F.lit(1), at) if forwards else F.right("word", at)).alias("half"), (at == (F.floor(size / 2) if forwards else F.ceil(size / 2))).alias("asks"))
    lengths = {True: [F.floor((size - 1) / 2), F.floor((size + 1) / 2)], False: [F.floor(size / 2), F.floor((size + 2) / 2)]}
    lengths[True].append(F.floor(size / 2))
    lengths[False].append(F.floor((size + 1) / 2))
    each = F.array_distinct(F.array(*[half(w, at.cast("int")) for w in (True, False) for at in lengths[w]]))
    rows = words.select("word", "n", F.explode(each).alias("x")).select("word", "n", "x.*")
    crowded = rows.groupBy("forwards", "half").agg(F.count("*").alias("_n")).where(F.col("_n") > CELL).select("forwards", "half", F.ceil(F.col("_n") / CELL).cast("int").alias("parts"))
    rows = rows.join(materialize(crowded, "crowded"), ["forwards", "half"], "left")
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    cell = lambda held, asked, holds, asks: F.struct((F.lit(-1) - F.abs(F.xxhash64("forwards", "half", held, asked) / 2).cast("long")).alias("bucket"), F.lit(holds).alias("holds"), (F.lit(asks) & F.col("asks")).alias("asks"))
    cells = F.concat(F.transform(others, lambda j: cell(mine, j, True, False)), F.transform(others, lambda i: cell(i, mine, False, True)))
    alone = F.array(F.struct(F.pmod(F.xxhash64("forwards", "half"), F.lit(n_buckets)).cast("long").alias("bucket"), F.lit(True).alias("holds"), F.col("asks").alias("asks")))
    return rows.select("forwards", "word", "n", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(cells)).alias("x")).select("x.bucket", "forwards", "word", "n", "x.holds", "x.asks")


class Index:
    """FM-index of delimited words that are read from their ends: suffix ranks and the transform."""

    def __init__(self, words: list[str]) -> None:
        self.letters = sorted(set("".join(words)))
        code = {c: i + FIRST_LETTER for i, c in enumerate(self.letters)}
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        letters = np.array([code[c] for w in words for c in w], dtype=np.int64)
        self.code, self.size = code, int(sizes.sum()) + len(words) + 2
        text = np.full(self.size, DELIMITER, dtype=np.int64)
        text[-1] = END
        self.first = np.cumsum(sizes + 1) - sizes  # where each word begins, after its delimiter
        text[np.repeat(self.first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(letters))] = letters
        self.order = _suffixes(text)
        # A symbol's ranks in the transform, as one sorted list of symbol and rank: the place where
        # (c, i) would go is the number of smaller symbols and of c's before rank i.
        self.places = np.sort(text[self.order - 1] * self.size + np.arange(self.size))

    def narrow(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes that begin with a symbol and then with what they began with."""
        return np.searchsorted(self.places, symbol * self.size + low), np.searchsorted(self.places, symbol * self.size + high)

    def words_at(self, rank: np.ndarray) -> np.ndarray:
        """Which word follows the delimiter that the suffix of each rank begins with."""
        return np.searchsorted(self.first, self.order[rank] + 1)


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling."""
    rank, size = text, 1
    while True:
        after = np.zeros(len(text), dtype=np.int64)
        after[:-size] = rank[size:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.ones(len(text), dtype=np.int64)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(len(text), dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        size *= 2
        if rank[order[-1]] == len(text) - 1:
            return order


def one_error(index: Index, asked: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(number in `asked`, number of the indexed word): pairs one edit apart of which the last
    `exact` symbols of the asked word are the end of the other, each pair once."""
    unknown = FIRST_LETTER + len(index.letters)  # narrows every interval to none
    flat = np.array([index.code.get(c, unknown) for w in asked for c in reversed(w)] + [DELIMITER], dtype=np.int64)
    sizes = np.array([len(w) for w in asked], dtype=np.int64)
    start = np.cumsum(sizes) - sizes
    symbol = lambda q, at: np.where(at < sizes[q], flat[np.minimum(start[q] + at, len(flat) - 1)], DELIMITER)
    q = np.arange(len(asked))
    low, high = (np.full(len(q), x, dtype=np.int64) for x in index.narrow(np.array([DELIMITER]), np.array([0]), np.array([index.size])))
    exact = np.array(exact, dtype=np.int64)
    for at in range(int(exact.max(initial=0))):
        on = np.flatnonzero(at < exact[q])
        low[on], high[on] = index.narrow(symbol(q[on], np.full(len(on), at)), low[on], high[on])
        some = low < high
        q, low, high = q[some], low[some], high[some]
    letters = np.arange(FIRST_LETTER, unknown, dtype=np.int64)
    at = exact[q]
    none = np.zeros(0, dtype=np.int64)
    wrong, found = (none, none, none, none), []  # those after their error: word, interval, next symbol
    while len(q) or len(wrong[0]):
        eq, elow, ehigh, eat = wrong
        elow, ehigh = index.narrow(symbol(eq, eat), elow, ehigh)
        some = elow < ehigh
        over = eat == sizes[eq]
        found.append((eq[some & over], index.words_at(elow[some & over])))
        some &= ~over
        wrong = [(eq[some], elow[some], ehigh[some], eat[some] + 1)]
        # An error here: a symbol of the asked word is missing, another stands for it, or one is put in.
        inner = at < sizes[q]
        wrong.append((q[inner], low[inner], high[inner], at[inner] + 1))
        every = np.repeat(np.arange(len(q)), len(letters))
        each = np.tile(letters, len(q))
        mlow, mhigh = index.narrow(each, low[every], high[every])
        some = mlow < mhigh
        every, each, mlow, mhigh = every[some], each[some], mlow[some], mhigh[some]
        wrong.append((q[every], mlow, mhigh, at[every]))
        other = inner[every] & (each != symbol(q[every], at[every]))
        wrong.append((q[every][other], mlow[other], mhigh[other], at[every][other] + 1))
        wrong = tuple(np.concatenate(x) for x in zip(*wrong, strict=True))
        q, low, high, at = q[inner], low[inner], high[inner], at[inner]
        low, high = index.narrow(symbol(q, at), low, high)
        some = low < high
        q, low, high, at = q[some], low[some], high[some], at[some] + 1
    pairs = np.unique(np.concatenate([a * len(index.first) + b for a, b in found])) if found else none
    return pairs // len(index.first), pairs % len(index.first)


def near_words(rows: pa.Table) -> pa.Table:
    """word, n, n_near, best_n, best: of the words of a bucket that ask, one way after the other."""
    out: dict[str, list] = {"word": [], "n": [], "n_near": [], "best_n": [], "best": []}
    for forwards in (True, False):
        holds: dict[str, int] = {}
        asks: dict[str, int] = {}
        for way, word, n, held, asked in zip(*(rows.column(c).to_pylist() for c in ("forwards", "word", "n", "holds", "asks")), strict=True):
            if way == forwards:
                holds |= {word: n} if held else {}
                asks |= {word: n} if asked else {}
        if not holds or not asks:
            continue
        held, asked = sorted(holds), list(asks)
        times = np.array([holds[w] for w in held], dtype=np.int64)
        turn = (lambda w: w[::-1]) if forwards else (lambda w: w)
        index = Index([turn(w) for w in held])
        for first in range(0, len(asked), SEARCHED):
            part = asked[first : first + SEARCHED]
            q, t = one_error(index, [turn(w) for w in part], [len(w) // 2 if forwards else -(-len(w) // 2) for w in part])
            if not forwards:  # the other search has those whose first halves agree
                new = np.array([not held[b].startswith(part[a][: len(part[a]) // 2]) for a, b in zip(q.tolist(), t.tolist(), strict=True)], dtype=bool)
                q, t = q[new], t[new]
            n_near = np.bincount(q, minlength=len(part))
            order = np.lexsort((t, -times[t], q))
            leads, at = np.unique(q[order], return_index=True)
            best: list = [None] * len(part)
            best_n: list = [None] * len(part)
            for a, b in zip(leads.tolist(), t[order][at].tolist(), strict=True):
                best[a], best_n[a] = held[b], holds[held[b]]
            for c, x in (("word", part), ("n", [asks[w] for w in part]), ("n_near", n_near.tolist()), ("best_n", best_n), ("best", best)):
                out[c] += x
    return pa.table({"word": pa.array(out["word"], pa.string()), "n": pa.array(out["n"], pa.int64()), "n_near": pa.array(out["n_near"], pa.int64()), "best_n": pa.array(out["best_n"], pa.int64()), "best": pa.array(out["best"], pa.string())})


def forms(words: DataFrame) -> DataFrame:
    """word, form, n, n_near, form_n of a table of different words and their counts."""
    chars = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    rows = dealt(words, max(1, 4 * chars // CHARS))
    found = rows.groupBy("bucket").applyInArrow(near_words, "word string, n long, n_near long, best_n long, best string")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    per = found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    larger = -F.col("_best.n") >= 2 * F.col("n")
    return per.select("word", F.when(larger, F.col("_best.word")).alias("form"), "n", "n_near", F.when(larger, -F.col("_best.n")).alias("form_n"))


def roots(named: DataFrame) -> DataFrame:
    """`named` with `root`, the last of a word's forms.

    Counts double along forms, so the paths, halved each round, are over after the logarithm of
    the logarithm of the largest count.
    """
    most = named.agg(F.max("form_n")).first()[0] or 1
    links = named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log2(max(most, 2)) + 1))):
        links = materialize(links, "links")
        on = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        links = links.join(on, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"))
    links = links.select(F.col("word").alias("_word"), "root")
    return named.join(links, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_times: int = MIN_TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word of `min_chars` and `min_times` at least.

    A word's form is its near word of largest count (ties: the smallest), if that is twice its own;
    its root is the last of the forms that follow each other, itself without any.  A null text has
    no words; a null id is written as nothing.  Repeated rows count as often as they occur.  Other
    columns aren't read, so clashing names don't matter.
    """
    words = materialize(word_counts(docs, key, text, min_chars, min_times), "words")
    return roots(materialize(forms(words), "forms"))
