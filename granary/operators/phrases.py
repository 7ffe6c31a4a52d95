"""Many patterns at once: rule lists that rows meet within the row, without a join.

Phrases go into one automaton, which reads a text once however many phrases there are.  Regular
expressions, and tests of several columns, are a constant array that each row filters.  Neither
shuffles rows, forms a product, or depends on a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of phrases that one automaton holds; longer lists go by several, one after the other.
BLOCK_BYTES = 16 << 20


def rule_array(rules: DataFrame, limit: int, most_bytes: int) -> Column:
    """The rules as a constant array of structs.  Rows and bytes are counted on the executors; a
    longer list is an error, as every row tests every rule."""
    cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rules.columns]), {"ignoreNullFields": "false"})
    n, size = rules.limit(limit + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length(cells).cast("long")), F.lit(0))).first()
    if n > limit or size > most_bytes:
        raise ValueError(f"over {limit} rules or {most_bytes} bytes: name a literal that they contain, or match them by an equality")
    rows = sorted(r[0] for r in rules.select(cells).collect())
    schema = f"array<{rules.schema.simpleString()}>"
    return F.from_json(F.lit("[" + ",".join(rows) + "]"), schema)


def _numbers(phrases: Broadcast, first: bool):
    @F.pandas_udf("int" if first else "array<int>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton, always = ahocorasick.Automaton(), []
        for no, phrase in phrases.value:
            if phrase:
                automaton.add_word(phrase, (*automaton.get(phrase, ()), no))
            else:
                always.append(no)
        if len(automaton):
            automaton.make_automaton()

        def of(text: str | None) -> set[int] | None:
            if text is None:
                return set()
            found = set(always)
            if len(automaton):
                for _, numbers in automaton.iter(text):
                    found.update(numbers)
            return found

        for texts in batches:
            hits = [of(t) for t in texts]
            yield pd.Series([min(h, default=None) for h in hits], dtype="Int32") if first else pd.Series([sorted(h) for h in hits])

    return find


def _blocks(rules: DataFrame, phrase: str, no: str) -> list[Broadcast]:
    """The phrases in broadcasts of BLOCK_BYTES at most, cut by number."""
    sized = rules.where(F.col(phrase).isNotNull()).select(F.col(no).cast("int").alias("no"), F.col(phrase).alias("phrase"), F.octet_length(phrase).cast("long").alias("n"))
    total = sized.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = 1 + total * 2 // BLOCK_BYTES
    context = rules.sparkSession.sparkContext
    parts = [sized.where(F.pmod(F.xxhash64("phrase"), F.lit(n)) == i) if n > 1 else sized for i in range(n)]
    return [context.broadcast([(r["no"], r["phrase"]) for r in p.select("no", "phrase").collect()]) for p in parts]


def phrase_hits(text: Column, rules: DataFrame, phrase: str, no: str) -> Column:
    """The sorted numbers of the rules whose phrase the text contains; none for a null text."""
    each = [_numbers(b, False)(text) for b in _blocks(rules, phrase, no)]
    return each[0] if len(each) == 1 else F.array_sort(F.concat(*each))


def first_phrase(text: Column, rules: DataFrame, phrase: str, no: str) -> Column:
    """The smallest number of a rule whose phrase the text contains, or null."""
    each = [_numbers(b, True)(text) for b in _blocks(rules, phrase, no)]
    return each[0] if len(each) == 1 else F.least(*each)
