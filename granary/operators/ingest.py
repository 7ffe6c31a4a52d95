"""Ingest: change detection, staged merge, upsert, and page extraction."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.parse import number, parse_energy, parse_percent
from granary.functions.text import quote

from .relational import best_per


def detect_changes(current: DataFrame, new: DataFrame, key: str, tracked: Sequence[str] = ()) -> DataFrame:
    """Merged snapshot table with `action`.

    Both sides have key, fingerprint, seen and the tracked columns, and a key once.  new: not
    stored yet; updated: another fingerprint, or a tracked value where the stored one is null;
    skipped: the same, and the row stays as it was, last_seen included; kept: not in the batch.
    A batch row no newer than the stored last_seen is skipped.
    """
    cols = ["fingerprint", *tracked]
    old = current.select(key, F.col("first_seen").alias("_first"), F.col("last_seen").alias("_last"), *[F.col(c).alias(f"_o_{c}") for c in cols])
    got = new.select(key, F.col("seen").alias("_seen"), *[F.col(c).alias(f"_n_{c}") for c in cols])
    both = old.join(got, key, "full_outer")
    gained = F.lit(False)
    for c in tracked:
        gained = gained | (F.col(f"_o_{c}").isNull() & F.col(f"_n_{c}").isNotNull())
    late = F.col("_seen") <= F.col("_last")
    action = (
        F.when(F.col("_last").isNull(), "new")
        .when(F.col("_seen").isNull(), "kept")
        .when(late, "skipped")
        .when(~F.col("_o_fingerprint").eqNullSafe(F.col("_n_fingerprint")) | gained, "updated")
        .otherwise("skipped")
    )
    both = both.withColumn("action", action)
    take = F.col("action").isin("new", "updated")
    merged = [F.when(take, F.coalesce(F.col(f"_n_{c}"), F.col(f"_o_{c}"))).otherwise(F.col(f"_o_{c}")).alias(c) for c in cols]
    return both.select(key, *merged, F.coalesce("_first", "_seen").alias("first_seen"), F.when(take, F.col("_seen")).otherwise(F.col("_last")).alias("last_seen"), "action")


def collapse_staged(staged: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per staged key: first non-null of each field in `order`; rows counts what merged.
    This is what a row-by-row merge ends with when later rows only fill nulls."""
    lead = F.struct(*order)
    cells = [F.min(F.when(F.col(c).isNotNull(), F.struct(lead.alias("o"), F.col(c).alias("v"))))["v"].alias(c) for c in [*fields, *carry]]
    return staged.groupBy(key).agg(F.count("*").alias("staged_rows"), *cells)


def merge_staged(canon: DataFrame, staged: DataFrame, allow: DataFrame, key: str, pair: Sequence[str], fields: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(canon, summary) after a run: staged keys that exist fill nulls; others that match one
    row by `pair` fill it (the smallest key of several) and give it their key; the rest are
    inserted if `pair`'s first column is allowlisted ACTIVE or PENDING, else skipped.

    Counts are of staged keys.  Running the same stage again changes nothing: a pair that a staged
    key already has in the table is that key's, and no other staged key takes a further row of it.
    Of several staged keys that match one row by `pair`, the smallest takes it; the others are
    inserted or skipped.
    """
    one = collapse_staged(staged, key, order, fields, pair)
    known = one.join(canon.select(key), key, "left_semi").withColumn("how", F.lit("updated"))
    rest = one.join(canon.select(key), key, "left_anti")
    held = canon.join(known.select(key, F.lit(True).alias("_held")), key, "left").groupBy(*pair).agg(F.min(key).alias("_target"), F.count("_held").alias("_held"))
    paired = rest.join(held.where(F.col("_held") == 0).drop("_held"), list(pair))
    taken = paired.groupBy("_target").agg(F.min(key).alias(key))
    rekey = paired.join(taken, ["_target", key])
    left = rest.join(rekey.select(key), key, "left_anti")
    ok = allow.where(F.col("status").isin("ACTIVE", "PENDING")).select(pair[0])
    insert = left.join(ok, pair[0], "left_semi")
    skip = left.join(ok, pair[0], "left_anti")
    updates = known.select(F.col(key).alias("_old"), F.col(key).alias("_new"), *[F.col(f).alias(f"_s_{f}") for f in fields]).unionByName(rekey.select(F.col("_target").alias("_old"), F.col(key).alias("_new"), *[F.col(f).alias(f"_s_{f}") for f in fields]))
    merged = canon.join(updates, F.col(key) == F.col("_old"), "left")
    merged = merged.withColumns({key: F.coalesce("_new", key), **{f: F.coalesce(F.col(f), F.col(f"_s_{f}")) for f in fields}}).select(*canon.columns)
    added = insert.select(*[F.col(c) if c in (key, *pair, *fields) else F.lit(None).cast(canon.schema[c].dataType).alias(c) for c in canon.columns])
    parts = [known.select(F.lit("updated").alias("how")), rekey.select(F.lit("rekeyed").alias("how")), insert.select(F.lit("inserted").alias("how")), skip.select(F.lit("skipped").alias("how"))]
    how = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    counts = how.agg(*[F.count_if(F.col("how") == h).alias(h) for h in ("updated", "rekeyed", "inserted", "skipped")])
    total = F.col("updated") + F.col("rekeyed") + F.col("inserted") + F.col("skipped")
    health = F.when((total >= 50) & (F.col("updated") + F.col("rekeyed") + F.col("inserted") == 0), "FAIL").otherwise("OK")
    return merged.unionByName(added), counts.withColumn("health", health)


def residuals(canon: DataFrame, staged: DataFrame, allow: DataFrame, key: str, pair: Sequence[str]) -> DataFrame:
    """Staged keys that the canonical table hasn't, with the reason."""
    lacking = staged.groupBy(key).agg(F.min(pair[0]).alias(pair[0])).join(canon.select(key), key, "left_anti")
    joined = lacking.join(allow.select(pair[0], "status"), pair[0], "left")
    reason = F.when(F.col("status").isNull(), "not on the list").when(F.col("status").isin("ACTIVE", "PENDING"), "not merged").otherwise(F.concat(F.lit("status "), F.col("status")))
    return joined.select(key, pair[0], reason.alias("reason"))


def allow_status(allow: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return ids.join(allow.select(key, "status"), key, "left").select(key, F.coalesce("status", F.lit("NOT_FOUND")).alias("status"))


def smart_import(canon: DataFrame, new: DataFrame, id_col: str, url: str, base: str) -> DataFrame:
    """What becomes of each new row: update (same URL), variant (same base name; the parent is
    the smallest id), or insert."""
    by_url = canon.groupBy(url).agg(F.min(id_col).alias("_u"))
    by_name = canon.groupBy(base).agg(F.min(id_col).alias("_b"))
    out = new.join(by_url, url, "left").join(by_name, base, "left")
    how = F.when(F.col("_u").isNotNull(), "update").when(F.col("_b").isNotNull(), "variant").otherwise("insert")
    return out.select(F.col(id_col).alias("id"), how.alias("how"), F.coalesce("_u", "_b").alias("target"))


def import_products(canon: DataFrame, new: DataFrame, id_col: str, name: str, url: str, base: str, consolidates: Column, groups: Sequence[Sequence[str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(catalogue, variants, outcomes) after an import of `new` (the columns of `canon`).

    A row's parent is the stored row of its URL, else of its base name (smallest id).  `consolidates`
    (over new rows: a size or a pack, not a stage) makes it a variant: it fills the parent's
    empty `groups` and is kept under it.  A group of fields is filled together, where its first
    field is empty, from the variant of smallest id that has that field; a null in it stays.
    A row with a parent of the same name is a duplicate and changes nothing, one without a name is
    an error, all others are imported.  Rows meet the stored catalogue only, not each other.
    """
    fields = [f for g in groups for f in g]
    kept = canon.select(F.col(id_col).alias("_id"), F.lower(name).alias("_name"), F.col(url).alias("_url"), F.col(base).alias("_base"))
    by_url = kept.where(F.col("_url").isNotNull()).groupBy("_url").agg(F.min(F.struct("_id", "_name")).alias("_u"))
    by_base = kept.where(F.col("_base").isNotNull()).groupBy("_base").agg(F.min(F.struct("_id", "_name")).alias("_b"))
    met = new.withColumn("_consolidates", consolidates).join(by_url, F.col(url) == F.col("_url"), "left").join(by_base, F.col(base) == F.col("_base"), "left").withColumn("_parent", F.coalesce("_u", "_b"))
    parent = F.col("_parent._id")
    status = F.when(F.coalesce(F.trim(name), F.lit("")) == "", "error").when(parent.isNotNull() & F.coalesce("_consolidates", F.lit(False)), "variant").when(F.lower(name) == F.col("_parent._name"), "duplicate").otherwise("imported")
    met = met.withColumn("status", status).withColumn("parent_id", F.when(F.col("status").isin("variant", "duplicate"), parent))
    variants = met.where("status = 'variant'").select("parent_id", *new.columns)
    first = lambda g: F.min(F.when(F.col(g[0]).isNotNull(), F.struct(F.col(id_col).alias("o"), *[F.col(f).alias(f) for f in g]))).alias(f"_g_{g[0]}")
    fills = variants.groupBy(F.col("parent_id").alias("_parent_id")).agg(*[first(g) for g in groups])
    filled = canon.join(fills, F.col(id_col) == F.col("_parent_id"), "left")
    cells = {f: F.when(F.col(g[0]).isNull(), F.coalesce(F.col(f"_g_{g[0]}.{f}"), F.col(f))).otherwise(F.col(f)) for g in groups for f in g}
    filled = filled.select(*[cells[c].alias(c) if c in fields else F.col(c) for c in canon.columns])
    return filled.unionByName(met.where("status = 'imported'").select(*canon.columns)), variants, met.select(F.col(id_col).alias("id"), "status", "parent_id")


def upsert(base: DataFrame, new: DataFrame, key: str, mode: str = "update") -> DataFrame:
    """base with new rows; of a known key the new row's values win (update; nulls don't) or the
    old row stays (nothing).  Of several new rows of a key the smallest counts."""
    rest = [c for c in base.columns if c != key]
    one = best_per(new.select(*base.columns), [key], [F.lit(0)])
    if mode == "nothing":
        return base.unionByName(one.join(base.select(key), key, "left_anti").select(*base.columns))
    both = base.select(key, *[F.col(c).alias(f"_o_{c}") for c in rest]).join(one, key, "full_outer")
    return both.select(key, *[F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c) for c in rest])


# Pages


class _Walker(HTMLParser):
    """(kind, label, value) triples in page order: th/td and dt/dd pairs, headings with their
    paragraphs, list items, JSON-LD blocks."""

    SKIP, HEADS, TEXT = {"style", "nav", "noscript"}, {"h1", "h2", "h3", "h4"}, {"p", "li", "td", "th", "dt", "dd", "title"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, str]] = []
        self.skip, self.tag, self.buffer, self.head, self.label = 0, "", [], "", None
        self.ld = False

    def _close(self) -> None:
        text = " ".join("".join(self.buffer).split())
        tag, self.buffer = self.tag, []
        self.tag = ""
        if not tag or not text and tag not in self.HEADS:
            return
        if tag in self.HEADS:
            self.head = text
            self.out.append(("heading", tag, text))
        elif tag in ("th", "dt"):
            self.label = text
        elif tag in ("td", "dd"):
            if self.label is None and tag == "td":
                self.label = text
            else:
                self.out.append(("row" if tag == "td" else "definition", self.label or "", text))
                self.label = None
        else:
            self.out.append(({"p": "paragraph", "li": "item", "title": "title"}[tag], self.head, text))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "script":
            self.ld = dict(attrs).get("type") == "application/ld+json"
            self._close()
            self.tag, self.skip = "script", self.skip + 1
        elif tag in self.SKIP:
            self._close()
            self.skip += 1
        elif tag in self.HEADS or tag in self.TEXT:
            self._close()
            self.tag = tag
        elif tag == "tr":
            self._close()
            self.label = None
        elif tag == "br":
            self.buffer.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag == "script":
            if self.ld and self.buffer:
                self.out.append(("json_ld", "", "".join(self.buffer).strip()))
            self.buffer, self.tag, self.ld, self.skip = [], "", False, max(0, self.skip - 1)
        elif tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag == self.tag or tag in ("tr", "ul", "ol", "div", "article"):
            self._close()

    def handle_data(self, data: str) -> None:
        if self.tag and (not self.skip or self.ld):
            self.buffer.append(data)


def extract_pairs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, seq, kind, label, value: what a page says, in its order.  A small tokenizer runs in
    Arrow batches; the rest is SQL over its rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, text in zip(f[key], f[html], strict=True):
                walker = _Walker()
                walker.feed(text or "")
                walker.close()
                walker._close()
                rows += [(k, i, *t) for i, t in enumerate(walker.out)]
            yield pd.DataFrame(rows, columns=[key, "seq", "kind", "label", "value"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, seq int, kind string, label string, value string")


#: Patterns of words by which labels name nutrients, English and Spanish.
NUTRIENTS = {"protein_percent": ("protein", "proteínas?"), "fat_percent": ("fat", "oils?", "lipids?", "grasas?"), "fiber_percent": ("fibre", "fiber", "fibra"), "ash_percent": ("ash", "inorganic matter", "cenizas?"), "moisture_percent": ("moisture", "water", "humidity", "humedad")}
#: What labels call energy.
ENERGY = ("energy", "kcal", "calor", "kj", "energía")
#: Kcal in a gram of protein, fat and carbohydrate, by which energy is estimated.
KCAL = (3.5, 8.5, 3.5)


def nutrition(pairs: DataFrame, key: str = "page_id", labels: Mapping[str, Sequence[str]] = NUTRIENTS, energy: Sequence[str] = ENERGY) -> DataFrame:
    """Nutrients of a page: from table rows, else definitions, else text, the first in order;
    kcal_per_100g as stated, else by difference from protein and fat, and kcal_basis (`stated`,
    `estimated`, or null).  `labels` and `energy` are patterns of words."""
    low = F.lower("label")
    cells = {}
    rank = F.struct(F.when(F.col("kind") == "row", 0).when(F.col("kind") == "definition", 1).otherwise(2).alias("k"), "seq")
    for name, words in labels.items():
        labelled = F.when(F.regexp_like(low, F.lit(f"\\b({'|'.join(words)})\\b")), parse_percent(F.col("value")))
        free = number(F.regexp_extract(F.lower("value"), rf"\b(?:{'|'.join(words)})\b[^0-9%]{{0,20}}([0-9]+(?:[.,][0-9]+)?) *%", 1))
        value = F.when(F.col("kind").isin("row", "definition"), labelled).otherwise(F.when(free.between(0, 100), free))
        cells[name] = F.min(F.when(value.isNotNull(), F.struct(rank.alias("o"), value.alias("v"))))["v"].alias(name)
    text = F.when(F.col("kind").isin("row", "definition"), F.when(F.regexp_like(low, F.lit("|".join(energy))), F.col("value"))).otherwise(F.nullif(F.regexp_extract(F.lower("value"), r"((?:[0-9]+(?:[.,][0-9]+)?) *(?:kcal|kj)[^;,]*)", 1), F.lit("")))
    stated = F.min(F.when(text.isNotNull(), F.struct(rank.alias("o"), parse_energy(text).alias("v"))))["v"].alias("_stated")
    got = pairs.groupBy(key).agg(*cells.values(), stated)
    protein, fat = (F.col(c) if c in labels else F.lit(None).cast("double") for c in ("protein_percent", "fat_percent"))
    others = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in labels), F.lit(0.0))
    guess = protein * KCAL[0] + fat * KCAL[1] + F.greatest(F.lit(100.0) - others, F.lit(0.0)) * KCAL[2]
    basis = F.when(F.col("_stated").isNotNull(), "stated").when(guess.isNotNull(), "estimated")
    return got.select(key, *labels, F.coalesce("_stated", guess).alias("kcal_per_100g"), basis.alias("kcal_basis"))


def infobox(pairs: DataFrame, spec: Mapping[str, tuple[str, Column]], key: str = "page_id") -> DataFrame:
    """Typed columns from label and value rows: spec gives a label pattern and the value's parser."""
    rows = pairs.where(F.col("kind").isin("row", "definition"))
    cells = [F.min(F.when(F.regexp_like(F.lower("label"), F.lit(p)) & v.isNotNull(), F.struct("seq", v.alias("v"))))["v"].alias(n) for n, (p, v) in spec.items()]
    return rows.groupBy(key).agg(*cells)


def sections(pairs: DataFrame, headings: Mapping[str, str], n: int, key: str = "page_id") -> DataFrame:
    """First n paragraphs under a heading that matches each pattern, joined in page order."""
    rows = pairs.where(F.col("kind") == "paragraph")
    cells = []
    for name, pattern in headings.items():
        found = F.sort_array(F.collect_list(F.when(F.regexp_like(F.lower("label"), F.lit(pattern)), F.struct("seq", "value"))))
        cells.append(F.array_join(F.transform(F.slice(found, 1, n), lambda x: x["value"]), " ").alias(name))
    return rows.groupBy(key).agg(*cells)


def json_ld(pages: DataFrame, schema: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """A row for each JSON-LD block of a page, parsed; blocks that can't be read are dropped."""
    blocks = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    rows = pages.select(key, F.posexplode(blocks).alias("n", "_text"))
    return rows.select(key, "n", F.from_json("_text", schema).alias("ld")).where(F.col("ld").isNotNull())


def extract_values(col: Column, patterns: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """First figure of each name by its patterns (group 1), in their order."""
    return {n: F.coalesce(*[number(F.regexp_extract(col, p, 1)) for p in ps]) for n, ps in patterns.items()}


def text_flags(col: Column, evidence: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> dict[str, Column]:
    """True, false or null by words for, words against, or neither (against counts more)."""
    any_of = lambda ws: F.regexp_like(F.lower(col), F.lit("|".join(quote(w) for w in ws)))
    return {n: F.when(any_of(against), F.lit(False)).when(any_of(for_), F.lit(True)) for n, (for_, against) in evidence.items()}
