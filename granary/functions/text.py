"""Text columns: slugs, keys, cleaning, tokens, keyword ladders, URLs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def quote(word: str) -> str:
    """`word` as a pattern that matches just itself, in Java and RE2 alike."""
    return "".join(c if c.isalnum() or c in " _" else f"\\{c}" for c in word)


def slug_us(col: Column) -> Column:
    """Lower case, trimmed, spaces to underscores."""
    return F.regexp_replace(F.lower(F.trim(col)), " ", "_")


def slug_hy(col: Column) -> Column:
    """Lower case; each run of other characters than letters and digits becomes a hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(col)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def make_key(cols: Sequence[Column], fmt: str = "plain", default: str = "unknown", digits: int = 16, slug: str = "us") -> Column:
    """A composite key.  plain: slugs joined by `|`; hash: md5 of them cut to `digits`;
    prefixed: the first slug, `_`, and the cut md5 of all.  A null part is `default`."""
    make = slug_us if slug == "us" else slug_hy
    parts = [F.coalesce(make(c), F.lit(default)) for c in cols]
    plain = F.concat_ws("|", *parts)
    if fmt == "plain":
        return plain
    cut = F.substring(F.md5(plain), 1, digits)
    return cut if fmt == "hash" else F.concat_ws("_", parts[0], cut)


def fingerprint(cols: Sequence[Column]) -> Column:
    """md5 of lowered, trimmed parts joined by `|`; null parts are empty."""
    return F.md5(F.concat_ws("|", *[F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in cols]))


def clean_text(col: Column, keep: str = r"A-Za-z0-9 .,%&+-") -> Column:
    """Characters outside `keep` become spaces; runs of spaces become one; trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, f"[^{keep}]", " "), " +", " "))


#: Pack sizes such as 12 x 400g or 1.5 kg.
PACK = r"([0-9]+ *x *)?[0-9]+([.,][0-9]+)? *(kg|g|lb|oz|ml|l)\b"


def match_name(col: Column, brand: Column | None = None, stopwords: Sequence[str] = (), drop_packs: bool = True) -> Column:
    """A name for matching: lowered, without leading brand, pack sizes and stop words."""
    out = F.lower(F.trim(col))
    if brand is not None:
        low = F.lower(F.trim(brand))
        out = F.when(F.startswith(out, F.concat(low, F.lit(" "))), F.substring(out, F.length(low) + 2, F.length(out))).otherwise(out)
    if drop_packs:
        out = F.regexp_replace(out, PACK, " ")
    words = F.filter(F.split(F.regexp_replace(out, "[^a-z0-9]+", " "), " +"), lambda w: (w != "") & ~w.isin(list(stopwords)))
    return F.array_join(words, " ")


def tokenize(col: Column, sep: str = r"[,;|]", drop_parens: bool = False, min_len: int = 1, distinct: bool = False, strip_digits: bool = False) -> Column:
    """Lowered, trimmed tokens of a text; the options give the reference's five variants."""
    text = F.lower(col)
    if drop_parens:
        text = F.regexp_replace(text, r"\([^)]*\)", " ")
    if strip_digits:
        text = F.regexp_replace(text, r"[0-9]+([.,][0-9]+)? *%?", " ")
    parts = F.transform(F.split(text, sep), lambda t: F.trim(F.regexp_replace(t, " +", " ")))
    parts = F.filter(parts, lambda t: F.length(t) >= min_len)
    return F.array_distinct(parts) if distinct else parts


def norm_tokens(arr: Column) -> Column:
    """Distinct, trimmed, lowered, non-empty tokens in order of appearance."""
    return F.array_distinct(F.filter(F.transform(arr, lambda t: F.lower(F.trim(t))), lambda t: t.isNotNull() & (t != "")))


def tokens_any(arr: Column, words: Sequence[str], mode: str = "equal") -> Column:
    """Whether a token equals, starts with or contains one of `words`."""
    tests = {"equal": lambda t, w: t == w, "prefix": lambda t, w: F.startswith(t, F.lit(w)), "contains": lambda t, w: F.contains(t, F.lit(w))}
    return F.exists(arr, lambda t: _any([tests[mode](t, w) for w in words]))


def classify_case(col: Column, rules: Sequence[tuple[str, str, object]], default: str | None = None) -> Column:
    """First match of (kind, label, argument): in (a list), like (a pattern), regex (any case)."""
    out = F.lit(default).cast("string")
    for kind, label, arg in reversed(rules):
        test = col.isin(list(arg)) if kind == "in" else col.like(arg) if kind == "like" else F.regexp_like(col, F.lit(f"(?i){arg}"))
        out = F.when(test, F.lit(label)).otherwise(out)
    return out


def first_keyword(col: Column, words: Sequence[str], default: str | None = None) -> Column:
    """The first of `words`, in their order, that the text contains (any case)."""
    low = F.lower(col)
    out = F.lit(default).cast("string")
    for w in reversed(words):
        out = F.when(F.contains(low, F.lit(w.lower())), F.lit(w)).otherwise(out)
    return out


def word_count(col: Column) -> Column:
    """Parts between single spaces, as the reference counts words."""
    return F.size(F.split(col, " "))


def normalize_url(col: Column) -> Column:
    """Lowered, without scheme, `www.`, query, fragment, trailing number and slashes."""
    out = F.regexp_replace(F.lower(F.trim(col)), r"^[a-z]+://(www\.)?", "")
    out = F.regexp_replace(out, r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(out, r"/[0-9]+/*$", ""), r"/+$", "")


def url_flags(col: Column, words: Sequence[str]) -> dict[str, Column]:
    """Whether the path holds each word between separators."""
    path = F.regexp_replace(F.regexp_replace(F.lower(col), r"^[a-z]+://[^/]*", ""), r"[?#].*$", "")
    return {w: F.regexp_like(path, F.lit(f"(^|[/_.-]){quote(w)}([/_.-]|$)")) for w in words}


def extract_code(col: Column) -> Column:
    """The first run of 14, 13, 12 or 8 digits between word ends."""
    return F.nullif(F.regexp_extract(col, r"\b([0-9]{12,14}|[0-9]{8})\b", 1), F.lit(""))


def guess_lang(col: Column, indicators: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """First language of which the text holds an indicator word."""
    text = F.concat(F.lit(" "), F.lower(col), F.lit(" "))
    out = F.lit(default).cast("string")
    for lang, words in reversed(list(indicators.items())):
        out = F.when(F.regexp_like(text, F.lit(f" ({'|'.join(quote(w) for w in words)}) ")), F.lit(lang)).otherwise(out)
    return F.when(col.isNotNull(), out)


def label(col: Column, names: Mapping[str, str]) -> Column:
    """Display label of a code; unknown codes stay."""
    out = col
    for code, text in names.items():
        out = F.when(col == code, F.lit(text)).otherwise(out)
    return out


def is_present(col: Column, kind: str = "string") -> Column:
    """Not null and not blank (string), or not empty (array); never null."""
    test = F.length(F.trim(col)) > 0 if kind == "string" else F.size(col) > 0 if kind == "array" else F.lit(True)
    return F.coalesce(col.isNotNull() & test, F.lit(False))


def tags_contain(arr: Column, words: Sequence[str]) -> Column:
    return F.exists(arr, lambda t: _any([F.contains(F.lower(t), F.lit(w)) for w in words]))


def exclude_words(col: Column, words: Sequence[str]) -> Column:
    """False where the text holds one of `words` as a word (any case); null text passes."""
    return ~F.coalesce(F.regexp_like(col, F.lit(rf"(?i)\b({'|'.join(quote(w) for w in words)})\b")), F.lit(False))
