"""Personal data by weak supervision, in DataFrame functions only.

Base spans are the valid matches of four fixed patterns.  A wider pattern gives candidates:
addresses with a spelt sign, numbers without a plus or with other separators, matches that fail a
check.  Five labelers look at a candidate and vote for, against or not at all: its strict form
and its shape (regular expressions), a list of known beginnings or endings (gazetteer), a word
for it nearby, and a word or a character that speaks against it (context).  Votes are counted by
pattern, 243 at most for a kind; expectation-maximisation over these counts estimates how often
each labeler votes which way for true and for false candidates, and so each pattern's posterior.
The posteriors are the soft labels of the final classifier of spans, naive Bayes over FEATURES of
the candidate and its surroundings (not of votes), trained by one aggregation over all
candidates.  Candidates that it takes for ACCEPT or more are added where no base span is.

A text's spans are arrays in its own row, so rows never meet but in the two small aggregations;
what reaches the driver are the numbers of the model, VOTES * 3 and FEATURES * CODES for a kind.
Patterns are possessive and start at the beginnings of runs, so long texts take linear time and
no stack.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
_NAME, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = (
    rf"(?:\G|(?<!{_NAME})){_NAME}++@{_LABEL}++(?:\.{_LABEL}++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_AT, _DOT = r"(?:\x20?(?:\([Aa][Tt]\)|\[[Aa][Tt]\]|@)\x20?|\x20[Aa][Tt]\x20)", r"(?:\x20?(?:\([Dd][Oo][Tt]\)|\[[Dd][Oo][Tt]\])\x20?|\x20[Dd][Oo][Tt]\x20|\.)"
#: Strict forms first, so that what they match is one candidate; then the wider ones.
WIDE = "|".join((PATTERNS[EMAIL].replace(r"\G|", ""), rf"(?<!{_NAME}){_NAME}++{_AT}{_LABEL}++(?:{_DOT}{_LABEL}++)++", PATTERNS[IP], PATTERNS[PHONE], r"\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])", r"[0-9](?:[\x20.-]?[0-9]){6,}+"))
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
OCTETS = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"

#: Gazetteer: endings of hosts, beginnings of card numbers, calling codes of countries.
ENDINGS = "com org net edu gov mil int info biz io eu de fr es uk it nl at ch be pt pl se no dk fi us ca mx br ar au nz jp cn in ru".split()
ISSUERS = r"^(?:4|5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720|3[47]|30[0-5]|36|38|35|6011|64[4-9]|65|62)"
CALLING = r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-9][0-9]|3[578][0-9]|42[0-3]|5[09][0-9]|67[0-9]|8[05][0-9]|9[679][0-9])"
#: Context: words before a candidate that speak for a kind, and for none.
CUES = (
    r"\b(?:e-?mail|mail|contact|write|courriel|correo|schreiben|adresse)",
    r"\b(?:ip|host|server|address|adresse|dirección|login|client)\b",
    r"\b(?:card|credit|visa|mastercard|amex|karte|carte|tarjeta|payment|iban)",
    r"\b(?:phone|tel|call|fax|mobile?|cell|téléphone|telefon|teléfono|handy|whatsapp|sms)",
)
AGAINST = r"(?:\b(?:version|release|page|chapter|order|invoice|isbn|issn|doi|ticket|token|sha|hash|license|serial|article|section)\b|\bv|[#=/$€£\"'_])\W{0,3}$"
BEFORE, AFTER = 32, 2

VOTES, FEATURES, CODES = 5, 9, 12
#: The feature that says whether a candidate is a valid strict form.
STRICT = 6
#: Rounds of expectation-maximisation at most, and the change of a posterior's log odds that ends them.
ROUNDS, STILL = 40, 1e-4
#: Shares of a labeler's votes for the true side, none and the false side that count as seen before, as often as PRIOR candidates and PRIOR_SHARE of all.
LIKELY, PRIOR, PRIOR_SHARE = (0.7, 0.2, 0.1), 8.0, 0.05
ACCEPT = 0.95
#: Elements of an array that are summed one by one; longer arrays go by runs of so many.
RUN = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once a row, though a lambda in `use` may ask for it often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(sizes: Column) -> Column:
    """The sums of the elements before each, in runs, so that long arrays don't take their square."""
    plus = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda s, v: s + v)
    runs = F.sequence(F.lit(0), F.floor(F.size(sizes) / RUN).cast("int"))
    before = F.aggregate(runs, F.array(F.lit(0).cast("long")), lambda got, r: F.concat(got, F.array(F.element_at(got, -1) + plus(F.slice(sizes, r * RUN + 1, RUN)))))
    inside = lambda part, sofar: F.transform(part, lambda _, i: sofar + plus(F.slice(part, 1, i)))
    each = lambda got: F.transform(runs, lambda r: let(F.slice(sizes, r * RUN + 1, RUN), lambda part: inside(part, F.get(got, r))))
    return F.flatten(let(before, each))


def matches(rows: DataFrame, pattern: str, out: str, when: Column) -> DataFrame:
    """`rows` with `out`: start, end, found, left, right of the matches of `pattern` in _text."""
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_found", F.when(when, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none))
    rows = rows.withColumn("_gaps", F.when(F.size("_found") > 0, F.split("_text", pattern)).otherwise(none))
    rows = rows.withColumn("_sizes", F.zip_with("_found", F.slice("_gaps", 1, F.size("_found")), lambda m, g: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("found"))))
    rows = rows.withColumn("_before", let(F.transform("_sizes", lambda x: x["gap"] + x["found"]), running_sums))

    def span(before: Column, gaps: Column, m: Column, i: Column) -> Column:
        start = F.get(before, i) + F.length(F.get(gaps, i))
        sides = (F.right(F.get(gaps, i), F.lit(BEFORE)).alias("left"), F.substring(F.get(gaps, i + 1), 1, AFTER).alias("right"))
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("found"), *sides)

    each = let(F.col("_before"), lambda before: let(F.col("_gaps"), lambda gaps: F.transform("_found", lambda m, i: span(before, gaps, m, i))))
    return rows.withColumn(out, each).drop("_found", "_gaps", "_sizes", "_before")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass the checksum: from the right, every second digit is doubled."""
    back = F.reverse(digits)
    odd = F.transform(F.split(back, ""), lambda c, i: F.when(i % 2 == 1, F.translate(c, "0123456789", "0246813579")).otherwise(c).cast("int"))
    right_size = F.length(digits).between(13, 19)
    return F.when(right_size, F.aggregate(odd, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) % 10 == 0).otherwise(F.lit(False))


def _valid(kind: int, found: Column) -> Column:
    return (F.lit(True), found.rlike(OCTETS), _luhn(_digits(found)), F.length(_digits(found)).between(9, 15))[kind]


def _valid_spans(kind: int) -> Column:
    good = F.filter("_spans", lambda x: _valid(kind, x["found"]))
    return F.transform(good, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def spans_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, base (kind, start, end), wide (start, end, found, left, right): all but the text."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    digit = F.col("_text").rlike("[0-9]")
    when = (F.contains(F.col("_text"), F.lit("@")), digit, digit, F.contains(F.col("_text"), F.lit("+")))
    for kind, pattern in enumerate(PATTERNS):
        rows = matches(rows, pattern, "_spans", when[kind]).withColumn(f"_{kind}", _valid_spans(kind))
    rows = matches(rows, WIDE, "wide", digit | when[EMAIL] | F.col("_text").rlike(_AT))
    return rows.select("doc_id", F.concat(*[F.col(f"_{kind}") for kind in range(4)]).alias("base"), "wide")


def _by_kind(kind: Column, *four: Column) -> Column:
    return F.when(kind == EMAIL, four[0]).when(kind == IP, four[1]).when(kind == CARD, four[2]).otherwise(four[3])


def _vote(yes: Column, no: Column) -> Column:
    """2 for, 0 against, 1 neither."""
    return F.when(yes, 2).when(no, 0).otherwise(1)


def _side(text: Column, c: Column) -> Column:
    """The class of a character beside a candidate."""
    return F.when(F.length(text) == 0, 0).when(c == " ", 1).when(c == "\n", 2).when(c.rlike(r"\p{L}"), 3).when(c.rlike("[0-9]"), 4).when(c.rlike("[\"'=:/_#$]"), 5).otherwise(6)


def _described(x: Column) -> Column:
    """A candidate's kind, pattern of votes and codes of FEATURES."""
    found, left, right = x["found"], F.lower(x["left"]), x["right"]
    kind, digits = x["kind"], x["digits"]
    n = F.length(digits)
    last, next_ = F.right(left, F.lit(1)), F.substring(right, 1, 1)
    strict = _by_kind(kind, found.rlike(f"^{_NAME}++@{_LABEL}++(?:\\.{_LABEL}++)++$"), found.rlike(OCTETS), found.rlike(r"^[0-9](?:[\x20-]?[0-9])++$") & _luhn(digits), found.startswith("+") & n.between(9, 15))
    shape = _by_kind(kind, found.rlike(r"[A-Za-z]{2,24}$"), ~found.rlike(r"(?:^|\.)0[0-9]"), found.rlike(r"^[0-9]{13,19}$|^[0-9]{4}(?:[\x20.-][0-9]{4}){3}$|^[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{5}$"), found.rlike(r"[\x20().-][0-9]{3,4}$") & n.between(9, 15))
    ending = F.lower(F.regexp_extract(found, "(?<![A-Za-z0-9-])([A-Za-z0-9-]++)$", 1)).isin(*ENDINGS)
    first = F.regexp_replace(F.substring_index(found, ".", 1), "^0+", "")
    listed = _by_kind(kind, ending, (F.length(first) <= 3) & F.coalesce(F.substring(first, 1, 4).try_cast("int"), F.lit(0)).between(1, 223), digits.rlike(ISSUERS), F.regexp_replace(found, "[^0-9+]", "").rlike(CALLING))
    unlisted = ~listed & ((kind != PHONE) | found.startswith("+"))
    cue = _by_kind(kind, *[left.rlike(c) for c in CUES])
    glued = last.rlike(r"[\p{L}0-9]") | next_.rlike("[0-9_=/]") | ((kind != EMAIL) & next_.rlike(r"\p{L}"))
    against = glued | left.rlike(AGAINST)
    votes = [_vote(strict, ~strict), _vote(shape, ~shape), _vote(listed, unlisted), _vote(cue, F.lit(False)), _vote(F.lit(False), against)]
    separators = F.regexp_replace(found, r"[^\x20().-]", "")
    only = lambda c: F.length(F.replace(separators, F.lit(c), F.lit(""))) == 0
    parts = lambda c: F.length(F.regexp_replace(F.regexp_replace(found, c, "\u0001"), "[^\u0001]", ""))
    sizes = F.when(n == 0, 0).when(n < 7, 1).when(n < 13, n - 5).when(n < 16, 8).when(n == 16, 9).when(n < 20, 10).otherwise(11)
    codes = [
        sizes,
        F.when(F.length(separators) == 0, 0).when(only(" "), 1).when(only("-"), 2).when(only("."), 3).when(separators.rlike("[()]"), 4).otherwise(5),
        F.when(found.startswith("+"), 0).when(found.startswith("("), 1).when(found.rlike("^[0-9]"), 2).otherwise(3),
        _side(left, last),
        _side(right, next_),
        F.when(cue, 1).otherwise(0) + F.when(against, 2).otherwise(0),
        F.when(strict, 1).otherwise(0),
        F.least(parts(r"\."), F.lit(5)),
        F.least(parts("[0-9]+"), F.lit(8)),
    ]
    code = reduce(lambda a, v: a * 3 + v, votes[1:], votes[0])
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), kind.alias("kind"), code.cast("int").alias("votes"), F.array(*[c.cast("int") for c in codes]).alias("features"))


def candidates(rows: DataFrame) -> DataFrame:
    """doc_id, base, wide: described candidates (start, end, kind, votes, features)."""
    letters = lambda x: x["found"].rlike("[A-Za-z@]")
    quad = lambda x: x["found"].rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    kind = lambda x: F.when(letters(x), EMAIL).when(quad(x), IP).when(x["found"].rlike(r"^(?:[+(]|00[\x20.-]?[1-9])") & (F.length(_digits(x["found"])) <= 15), PHONE).when(F.length(_digits(x["found"])) >= 13, CARD).otherwise(PHONE)
    with_kind = F.transform("wide", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["found"].alias("found"), x["left"].alias("left"), x["right"].alias("right"), kind(x).alias("kind"), _digits(x["found"]).alias("digits")))
    return rows.select("doc_id", "base", F.transform(with_kind, _described).alias("wide"))


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def log_odds(patterns: DataFrame) -> list[float]:
    """Log odds of each pattern of votes that a candidate is true, by kind * 243 + pattern.

    `patterns`: kind, votes, n; a row per pattern.  Each round is one aggregation of these rows;
    the first takes for true what more labelers vote for.  Labelers start as LIKELY and keep so
    much of it as PRIOR and PRIOR_SHARE say: a kind whose labelers never disagree stays as it is.
    """
    width = 3**VOTES
    votes = F.transform(F.array(*[F.lit(3**j) for j in reversed(range(VOTES))]), lambda p: F.floor(F.col("votes") / p).cast("int") % 3)
    rows = materialize(patterns.coalesce(1).select("kind", votes.alias("votes"), "n"), "patterns")
    total = {r["kind"]: float(r["n"]) for r in rows.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    start = [log(LIKELY[2] / LIKELY[0]), 0.0, log(LIKELY[0] / LIKELY[2])]
    weigh = [[0.0] + start * VOTES for _ in KINDS]  # the prior's log odds, then a labeler's by vote
    for _ in range(ROUNDS):
        flat = _numbers([v for kind in weigh for v in kind])
        per = 1 + 3 * VOTES
        base = F.col("kind") * per + 1
        odds = F.aggregate(F.transform("votes", lambda v, j: F.element_at(flat, base + 1 + j * 3 + v)), F.element_at(flat, base), lambda s, v: s + v)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
        each = rows.coalesce(1).select("kind", (F.col("n") * p).alias("yes"), F.col("n").cast("double").alias("n"), F.posexplode("votes").alias("labeler", "vote"))
        got = {(r["kind"], r["labeler"], r["vote"]): (r["yes"], r["n"] - r["yes"]) for r in each.groupBy("kind", "labeler", "vote").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n")).collect()}
        new = []
        for kind in range(len(KINDS)):
            n = total.get(kind, 0.0)
            before = PRIOR + PRIOR_SHARE * n
            yes = sum(got.get((kind, 0, v), (0.0, 0.0))[0] for v in range(3))
            row = [log((yes + 1) / (n - yes + 1))]
            for j in range(VOTES):
                for v in range(3):
                    a, b = got.get((kind, j, v), (0.0, 0.0))
                    row.append(log((a + before * LIKELY[2 - v]) / (yes + before)) - log((b + before * LIKELY[v]) / (n - yes + before)))
            new.append(row)
        change = max(abs(a - b) for x, y in zip(weigh, new, strict=True) for a, b in zip(x, y, strict=True))
        weigh = new
        if change < STILL:
            break
    return [weigh[k][0] + sum(weigh[k][1 + j * 3 + code // 3 ** (VOTES - 1 - j) % 3] for j in range(VOTES)) for k in range(len(KINDS)) for code in range(width)]


def classifier(rows: DataFrame, odds: list[float]) -> list[float]:
    """Weights of the features' codes for each kind, the prior first, from the soft labels `odds`
    of all candidates."""
    per = 1 + FEATURES * CODES
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.element_at(_numbers(odds), F.col("x.kind") * 3**VOTES + F.col("x.votes") + 1)))
    each = rows.select(F.explode("wide").alias("x")).select(F.col("x.kind").alias("kind"), p.alias("p"), F.posexplode("x.features").alias("feature", "code"))
    got = {(r["kind"], r["feature"], r["code"]): (r["yes"], r["n"] - r["yes"]) for r in each.groupBy("kind", "feature", "code").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).collect()}
    out = [0.0] * (len(KINDS) * per)
    for kind in range(len(KINDS)):
        yes, no = (sum(v[i] for (k, f, _), v in got.items() if k == kind and f == 0) for i in (0, 1))
        out[kind * per] = log((yes + 1) / (no + 1))
        for feature in range(FEATURES):
            for code in range(CODES):
                a, b = got.get((kind, feature, code), (0.0, 0.0))
                out[kind * per + 1 + feature * CODES + code] = log((a + 1) / (yes + CODES)) - log((b + 1) / (no + CODES))
    return out


def find_private(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """doc_id, base, added: arrays of (kind, start, end) in code points, end exclusive, ordered.

    A row per row of `docs`.  A null or empty text has no spans; repeated rows have equal ones,
    and count as often as they occur in the counts of votes and features.  Without candidates of
    a kind nothing is added.  Other columns aren't read, so clashing names don't matter.
    """
    rows = materialize(candidates(spans_of(docs, key, text)), "candidates")
    patterns = rows.select(F.explode("wide").alias("x")).groupBy("x.kind", "x.votes").agg(F.count("*").alias("n"))
    weights = _numbers(classifier(rows, log_odds(patterns)))
    per = 1 + FEATURES * CODES
    score = lambda x: F.aggregate(F.transform(x["features"], lambda c, j: F.element_at(weights, x["kind"] * per + 2 + j * CODES + c)), F.element_at(weights, x["kind"] * per + 1), lambda s, v: s + v)
    free = lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"]))
    spelt = lambda x: F.get(x["features"], F.lit(STRICT)) == 0  # noqa: E731  the others are base spans
    taken = F.filter("wide", lambda x: spelt(x) & (score(x) >= log(accept / (1 - accept))) & free(x))
    added = F.array_sort(F.transform(taken, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    return rows.select("doc_id", F.array_sort("base").alias("base"), added.alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def probability(odds: float) -> float:
    return 1 / (1 + exp(-odds))
