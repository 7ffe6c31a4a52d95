"""Personal data: base spans against the definition, estimates against plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from made_texts import prose

from granary.llm import private, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SHOWN = "doc_id long, text string, found string, base int, wide string, added long"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for kind, (name, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[name]():  # noqa: B023
                out.append((kind, m.start(), m.end()))
    return out


def card(rng: random.Random, good: bool = True) -> str:
    head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    check = next(str(c) for c in range(10) if luhn(head + str(c)))
    return head + (check if good else str((int(check) + 1 + rng.randrange(8)) % 10))


@pytest.fixture(scope="module")
def personal_rows() -> list[tuple]:
    """Base forms of all kinds, spelt ones that only the method can find, and decoys."""
    rng = random.Random(12)
    rows = []

    def add(i: int, middle: str) -> None:
        rows.append((i, f"{prose(rng, 'en', 9)} {middle} {prose(rng, 'en', 6)}", "x", 1, "y", 2))

    for i in range(300):
        host = f"{rng.choice(('mail', 'post', 'web'))}{i % 7}.example.{rng.choice(('com', 'org', 'de'))}"
        add(i, (f"mail me {prose(rng, 'en', 1).strip('.').lower()}.{i}@{host}", f"server {rng.randint(1, 223)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(1, 254)}", f"card {card(rng)}", f"phone +1 ({rng.randint(200, 989)}) 555-{rng.randint(1000, 9999)}")[i % 4])
    for i in range(300, 340):
        add(i, f"email jo.{i} at mail{i % 7}.example.com" if i % 2 else f"phone 00 44 {rng.randint(200, 989)} 555-{rng.randint(1000, 9999)}")
    for i in range(340, 480):
        add(i, (f"order {rng.randint(10**8, 10**9)}", f"version {i}.{i}.{i}.{i}", f"token=x{rng.randint(10**15, 10**16)}y", f"serial {card(rng, False)}")[i % 4])
    return rows


LONG = ["a" * 300_000, "1 " * 200_000, "1." * 100_000, "a@b." * 50_000, "+1(" * 80_000, "a@" * 100_000, "1-" * 100_000, " at " * 80_000, "1" * 300_000 + "@", "4111111111111111, " * 3_000, "+" * 200_000, "a" * 300_000 + "@b." + "c" * 300_000]


def test_very_long_texts(spark):
    """Linear time and no deep stack; the plain patterns would take the square of the length."""
    out = private.find_private(spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string").repartition(4)).collect()
    n = {r["doc_id"]: len(r["base"]) for r in out}
    assert n == {i: {2: 25_000, 3: 25_000, 9: 3_000, 11: 1}.get(i, 0) for i in range(len(LONG))}


def test_base_spans_follow_the_definition(spark, docs, docs_rows, personal_rows):
    odd = [None, "", "a@b.c@d.e_x@d.e.f", "@a.b", "a@b", "a@b.", "..@a-.b..c", "1.2.3.4.5.6.7.8", "01.002.0003.255", "1.2.3.256", "999.1.1.1.1", "4111 1111-1111 1111", "4111  1111 1111 1111", "41111111111111111111111", "+1 2", "+12345678 9.", "+1 (499) 555-6503)", "++49 30 1234567", "+4111111111111111", "😀 a@b.co 中1.1.1.1", "1.1.1.1 a@b.co\n+49-30-1234567 4111111111111111", "0" * 13, "a.b@c.d.e,f@g.h"]
    long = [t[:2_000] for t in LONG]
    rng = random.Random(1)
    mixed = ["".join(rng.choice("ab1234+-.@ ()") for _ in range(rng.randint(1, 60))) for _ in range(1_500)]
    rows = [(i, t, "x", 1, "y", 2) for i, t in enumerate([*odd, *long, *mixed])] + [r for r in personal_rows if r[0] < 300]
    out = private.find_private(spark.createDataFrame(rows, SHOWN).repartition(4)).collect()
    assert len(out) == len(rows)
    want = Counter((r[0], tuple(plain_spans(r[1]))) for r in rows)
    assert Counter((r["doc_id"], tuple(tuple(x) for x in r["base"])) for r in out) == want
    got = private.find_private(docs).collect()
    assert Counter((r["doc_id"], tuple(tuple(x) for x in r["base"])) for r in got) == Counter((r[0], tuple(plain_spans(r[1]))) for r in docs_rows)


def test_the_method_adds_spelt_forms_and_no_decoys(spark, personal_rows):
    rows = [*personal_rows, personal_rows[0], personal_rows[0]]
    out = {r["doc_id"]: r for r in private.find_private(spark.createDataFrame(rows, SHOWN)).collect()}
    text = {r[0]: r[1] for r in rows}
    added = {i: [(x["kind"], text[i][x["start"] : x["end"]]) for x in r["added"]] for i, r in out.items() if r["added"]}
    assert not [i for i in added if not 300 <= i < 340], added
    found = [i for i in range(300, 340) if i in added]
    assert len(found) >= 36
    assert all(added[i][0][0] == (0 if i % 2 else 3) for i in found)
    assert all(added[i][0][1].startswith("jo." if i % 2 else "00 44") for i in found)


def plain_em(counts: dict[tuple[int, tuple], int]) -> dict[tuple[int, tuple], float]:
    """The rounds by loops over candidates' patterns."""
    width, odds = private.VOTES, {}
    like = private.LIKELY
    for kind in {k for k, _ in counts}:
        mine = {v: n for (k, v), n in counts.items() if k == kind}
        n = sum(mine.values())
        before = private.PRIOR + private.PRIOR_SHARE * n
        w, prior = [[math.log(like[2] / like[0]), 0.0, math.log(like[0] / like[2])]] * width, 0.0
        for _ in range(private.ROUNDS):
            p = {v: 1 / (1 + math.exp(-prior - sum(w[j][x] for j, x in enumerate(v)))) for v in mine}
            yes = sum(p[v] * m for v, m in mine.items())
            new_prior, new = math.log((yes + 1) / (n - yes + 1)), []
            for j in range(width):
                a = [sum(p[v] * m for v, m in mine.items() if v[j] == x) for x in range(3)]
                b = [sum((1 - p[v]) * m for v, m in mine.items() if v[j] == x) for x in range(3)]
                new.append([math.log((a[x] + before * like[2 - x]) / (yes + before)) - math.log((b[x] + before * like[x]) / (n - yes + before)) for x in range(3)])
            change = max([abs(prior - new_prior)] + [abs(x - y) for s, t in zip(w, new, strict=True) for x, y in zip(s, t, strict=True)])
            w, prior = new, new_prior
            if change < private.STILL / 10:
                break
        odds |= {(kind, v): prior + sum(w[j][x] for j, x in enumerate(v)) for v in mine}
    return odds


def test_estimates_equal_plain_loops(spark, personal_rows):
    rows = private.candidates(private.spans_of(spark.createDataFrame(personal_rows, SHOWN), "doc_id", "text")).collect()
    votes = lambda code: tuple(code // 3 ** (private.VOTES - 1 - j) % 3 for j in range(private.VOTES))
    counts = Counter((x["kind"], votes(x["votes"])) for r in rows for x in r["wide"])
    table = spark.createDataFrame([(k, sum(x * 3 ** (private.VOTES - 1 - j) for j, x in enumerate(v)), n) for (k, v), n in counts.items()], "kind int, votes int, n long")
    odds = private.log_odds(table)
    want = plain_em(counts)
    code = lambda k, v: k * 243 + sum(x * 3 ** (private.VOTES - 1 - j) for j, x in enumerate(v))
    assert all(abs(odds[code(k, v)] - x) < 0.02 for (k, v), x in want.items())
    frame = spark.createDataFrame(rows, "doc_id long, base array<struct<kind:int,start:long,end:long>>, wide array<struct<start:long,end:long,kind:int,votes:int,features:array<int>>>")
    weights = private.classifier(frame, odds)
    yes, no = defaultdict(float), defaultdict(float)
    for r in rows:
        for x in r["wide"]:
            p = private.probability(odds[x["kind"] * 243 + x["votes"]])
            for j, c in enumerate(x["features"]):
                yes[x["kind"], j, c] += p
                no[x["kind"], j, c] += 1 - p
    per = 1 + private.FEATURES * private.CODES
    for kind in range(4):
        a, b = (sum(v for (k, j, _), v in m.items() if k == kind and j == 0) for m in (yes, no))
        assert abs(weights[kind * per] - math.log((a + 1) / (b + 1))) < 1e-6
        for (k, j, c), v in yes.items():
            if k == kind:
                assert abs(weights[kind * per + 1 + j * private.CODES + c] - math.log((v + 1) / (a + private.CODES)) + math.log((no[k, j, c] + 1) / (b + private.CODES))) < 1e-6


def test_codes_are_within_the_model(spark, personal_rows, docs):
    rows = private.candidates(private.spans_of(docs.select("doc_id", "text").union(spark.createDataFrame(personal_rows, SHOWN).select("doc_id", "text")), "doc_id", "text"))
    x = rows.select(F.explode("wide").alias("x")).select("x.*")
    bad = x.where("kind not between 0 and 3 or votes not between 0 and 242 or size(features) <> 9 or exists(features, c -> c is null or c < 0 or c > 11)")
    assert x.count() > 300 and bad.count() == 0


def test_running_sums_of_long_arrays(spark):
    got = spark.range(1).select(private.running_sums(F.transform(F.sequence(F.lit(1), F.lit(1_000)), lambda x: x.cast("long"))).alias("s"), private.running_sums(F.array().cast("array<bigint>")).alias("e")).first()
    assert got["s"] == [i * (i + 1) // 2 for i in range(1_000)] and got["e"] == []


def test_empty_table_and_query(spark, no_docs, sf):
    assert private.find_private(no_docs).collect() == []
    out = queries.op12_private(spark, sf)
    text = {r["doc_id"]: r["text"] for r in queries.documents(spark, sf).collect()}
    for r in out.collect():
        base = plain_spans(text[r["doc_id"]])
        shown = ",".join(f"{private.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in private.KINDS] == [sum(b[0] == j for b in base) for j in range(4)]
        assert set(shown.split(",")) <= set(r["spans"].split(","))
