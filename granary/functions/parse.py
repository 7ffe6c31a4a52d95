"""Numbers, units, ranges, JSON and key-value blocks out of text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import quote

NUMBER = r"([0-9]+(?:[.,][0-9]+)?)"
#: Kilograms in a unit; millilitres and litres count as grams and kilograms.
KG = {"kg": 1.0, "g": 0.001, "l": 1.0, "ml": 0.001, "lb": 0.45359237, "oz": 0.028349523}
KJ_PER_KCAL = 4.184


def number(text: Column) -> Column:
    """Double of a figure with a point or a comma; null where there is none."""
    return F.regexp_replace(F.nullif(text, F.lit("")), ",", ".").try_cast("double")


def parse_percent(col: Column) -> Column:
    """First figure of a text, if it is within 0 and 100."""
    value = number(F.regexp_extract(col, NUMBER, 1))
    return F.when(value.between(0, 100), value)


def parse_energy(col: Column, unit: str | None = None) -> Column:
    """kcal per 100 g; kJ are divided by 4.184, figures per kg by 10."""
    low = F.lower(col)
    value = number(F.regexp_extract(low, NUMBER, 1))
    joule = F.lit(unit == "kj") if unit else F.contains(low, F.lit("kj"))
    value = F.when(joule, value / KJ_PER_KCAL).otherwise(value)
    return F.when(F.regexp_like(low, F.lit("(/|per) *kg")), value / 10).otherwise(value)


def _unit_kg(unit: Column) -> Column:
    out = F.lit(None).cast("double")
    for name, kg in KG.items():
        out = F.when(unit == name, F.lit(kg)).otherwise(out)
    return out


_UNITS = "(kg|ml|g|lb|oz|l)"


def parse_weight_kg(col: Column) -> Column:
    """Weight of the first pack in a text: `12 x 400g`, `1,5 kg`, `2 lb`; null without one."""
    low = F.lower(col)
    multi = rf"([0-9]+) *x *{NUMBER} *{_UNITS}\b"
    single = rf"{NUMBER} *{_UNITS}\b"
    many = F.regexp_extract(low, multi, 1).try_cast("double") * number(F.regexp_extract(low, multi, 2)) * _unit_kg(F.regexp_extract(low, multi, 3))
    return F.coalesce(many, number(F.regexp_extract(low, single, 1)) * _unit_kg(F.regexp_extract(low, single, 2)))


def pack_sizes(col: Column) -> Column:
    """All single pack sizes of a text, normalised to `figure unit`."""
    found = F.regexp_extract_all(F.lower(col), F.lit(rf"[0-9]+(?:[.,][0-9]+)? *{_UNITS}\b"), F.lit(0))
    return F.transform(found, lambda x: F.regexp_replace(F.regexp_replace(x, " +", ""), ",", "."))


def parse_money(col: Column) -> Column:
    """Figure of a price with any currency sign; thousands commas are dropped."""
    plain = F.regexp_replace(col, r"[^0-9.,]", "")
    plain = F.regexp_replace(plain, r",([0-9]{3})", "$1")
    return number(plain)


def currency_of(col: Column, signs: Mapping[str, str], default: str) -> Column:
    out = F.lit(default)
    for sign, code in reversed(list(signs.items())):
        out = F.when(F.contains(F.upper(col), F.lit(sign)), F.lit(code)).otherwise(out)
    return out


def unit_price(price: Column, sizes: Column, mode: str = "first") -> Column:
    """Price per kg from an array of pack sizes: by the first, or by their mean."""
    weights = F.filter(F.transform(sizes, parse_weight_kg), lambda w: w.isNotNull())
    if mode == "first":
        weight = F.try_element_at(weights, F.lit(1))
    else:
        weight = F.try_divide(F.aggregate(weights, F.lit(0.0), lambda s, w: s + w), F.size(weights))
    return price / F.nullif(weight, F.lit(0.0))


def bucket(col: Column, edges: Sequence[tuple[float, str]], above: str, default: str | None = None) -> Column:
    """Label of the first edge the value is not above; `above` beyond all; `default` for null."""
    out = F.lit(above)
    for edge, name in reversed(edges):
        out = F.when(col <= edge, F.lit(name)).otherwise(out)
    return F.when(col.isNull(), F.lit(default).cast("string")).otherwise(out)


def estimate_energy(protein: Column, fat: Column, fiber: Column, ash: Column, moisture: Column, factors: tuple = (3.5, 8.5, 3.5), ash_default: float = 8.0, moisture_default: float = 10.0) -> Column:
    """kcal by difference: carbohydrate is what the others leave of 100, at least 0; null
    without protein or fat."""
    rest = F.lit(100.0) - protein - fat - F.coalesce(fiber, F.lit(0.0)) - F.coalesce(ash, F.lit(ash_default)) - F.coalesce(moisture, F.lit(moisture_default))
    return protein * factors[0] + fat * factors[1] + F.greatest(F.lit(0.0), rest) * factors[2]


def parse_range(col: Column, spread: float = 0.0, scale: float = 1.0) -> Column:
    """struct(low, high) of `a-b`, `a to b` (hyphen, en dash, or the word), or a single figure
    minus and plus `spread` (a share of it); both times `scale`."""
    pair = rf"{NUMBER} *(?:-|–|to) *{NUMBER}"
    low, high, one = number(F.regexp_extract(col, pair, 1)), number(F.regexp_extract(col, pair, 2)), number(F.regexp_extract(col, NUMBER, 1))
    return F.struct((F.coalesce(low, one * (1 - spread)) * scale).alias("low"), (F.coalesce(high, one * (1 + spread)) * scale).alias("high"))


def ordinal(col: Column, ladder: Sequence[tuple[str, int]], default: int | None = None) -> Column:
    """Number of the first phrase, in the ladder's order, that the lowered text contains."""
    low = F.lower(col)
    out = F.lit(default).cast("int")
    for phrase, value in reversed(ladder):
        out = F.when(F.contains(low, F.lit(phrase)), F.lit(value)).otherwise(out)
    return out


def step(col: Column, edges: Sequence[tuple[float, object]], above: object) -> Column:
    """Value of the first edge that the number is below; `above` beyond all; null for null."""
    out = F.lit(above)
    for edge, value in reversed(edges):
        out = F.when(col < edge, F.lit(value)).otherwise(out)
    return F.when(col.isNotNull(), out)


def json_get(col: Column, paths: Sequence[str], default: str | None = None) -> Column:
    """First non-null of several dotted paths in a JSON text."""
    return F.coalesce(*[F.get_json_object(col, f"$.{p}") for p in paths], F.lit(default).cast("string"))


def json_collect(col: Column, path: str, field: str) -> Column:
    """`field` of each object in the array at `path`; an empty array where there is none."""
    kind = f"array<struct<`{field}`:string>>"
    return F.coalesce(F.transform(F.from_json(F.get_json_object(col, f"$.{path}"), kind), lambda x: x[field]), F.array().cast("array<string>"))


def to_double(col: Column) -> Column:
    return F.regexp_replace(F.trim(col), ",", ".").try_cast("double")


def to_int(col: Column) -> Column:
    """Whole part of a figure, null where it isn't one."""
    return to_double(col).try_cast("long")


def to_bool(col: Column) -> Column:
    """true, yes, 1, y, on; false, no, 0, n, off; else null."""
    low = F.lower(F.trim(col))
    return F.when(low.isin("true", "yes", "1", "y", "on"), F.lit(True)).when(low.isin("false", "no", "0", "n", "off"), F.lit(False))


def parse_block(col: Column, keys: Sequence[str]) -> Column:
    """Map of the values in a text of `Key: value` parts, cut at line ends and semicolons."""
    cells = []
    for k in keys:
        cells += [F.lit(k), F.trim(F.nullif(F.regexp_extract(col, rf"(?i)(?:^|[\n;]) *{quote(k)} *: *([^\n;]*)", 1), F.lit("")))]
    return F.map_filter(F.create_map(*cells), lambda k, v: v.isNotNull())


def repair_array(col: Column) -> Column:
    """Array of strings from its JSON text; one that can't be read gives an empty array."""
    return F.coalesce(F.from_json(col, "array<string>"), F.array().cast("array<string>"))


def in_band(col: Column, low: float, high: float) -> Column:
    return F.coalesce(col.between(low, high), F.lit(False))
