"""Text cleaning, coordinates and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_control(c: Column) -> Column:
    """Drop the SUB control character that some early files carry."""
    return F.replace(c, F.lit("\x1a"), F.lit(""))


def to_latin1(c: Column, sub: str = "/") -> Column:
    """Replace each character outside Latin-1 by ``sub``."""
    return F.regexp_replace(c, r"[^\x00-\xFF]", sub)


def clean_text(c: Column) -> Column:
    return F.trim(to_latin1(strip_control(c)))


def strip_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def pad2(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def unite(a: Column, b: Column) -> Column:
    return F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def fix_code(c: Column, mapping: dict[str, str]) -> Column:
    """Swap whole codes, e.g. {"RS": "XS"}."""
    out = c
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def parse_latitude(position: Column) -> Column:
    """Decimal degrees from ``DDMMN DDDMMW``; south is negative."""
    degrees = F.substring(position, 1, 2).try_cast("double") + F.substring(position, 3, 2).try_cast("double") / 60
    return F.when(position.contains("N"), degrees).otherwise(F.lit(0.0) - degrees)


def parse_longitude(position: Column, lon_layout: str = "DDDMM") -> Column:
    """Decimal degrees from the five digits before the last letter; west is negative.

    ``lon_layout="DDMMS"`` reads them as two degrees, two minutes and one second digit instead.
    """
    digits = F.substring(F.right(position, F.lit(6)), 1, 5)

    def part(start: int, n: int) -> Column:
        return F.substring(digits, start, n).try_cast("double")

    if lon_layout == "DDDMM":
        degrees = part(1, 3) + part(4, 2) / 60
    else:
        degrees = part(1, 2) + part(3, 2) / 60 + part(5, 1) / 3600
    return F.when(position.contains("E"), degrees).otherwise(F.lit(0.0) - degrees)


# Prefix and suffix of each unit's legend.
UNIT_MARKS = {
    "price": ("£", ""),
    "weight": ("", " kg"),
    "price_per_kilo": ("£", "/kg"),
    "consignments": ("", " Con."),
}
# Legend titles.
UNIT_TITLES = {
    "price": "Price", "weight": "Weight", "price_per_kilo": "Price/Weight",
    "consignments": "# Consignments",
}


def _number(v: Column) -> Column:
    return v.cast("decimal(38,2)").cast("string")


def value_label(value: Column, unit: str, suffix: Column) -> Column:
    """Legend text: mark, number, scale letter, unit."""
    before, after = UNIT_MARKS[unit]
    return F.concat(F.lit(before), _number(value), suffix, F.lit(after))


def popup_label(region: Column, value: Column, suffix: Column, inbound: bool = True) -> Column:
    """Map popup text."""
    side = "Country of Origin" if inbound else "Country of Dispatch"
    return F.concat(F.lit(f"<strong>{side}: </strong>"), region, F.lit("<br><strong>Value: </strong>"),
                    _number(value), suffix)
