"""Expressions over commodity codes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAF_LENGTH = 8
_BOUNDS = 16        # ranges of codes that a scan is asked for


def build_code_patterns(codes2=None, codes4=None, codes6=None, codes8=None) -> list[str]:
    """Patterns for the deepest level that has a choice; ``_`` stands for any one character."""
    for chosen in (codes8, codes6, codes4, codes2):
        picked = [c for c in chosen or () if c != "All"]
        if picked and "All" not in chosen:
            return sorted({c.ljust(LEAF_LENGTH, "_") for c in picked})
    return ["_" * LEAF_LENGTH]


def _after(prefix: str) -> str:
    """The least text above all that begin with the prefix, blank if there is none."""
    for i in reversed(range(len(prefix))):
        point = ord(prefix[i]) + 1
        if point <= 0x10FFFF:
            return prefix[:i] + chr(0xE000 if point == 0xD800 else point)
    return ""


def prefix_ranges(prefixes: Iterable[str]) -> list[tuple[str, str]]:
    """The fewest ranges [low, high) of texts that begin with one of the prefixes; a blank ``high`` has no end."""
    out: list[tuple[str, str]] = []
    for low in sorted(set(prefixes)):
        if out and (not out[-1][1] or low < out[-1][1]):
            continue                                # begins with a prefix that is there already
        if out and low == out[-1][1]:
            out[-1] = (out[-1][0], _after(low))
        else:
            out.append((low, _after(low)))
    return out


def _gap(low: str, high: str) -> int:
    """How much lies between two texts, by their first eight characters."""
    def number(x: str) -> int:
        return sum(ord(c) << (21 * (LEAF_LENGTH - i)) for i, c in enumerate(x[:LEAF_LENGTH]))
    return number(high) - number(low)


def bounds(ranges: list[tuple[str, str]], most: int = _BOUNDS) -> list[tuple[str, str]]:
    """No more than ``most`` ranges that hold all the given ones: the widest gaps between them stay."""
    gaps = sorted(range(1, len(ranges)), key=lambda i: -_gap(ranges[i - 1][1], ranges[i][0]))[:most - 1]
    cuts = [0, *sorted(gaps), len(ranges)]
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(cuts, cuts[1:]) if a < b]


def _within(code: Column, ranges: list[tuple[str, str]]) -> Column:
    return reduce(Column.__or__, [(code >= low) & (code < high) if high else code >= low for low, high in ranges])


def code_matches(code: Column, patterns: Iterable[str]) -> Column:
    """Whole-string match of ``code`` against any of the wildcard patterns.

    Patterns that are a prefix plus wildcards become a few ranges of codes, which the Parquet reader can use whatever the
    number of prefixes, a set lookup of the prefixes, and a length test. Others are matched one by one.
    """
    whole, prefixes, other = [], {}, []
    for p in set(patterns):
        prefix = p.rstrip("_")
        if "_" in prefix or "%" in prefix or "\\" in prefix:
            other.append(p)
        elif prefix == p:
            whole.append(p)
        else:
            prefixes.setdefault(len(p), set()).add(prefix)
    terms = []
    if whole:
        terms.append(code.isin(sorted(whole)))
    for length, group in sorted(prefixes.items()):
        if "" in group:
            terms.append(F.length(code) == length)
            continue
        sizes = sorted({len(p) for p in group})
        member = reduce(Column.__or__, [F.substring(code, 1, n).isin(sorted(p for p in group if len(p) == n)) for n in sizes])
        terms.append(_within(code, bounds(prefix_ranges(group))) & member & (F.length(code) == length))
    # A literal % or \ in a pattern stands for itself; only _ is a wildcard.
    terms += [code.like(p.replace("\\", "\\\\").replace("%", "\\%")) for p in sorted(other)]
    return reduce(Column.__or__, terms) if terms else F.lit(False)


def strip_wildcards(patterns: Iterable[str]) -> str:
    """The code list shown when a query returns nothing."""
    return ",".join(p.replace("_", "") for p in patterns)


def code_prefix(code: Column, n: int) -> Column:
    return F.substring(code, 1, n)


def is_section(code: Column) -> Column:
    """Section rows carry Roman numerals instead of digits."""
    return code.rlike("I|V|X")


def in_chapters(code: Column, first: int, last: int) -> Column:
    return code_matches(code, [f"{n:02d}".ljust(LEAF_LENGTH, "_") for n in range(first, last + 1)])


def code_label(code: Column, description: Column) -> Column:
    return F.concat(code, F.lit(" - "), F.coalesce(description, F.lit("NA")))


def code_from_label(label: Column) -> Column:
    """Code part of a label; "All" passes through and text without a separator has no code."""
    return (F.when(label == "All", F.lit("All"))
             .when(label.contains(" - "), F.substring_index(label, " - ", 1)))
