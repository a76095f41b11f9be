"""Secret scans behind a trigram inverted index.

Each rule's regex gives a Boolean query on trigrams that every match must contain. The index lists, for each
trigram that some query names, the documents that contain it; a rule's candidates are those found in the
postings of all its trigrams, and only they are scanned with the regex. A rule without mandatory
trigrams scans every document.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import text_of
from tradewind.sources.stage import stage

try:
    from re import _parser as _re_parser
except ImportError:                                     # before Python 3.11
    import sre_parse as _re_parser


class Rule(NamedTuple):
    kind: str
    regex: str
    least: int = 0          # characters of the group that a match needs
    group: int = 0


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # runs of fewer characters would be dropped, so that the regex need not find them
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Well-known key formats. Their prefixes and lengths are the issuers'.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("stripe", r"sk_live_[0-9A-Za-z]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
_MOST = 16                  # strings kept apart while a regex is read; beyond them they are cut into trigrams

Query = frozenset           # a set of clauses, each a set of trigrams, of which one must be contained whole


def _grams(strings: frozenset[str]) -> Query:
    """Any of these strings is contained: the trigrams of each as one clause. No clause: nothing is known."""
    clauses = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    return frozenset() if frozenset() in clauses else frozenset(clauses)


def _both(a: Query, b: Query) -> Query:
    return a or b if not (a and b) else frozenset(x | y for x in a for y in b)


def _either(parts: Sequence[Query]) -> Query:
    return frozenset() if not all(parts) else frozenset().union(*parts)


def _strings(kind, value) -> frozenset[str] | None:
    """The few lower-case strings that an item stands for, or None."""
    kind = str(kind)
    if kind == "LITERAL":
        return frozenset({chr(value).lower()})
    if kind == "IN":
        if any(str(k) != "LITERAL" for k, _ in value):
            return None
        return frozenset(chr(v).lower() for _, v in value) if len(value) <= _MOST else None
    if kind == "SUBPATTERN":
        return _walk(value[3])[0]
    if kind == "BRANCH":
        parts = [_walk(p)[0] for p in value[1]]
        return None if None in parts else frozenset().union(*parts)
    if kind == "MAX_REPEAT" and value[:2] == (0, 1):
        inner = _walk(value[2])[0]
        return None if inner is None else inner | {""}
    if kind == "MAX_REPEAT" and value[0] == value[1] <= 4:
        inner = _walk(value[2])[0]
        return None if inner is None or len(inner) > 1 else frozenset(s * value[0] for s in inner)
    return None


def _inside(kind, value) -> Query:
    """What an item that is not a few strings must still contain."""
    kind = str(kind)
    if kind == "SUBPATTERN":
        return _walk(value[3])[1]
    if kind == "BRANCH":
        return _either([_walk(p)[1] for p in value[1]])
    if kind == "MAX_REPEAT" and value[0] >= 1:
        return _walk(value[2])[1]
    return frozenset()


def _walk(items) -> tuple[frozenset[str] | None, Query]:
    """The strings that a sequence stands for (None if too many), and its trigram query."""
    now, whole, query = frozenset({""}), True, frozenset()
    for kind, value in items:
        nxt = _strings(kind, value)
        if nxt is not None and len(now) * len(nxt) <= _MOST:
            now = frozenset(a + b for a in now for b in nxt)
            continue
        query, whole = _both(query, _grams(now)), False
        now = nxt if nxt is not None else frozenset({""})
        if nxt is None:
            query = _both(query, _inside(kind, value))
    return (now if whole else None), _both(query, _grams(now))


def trigram_query(regex: str) -> Query:
    """Clauses of lower-case trigrams: a text that matches contains, in lower case, all of some clause. Empty: no such trigrams."""
    return _walk(_re_parser.parse(regex.removeprefix("(?i)")))[1]


def postings(docs: DataFrame, grams: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """The inverted index: ``gram`` (its place in ``grams``) and ``id`` of each document that contains it."""
    named = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(g).alias("g")) for i, g in enumerate(grams)])
    # the lower-case text is bound once for all trigrams
    found = F.transform(F.array(F.lower(text_of(text_col))), lambda low: F.filter(named, lambda g: F.contains(low, g["g"])))
    return docs.select(F.col(id_col).alias("id"), F.explode(F.transform(found[0], lambda g: g["i"])).alias("gram"))


def candidates(index: DataFrame, grams: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """``id`` and the kinds of the rules whose trigram query its postings meet."""
    at = {g: i for i, g in enumerate(grams)}
    seen = index.groupBy("id").agg(F.collect_set("gram").alias("grams"))

    def met(rule: Rule) -> Column:
        clauses = [reduce(lambda a, b: a & b, [F.array_contains("grams", at[g]) for g in sorted(c)]) for c in trigram_query(rule.regex)]
        return reduce(lambda a, b: a | b, clauses)

    kinds = F.array_compact(F.array(*[F.when(met(r), F.lit(r.kind)) for r in rules]))
    return seen.select(F.col("id").alias("_id"), kinds.alias("_kinds")).where(F.size("_kinds") > 0)


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Matches as (start, rule number, end), from the lengths of the matches and of what lies between them."""
    hits, between = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), F.split(text, rule.regex, -1)
    needed = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else hits
    rows = F.arrays_zip(F.transform(hits, F.length).alias("hit"), F.transform(needed, F.length).alias("need"),
                        F.transform(F.slice(between, 1, F.size(hits)), F.length).alias("gap"))
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    walked = F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("spans")), lambda a, x: F.struct(
        (a["at"] + x["gap"] + x["hit"]).alias("at"),
        F.when(x["need"] >= rule.least, F.concat(a["spans"], F.array(F.struct(
            (a["at"] + x["gap"]).alias("start"), F.lit(number).alias("rule"), (a["at"] + x["gap"] + x["hit"]).alias("end")))))
        .otherwise(a["spans"]).alias("spans")))
    return walked["spans"]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = BASE_RULES + MORE_RULES) -> DataFrame:
    """One row per input row: id and ``secrets``, the spans (start, kind, end) in code points, sorted by start and rule.

    Matches of one rule are leftmost and do not overlap; those of different rules may. A null text is empty.
    Rows that repeat an id, null ids too, are each scanned with the candidates of all rows of that id. An
    empty table gives an empty one; other columns are left out.
    """
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    listed = [r for r in rules if queries[r.kind]]
    grams = sorted({g for q in queries.values() for c in q for g in c})
    wanted = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    if listed:
        index = stage(postings(wanted, grams, "id", "text"), "postings")
        found = stage(candidates(index, grams, listed), "candidates")     # of known size: few go to every task, so texts stay where they are
        wanted = wanted.join(found, F.col("id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    text, parts = F.col("text"), []
    for n, rule in enumerate(rules):
        hit = text.rlike(rule.regex)
        if queries[rule.kind]:
            hit = F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False)) & hit
        parts.append(F.when(hit, _spans(text, rule, n)).otherwise(none))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(F.array_sort(F.concat(*parts)), lambda s: F.struct(
        s["start"].alias("start"), F.element_at(kinds, s["rule"] + 1).alias("kind"), s["end"].alias("end")))
    return wanted.select(F.col("id").alias(id_col), spans.alias("secrets"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
