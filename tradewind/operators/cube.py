"""Flow cubes and what is summed from them.

A cube holds one row per country, code, port (non-EU) and month, or per fewer of these. The fact table is
read once, with the code and month filters in the scan, and is summed before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import periods
from tradewind.functions.codes import code_matches
from tradewind.functions.measures import PRICE_PER_KILO, safe_ratio
from tradewind.operators import filters
from tradewind.schema import FactShape
from tradewind.spec import QuerySpec


def flow_cube(fact: DataFrame, shape: FactShape, spec: QuerySpec, country: DataFrame,
              port: DataFrame | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Cube of a query: ``country, comcode[, port], month`` and the summed measures.

    ``keys`` asks for fewer of the four, in which case the facts are summed straight to that grain: a
    monthly series or a country total moves a few rows per task instead of the whole cube. Which rows
    count does not depend on it.
    """
    by_port = shape.port is not None
    if keys is None:
        keys = ("country", "comcode", "port", "month") if by_port else ("country", "comcode", "month")
    rows = fact.where(code_matches(F.col(shape.code), spec.patterns))
    stored = "month" in fact.columns     # a stored table is partitioned by month: skip the other folders
    if stored:
        if spec.start is not None:
            rows = rows.where(F.col("month") >= spec.start)
        if spec.end is not None:
            rows = rows.where(F.col("month") <= spec.end)
    else:
        rows = filters.filter_months(rows, shape.period, spec.start, spec.end, shape.style)
    # Picked names narrow the rows before the sum, and so does a lookup whose key the sum drops. Otherwise
    # "All" filters a key of the sum and may follow it, where a country with very many rows is already few.
    late_country = spec.countries is None and "country" in keys
    late_port = spec.ports is None and "port" in keys
    if not late_country:
        rows = filters.filter_country(rows, shape.country, country, spec.countries, spec.keep_unknown and spec.countries is None)
    if by_port and not late_port:
        rows = filters.filter_port(rows, shape.port, port, spec.ports, spec.keep_unknown and spec.ports is None)
    source = {"country": shape.country, "comcode": shape.code, "port": shape.port,
              "month": "month" if stored else shape.period}
    groups = {k: F.col(source[k]) for k in keys}
    if spec.keep_unknown:
        # One group for what is unknown, however it is spelled.
        if "country" in groups:
            groups["country"] = F.when(groups["country"] != "", groups["country"])
        if "port" in groups:
            groups["port"] = F.coalesce(groups["port"], F.lit(""))
    cube = (rows.groupBy(*[c.alias(k) for k, c in groups.items()])
                .agg(*[F.sum(c).alias(name) for name, c in shape.measures]))
    if "month" in keys and not stored:
        # Respelled after the sum: the filter left one spelling per month.
        cube = cube.withColumn("month", periods.to_month(F.col("month"), shape.style))
    if late_country:
        cube = filters.filter_country(cube, "country", country, keep_unknown=spec.keep_unknown)
    if by_port and late_port:
        cube = filters.filter_port(cube, "port", port, keep_unknown=spec.keep_unknown)
    return filters.fill_unknown(cube)


def measures_of(df: DataFrame) -> list[str]:
    return [m for m in ("consignments", "price", "weight") if m in df.columns]


def sum_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures_of(df)])


def pair_rollup(cube: DataFrame, a: str, b: str) -> DataFrame:
    """One pairwise roll-up per month."""
    return sum_by(cube, a, b, "month")


def pair_rollups(cube: DataFrame, steps: Sequence[tuple[str, str]], with_month: bool = True) -> DataFrame:
    """Several pairwise roll-ups in one pass: ``step`` (position in ``steps``), the key columns, measures.

    One aggregate over grouping sets, so the cube is shuffled once for all of them.
    """
    cols = sorted({c for s in steps for c in s})
    always = ["month"] if with_month else []
    sums = [F.sum(m).alias(m) for m in measures_of(cube)]
    if len(steps) == 1:
        return cube.groupBy(*steps[0], *always).agg(*sums).select(F.lit(0).alias("step"), "*")
    flags = [F.grouping(c).alias(f"_g_{c}") for c in cols]
    rolled = cube.groupingSets([list(s) + always for s in steps], *cols, *always).agg(*sums, *flags)
    step = None
    for i, s in enumerate(steps):
        hit = F.lit(True)
        for c in cols:
            hit = hit & (F.col(f"_g_{c}") == (0 if c in s else 1))
        step = F.when(hit, F.lit(i)) if step is None else step.when(hit, F.lit(i))
    return rolled.select(step.alias("step"), *cols, *always, *measures_of(cube))


def drop_month(pairs: DataFrame) -> DataFrame:
    """All months together."""
    keys = [c for c in pairs.columns if c != "month" and c not in measures_of(pairs)]
    return sum_by(pairs, *keys)


def country_totals(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("country").agg(F.sum("value").alias("value"))


def price_per_kilo(df: DataFrame, keys: Sequence[str], zero_weight: str = "null") -> DataFrame:
    """Ratio of sums at the grain of ``keys``."""
    return filters.select_unit(sum_by(df.select(*keys, "price", "weight"), *keys), PRICE_PER_KILO, zero_weight)


def sum_of_ratios(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of each row's price per kilo (the EU variant)."""
    return df.groupBy(*keys).agg(F.sum(safe_ratio(F.col("price"), F.col("weight"))).alias("value"))


def series(cube: DataFrame, dim: str, unit: str, month: str | None = None, zero_weight: str = "null") -> DataFrame:
    """Monthly series by code, country or port; ``month`` narrows it to one month."""
    if month is not None:
        cube = cube.where(F.col("month") == month)
    return filters.select_unit(sum_by(cube, "month", dim), unit, zero_weight)
