"""Row selection: codes, partners, gateways, months, units and unknown values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import periods
from tradewind.functions.codes import code_matches, strip_wildcards
from tradewind.functions.measures import PRICE_PER_KILO, safe_ratio
from tradewind.functions.text import is_blank

UNKNOWN_COUNTRY = "Unknown Country"
UNKNOWN_PORT = "Unknown Port"
DEFAULT_LAT, DEFAULT_LONG = 56.0, 0.0     # a point at sea, for ports without a position


def filter_codes(df: DataFrame, code: str, patterns: Iterable[str]) -> DataFrame:
    return df.where(code_matches(F.col(code), patterns))


def filter_listed(df: DataFrame, col: str, dim: DataFrame, key: str, name: str | None = None,
                  names: Sequence[str] | None = None, keep_unknown: bool = False) -> DataFrame:
    """Rows whose code the lookup lists; with ``names``, only the codes of those names.

    "All" therefore still drops NULL, blank and unlisted codes; ``keep_unknown`` keeps NULL and blank.
    """
    listed = dim if names is None else dim.where(F.col(name).isin(list(names)))
    keys = listed.select(F.col(key).alias("_key"))
    if not keep_unknown:
        return df.join(keys, F.col(col) == F.col("_key"), "left_semi")
    marked = df.join(keys.distinct(), F.col(col) == F.col("_key"), "left")
    return marked.where(F.col("_key").isNotNull() | is_blank(F.col(col))).drop("_key")


def filter_country(df, col, dim, names=None, keep_unknown=False) -> DataFrame:
    return filter_listed(df, col, dim, "countrycode", "countryname", names, keep_unknown)


def filter_port(df, col, dim, names=None, keep_unknown=False) -> DataFrame:
    return filter_listed(df, col, dim, "portcode", "portname", names, keep_unknown)


def filter_months(df: DataFrame, col: str, start: str | None, end: str | None, style: str) -> DataFrame:
    """Rows of the months from start to end; None is no bound on that side."""
    if start is None and end is None:
        return df
    return df.where(periods.in_month_range(F.col(col), start, end, style))


def available_months(as_of: DataFrame, col: str, years_back: int = 9, cutoff_day: int = 15) -> DataFrame:
    """Selectable months for each day in ``as_of``: back to January ``years_back`` years earlier, up to the
    publication lag."""
    first = F.make_date(F.year(col) - years_back, F.lit(1), F.lit(1))
    last = periods.month_start(periods.latest_month(F.col(col), cutoff_day, "after"))
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return as_of.select(F.explode(months).alias("_m")).select(F.date_format("_m", "yyyy-MM").alias("month"))


def end_months(calendar: DataFrame, start: str) -> DataFrame:
    return calendar.where(F.col("month") >= start)


def ascending_range(calendar: DataFrame, start: str, end: str) -> DataFrame:
    return calendar.where(F.col("month").between(start, end)).orderBy("month")


def slice_month(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col("month") == month).drop("month")


def select_unit(df: DataFrame, unit: str, zero_weight: str = "null") -> DataFrame:
    """Key columns plus the chosen measure as ``value``."""
    keys = [c for c in df.columns if c not in ("price", "weight", "consignments")]
    if unit == PRICE_PER_KILO:
        value = safe_ratio(F.col("price"), F.col("weight"), zero_weight)
    else:
        value = F.col(unit)
    return df.select(*keys, value.alias("value"))


def valid_eu_period(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).startswith("020"))


def exclude_years(df: DataFrame, col: str, years: Sequence[str]) -> DataFrame:
    return df.where(~F.substring(col, 1, 4).isin(list(years)))


def codes_at_level(df: DataFrame, n: int, code: str = "commoditycode") -> DataFrame:
    return df.where(F.length(code) == n)


def drop_blank(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.where(~is_blank(F.col(c)))
    return df


def fill_unknown(df: DataFrame) -> DataFrame:
    """Readable stand-ins for missing countries and ports, a default point for missing positions."""
    def fix(name: str) -> Column:
        c = F.col(name)
        if name == "country":
            return F.coalesce(c, F.lit(UNKNOWN_COUNTRY)).alias(name)
        if name == "port":
            return F.when(c == "", F.lit(UNKNOWN_PORT)).otherwise(c).alias(name)
        if name == "lat":
            return F.coalesce(c, F.lit(DEFAULT_LAT)).alias(name)
        if name == "long":
            return F.coalesce(c, F.lit(DEFAULT_LONG)).alias(name)
        return c
    return df.select(*[fix(c) for c in df.columns])


def search_codes(dim: DataFrame, text: str | None = None, codes: Sequence[str] | None = None) -> DataFrame:
    """Lookup search: every word must occur in the code or the description; ``codes`` picks exact codes."""
    if codes:
        dim = dim.where(F.col("commoditycode").isin(list(codes)))
    hay = F.lower(F.concat_ws(" ", F.col("commoditycode"), F.col("description")))
    for word in (text or "").lower().split():
        dim = dim.where(hay.contains(word))
    return dim


def result_status(result: DataFrame, patterns: Iterable[str], side: str, flow: str) -> DataFrame:
    """One row telling whether a query found anything, with the code list asked for."""
    return result.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(side).alias("side"), F.lit(flow).alias("flow"), "rows",
        F.lit(strip_wildcards(patterns)).alias("codes"), (F.col("rows") == 0).alias("is_empty"))
