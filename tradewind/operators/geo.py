"""Map tables: country totals on region outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.text import fix_code

# Outline codes that differ from the country table's.
REGION_FIXES = {"RS": "XS"}


def choropleth(points: DataFrame, totals: DataFrame, country: DataFrame,
               region_fixes: dict[str, str] | None = None) -> DataFrame:
    """Outline points of regions that have a value, with the value and the country name as ``region``.

    ``points`` has ``region, grp, ord, lng, lat``; ``totals`` has ``country, value``.
    """
    code = fix_code(F.col("region"), REGION_FIXES if region_fixes is None else region_fixes)
    fixed = points.withColumn("_code", code).drop("region")
    names = country.select(F.col("countrycode").alias("_c"), F.col("countryname").alias("region"))
    valued = totals.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    return (fixed.join(valued, F.col("_code") == F.col("country"))
                 .join(names, F.col("_code") == F.col("_c"), "left")
                 .select("region", "grp", "ord", "lng", "lat", "value"))


def polygon_rings(points: DataFrame, piece: int = 10_000, whole: bool = False) -> DataFrame:
    """Points of each outline in drawing order, as an array per ``piece`` consecutive order numbers.

    With ``whole`` the pieces, each sorted by a task of its own, are put together by their number: one row per outline.
    """
    cut = points.withColumn("piece", F.floor(F.col("ord") / piece))
    gathered = F.array_sort(F.collect_list(F.struct("ord", "lng", "lat")))
    ring = F.transform(gathered, lambda p: F.struct(p["lng"].alias("lng"), p["lat"].alias("lat")))
    pieces = cut.groupBy("grp", "piece").agg(ring.alias("ring"))
    if not whole:
        return pieces
    parts = F.array_sort(F.collect_list(F.struct("piece", "ring")))
    return pieces.groupBy("grp").agg(F.flatten(F.transform(parts, lambda p: p["ring"])).alias("ring"))


def ring_attributes(mapped: DataFrame) -> DataFrame:
    return mapped.select("region", "grp", "value").distinct()


def scale_values(df: DataFrame, col: str = "value") -> DataFrame:
    """Divide by 1e9 or 1e6 when the largest value is above 1e12 or 1e9; ``suffix`` is b, m or blank."""
    top = df.agg(F.max(col).alias("top")).scalar()
    value = F.col(col).cast("double")
    return (df.withColumn("_top", top)
              .withColumn("suffix", F.when(F.col("_top") > 1e12, "b").when(F.col("_top") > 1e9, "m").otherwise(""))
              .withColumn(col, F.when(F.col("_top") > 1e12, value / 1e9)
                                .when(F.col("_top") > 1e9, value / 1e6).otherwise(value))
              .drop("_top"))


def bar_layout(series: DataFrame) -> DataFrame:
    """Grouped bars below seven months, stacked bars from seven on."""
    return series.agg(F.count_distinct("month").alias("months")).select(
        "months", F.when(F.col("months") < 7, "dodge").otherwise("stack").alias("layout"))
