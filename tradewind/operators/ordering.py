"""Operators that depend on row order, written so that no task sees the whole table.

Rows are sorted by ranges of their order, whatever the keys, and written with their place in the range; the ranges'
sizes, one row each, supply every range's starting point. Ranks, following rows and pages come from these two.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.sources.stage import stage


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key. An aggregate, so a key with very many rows is reduced before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)],
                      *[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ranked).alias("_first"))
    return kept.select(*[F.col("_first")[c].alias(c) if c in rest else F.col(c) for c in df.columns])


def ranges_in_order(df: DataFrame, order: Sequence[str | Column], by: Sequence[str | Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows sorted by ranges of ``order`` (staged, with ``_at``), and each range's ``_range``, ``_start`` and ``_n``.

    ``order`` must be unique per row: then every range holds about the same number of rows, whatever the keys. Only one row
    per range is looked at as a whole. The bounds of ranges are taken from a sample of keys, which goes to the driver: where
    keys may be long texts, ``by`` gives shorter ones that follow the order; rows equal in them share a range.
    """
    rows = stage(df.repartitionByRange(*(by or order)).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    return rows, sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "id", by: Sequence[str | Column] | None = None) -> DataFrame:
    """Consecutive numbers from 0 in ``order`` (unique per row), from two small steps: sorted ranges and their sizes."""
    rows, sizes = ranges_in_order(df, order, by)
    at = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(sizes, F.shiftright("_at", 33) == F.col("_range")).withColumn(name, at).select(*df.columns, name)


def next_in_order(df: DataFrame, value: str, order: Sequence[str | Column], name: str = "next_value") -> DataFrame:
    """Value of the row that follows in ``order`` (unique per row)."""
    rows, sizes = ranges_in_order(df, order)
    cut = rows.withColumn("_part", F.shiftright("_at", 33))
    inside = Window.partitionBy("_part").orderBy("_at")
    heads = (cut.groupBy("_part").agg(F.min_by(value, "_at").alias("_head"))
                .select(F.col("_part").alias("_of"), F.lead("_head").over(Window.orderBy("_part")).alias("_next_head")))
    return (cut.withColumn("_next_at", F.lead("_at").over(inside)).withColumn("_next", F.lead(value).over(inside))
               .join(heads, F.col("_part") == F.col("_of"))
               .withColumn(name, F.when(F.col("_next_at").isNotNull(), F.col("_next")).otherwise(F.col("_next_head")))
               .select(*df.columns, name))


def every_nth(df: DataFrame, col: str, n: int = 3) -> DataFrame:
    """Every n-th distinct value in ascending order, starting with the first (axis ticks)."""
    ranked = global_rank(df.select(col).distinct(), [col], "_pos")
    return ranked.where(F.col("_pos") % n == 0).select(col)


def page(df: DataFrame, order: Sequence[str | Column], size: int = 25, number: int = 1) -> DataFrame:
    """One page of a table ordered by ``order`` (unique per row), pages counted from 1, in order.

    The sizes of the sorted ranges tell which range holds the page; only its rows are read, however late the page.
    """
    rows, sizes = ranges_in_order(df, order)
    first = (number - 1) * size
    met = sizes.where((F.col("_start") < first + size) & (F.col("_start") + F.col("_n") > first)).collect()    # no more than ``size``
    spans = [((r["_range"] << 33) + max(0, first - r["_start"]), (r["_range"] << 33) + min(r["_n"], first + size - r["_start"])) for r in met]
    inside = reduce(Column.__or__, [(F.col("_at") >= a) & (F.col("_at") < b) for a, b in spans], F.lit(False))
    return rows.where(inside).orderBy("_at").select(*df.columns)
