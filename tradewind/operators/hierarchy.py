"""The ragged commodity hierarchy: parents, descendants, choices per level, section rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.codes import LEAF_LENGTH, code_label, is_section
from tradewind.operators.ordering import first_per_key, next_in_order
from tradewind.sources.stage import stage


def derive_parent(codes: DataFrame, mode: str = "nearest") -> DataFrame:
    """Parent of every code in a table of distinct codes (column ``commoditycode``).

    ``nearest``: drop two characters until a listed code is found, else blank.
    ``two_step``: drop two characters; if that is not listed drop two more, listed or not.
    """
    code = F.col("commoditycode")
    listed = codes.select(F.col("commoditycode").alias("_listed"))
    shorter = F.substring(code, F.lit(1), F.length(code) - 2)
    if mode == "two_step":
        up = codes.select("commoditycode", F.when(F.length(code) > 2, shorter).otherwise("").alias("_up"))
        again = F.substring(F.col("_up"), F.lit(1), F.greatest(F.length("_up") - 2, F.lit(0)))
        return (up.join(listed, F.col("_up") == F.col("_listed"), "left")
                  .select("commoditycode", F.coalesce("_listed", again).alias("parent")))
    # Every shorter prefix is tried; the length of the longest listed one says which it is.
    lengths = F.when(F.length(code) > 2, F.sequence(F.length(code) - 2, F.lit(1), F.lit(-2)))
    tries = (codes.select("commoditycode", F.explode_outer(lengths).alias("_n"))
                  .select("commoditycode", F.expr("substring(commoditycode, 1, _n)").alias("_try")))
    return (tries.join(listed, F.col("_try") == F.col("_listed"), "left")
                 .groupBy("commoditycode").agg(F.coalesce(F.max(F.length("_listed")), F.lit(0)).alias("_n"))
                 .select("commoditycode", F.expr("substring(commoditycode, 1, _n)").alias("parent")))


def closure(dim: DataFrame) -> DataFrame:
    """``ancestor, commoditycode, distance`` of every code and each code above it (staged), to be stored with the code table.

    Paths double in every round, so a hierarchy of depth d takes log2(d) joins, however published parents lead; codes in a
    circle are below one another and themselves. Codes of full length have no children.
    """
    edges = dim.where((F.col("parent") != "") & (F.length("parent") < LEAF_LENGTH))
    reach, covered = stage(edges.select(F.col("parent").alias("ancestor"), "commoditycode", F.lit(1).alias("distance")).distinct(), "closure"), 1
    while (reach.agg(F.max("distance")).first()[0] or 0) >= covered:
        below = reach.select(F.col("ancestor").alias("_from"), F.col("commoditycode").alias("_to"), F.col("distance").alias("_more"))
        further = reach.join(below, F.col("commoditycode") == F.col("_from")).select(
            "ancestor", F.col("_to").alias("commoditycode"), (F.col("distance") + F.col("_more")).alias("distance"))
        reach = stage(reach.unionByName(further).groupBy("ancestor", "commoditycode").agg(F.min("distance").alias("distance")), "closure")
        covered *= 2
    return reach


def descendants(dim: DataFrame, codes: Sequence[str], reach: DataFrame | None = None) -> DataFrame:
    """All codes below the given ones, roots left out. A filter on the stored ``closure``, which is built if it isn't given."""
    reach = closure(dim) if reach is None else reach
    return reach.where(F.col("ancestor").isin(list(codes))).select("commoditycode").distinct()


def cascade(dim: DataFrame, level: int, codes: Sequence[str] | None, reach: DataFrame | None = None) -> DataFrame:
    """Choices for the selector of ``level`` digits after picking ``codes`` higher up (None or "All": all)."""
    at_level = dim.where(F.length("commoditycode") == level)
    if codes is not None and "All" not in codes:
        at_level = at_level.join(descendants(dim, codes, reach), "commoditycode", "left_semi")
    label = code_label(F.col("commoditycode"), F.col("description"))
    return at_level.select("commoditycode", label.alias("label")).orderBy("commoditycode")


def split_sections(nomen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Section rows (Roman numerals) and code rows."""
    return nomen.where(is_section(F.col("commoditycode"))), nomen.where(~is_section(F.col("commoditycode")))


def section_starts(nomen: DataFrame) -> DataFrame:
    """Each section row with the code on the line below it; ``line_no`` gives the line order."""
    marked = next_in_order(nomen.select("line_no", "commoditycode", "description"),
                           "commoditycode", ["line_no"], "before_code")
    return (marked.where(is_section(F.col("commoditycode")))
                  .select("commoditycode", "description", "before_code"))


def attach_sections(codes: DataFrame, starts: DataFrame) -> DataFrame:
    """Code table with each section placed before its first code, parent blank, one row per code.

    (``place``, ``place_rank``) is the sort key of the finished table.
    """
    rows = codes.select("commoditycode", "parent", "description",
                        F.col("commoditycode").alias("place"), F.lit(1).alias("place_rank"))
    sections = starts.select("commoditycode", F.lit("").alias("parent"), "description",
                             F.col("before_code").alias("place"), F.lit(0).alias("place_rank"))
    return first_per_key(rows.unionByName(sections), "commoditycode", ["place", "place_rank"])
