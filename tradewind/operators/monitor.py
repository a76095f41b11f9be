"""Checks on what has been loaded: records and food trade per month, missing files, load report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import periods
from tradewind.functions.codes import in_chapters
from tradewind.operators.filters import exclude_years, valid_eu_period
from tradewind.schema import FACTS, FactShape

# Names of the four flows in the reports.
FLOWS = ("Import", "Export", "Arrival", "Dispatch")
# Measure each flow contributes to the food balance.
FOOD_MEASURES = {"imports": "quantity_1", "exports": "quantity_1",
                 "arrivals": "smk_stat_value", "dispatches": "smk_stat_value"}


def _per_period(rows: DataFrame, shape: FactShape, measure) -> DataFrame:
    """Measure per ``YYYYMM`` period; EU periods that do not start 020 are left out.

    ``measure`` is built from the grouping column. A stored table is grouped by its partition column, so a
    plain count opens no column at all.
    """
    if shape.port is None:
        rows = valid_eu_period(rows, shape.period)
    stored = "month" in rows.columns
    col = "month" if stored else shape.period
    by = rows.groupBy(F.col(col).alias("period")).agg(measure(col).alias("records"))
    month = F.col("period") if stored else periods.to_month(F.col("period"), shape.style)
    return by.select(periods.from_month(month, "YYYYMM").alias("period"), "records")


def records_per_period(fact: DataFrame, shape: FactShape) -> DataFrame:
    """Rows per period (the row for a missing period counts 0, as the count is of the period)."""
    return _per_period(fact, shape, F.count)


def chapter_balance(fact: DataFrame, shape: FactShape, measure: str | None = None,
                    first: int = 1, last: int = 23) -> DataFrame:
    """Sum of a measure per period over a range of chapters (food by default)."""
    food = fact.where(in_chapters(F.col(shape.code), first, last))
    return _per_period(food, shape, lambda _: F.sum(measure or FOOD_MEASURES[shape.name]))


def records_of_flows(flows: DataFrame, measure: Column | None = None) -> DataFrame:
    """``type, period, records`` of all four flows from one table with ``table_name`` and ``month``, in one pass.

    ``measure`` is an aggregate, the number of rows by default. EU periods that do not start 020 are left out.
    """
    eu = [s.name for s in FACTS.values() if s.port is None]
    valid = flows.where(~F.col("table_name").isin(eu) | F.col("month").startswith("20"))
    names = F.create_map(*[F.lit(x) for pair in zip(FACTS, FLOWS) for x in pair])
    by = valid.groupBy("table_name", "month").agg((F.count("month") if measure is None else measure).alias("records"))
    return by.select(F.element_at(names, F.col("table_name")).alias("type"), periods.from_month(F.col("month"), "YYYYMM").alias("period"), "records")


def balance_of_flows(flows: DataFrame, first: int = 1, last: int = 23) -> DataFrame:
    """As ``chapter_balance`` for all four flows at once: ``comcode`` and each flow's measure, ``price`` or ``weight``, are needed too."""
    by_weight = [t for t, m in FOOD_MEASURES.items() if m == dict(FACTS[t].measures)["weight"]]
    food = flows.where(in_chapters(F.col("comcode"), first, last))
    return records_of_flows(food, F.sum(F.when(F.col("table_name").isin(by_weight), F.col("weight")).otherwise(F.col("price"))))


def pivot_flows(records: DataFrame) -> DataFrame:
    """One column per flow from ``type, period, records``, for the periods that have imports."""
    def of(name: str) -> Column:
        return F.max(F.when(F.col("type") == name, F.col("records"))).alias(name)
    wide = records.groupBy("period").agg(F.bool_or(F.col("type") == FLOWS[0]).alias("_any"), *[of(n) for n in FLOWS])
    return wide.where("_any").drop("_any")


def align_by_period(imports: DataFrame, exports: DataFrame, arrivals: DataFrame, dispatches: DataFrame) -> DataFrame:
    """One column per flow, for the periods that have imports."""
    out = imports.select("period", F.col("records").alias(FLOWS[0]))
    for name, side in zip(FLOWS[1:], (exports, arrivals, dispatches)):
        out = out.join(side.select("period", F.col("records").alias(name)), "period", "left")
    return out


def to_long(aligned: DataFrame, excluded_years: Sequence[str] = ()) -> DataFrame:
    """``period, type, records``, rows without records kept."""
    long = aligned.unpivot("period", list(FLOWS), "type", "records")
    return exclude_years(long, "period", excluded_years) if excluded_years else long


def expected_files(span: DataFrame, families: dict[str, str]) -> DataFrame:
    """File names ``FAMILYYYMM`` for every family and month; ``span`` has one row, ``first`` and ``last``
    month as ``yyyy-MM``."""
    months = F.sequence(periods.month_start(F.col("first")), periods.month_start(F.col("last")),
                        F.expr("interval 1 month"))
    pairs = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(f).alias("family")) for t, f in families.items()])
    return (span.select(F.explode(months).alias("_m"))
                .select("_m", F.explode(pairs).alias("_f"))
                .select("_f.table_name", F.date_format("_m", "yyyy-MM").alias("month"),
                        F.concat("_f.family", F.date_format("_m", "yyMM")).alias("file")))


def missing_files(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files that are not present (column ``file``)."""
    return expected.join(present.select("file"), "file", "left_anti")


def load_report(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """Every expected file with its rows and rejects; ``counts`` has ``file, loaded, rejected``."""
    loaded = counts.select("file", F.col("loaded").alias("rows"), F.col("rejected").alias("rejects"))
    state = F.when(F.col("rows").isNull(), "missing").when(F.col("rejects") > 0, "rejects").otherwise("loaded")
    return expected.join(loaded, "file", "left").select(
        "file", state.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("rejects", F.lit(0)).alias("rejects"))
