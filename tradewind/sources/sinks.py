"""Writing: fact tables, guarded loads, description upserts, extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.periods import to_month
from tradewind.operators.extract import with_headers
from tradewind.schema import FactShape

GUARD_ROWS = 50


def create_or_replace(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty table of the given layout."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def with_month(df: DataFrame, shape: FactShape) -> DataFrame:
    return df.withColumn("month", to_month(F.col(shape.period), shape.style))


def lay_out(df: DataFrame, code: str) -> DataFrame:
    """Rows gathered by month for writing, sorted by code.

    Rebalancing lets adaptive execution split a large month over many tasks, and put small ones together,
    by the size the shuffle turns out to have; inside a file the sort lets readers skip by code.
    """
    return df.hint("rebalance", "month").sortWithinPartitions("month", code)


def append_period(df: DataFrame, path: str, shape: FactShape, mode: str = "append") -> None:
    """Add fact rows to a table partitioned by month."""
    dated = df if "month" in df.columns else with_month(df, shape)
    lay_out(dated, shape.code).write.mode(mode).partitionBy("month").parquet(path)


def period_count(fact: DataFrame, col: str, period: str) -> int:
    return fact.where(F.col(col) == period).count()


def guarded_append(new: DataFrame, existing: DataFrame, period: str, threshold: int = GUARD_ROWS) -> DataFrame:
    """New rows of periods that are not loaded yet, that is, hold at most ``threshold`` rows so far."""
    loaded = (existing.groupBy(period).agg(F.count(period).alias("_n"))
                      .where(F.col("_n") > threshold).select(period))
    return new.join(loaded, period, "left_anti")


def upsert_descriptions(batches: DataFrame, key: str, update_cols: Sequence[str],
                        order: Sequence[str | Column]) -> DataFrame:
    """One row per key: ``update_cols`` as last loaded, every other column as first loaded.

    ``order`` says when a row was loaded and is not part of the result.
    """
    order_names = [o for o in order if isinstance(o, str)]
    others = [c for c in batches.columns if c != key and c not in update_cols and c not in order_names]
    when = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    aggs = [F.max_by(F.struct(*update_cols), when).alias("_last")]
    if others:
        aggs.append(F.min_by(F.struct(*others), when).alias("_first"))
    merged = batches.groupBy(key).agg(*aggs)
    return merged.select(*[
        F.col(key) if c == key else F.col("_last" if c in update_cols else "_first")[c].alias(c)
        for c in batches.columns if c not in order_names])


def upsert_table(current: DataFrame, batch: DataFrame, key: str, update_cols: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """The stored table brought up to date with one batch; rows of the table count as loaded before it."""
    kept = current.withColumn("_round", F.lit(0))
    for o in order:
        if o not in kept.columns:
            kept = kept.withColumn(o, F.lit(None).cast(batch.schema[o].dataType))
    both = kept.unionByName(batch.withColumn("_round", F.lit(1)))
    return upsert_descriptions(both, key, update_cols, ["_round", *order])


def write_extract(extract: DataFrame, path: str) -> None:
    """Flat files with display headers."""
    with_headers(extract).write.mode("overwrite").csv(path, header=True, escape='"')
