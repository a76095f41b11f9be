"""A stored fact table made of loads, and the manifest that says which of them count.

Each load writes its rows under ``facts/load_id=.../month=...`` and then one line per month under ``manifest/load_id=...``. Rows without
a line in the manifest do not exist for readers, so a load that dies half-way leaves nothing behind that counts. A line names
the issue of the month and the loads that it replaces; of each month, the lines of the highest issue count that no other
line replaces. So a later issue takes a month over once it is there, whichever came first, and compaction swaps the loads of
a month for one with the same rows in a single step.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.schema import FactShape
from tradewind.sources.sinks import GUARD_ROWS, append_period
from tradewind.sources.stage import stage
from tradewind.sources.tables import fact_schema

MANIFEST = "month string, issue int, rows long, replaces array<string>, load_id string"


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The Parquet files under a folder, None if there is no such folder."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def live_months(spark: SparkSession, dst: str, without: str | None = None) -> DataFrame:
    """``month, load_id, issue, rows`` of the loads that count; ``without`` leaves one load out of account.

    Rows without a readable month have no issue: every load of them counts unless it is replaced.
    """
    lines = read_or_none(spark, f"{dst}/manifest", MANIFEST)
    if lines is None:
        return spark.createDataFrame([], "month string, load_id string, issue int, rows long")
    if without is not None:
        lines = lines.where(F.col("load_id") != without)
    gone = lines.select(F.col("month").alias("_m"), F.explode("replaces").alias("_gone"))
    left = lines.join(gone, F.col("month").eqNullSafe(F.col("_m")) & (F.col("load_id") == F.col("_gone")), "left_anti")
    top = left.groupBy(F.col("month").alias("_m")).agg(F.max("issue").alias("_top"))
    live = left.join(top, F.col("month").eqNullSafe(F.col("_m")))
    return live.where(F.col("month").isNull() | (F.col("issue") == F.col("_top"))).select("month", "load_id", "issue", "rows")


def _stored(spark: SparkSession, dst: str, shape: FactShape) -> DataFrame:
    layout = T.StructType(fact_schema(shape).fields + [T.StructField("load_id", T.StringType())])
    found = read_or_none(spark, f"{dst}/facts", layout)
    return spark.createDataFrame([], layout) if found is None else found


def _of(rows: DataFrame, live: DataFrame) -> DataFrame:
    keys = live.select(F.col("month").alias("_m"), F.col("load_id").alias("_l")).distinct()
    return rows.join(keys, F.col("month").eqNullSafe(F.col("_m")) & (F.col("load_id") == F.col("_l")), "left_semi")


def read_store(spark: SparkSession, dst: str, shape: FactShape) -> DataFrame:
    """The rows that count, with ``month`` and ``load_id``; both are folders, so what does not count is not opened."""
    return _of(_stored(spark, dst, shape), live_months(spark, dst))


def admit(records: DataFrame, live: DataFrame, threshold: int = GUARD_ROWS) -> DataFrame:
    """Of new records with ``month`` and ``issue``, those that go in.

    A month's highest issue among them counts. It goes in if it is higher than the stored one, or the same and the store has
    no more than ``threshold`` rows of the month. Records without a month always go in.
    """
    top = records.groupBy(F.col("month").alias("_m")).agg(F.max("issue").alias("_new"))
    have = live.groupBy(F.col("month").alias("_h")).agg(F.max("issue").alias("_old"), F.sum("rows").alias("_rows"))
    rule = (top.join(have, F.col("_m") == F.col("_h"), "left")
               .where(F.col("_old").isNull() | (F.col("_new") > F.col("_old")) | ((F.col("_new") == F.col("_old")) & (F.col("_rows") <= threshold)))
               .select("_m", "_new"))
    return records.join(rule, F.col("month").eqNullSafe(F.col("_m")) & (F.col("month").isNull() | (F.col("issue") == F.col("_new"))), "left_semi")


def write_load(records: DataFrame, dst: str, shape: FactShape, load_id: str, threshold: int = GUARD_ROWS) -> DataFrame:
    """Stores the records with ``month`` and ``issue`` that go in, and returns ``file`` of each row stored. A load that is run again replaces itself."""
    spark = records.sparkSession
    good = admit(records, live_months(spark, dst, without=load_id), threshold)
    append_period(good, f"{dst}/facts/load_id={load_id}", shape, mode="overwrite")
    written = spark.read.schema("file string, issue int, month string").parquet(f"{dst}/facts/load_id={load_id}")
    _commit(written.groupBy("month").agg(F.max("issue").alias("issue"), F.count(F.lit(1)).alias("rows")).withColumn(
        "replaces", F.array().cast("array<string>")), dst, load_id)
    return written.select("file")


def _commit(lines: DataFrame, dst: str, load_id: str) -> None:
    """The step that makes a load count: one small file."""
    lines.coalesce(1).write.mode("overwrite").parquet(f"{dst}/manifest/load_id={load_id}")


def compact(spark: SparkSession, dst: str, shape: FactShape, least: int = 2) -> str | None:
    """Merges the loads of every month that has ``least`` or more, and returns the id of the load that takes their place.

    The rows are written first, under an id that nothing refers to; the manifest line, written last, brings them in and
    the old loads out. Dying in between changes nothing. A large month is written by many tasks (see ``lay_out``).
    """
    live = live_months(spark, dst)
    many = live.groupBy("month").agg(F.count(F.lit(1)).alias("_n"), F.max("issue").alias("issue"), F.sum("rows").alias("rows"),
                                     F.array_sort(F.collect_list("load_id")).alias("replaces")).where(F.col("_n") >= least)
    plan = stage(many.drop("_n"), "compaction")
    if plan.isEmpty():
        return None
    load_id = f"compact-{uuid.uuid4().hex}"
    old = plan.select("month", F.explode("replaces").alias("load_id"))
    append_period(_of(_stored(spark, dst, shape), old).drop("load_id"), f"{dst}/facts/load_id={load_id}", shape, mode="overwrite")
    _commit(plan, dst, load_id)
    return load_id


def dead_folders(spark: SparkSession, dst: str, shape: FactShape) -> DataFrame:
    """``month, load_id`` of stored rows that do not count any more, for whoever removes files."""
    live = live_months(spark, dst).select(F.col("month").alias("_m"), F.col("load_id").alias("_l"))
    found = _stored(spark, dst, shape).select("month", "load_id").distinct()
    return found.join(live, F.col("month").eqNullSafe(F.col("_m")) & (F.col("load_id") == F.col("_l")), "left_anti")


def adopt(spark: SparkSession, dst: str, shape: FactShape) -> None:
    """Manifest lines, as first issues, for loads that were stored without a manifest. Running it again changes nothing."""
    lines = read_or_none(spark, f"{dst}/manifest", MANIFEST)
    found = _stored(spark, dst, shape).groupBy("load_id", "month").agg(F.count(F.lit(1)).alias("rows"))
    if lines is not None:
        found = found.join(lines.select("load_id").distinct(), "load_id", "left_anti")
    new = stage(found.select("month", F.lit(1).alias("issue"), "rows", F.array().cast("array<string>").alias("replaces"), "load_id"), "adopted")
    if not new.isEmpty():
        new.repartition("load_id").write.mode("append").partitionBy("load_id").parquet(f"{dst}/manifest")
