"""Intermediate tables in the cluster's shared folder.

A result that several later steps read (a cube, the links of a graph, a lookup) is written once, so the
fact table behind it is scanned once and a lost executor costs no recomputation of it. The folder is the
one named by ``spark.checkpoint.dir``; tables lie under ``tradewind/<application id>`` and may be removed
once the application has ended.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_staged: list[str] = []         # tables written by this process


def shared_folder(spark: SparkSession) -> str:
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tradewind-")
    return _local_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """The path of a folder that does not exist yet, in the shared folder."""
    return f"{shared_folder(spark)}/tradewind/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` now and return it as a table with known size; ``by`` names a column to lay folders out by."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.option("compression", "zstd")         # its buffers are freed at once, unlike snappy's direct memory
    (writer if by is None else writer.partitionBy(by)).parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_so_far() -> int:
    """A mark in the list of staged tables, for ``staged_since``."""
    return len(_staged)


def staged_since(mark: int) -> list[str]:
    return _staged[mark:]


def reads_staged(df: DataFrame, paths: list[str]) -> bool:
    """Whether a table still rests on one of the staged tables."""
    names = {path.rsplit("/", 1)[-1] for path in paths}
    return bool(names) and any(names & set(file.split("/")) for file in df.inputFiles())


def remove_staged(spark: SparkSession, paths: list[str]) -> None:
    """Deletes staged tables; nothing that is still to be read may rest on them."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
