"""Reading the published code lists that the lookups are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.text import parse_latitude, parse_longitude, strip_spaces
from tradewind.operators.filters import drop_blank
from tradewind.schema import LOCODE_SCHEMA, MISSING_PORTS_SCHEMA, FactShape
from tradewind.sources.files import safe_names

_DESCRIPTION_PLACE = 7      # the eighth column holds the description


def clean_nomenclature(raw: DataFrame) -> DataFrame:
    """``line_no, commoditycode, parent, description`` with spaces out of the codes; rows without code dropped.

    ``raw`` has ``line_no, code_1, parent_1, description``.
    """
    return (raw.select("line_no", strip_spaces(F.col("code_1")).alias("commoditycode"),
                       strip_spaces(F.col("parent_1")).alias("parent"), "description")
               .where(F.col("commoditycode").isNotNull()))


def read_nomenclature(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated nomenclature, in file order (``line_no``)."""
    raw = spark.read.csv(path, sep=";", header=True, escape='"', multiLine=False)
    return clean_nomenclature(raw.select(
        F.monotonically_increasing_id().alias("line_no"), F.col("Code_1").alias("code_1"),
        F.col("Parent_1").alias("parent_1"), F.col(f"`{raw.columns[_DESCRIPTION_PLACE]}`").alias("description")))


def shape_locode(raw: DataFrame, country: str = "GB", lon_layout: str = "DDDMM") -> DataFrame:
    """``portcode, portname, lat, long`` of one country from location code rows; rows without position dropped."""
    picked = raw.where(F.col("x2") == country).where(F.col("x11").isNotNull())
    return picked.select(F.col("x3").alias("portcode"), F.col("x5").alias("portname"),
                         parse_latitude(F.col("x11")).alias("lat"),
                         parse_longitude(F.col("x11"), lon_layout).alias("long"))


def read_locode(spark: SparkSession, paths: str | Sequence[str], country: str = "GB",
                lon_layout: str = "DDDMM") -> DataFrame:
    """All headerless location code list files of a glob, stacked."""
    raw = spark.read.schema(LOCODE_SCHEMA).csv(paths, escape='"')
    return shape_locode(raw, country, lon_layout)


def read_missing_ports(spark: SparkSession, path: str) -> DataFrame:
    """Hand-made port positions; names may be quoted, ``NA`` means missing."""
    return spark.read.schema(MISSING_PORTS_SCHEMA).csv(path, header=True, quote='"', nullValue="NA",
                                                       enforceSchema=True)


def type_code_list(raw: DataFrame, names: Sequence[str], type_: str | None = None) -> DataFrame:
    """Name the columns of a two-column list, tag the rows, drop those without a name."""
    out = drop_blank(raw.toDF(*names), names[0])
    return out if type_ is None else out.withColumn("type", F.lit(type_))


def read_code_list(spark: SparkSession, path: str, names: Sequence[str] = ("portname", "portcode"),
                   type_: str | None = None) -> DataFrame:
    """A sheet exported as CSV, one title row on top."""
    schema = ", ".join(f"{n} string" for n in names)
    return type_code_list(spark.read.schema(schema).csv(path, header=True, enforceSchema=True), names, type_)


def fact_schema(shape: FactShape) -> T.StructType:
    """Stored layout of a fact table; ``month`` is the partition column and stays text."""
    cols = [T.StructField(n, T.LongType() if n in shape.integers else T.StringType()) for n in safe_names(shape.columns)]
    return T.StructType(cols + [T.StructField("month", T.StringType())])


def read_facts(spark: SparkSession, path: str, shape: FactShape) -> DataFrame:
    """A stored fact table. Given its layout, so that months are not read as dates and no file is opened
    to plan a query; columns a file lacks are NULL."""
    return spark.read.schema(fact_schema(shape)).parquet(path)
