"""The flat extract: cube rows with every code spelled out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.codes import code_prefix

# Column headers of the extract files.
HEADERS = {
    "comcode2": "2-Digit Comcode", "description2": "2-Digit Description", "comcode": "Commodity Code",
    "port": "Port Code", "portname": "Port Name", "type": "Port Type", "country": "Country Code",
    "countryname": "Country Name", "month": "Month", "price": "Value (£)", "weight": "Weight (kg)",
    "consignments": "Number of Consignments", "description": "Commodity Description",
}
NON_EU_EXTRACT = ["comcode2", "description2", "comcode", "port", "portname", "type", "country",
                  "countryname", "month", "price", "weight", "description"]
EU_EXTRACT = ["comcode2", "description2", "comcode", "country", "countryname", "month", "price",
              "consignments", "description"]


def enrich_extract(cube: DataFrame, comcode: DataFrame, country: DataFrame,
                   port: DataFrame | None = None) -> DataFrame:
    """Cube with the description of each code and of its chapter, port and country names.

    The lookups must hold one row per key. The chapter description comes from the same lookup, by the
    first two digits.
    """
    chapter = comcode.where(F.length("commoditycode") == 2).select(
        F.col("commoditycode").alias("comcode2"), F.col("description").alias("description2"))
    item = comcode.select(F.col("commoditycode").alias("comcode"), "description")
    names = country.select(F.col("countrycode").alias("country"), "countryname")
    out = (cube.withColumn("comcode2", code_prefix(F.col("comcode"), 2))
               .join(item, "comcode", "left").join(names, "country", "left").join(chapter, "comcode2", "left"))
    if port is None:
        return out.select(*EU_EXTRACT)
    gate = port.select(F.col("portcode").alias("port"), "portname", "type")
    return out.join(gate, "port", "left").select(*NON_EU_EXTRACT)


def with_headers(extract: DataFrame) -> DataFrame:
    return extract.select(*[F.col(c).alias(HEADERS[c]) for c in extract.columns])
