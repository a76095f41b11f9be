"""Building and using the lookup tables: commodity codes, ports, countries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.text import is_blank
from tradewind.operators.ordering import first_per_key

LABEL_LENGTH = 30


def coalesce_cols(a: str, b: str, name: str) -> Column:
    return F.coalesce(F.col(a), F.col(b)).alias(name)


def merge_parent(nomen: DataFrame, derived: DataFrame) -> DataFrame:
    """Published parent where there is one, else the derived parent."""
    other = derived.select("commoditycode", F.col("parent").alias("_derived"))
    return nomen.join(other, "commoditycode", "full_outer").select(
        "commoditycode", coalesce_cols("parent", "_derived", "parent"), "description")


def merge_description(nomen: DataFrame, control: DataFrame) -> DataFrame:
    """Published description where there is one, else that of the control files."""
    other = control.select("commoditycode", F.col("description").alias("_control"))
    return nomen.join(other, "commoditycode", "full_outer").select(
        "commoditycode", "parent", coalesce_cols("description", "_control", "description"))


def merge_missing_ports(locode: DataFrame, extra: DataFrame) -> DataFrame:
    """Positions by port name from both sources; names in upper case."""
    other = extra.select(F.col("portname_x").alias("portname"), F.col("portcode").alias("_code"),
                         F.col("lat").alias("_lat"), F.col("long").alias("_long"))
    return locode.join(other, "portname", "full_outer").select(
        F.upper("portname").alias("portname"), coalesce_cols("portcode", "_code", "portcode"),
        coalesce_cols("lat", "_lat", "lat"), coalesce_cols("long", "_long", "long"))


def attach_coords(port: DataFrame, coords: DataFrame) -> DataFrame:
    """Left join of positions by code; ``portname_y`` is the name the position came with."""
    other = coords.select("portcode", F.col("portname").alias("portname_y"), "lat", "long")
    return port.join(other, "portcode", "left").select(
        "portname", "portcode", "type", "portname_y", "lat", "long")


def name_start(name: Column) -> Column:
    """The characters by which two names of a port are compared."""
    return F.substring(name, 1, 3)


def _starts_upper(name: Column) -> Column:
    return F.upper(name_start(name)) == name_start(name)


def keep_main_ports(df: DataFrame) -> DataFrame:
    """Main ports: of a code with several names keep those that start in capitals.

    Rows in capitals stay either way, so only the others need to know whether their code is unique, and
    that comes out of one aggregate.
    """
    rest = [c for c in df.columns if c != "portcode"]
    alone = (df.groupBy("portcode").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
               .where("_n = 1")
               .select(*[F.col("portcode") if c == "portcode" else F.col("_row")[c].alias(c) for c in df.columns]))
    main = _starts_upper(F.col("portname"))
    return df.where(main).unionByName(alone.where(~F.coalesce(main, F.lit(False))))


def resolve_ports(port: DataFrame, coords: DataFrame) -> DataFrame:
    """Ports with positions, keeping of a repeated code the pairs whose names agree on three characters.

    Same rows as ``attach_coords`` followed by that filter, without building every pair of a code: pairs
    that agree come from a join on code and name start, codes that give a single pair from the counts.
    Where several positions share a code and a name start, each of them gives a row; pass the positions
    through ``first_per_key`` on both to get one.
    """
    left = port.select("portcode", name_start(F.col("portname")).alias("_start"), "portname", "type")
    right = coords.select("portcode", name_start(F.col("portname")).alias("_start"), "lat", "long")
    cols = ["portname", "portcode", "type", "lat", "long"]
    agree = left.join(right, ["portcode", "_start"]).select(*cols)

    ports_per = left.groupBy("portcode").agg(
        F.count(F.lit(1)).alias("_ports"),
        F.first(F.struct("portname", "type", "_start")).alias("_port"))
    coords_per = right.groupBy("portcode").agg(
        F.count(F.lit(1)).alias("_coords"),
        F.first(F.struct("lat", "long", "_start")).alias("_coord"))
    single = (ports_per.where("_ports = 1").join(coords_per, "portcode", "left")
                       .where("coalesce(_coords, 1) = 1 and not coalesce(_port._start = _coord._start, false)")
                       .select(F.col("_port.portname").alias("portname"), "portcode",
                               F.col("_port.type").alias("type"),
                               F.col("_coord.lat").alias("lat"), F.col("_coord.long").alias("long")))
    return agree.unionByName(single)


def union_keys(*cols: DataFrame) -> DataFrame:
    """Distinct values of several one-column tables."""
    return reduce(DataFrame.union, [c.distinct() for c in cols]).distinct()


def flag_membership(dim: DataFrame, key: str, sets: dict[str, DataFrame]) -> DataFrame:
    """One boolean column per named set telling whether the key occurs in it."""
    for name, values in sets.items():
        seen = values.toDF("_seen").distinct()
        dim = (dim.join(seen, F.col(key) == F.col("_seen"), "left")
                  .withColumn(name, F.col("_seen").isNotNull()).drop("_seen"))
    return dim


def country_groups(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """EU countries, and countries seen outside the EU side only."""
    eu = dim.where(F.col("eu"))
    return eu, dim.where(F.col("non_eu")).join(eu.select("countrycode"), "countrycode", "left_anti")


def load_dim(df: DataFrame, key: str, order: str) -> DataFrame:
    """Lookup with one row per key (the first by ``order``), sorted."""
    return first_per_key(df, key, [order]).orderBy(order)


def desc_lookup(port: DataFrame, country: DataFrame) -> DataFrame:
    """One name per code: ports before countries, then by name; blank names left out."""
    both = port.select(F.col("portcode").alias("key_name"), F.col("portname").alias("value"), F.lit(0).alias("_rank")) \
        .unionByName(country.select(F.col("countrycode").alias("key_name"), F.col("countryname").alias("value"),
                                    F.lit(1).alias("_rank")))
    named = both.where(~is_blank(F.col("value")))
    return first_per_key(named, "key_name", ["_rank", "value"]).select("key_name", "value")


def name_series(df: DataFrame, col: str, lookup: DataFrame) -> DataFrame:
    """Code column replaced by its name, NULL where the lookup has none."""
    names = lookup.select(F.col("key_name").alias("_key"), F.col("value").alias("_name"))
    return df.join(names, F.col(col) == F.col("_key"), "left").select(
        *[F.col("_name").alias(c) if c == col else F.col(c) for c in df.columns])


def node_label(df: DataFrame, lookup: DataFrame, col: str = "name") -> DataFrame:
    """``label``: name cut to 30 characters, or the code itself."""
    names = lookup.select(F.col("key_name").alias("_key"), F.col("value").alias("_name"))
    return (df.join(names, F.col(col) == F.col("_key"), "left")
              .withColumn("label", F.coalesce(F.substring("_name", 1, LABEL_LENGTH), F.col(col)))
              .drop("_key", "_name"))


def code_legend(result: DataFrame, dim: DataFrame) -> DataFrame:
    """Codes that occur in a result, with descriptions, sorted."""
    used = result.select(F.col("comcode").alias("commoditycode")).distinct()
    return (used.join(dim.select("commoditycode", "description"), "commoditycode", "left")
                .orderBy("commoditycode"))
