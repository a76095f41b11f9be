"""Building the three lookup tables from their sources, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import dims, filters, hierarchy, ordering
from tradewind.schema import FACTS
from tradewind.sources.stage import stage


def build_code_table(nomen: DataFrame, control: DataFrame, mode: str = "nearest") -> DataFrame:
    """``commoditycode, parent, description`` and the sort key (``place, place_rank``).

    ``nomen`` is the cleaned nomenclature (``line_no, commoditycode, parent, description``), ``control`` has
    ``commoditycode, description``. Both are read several times and staged for it.
    """
    nomen, control = stage(nomen, "nomenclature"), stage(control, "control")
    rows = hierarchy.split_sections(nomen)[1].select("commoditycode", "parent", "description")
    everything = dims.union_keys(rows.select("commoditycode"), control.select("commoditycode"))
    merged = dims.merge_parent(rows, hierarchy.derive_parent(everything, mode))
    described = dims.merge_description(merged, control)
    return hierarchy.attach_sections(described, hierarchy.section_starts(nomen))


def one_per_start(positions: DataFrame) -> DataFrame:
    """One position per code and name start, so that a port meets at most one."""
    marked = positions.withColumn("start", dims.name_start(F.col("portname")))
    return ordering.first_per_key(marked, ["portcode", "start"], ["portname", "lat", "long"]).drop("start")


def build_port_table(ports: DataFrame, locode: DataFrame, extra: DataFrame, single: bool = True) -> DataFrame:
    """``portname, portcode, type, lat, long``: main ports with positions, a default point where unknown.

    ``single=False`` keeps every position that shares a port's code and name start, one row each.
    """
    coords = dims.merge_missing_ports(locode, extra)
    if single:
        coords = one_per_start(coords)
    return filters.fill_unknown(dims.resolve_ports(dims.keep_main_ports(ports), coords))


def build_country_table(countries: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """``countryname, countrycode, eu, non_eu``, the flags telling on which side a country occurs."""
    def seen(eu: bool) -> DataFrame:
        return dims.union_keys(*[facts[s.name].select(s.country) for s in FACTS.values() if (s.port is None) == eu])
    return dims.flag_membership(countries, "countrycode", {"eu": seen(True), "non_eu": seen(False)})
