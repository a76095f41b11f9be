"""One query and everything shown for it: status, legend, graphs, map, series, extract."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.measures import PRICE_PER_KILO
from tradewind.operators import cube, dims, extract, filters, geo, graph
from tradewind.schema import FactShape
from tradewind.sources.stage import stage
from tradewind.spec import QuerySpec


@dataclass
class FlowResult:
    """A query's cube, written once; each view of it is derived from there.

    ``unit`` is price, weight, price_per_kilo or, on the EU side, consignments. ``month`` narrows a view to
    one month of the selection.
    """

    fact: DataFrame
    shape: FactShape
    spec: QuerySpec
    country: DataFrame
    comcode: DataFrame
    port: DataFrame | None = None
    cube: DataFrame = field(init=False)

    def __post_init__(self) -> None:
        self.cube = stage(cube.flow_cube(self.fact, self.shape, self.spec, self.country, self.port), "cube")
        names = self.port if self.port is not None else self.country.select(
            F.col("countryname").alias("portname"), F.col("countrycode").alias("portcode")).limit(0)
        self.lookup = dims.desc_lookup(names, self.country)

    @property
    def is_eu(self) -> bool:
        return self.shape.port is None

    def _cells(self, month: str | None) -> DataFrame:
        return self.cube if month is None else self.cube.where(F.col("month") == month)

    def status(self) -> DataFrame:
        flow = "Imports" if self.shape.flow == "inbound" else "Exports"
        return filters.result_status(self.cube, self.spec.patterns, "EU" if self.is_eu else "Non-EU", flow)

    def legend(self, month: str | None = None) -> DataFrame:
        return dims.code_legend(self._cells(month), self.comcode)

    def graph(self, unit: str = "price", month: str | None = None) -> tuple[DataFrame, DataFrame]:
        """Nodes and links: country, code and (non-EU) port."""
        steps = {("inbound", False): graph.FULL_INBOUND, ("outbound", False): graph.FULL_OUTBOUND,
                 ("inbound", True): graph.EU_INBOUND, ("outbound", True): graph.EU_OUTBOUND}[self.shape.flow, self.is_eu]
        return graph.flow_graph(self._cells(month), steps, self.lookup, unit)

    def country_port_graph(self, unit: str = "price", month: str | None = None) -> tuple[DataFrame, DataFrame]:
        """Nodes and links of countries and ports; the EU side has no ports."""
        if self.is_eu:
            raise ValueError("facts of the EU side have no ports to draw")
        steps = graph.COUNTRY_PORT_INBOUND if self.shape.flow == "inbound" else graph.COUNTRY_PORT_OUTBOUND
        return graph.flow_graph(self._cells(month), steps, self.lookup, unit)

    def totals(self, unit: str = "price", month: str | None = None) -> DataFrame:
        """``country, value``. Price per kilo is a ratio of sums, on the EU side a sum of the pairs' ratios."""
        cells = self._cells(month)
        if unit != PRICE_PER_KILO:
            return filters.select_unit(cube.sum_by(cells, "country"), unit).select("country", "value")
        if self.is_eu:
            return cube.sum_of_ratios(cube.sum_by(cells, "country", "comcode"), ["country"])
        return cube.price_per_kilo(cells, ["country"])

    def map(self, points: DataFrame, unit: str = "price", month: str | None = None,
            region_fixes: dict[str, str] | None = None) -> DataFrame:
        fixes = {} if self.is_eu else region_fixes
        return geo.choropleth(points, self.totals(unit, month), self.country, fixes)

    def scaled_map(self, points: DataFrame, unit: str = "price", month: str | None = None,
                   region_fixes: dict[str, str] | None = None) -> DataFrame:
        """The map with its values in billions or millions (``suffix``), by the largest value on the map."""
        return geo.scale_values(stage(self.map(points, unit, month, region_fixes), "map"))

    def bar_layout(self, dim: str, unit: str = "price", month: str | None = None) -> DataFrame:
        return geo.bar_layout(self.series(dim, unit, month))

    def series(self, dim: str, unit: str = "price", month: str | None = None) -> DataFrame:
        """``month, dim, value``, countries and ports by name."""
        if unit == PRICE_PER_KILO and self.is_eu:
            out = cube.sum_of_ratios(self._cells(month), ["month", dim])
        else:
            out = cube.series(self.cube, dim, unit, month)
        return out if dim == "comcode" else dims.name_series(out, dim, self.lookup)

    def extract(self) -> DataFrame:
        return extract.enrich_extract(self.cube, self.comcode, self.country, self.port)
