"""Everything shown for one query of a user, as ``FlowResult`` derives it from the query's cube."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.measures import PRICE_PER_KILO
from tradewind.plans.explore import FlowResult
from tradewind.plans.flows import CHAPTERS_1998
from tradewind.plans.registry import query
from tradewind.schema import FACTS
from tradewind.sources.stage import stage
from tradewind.spec import QuerySpec

_WHERE = "comcode[1:2] IN ('01', '02', '03', '04', '05') AND month BETWEEN '1998-01' AND '1998-12'"
_CUBES = {"imports": "imp_cube", "exports": "exp_cube", "arrivals": "arr_cube", "dispatches": "disp_cube"}
_LABEL = "coalesce((SELECT value[1:30] FROM lookup WHERE key_name = {0}), {0})"


def run_query(v, name: str, spec: QuerySpec = CHAPTERS_1998) -> FlowResult:
    return FlowResult(v.fact(name, spec.start, spec.end), FACTS[name], spec, v.country(), stage(v.codes(), "codes"), v.port() if FACTS[name].port else None)


def _of_each(v, build) -> DataFrame:
    """All four flows, from line items joined once."""
    v.keep_base()
    return reduce(DataFrame.unionByName, [build(run_query(v, name)).select(F.lit(name).alias("flow"), "*") for name in FACTS])


@query("screen_status", " UNION ALL ".join(
    f"SELECT '{side}' AS side, '{flow}' AS flow, count(*) AS rows, '{codes}' AS codes, count(*) = 0 AS is_empty FROM {_CUBES[name]} WHERE {where}"
    for name, side, flow in (("imports", "Non-EU", "Imports"), ("dispatches", "EU", "Exports"))
    for codes, where in (("01,02,03,04,05", _WHERE), ("99", "comcode LIKE '99______'"))))
def screen_status(v):
    """A query that finds something and one that does not, on either side."""
    nothing = QuerySpec(codes2=("99",))
    return reduce(DataFrame.unionByName, [run_query(v, name, spec).status() for name in ("imports", "dispatches") for spec in (CHAPTERS_1998, nothing)])


@query("screen_legends", " UNION ALL ".join(
    f"SELECT DISTINCT '{name}' AS flow, c.comcode AS commoditycode, d.description FROM {cube} c LEFT JOIN codes d ON d.commoditycode = c.comcode "
    f"WHERE {_WHERE} AND month = '1998-06'" for name, cube in _CUBES.items()))
def screen_legends(v):
    return _of_each(v, lambda r: r.legend("1998-06"))


@query("screen_totals", " UNION ALL ".join(
    [f"SELECT '{name}' AS flow, 'weight' AS unit, country, sum(weight)::double AS value FROM {cube} WHERE {_WHERE} GROUP BY country" for name, cube in _CUBES.items()]
    + [f"SELECT '{name}', 'price_per_kilo', country, round(sum(price)::double / nullif(sum(weight), 0)::double, 6) FROM {_CUBES[name]} WHERE {_WHERE} GROUP BY country"
       for name in ("imports", "exports")]
    + [f"SELECT '{name}', 'price_per_kilo', country, round(sum(r), 6) FROM (SELECT country, sum(price)::double / nullif(sum(weight), 0)::double AS r "
       f"FROM {_CUBES[name]} WHERE {_WHERE} GROUP BY country, comcode) GROUP BY country" for name in ("arrivals", "dispatches")]))
def screen_totals(v):
    def of(r: FlowResult) -> DataFrame:
        return r.totals("weight").select(F.lit("weight").alias("unit"), "country", F.col("value").cast("double").alias("value")).unionByName(
            r.totals(PRICE_PER_KILO).select(F.lit("price_per_kilo").alias("unit"), "country", F.round("value", 6).alias("value")))
    return _of_each(v, of)


@query("screen_series", " UNION ALL ".join(
    f"SELECT '{name}' AS flow, month, (SELECT value FROM lookup WHERE key_name = s.country) AS country, value FROM "
    f"(SELECT month, country, sum(price)::bigint AS value FROM {cube} WHERE {_WHERE} GROUP BY month, country) s" for name, cube in _CUBES.items()))
def screen_series(v):
    return _of_each(v, lambda r: r.series("country"))


def _named(r: FlowResult, nodes: DataFrame, links: DataFrame) -> DataFrame:
    names = nodes.select("id", "label")
    return (links.join(names.toDF("source_id", "source"), "source_id").join(names.toDF("target_id", "target"), "target_id")
                 .select("source", "target", F.col("value").cast("bigint").alias("value")))


def _links(name: str, cube: str, source: str, target: str) -> str:
    return (f"SELECT '{name}' AS flow, {_LABEL.format('s')} AS source, {_LABEL.format('t')} AS target, value FROM (SELECT {source} AS s, {target} AS t, "
            f"sum(price)::bigint AS value FROM {cube} WHERE {_WHERE} AND month = '1998-06' GROUP BY ALL)")


@query("screen_links", " UNION ALL ".join([
    _links("imports", "imp_cube", "country", "comcode"), _links("imports", "imp_cube", "comcode", "port"),
    _links("exports", "exp_cube", "comcode", "country"), _links("exports", "exp_cube", "port", "comcode"),
    _links("arrivals", "arr_cube", "country", "comcode"), _links("dispatches", "disp_cube", "comcode", "country")]))
def screen_links(v):
    """The links of the flow graph of one month, its ends by label."""
    return _of_each(v, lambda r: _named(r, *r.graph("price", "1998-06")))


@query("screen_map", f"""
WITH totals AS (SELECT country, sum(price) AS value FROM exp_cube WHERE {_WHERE} GROUP BY country),
mapped AS (SELECT countryname AS region, grp, ord, lng, lat, value FROM map_points JOIN totals ON country = CASE WHEN region = 'RS' THEN 'XS' ELSE region END
  LEFT JOIN country ON countrycode = region)
SELECT region, grp, ord, lng, lat, round(value::double / CASE WHEN top > 1e12 THEN 1e9 WHEN top > 1e9 THEN 1e6 ELSE 1.0 END::double, 6) AS value,
  CASE WHEN top > 1e12 THEN 'b' WHEN top > 1e9 THEN 'm' ELSE '' END AS suffix FROM mapped, (SELECT max(value) AS top FROM mapped)""")
def screen_map(v):
    scaled = run_query(v, "exports").scaled_map(v.map_points())
    return scaled.withColumn("value", F.round("value", 6))
