"""Queries that shape a cube for display: graphs, maps, legends, named series, extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions import text
from tradewind.operators import cube, dims, extract, filters, geo, graph
from tradewind.plans.flows import ALL, CHAPTERS_1998, cube_of
from tradewind.plans.registry import query
from tradewind.sources.stage import stage


def _lookup(v):
    return dims.desc_lookup(v.port(), v.country())


# --- graphs


def _links_sql(table: str, steps, where: str = "TRUE", unit: str = "price") -> str:
    parts = [f"SELECT {i} AS step, {a} AS source, {b} AS target, cast(sum({unit}) AS bigint) AS value FROM {table} "
             f"WHERE {where} GROUP BY ALL" for i, (a, b) in enumerate(steps)]
    return "links AS (" + " UNION ALL ".join(parts) + ")"


# Stacked links, sorted inside each step; nodes in order of first appearance, all sources before all targets.
_NODES = """stacked AS (SELECT *, row_number() OVER (ORDER BY step, source, target) AS pos FROM links),
ends AS (SELECT source AS name, pos FROM stacked UNION ALL SELECT target, pos + (SELECT count(*) FROM links) FROM stacked),
nodes AS (SELECT name, row_number() OVER (ORDER BY min(pos)) - 1 AS id FROM ends GROUP BY name)"""
_NODE_ROWS = """SELECT n.id, n.name, coalesce(l.value[1:30], n.name) AS label FROM nodes n LEFT JOIN lookup l ON n.name = l.key_name"""
_LINK_ROWS = """SELECT s.id AS source_id, t.id AS target_id, value FROM links JOIN nodes s ON s.name = source JOIN nodes t ON t.name = target"""
_SLICE = "comcode[1:2] BETWEEN '01' AND '05' AND month BETWEEN '1998-01' AND '1998-12'"


def _graph(key: str, table: str, fact: str, steps, what: str, spec=ALL, where: str = "TRUE", unit: str = "price") -> None:
    rows = _NODE_ROWS if what == "nodes" else _LINK_ROWS

    @query(key, f"WITH {_links_sql(table, steps, where, unit)}, {_NODES} {rows}")
    def build(v):
        facts = cube_of(v, fact, spec, graph.ends_of(steps))
        return graph.flow_graph(facts, steps, _lookup(v), unit)[0 if what == "nodes" else 1]


_graph("flow_nodes", "imp_cube", "imports", graph.FULL_INBOUND, "nodes")
_graph("flow_links", "imp_cube", "imports", graph.FULL_INBOUND, "links")
_graph("export_flow_nodes", "exp_cube", "exports", graph.FULL_OUTBOUND, "nodes")
_graph("export_flow_links", "exp_cube", "exports", graph.FULL_OUTBOUND, "links")
_graph("country_port_nodes", "imp_cube", "imports", graph.COUNTRY_PORT_INBOUND, "nodes")
_graph("country_port_links", "imp_cube", "imports", graph.COUNTRY_PORT_INBOUND, "links")
_graph("port_country_links", "exp_cube", "exports", graph.COUNTRY_PORT_OUTBOUND, "links")
_graph("eu_flow_nodes", "arr_cube", "arrivals", graph.EU_INBOUND, "nodes")
_graph("eu_flow_links", "arr_cube", "arrivals", graph.EU_INBOUND, "links")
_graph("eu_dispatch_links", "disp_cube", "dispatches", graph.EU_OUTBOUND, "links")
_graph("eu_consignment_links", "arr_cube", "arrivals", graph.EU_INBOUND, "links", unit="consignments")
_graph("weight_flow_links", "exp_cube", "exports", graph.FULL_OUTBOUND, "links", unit="weight")
_graph("selected_flow_nodes", "imp_cube", "imports", graph.FULL_INBOUND, "nodes", CHAPTERS_1998, _SLICE)
_graph("selected_flow_links", "imp_cube", "imports", graph.FULL_INBOUND, "links", CHAPTERS_1998, _SLICE)


@query("stack_links", f"WITH {_links_sql('imp_cube', graph.FULL_INBOUND)} SELECT * FROM links")
def stack_links(v):
    return graph.stack_links(cube_of(v, "imports", keys=graph.ends_of(graph.FULL_INBOUND)), graph.FULL_INBOUND)


@query("ppk_links", """
SELECT 0 AS step, comcode AS source, country AS target, round(sum(price)::double / nullif(sum(weight), 0)::double, 6) AS value FROM exp_cube GROUP BY ALL
UNION ALL SELECT 1, port, comcode, round(sum(price)::double / nullif(sum(weight), 0)::double, 6) FROM exp_cube GROUP BY ALL""")
def ppk_links(v):
    cells = cube_of(v, "exports", keys=graph.ends_of(graph.FULL_OUTBOUND))
    links = graph.stack_links(cells, graph.FULL_OUTBOUND, "price_per_kilo")
    return links.withColumn("value", F.round("value", 6))


@query("node_labels", "SELECT code, coalesce(l.value[1:30], code) AS label FROM (SELECT coalesce(coo_alpha, '??') AS code FROM imports "
                      "UNION SELECT port_alpha FROM imports UNION SELECT comcode FROM imports) c LEFT JOIN lookup l ON code = key_name")
def node_labels(v):
    rows = stage(v.imports().select("coo_alpha", "port_alpha", "comcode").distinct(), "codes")
    codes = dims.union_keys(rows.select(F.coalesce("coo_alpha", F.lit("??"))), rows.select("port_alpha"),
                            rows.select("comcode")).toDF("code")
    return dims.node_label(codes, _lookup(v), "code")


# --- maps


_TOTALS = "totals AS (SELECT country, cast(sum(price) AS bigint) AS value FROM imp_cube GROUP BY 1)"
_MAPPED = f"""{_TOTALS}, mapped AS (SELECT k.countryname AS region, p.grp, p.ord, p.lng, p.lat, t.value
  FROM (SELECT CASE WHEN region = '05' THEN '04' ELSE region END AS code, * FROM map_points) p
  LEFT JOIN totals t ON p.code = t.country LEFT JOIN country k ON p.code = k.countrycode WHERE t.value IS NOT NULL)"""


def _totals(v):
    return cube.country_totals(filters.select_unit(cube_of(v, "imports", keys=("country",)), "price"))


def _mapped(v):
    return geo.choropleth(v.map_points(), _totals(v), v.country(), {"05": "04"})


@query("choropleth", f"WITH {_MAPPED} SELECT * FROM mapped")
def choropleth(v):
    return _mapped(v)


@query("eu_choropleth", """
WITH totals AS (SELECT country, cast(sum(consignments) AS bigint) AS value FROM arr_cube GROUP BY 1)
SELECT k.countryname AS region, p.grp, p.ord, p.lng, p.lat, t.value FROM map_points p
LEFT JOIN totals t ON p.region = t.country LEFT JOIN country k ON p.region = k.countrycode WHERE t.value IS NOT NULL""")
def eu_choropleth(v):
    totals = cube.country_totals(filters.select_unit(cube_of(v, "arrivals", keys=("country",)), "consignments"))
    return geo.choropleth(v.map_points(), totals, v.country(), {})


@query("ppk_choropleth", """
WITH totals AS (SELECT country, round(sum(price)::double / nullif(sum(weight), 0)::double, 6) AS value FROM exp_cube GROUP BY 1)
SELECT k.countryname AS region, p.grp, p.ord, p.lng, p.lat, t.value FROM map_points p
LEFT JOIN totals t ON p.region = t.country LEFT JOIN country k ON p.region = k.countrycode WHERE t.value IS NOT NULL""")
def ppk_choropleth(v):
    ratios = cube.price_per_kilo(cube_of(v, "exports", keys=("country",)), ["country"])
    return geo.choropleth(v.map_points(), ratios.withColumn("value", F.round("value", 6)), v.country(), {})


@query("ring_attributes", f"WITH {_MAPPED} SELECT DISTINCT region, grp, value FROM mapped")
def ring_attributes(v):
    return geo.ring_attributes(_mapped(v))


@query("polygon_rings", f"WITH {_MAPPED} SELECT grp, cast(floor(ord / 10000) AS bigint) AS piece, count(*) AS points, "
                        "string_agg(cast(lng AS varchar) || ' ' || cast(lat AS varchar), ',' ORDER BY ord) AS ring FROM mapped GROUP BY ALL")
def polygon_rings(v):
    point = lambda p: F.concat(p["lng"].cast("string"), F.lit(" "), p["lat"].cast("string"))
    return geo.polygon_rings(_mapped(v)).select(
        "grp", "piece", F.size("ring").cast("bigint").alias("points"),
        F.array_join(F.transform("ring", point), ",").alias("ring"))


_SCALED = f"""{_TOTALS}, top AS (SELECT max(value) AS m FROM totals),
scaled AS (SELECT country, CASE WHEN m > 1e12 THEN value::double / 1e9 WHEN m > 1e9 THEN value::double / 1e6 ELSE value::double END AS value,
  CASE WHEN m > 1e12 THEN 'b' WHEN m > 1e9 THEN 'm' ELSE '' END AS suffix FROM totals, top)"""


@query("scaled_totals", f"WITH {_SCALED} SELECT country, round(value, 6) AS value, suffix FROM scaled")
def scaled_totals(v):
    return geo.scale_values(stage(_totals(v), "totals")).withColumn("value", F.round("value", 6))


@query("value_labels", f"""WITH {_SCALED}
SELECT country, 'Price' AS title, '£' || cast(cast(value AS decimal(38,2)) AS varchar) || suffix AS price_label,
  cast(cast(value AS decimal(38,2)) AS varchar) || suffix || ' kg' AS weight_label,
  '£' || cast(cast(value AS decimal(38,2)) AS varchar) || suffix || '/kg' AS ratio_label,
  cast(cast(value AS decimal(38,2)) AS varchar) || suffix || ' Con.' AS count_label,
  '<strong>Country of Origin: </strong>' || countryname || '<br><strong>Value: </strong>' || cast(cast(value AS decimal(38,2)) AS varchar) || suffix AS popup
FROM scaled JOIN country ON country = countrycode""")
def value_labels(v):
    scaled = geo.scale_values(stage(_totals(v), "totals")).join(v.country(), F.col("country") == F.col("countrycode"))
    value, suffix = F.col("value"), F.col("suffix")
    return scaled.select(
        "country", F.lit(text.UNIT_TITLES["price"]).alias("title"),
        text.value_label(value, "price", suffix).alias("price_label"),
        text.value_label(value, "weight", suffix).alias("weight_label"),
        text.value_label(value, "price_per_kilo", suffix).alias("ratio_label"),
        text.value_label(value, "consignments", suffix).alias("count_label"),
        text.popup_label(F.col("countryname"), value, suffix).alias("popup"))


# --- legends, names, layout


@query("code_legend", "SELECT c.comcode AS commoditycode, k.description FROM (SELECT DISTINCT comcode FROM imp_cube) c "
                      "LEFT JOIN codes k ON c.comcode = k.commoditycode ORDER BY 1")
def code_legend(v):
    return dims.code_legend(cube_of(v, "imports", keys=("comcode",)), v.codes())


@query("eu_code_legend", "SELECT c.comcode AS commoditycode, k.description FROM (SELECT DISTINCT comcode FROM disp_cube) c "
                         "LEFT JOIN codes k ON c.comcode = k.commoditycode ORDER BY 1")
def eu_code_legend(v):
    return dims.code_legend(cube_of(v, "dispatches", keys=("comcode",)), v.codes())


@query("named_series", """
SELECT month, value, name AS country FROM (SELECT month, country, cast(sum(price) AS bigint) AS value FROM imp_cube GROUP BY ALL) s
LEFT JOIN (SELECT key_name, value AS name FROM lookup) l ON s.country = l.key_name""")
def named_series(v):
    return dims.name_series(cube.series(cube_of(v, "imports", keys=("month", "country")), "country", "price"), "country", _lookup(v))


@query("named_port_series", """
SELECT month, value, name AS port FROM (SELECT month, port, cast(sum(weight) AS bigint) AS value FROM exp_cube GROUP BY ALL) s
LEFT JOIN (SELECT key_name, value AS name FROM lookup) l ON s.port = l.key_name""")
def named_port_series(v):
    return dims.name_series(cube.series(cube_of(v, "exports", keys=("month", "port")), "port", "weight"), "port", _lookup(v))


@query("bar_layout", "SELECT count(DISTINCT month) AS months, CASE WHEN count(DISTINCT month) < 7 THEN 'dodge' ELSE 'stack' END AS layout FROM imp_cube")
def bar_layout(v):
    return geo.bar_layout(cube.series(cube_of(v, "imports", keys=("month", "comcode")), "comcode", "price"))


# --- extracts


@query("extract_non_eu", """
SELECT c.comcode[1:2] AS comcode2, h.description AS description2, c.comcode, c.port, p.portname, p.type, c.country, k.countryname,
  c.month, c.price, c.weight, d.description
FROM imp_cube c LEFT JOIN codes d ON c.comcode = d.commoditycode LEFT JOIN port p ON c.port = p.portcode
  LEFT JOIN country k ON c.country = k.countrycode LEFT JOIN codes h ON c.comcode[1:2] = h.commoditycode""")
def extract_non_eu(v):
    return extract.enrich_extract(cube_of(v, "imports"), stage(v.codes(), "codes"), v.country(), v.port())


@query("extract_eu", """
SELECT c.comcode[1:2] AS comcode2, h.description AS description2, c.comcode, c.country, k.countryname,
  c.month, c.price, c.consignments, d.description
FROM arr_cube c LEFT JOIN codes d ON c.comcode = d.commoditycode
  LEFT JOIN country k ON c.country = k.countrycode LEFT JOIN codes h ON c.comcode[1:2] = h.commoditycode""")
def extract_eu(v):
    return extract.enrich_extract(cube_of(v, "arrivals"), stage(v.codes(), "codes"), v.country())


@query("extract_headers", """
SELECT c.comcode[1:2] AS "2-Digit Comcode", h.description AS "2-Digit Description", c.comcode AS "Commodity Code",
  c.country AS "Country Code", k.countryname AS "Country Name", c.month AS "Month", c.price AS "Value (£)",
  c.consignments AS "Number of Consignments", d.description AS "Commodity Description"
FROM disp_cube c LEFT JOIN codes d ON c.comcode = d.commoditycode
  LEFT JOIN country k ON c.country = k.countrycode LEFT JOIN codes h ON c.comcode[1:2] = h.commoditycode""")
def extract_headers(v):
    return extract.with_headers(extract.enrich_extract(cube_of(v, "dispatches"), stage(v.codes(), "codes"), v.country()))
