"""Queries over the lookups: hierarchy, ports, countries, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions.codes import code_from_label, code_label, is_section
from tradewind.functions.text import pad2, parse_latitude, parse_longitude
from tradewind.operators import dims, filters, hierarchy, ordering
from tradewind.plans import builds
from tradewind.plans.registry import query
from tradewind.schema import FACTS
from tradewind.sources import tables
from tradewind.sources.stage import new_folder, stage

# --- nomenclature and hierarchy


def nomen(v):
    return tables.clean_nomenclature(v.nomen_raw())


def code_rows(v):
    return hierarchy.split_sections(nomen(v))[1].select("commoditycode", "parent", "description")


def all_codes(v):
    """Every code of the nomenclature and of the control files, once."""
    return dims.union_keys(code_rows(v).select("commoditycode"), v.control().select("commoditycode"))


def parented(v):
    """The derived code table with nearest parents, stored like any lookup."""
    codes = stage(v.codes(), "codes")
    return stage(codes.join(hierarchy.derive_parent(codes.select("commoditycode")), "commoditycode"), "parents")


def comcode(v):
    """The code lookup as built from nomenclature, control files and sections."""
    return builds.build_code_table(nomen(v), v.control())


_DIGITS = "NOT regexp_matches(commoditycode, 'I|V|X')"


@query("clean_nomenclature", "SELECT line_no, commoditycode, parent, description FROM nomen")
def clean_nomenclature(v):
    return nomen(v)


@query("section_rows", "SELECT commoditycode, description, regexp_matches(commoditycode, 'I|V|X') AS section FROM nomen")
def section_rows(v):
    return nomen(v).select("commoditycode", "description", is_section(F.col("commoditycode")).alias("section"))


@query("next_code", "SELECT commoditycode, lead(commoditycode) OVER (ORDER BY line_no) AS next_code FROM nomen")
def next_code(v):
    marked = ordering.next_in_order(nomen(v), "commoditycode", ["line_no"], "next_code")
    return marked.select("commoditycode", "next_code")


_CODE_ROWS = f"""code_rows AS (SELECT commoditycode, parent, description FROM nomen WHERE {_DIGITS}),
all_codes AS (SELECT commoditycode FROM code_rows UNION SELECT commoditycode FROM control)"""


def _nearest(source: str) -> str:
    """Nearest parent by trying each prefix length in turn."""
    return f"""SELECT c.commoditycode, coalesce(
    (SELECT p.commoditycode FROM {source} p WHERE length(c.commoditycode) > 6 AND p.commoditycode = c.commoditycode[1:6]),
    (SELECT p.commoditycode FROM {source} p WHERE length(c.commoditycode) > 4 AND p.commoditycode = c.commoditycode[1:4]),
    (SELECT p.commoditycode FROM {source} p WHERE length(c.commoditycode) > 2 AND p.commoditycode = c.commoditycode[1:2]),
    '') AS parent FROM {source} c"""


@query("nearest_parent", _nearest("codes"))
def nearest_parent(v):
    return hierarchy.derive_parent(v.codes().select("commoditycode"))


@query("two_step_parent", """
SELECT c.commoditycode, CASE WHEN p.commoditycode IS NOT NULL THEN p.commoditycode
  WHEN length(c.commoditycode) > 4 THEN c.commoditycode[1:length(c.commoditycode)-4] ELSE '' END AS parent
FROM codes c LEFT JOIN codes p ON p.commoditycode = c.commoditycode[1:length(c.commoditycode)-2]""")
def two_step_parent(v):
    return hierarchy.derive_parent(v.codes().select("commoditycode"), "two_step")


_MERGED = f"""{_CODE_ROWS}, derived AS ({_nearest('all_codes')}),
merged AS (SELECT coalesce(n.commoditycode, d.commoditycode) AS commoditycode, coalesce(n.parent, d.parent) AS parent, n.description
  FROM code_rows n FULL OUTER JOIN derived d ON n.commoditycode = d.commoditycode)"""
_DESCRIBED = f"""{_MERGED}, described AS (SELECT coalesce(m.commoditycode, k.commoditycode) AS commoditycode, m.parent,
  coalesce(m.description, k.description) AS description
  FROM merged m FULL OUTER JOIN control k ON m.commoditycode = k.commoditycode)"""


@query("merge_parent", f"WITH {_MERGED} SELECT * FROM merged")
def merge_parent(v):
    return dims.merge_parent(code_rows(v), hierarchy.derive_parent(all_codes(v)))


@query("merge_description", f"WITH {_CODE_ROWS} SELECT coalesce(n.commoditycode, k.commoditycode) AS commoditycode, n.parent, "
                            "coalesce(n.description, k.description) AS description "
                            "FROM code_rows n FULL OUTER JOIN control k ON n.commoditycode = k.commoditycode")
def merge_description(v):
    return dims.merge_description(code_rows(v), v.control())


@query("sections", f"""WITH {_DESCRIBED},
following AS (SELECT commoditycode, description, lead(commoditycode) OVER (ORDER BY line_no) AS before_code FROM nomen),
placed AS (SELECT commoditycode, parent, description, commoditycode AS place, 1 AS place_rank FROM described
  UNION ALL SELECT commoditycode, '', description, before_code, 0 FROM following WHERE regexp_matches(commoditycode, 'I|V|X'))
SELECT commoditycode, parent, description, place, place_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY commoditycode ORDER BY place, place_rank) AS rn FROM placed) p WHERE rn = 1""")
def sections(v):
    return comcode(v).orderBy("place", "place_rank")


_TREE = f"tree AS ({_nearest('codes')})"
_BELOW = f"""{_TREE}, below AS (
  SELECT commoditycode FROM tree WHERE parent IN ('01', '0205', '11')
  UNION SELECT t.commoditycode FROM tree t JOIN below b ON t.parent = b.commoditycode WHERE length(b.commoditycode) < 8)"""
_ROOTS = ["01", "0205", "11"]


@query("descendants", f"WITH {_BELOW} SELECT commoditycode FROM below")
def descendants(v):
    return hierarchy.descendants(parented(v), _ROOTS)


@query("code_closure", f"""WITH {_TREE}, reach AS (
  SELECT parent AS ancestor, commoditycode, 1 AS distance FROM tree WHERE parent <> ''
  UNION ALL SELECT r.ancestor, t.commoditycode, r.distance + 1 FROM reach r JOIN tree t ON t.parent = r.commoditycode)
SELECT ancestor, commoditycode, distance FROM reach""")
def code_closure(v):
    return hierarchy.closure(parented(v))


@query("cascade_choices", f"""WITH {_BELOW}
SELECT 6 AS level, commoditycode, commoditycode || ' - ' || coalesce(description, 'NA') AS label FROM codes
WHERE length(commoditycode) = 6 AND commoditycode IN (SELECT commoditycode FROM below)
UNION ALL SELECT 4, commoditycode, commoditycode || ' - ' || coalesce(description, 'NA') FROM codes WHERE length(commoditycode) = 4""")
def cascade_choices(v):
    dim = parented(v)
    return (hierarchy.cascade(dim, 6, _ROOTS, hierarchy.closure(dim)).select(F.lit(6).alias("level"), "*")
                     .unionByName(hierarchy.cascade(dim, 4, ["All"]).select(F.lit(4).alias("level"), "*")))


@query("codes_by_level", "SELECT length(commoditycode) AS level, commoditycode, description FROM codes WHERE length(commoditycode) IN (2, 4, 6, 8)")
def codes_by_level(v):
    dim, out = v.codes(), None
    for n in (2, 4, 6, 8):
        part = filters.codes_at_level(dim, n).select(F.lit(n).cast("bigint").alias("level"), "commoditycode", "description")
        out = part if out is None else out.unionByName(part)
    return out


@query("search_codes", """
SELECT commoditycode, description FROM codes
WHERE lower(commoditycode || ' ' || description) LIKE '%red%' AND lower(commoditycode || ' ' || description) LIKE '%07%'""")
def search_codes(v):
    return filters.search_codes(v.codes(), "RED 07")


@query("pick_codes", "SELECT commoditycode, description FROM codes WHERE commoditycode IN ('01', '02', '0205', '11')")
def pick_codes(v):
    return filters.search_codes(v.codes(), codes=["01", "02", "0205", "11"])


@query("code_labels", """
SELECT commoditycode, commoditycode || ' - ' || description AS label, commoditycode AS back,
  NULL::varchar AS unlabelled, 'All' AS everything FROM codes""")
def code_labels(v):
    label = code_label(F.col("commoditycode"), F.col("description"))
    return v.codes().select("commoditycode", label.alias("label"), code_from_label(label).alias("back"),
                            code_from_label(F.col("commoditycode")).alias("unlabelled"),
                            code_from_label(F.lit("All")).alias("everything"))


@query("late_page", "SELECT commoditycode, description FROM codes ORDER BY commoditycode DESC LIMIT 10 OFFSET 300")
def late_page(v):
    return ordering.page(v.codes(), [F.col("commoditycode").desc()], 10, 31)


@query("lookup_page", "SELECT commoditycode, description FROM codes ORDER BY commoditycode LIMIT 25 OFFSET 50")
def lookup_page(v):
    return ordering.page(v.codes(), ["commoditycode"], 25, 3)


# --- ports


@query("locode_gb", "SELECT portcode, portname, round(lat, 6) AS lat, round(long, 6) AS long FROM locode")
def locode_gb(v):
    return tables.shape_locode(v.locode_raw()).select(
        "portcode", "portname", F.round("lat", 6).alias("lat"), F.round("long", 6).alias("long"))


@query("missing_ports", "SELECT portname_x, portcode, CASE WHEN portname_x LIKE 'Port%' THEN 'Seaport' ELSE 'Airport' END AS type, lat, long FROM extra_ports")
def missing_ports(v):
    """The hand-made positions, written as the list is published and read back."""
    folder, kind = new_folder(v.spark, "ports"), F.when(F.col("portname_x").startswith("Port"), "Seaport").otherwise("Airport")
    (v.extra_ports().select(F.col("portname_x").alias("portname.x"), "portcode", kind.alias("type"), "lat", "long")
      .write.option("header", True).option("quoteAll", True).option("nullValue", "NA").csv(folder))
    return tables.read_missing_ports(v.spark, folder)


@query("dms_to_decimal", """
SELECT x11, round((cast(x11[1:2] AS double) + cast(x11[3:4] AS double) / 60) * CASE WHEN contains(x11, 'N') THEN 1 ELSE -1 END, 6) AS lat,
  round((cast(x11[7:9] AS double) + cast(x11[10:11] AS double) / 60) * CASE WHEN contains(x11, 'E') THEN 1 ELSE -1 END + 0.0::double, 6) AS long,
  round((cast(x11[7:8] AS double) + cast(x11[9:10] AS double) / 60 + cast(x11[11:11] AS double) / 3600)
    * CASE WHEN contains(x11, 'E') THEN 1 ELSE -1 END + 0.0::double, 6) AS long_dms
FROM locode_raw WHERE x11 IS NOT NULL""")
def dms_to_decimal(v):
    x = F.col("x11")
    return v.locode_raw().where(x.isNotNull()).select(
        x, F.round(parse_latitude(x), 6).alias("lat"), F.round(parse_longitude(x), 6).alias("long"),
        F.round(parse_longitude(x, "DDMMS"), 6).alias("long_dms"))


@query("code_list_typed", """
SELECT portname, portcode, 'Airport' AS type FROM port_raw WHERE type = 'Airport' AND portname <> 'Port Supplier#000000002'
UNION ALL SELECT portname, portcode, 'Seaport' FROM port_raw WHERE type = 'Seaport'""")
def code_list_typed(v):
    raw = v.port_raw()

    def sheet(kind):
        name = F.when(F.col("portname") != "Port Supplier#000000002", F.col("portname"))
        rows = raw.where(F.col("type") == kind).select(name.alias("a"), F.col("portcode").alias("b"))
        return tables.type_code_list(rows, ["portname", "portcode"], kind)
    return sheet("Airport").unionByName(sheet("Seaport"))


@query("main_ports", """
SELECT portname, portcode, type FROM (SELECT *, count(*) OVER (PARTITION BY portcode) AS n FROM port_raw) p
WHERE (upper(portname[1:3]) = portname[1:3] AND n > 1) OR n = 1""")
def main_ports(v):
    return dims.keep_main_ports(v.port_raw())


def coords(v):
    return dims.merge_missing_ports(tables.shape_locode(v.locode_raw()), v.extra_ports())


def _positions(df):
    return df.withColumn("lat", F.round("lat", 6)).withColumn("long", F.round("long", 6))


@query("merge_ports", "SELECT portname, portcode, round(lat, 6) AS lat, round(long, 6) AS long FROM coords")
def merge_ports(v):
    return _positions(coords(v))


@query("attach_coords", """
SELECT p.portname, p.portcode, p.type, c.portname AS portname_y, round(c.lat, 6) AS lat, round(c.long, 6) AS long
FROM port_raw p LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY portcode ORDER BY portname, lat, long) AS rn
  FROM coords) r WHERE rn = 1) c ON p.portcode = c.portcode""")
def attach_coords(v):
    one_each = ordering.first_per_key(coords(v), "portcode", ["portname", "lat", "long"])
    return _positions(dims.attach_coords(v.port_raw(), one_each))


def _one_per_start_sql(table: str) -> str:
    return (f"one AS (SELECT portname, portcode, lat, long FROM (SELECT *, row_number() OVER (PARTITION BY portcode, portname[1:3] "
            f"ORDER BY portname, lat, long) AS rn FROM {table}) r WHERE rn = 1)")


@query("resolve_ports", f"""
WITH {_one_per_start_sql('locode')}, pairs AS (SELECT p.portname, p.portcode, p.type, c.portname AS portname_y, c.lat, c.long
  FROM port_raw p LEFT JOIN one c ON p.portcode = c.portcode),
counted AS (SELECT *, count(*) OVER (PARTITION BY portcode) AS n FROM pairs)
SELECT portname, portcode, type, round(coalesce(lat, 56), 6) AS lat, round(coalesce(long, 0), 6) AS long FROM counted
WHERE (portname[1:3] = portname_y[1:3] AND n > 1) OR n = 1""")
def resolve_ports(v):
    located = builds.one_per_start(tables.shape_locode(v.locode_raw()))
    return _positions(filters.fill_unknown(dims.resolve_ports(v.port_raw(), located)))


@query("port_table", f"""
WITH {_one_per_start_sql('coords')}, main AS (SELECT portname, portcode, type FROM (SELECT *, count(*) OVER (PARTITION BY portcode) AS n FROM port_raw) p
  WHERE (upper(portname[1:3]) = portname[1:3] AND n > 1) OR n = 1),
pairs AS (SELECT p.portname, p.portcode, p.type, c.portname AS portname_y, c.lat, c.long
  FROM main p LEFT JOIN one c ON p.portcode = c.portcode),
counted AS (SELECT *, count(*) OVER (PARTITION BY portcode) AS n FROM pairs)
SELECT portname, portcode, type, round(coalesce(lat, 56), 6) AS lat, round(coalesce(long, 0), 6) AS long FROM counted
WHERE (portname[1:3] = portname_y[1:3] AND n > 1) OR n = 1""")
def port_table(v):
    return _positions(builds.build_port_table(v.port_raw(), tables.shape_locode(v.locode_raw()), v.extra_ports()))


@query("drop_blank", "SELECT portname, portcode, lat, long FROM (SELECT portname, portcode, round(lat, 6) AS lat, round(long, 6) AS long "
                     "FROM coords) c WHERE portname IS NOT NULL AND portname <> '' AND long IS NOT NULL")
def drop_blank(v):
    return filters.drop_blank(_positions(coords(v)), "portname").where(F.col("long").isNotNull())


# --- countries and names


@query("country_dim", """
SELECT countryname, countrycode FROM (SELECT *, row_number() OVER (PARTITION BY countrycode ORDER BY countryname) AS rn FROM (
  SELECT countryname, countrycode FROM country
  UNION ALL SELECT r_name || ': ' || n_name, lpad(cast(n_nationkey AS varchar), 2, '0') FROM nation JOIN region ON n_regionkey = r_regionkey) c) r
WHERE rn = 1 ORDER BY countryname""")
def country_dim(v):
    region = v.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    other = v.table("nation").join(region, "n_regionkey").select(
        F.concat("r_name", F.lit(": "), "n_name").alias("countryname"), pad2(F.col("n_nationkey")).alias("countrycode"))
    return dims.load_dim(v.country().unionByName(other), "countrycode", "countryname")


@query("port_dim", """
SELECT portcode, portname, type FROM (SELECT *, row_number() OVER (PARTITION BY portcode ORDER BY portname) AS rn FROM port_raw) r
WHERE rn = 1 ORDER BY portname""")
def port_dim(v):
    return dims.load_dim(v.port_raw(), "portcode", "portname").select("portcode", "portname", "type")


@query("first_per_key", """
SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) r WHERE rn = 1""")
def first_per_key(v):
    return ordering.first_per_key(v.table("orders").select("o_custkey", "o_orderdate", "o_orderkey"),
                                  "o_custkey", ["o_orderdate", "o_orderkey"])


def _seen(v):
    """The countries of each fact table, from one scan of all four."""
    seen = stage(v.flows().select("table_name", "country").distinct(), "seen")
    return {name: seen.where(F.col("table_name") == name).select(F.col("country").alias(s.country)) for name, s in FACTS.items()}


def flagged(v):
    return builds.build_country_table(v.country(), _seen(v))


_FLAGGED = """flagged AS (SELECT countryname, countrycode,
  countrycode IN (SELECT smk_cod_alpha FROM arrivals UNION SELECT smk_cod_alpha FROM dispatches) AS eu,
  countrycode IN (SELECT coo_alpha FROM imports WHERE coo_alpha IS NOT NULL UNION SELECT cod_alpha FROM exports) AS non_eu FROM country)"""


@query("country_flags", f"WITH {_FLAGGED} SELECT * FROM flagged")
def country_flags(v):
    return flagged(v)


@query("non_eu_only", f"WITH {_FLAGGED} SELECT 'eu' AS grp, countryname, countrycode FROM flagged WHERE eu "
                      "UNION ALL SELECT 'non_eu', countryname, countrycode FROM flagged WHERE non_eu AND NOT eu")
def non_eu_only(v):
    eu, other = dims.country_groups(flagged(v))
    return eu.select(F.lit("eu").alias("grp"), "countryname", "countrycode").unionByName(
        other.select(F.lit("non_eu").alias("grp"), "countryname", "countrycode"))


@query("observed_countries", "SELECT coo_alpha AS code FROM imports UNION SELECT cod_alpha FROM exports "
                             "UNION SELECT smk_cod_alpha FROM arrivals UNION SELECT smk_cod_alpha FROM dispatches")
def observed_countries(v):
    return dims.union_keys(*_seen(v).values()).toDF("code")


@query("desc_lookup", "SELECT key_name, value FROM lookup")
def desc_lookup(v):
    return dims.desc_lookup(v.port(), v.country())
