"""Queries over the facts: filters, cubes, roll-ups, units, ratios, series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions import measures, periods
from tradewind.functions.codes import code_prefix
from tradewind.operators import cube, filters, monitor
from tradewind.plans.registry import query
from tradewind.schema import ARRIVALS, DISPATCHES, EXPORTS, FACTS, IMPORTS
from tradewind.sources.stage import stage
from tradewind.spec import QuerySpec

# Every month the data can hold, everything the lookups list.
ALL = QuerySpec()
ALL_KNOWN_OR_NOT = QuerySpec(keep_unknown=True)
# A typical selection: chapters 01-05 in one year.
CHAPTERS_1998 = QuerySpec(start="1998-01", end="1998-12", codes2=("01", "02", "03", "04", "05"))
MONTH = "1998-06"


def cube_of(v, name: str, spec: QuerySpec = ALL, keys=None):
    shape = FACTS[name]
    port = v.port() if shape.port else None
    return cube.flow_cube(v.fact(name, spec.start, spec.end), shape, spec, v.country(), port, keys)


# --- filters


_IMPORT_COLS = "comcode, coo_alpha, port_alpha, account_date, value, quantity_1"


@query("filter_code_patterns", f"""
SELECT {_IMPORT_COLS} FROM imports
WHERE comcode LIKE '01______' OR comcode LIKE '0205____' OR comcode LIKE '03__02__' OR comcode LIKE '041003__'""")
def filter_code_patterns(v):
    return filters.filter_codes(v.imports(), "comcode", ["01______", "0205____", "03__02__", "041003__"])


@query("deepest_level_filter", f"""
SELECT {_IMPORT_COLS} FROM imports WHERE length(comcode) = 8 AND (comcode[1:4] = '0712' OR comcode[1:4] = '1130')""")
def deepest_level_filter(v):
    spec = QuerySpec(start="1995-01", end="2001-12", codes2=("01", "02"), codes4=("0712", "1130"), codes6=("All",))
    return filters.filter_codes(v.imports(), "comcode", spec.patterns)


@query("filter_country", f"""
SELECT {_IMPORT_COLS} FROM imports WHERE coo_alpha IN
  (SELECT countrycode FROM country WHERE countryname IN ('NATION_3', 'NATION_8', 'NATION_15'))""")
def filter_country(v):
    return filters.filter_country(v.imports(), "coo_alpha", v.country(), ["NATION_3", "NATION_8", "NATION_15"])


@query("filter_country_all", f"""
SELECT {_IMPORT_COLS} FROM imports WHERE coo_alpha IN (SELECT countrycode FROM country)""")
def filter_country_all(v):
    return filters.filter_country(v.imports(), "coo_alpha", v.country())


@query("filter_port", f"""
SELECT {_IMPORT_COLS} FROM imports WHERE port_alpha IN
  (SELECT portcode FROM port WHERE portname IN ('Port 02', 'Port 17', 'Port 33'))""")
def filter_port(v):
    return filters.filter_port(v.imports(), "port_alpha", v.port(), ["Port 02", "Port 17", "Port 33"])


@query("filter_port_all", "SELECT comcode, cod_alpha, port_alpha, account_date, value, quantity_1 FROM exports "
                          "WHERE port_alpha IN (SELECT portcode FROM port)")
def filter_port_all(v):
    return filters.filter_port(v.exports(), "port_alpha", v.port())


@query("filter_months", """
SELECT 'imports' AS fact, comcode AS code, account_date AS period, value FROM imports
WHERE account_date[4:7] || account_date[1:2] BETWEEN '199711' AND '199902'
UNION ALL SELECT 'arrivals', smk_comcode, smk_period_reference, smk_stat_value FROM arrivals
WHERE smk_period_reference BETWEEN '0199711' AND '0199902'""")
def filter_months(v):
    def part(shape, value):
        rows = filters.filter_months(v.fact(shape.name, "1997-11", "1999-02"), shape.period, "1997-11", "1999-02", shape.style)
        return rows.select(F.lit(shape.name).alias("fact"), F.col(shape.code).alias("code"),
                           F.col(shape.period).alias("period"), F.col(value).alias("value"))
    return part(IMPORTS, "value").unionByName(part(ARRIVALS, "smk_stat_value"))


@query("exclude_years", """
SELECT account_date[4:7] || account_date[1:2] AS period, count(*) AS records FROM exports
WHERE account_date[4:7] NOT IN ('1995', '1996') GROUP BY 1""")
def exclude_years(v):
    return filters.exclude_years(monitor.records_per_period(v.exports(), EXPORTS), "period", ["1995", "1996"])


@query("valid_eu_period", """
SELECT smk_comcode, smk_cod_alpha, smk_period_reference, smk_no_of_consignments, smk_stat_value, smk_nett_mass
FROM dispatches WHERE smk_period_reference LIKE '020%'""")
def valid_eu_period(v):
    return filters.valid_eu_period(v.dispatches(), "smk_period_reference")


@query("food_chapters", f"SELECT {_IMPORT_COLS} FROM imports WHERE length(comcode) = 8 AND comcode[1:2] BETWEEN '01' AND '23'")
def food_chapters(v):
    from tradewind.functions.codes import in_chapters
    return v.imports().where(in_chapters(F.col("comcode"), 1, 23))


@query("fill_unknown", """
SELECT coalesce(coo_alpha, 'Unknown Country') AS country, comcode,
  CASE WHEN port_alpha = '' THEN 'Unknown Port' ELSE port_alpha END AS port,
  account_date[4:7] || '-' || account_date[1:2] AS month,
  cast(sum(value) AS bigint) AS price, cast(sum(quantity_1) AS bigint) AS weight
FROM imports WHERE (coo_alpha IS NULL OR coo_alpha IN (SELECT countrycode FROM country))
  AND (port_alpha = '' OR port_alpha IN (SELECT portcode FROM port)) GROUP BY ALL""")
def fill_unknown(v):
    return cube_of(v, "imports", ALL_KNOWN_OR_NOT)


@query("result_status", """
SELECT 'Non-EU' AS side, 'Imports' AS flow, count(*) AS rows, '0105,99' AS codes, count(*) = 0 AS is_empty
FROM imp_cube WHERE comcode LIKE '0105____' OR comcode LIKE '99______'
UNION ALL SELECT 'EU', 'Exports', count(*), '99', count(*) = 0 FROM disp_cube WHERE comcode LIKE '99______'""")
def result_status(v):
    some, none = ["0105____", "99______"], ["99______"]
    hit = filters.filter_codes(cube_of(v, "imports"), "comcode", some)
    miss = filters.filter_codes(cube_of(v, "dispatches"), "comcode", none)
    return filters.result_status(hit, some, "Non-EU", "Imports").unionByName(
        filters.result_status(miss, none, "EU", "Exports"))


# --- calendar


_MONTHLY = """monthly AS (SELECT account_date[4:7] || '-' || account_date[1:2] AS month, count(*) AS records
  FROM imports GROUP BY 1)"""
_CALENDAR = _MONTHLY + """, last_day AS (SELECT max(l_shipdate)::date AS d FROM lineitem),
calendar AS (SELECT strftime(m, '%Y-%m') AS month FROM (
  SELECT unnest(generate_series(make_date(year(d) - 9, 1, 1)::timestamp,
    date_trunc('month', d)::timestamp - to_months(CASE WHEN day(d) > 15 THEN 2 ELSE 3 END), INTERVAL 1 MONTH)) AS m FROM last_day) s)"""


def _days(v):
    """Shipping days of all records with the number of imports, from one scan: a few thousand rows."""
    return stage(v.flow_base().groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count_if(v.is_import()).alias("imports")), "days")


def _calendar(days):
    return filters.available_months(days.agg(F.max("day").alias("day")), "day")


def _monthly(days):
    return days.where("imports > 0").groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.sum("imports").alias("records"))


@query("month_calendar", f"WITH {_CALENDAR} SELECT c.month, coalesce(records, 0) AS records "
                         "FROM calendar c LEFT JOIN monthly m ON c.month = m.month")
def month_calendar(v):
    days = _days(v)
    return (_calendar(days).join(_monthly(days), "month", "left")
                           .select("month", F.coalesce("records", F.lit(0)).alias("records")))


@query("end_months", f"WITH {_CALENDAR} SELECT c.month, coalesce(records, 0) AS records "
                     "FROM calendar c LEFT JOIN monthly m ON c.month = m.month WHERE c.month >= '1999-03'")
def end_months(v):
    return filters.end_months(month_calendar(v), "1999-03")


@query("ascending_range", f"WITH {_CALENDAR} SELECT c.month FROM calendar c JOIN monthly m ON c.month = m.month "
                          "WHERE c.month BETWEEN '1996-02' AND '2000-10' ORDER BY 1")
def ascending_range(v):
    days = _days(v)
    seen = _calendar(days).join(_monthly(days).select("month"), "month", "left_semi")
    return filters.ascending_range(seen, "1996-02", "2000-10")


@query("latest_month", """
SELECT strftime(date_trunc('month', o_orderdate) - to_months(CASE WHEN day(o_orderdate) >= 15 THEN 2 ELSE 3 END), '%Y-%m') AS latest_from,
       strftime(date_trunc('month', o_orderdate) - to_months(CASE WHEN day(o_orderdate) > 15 THEN 2 ELSE 3 END), '%Y-%m') AS latest_after,
       count(*) AS orders FROM orders GROUP BY ALL""")
def latest_month(v):
    day = F.col("o_orderdate").cast("date")
    return (v.table("orders")
             .groupBy(periods.latest_month(day, 15, "from").alias("latest_from"),
                      periods.latest_month(day, 15, "after").alias("latest_after"))
             .agg(F.count(F.lit(1)).alias("orders")))


@query("period_conversions", """
SELECT account_date, account_date[4:7] || '-' || account_date[1:2] AS dashed, account_date[4:7] || account_date[1:2] AS plain,
  '0' || account_date[4:7] || account_date[1:2] AS eu, account_date AS back, count(*) AS records FROM imports GROUP BY ALL""")
def period_conversions(v):
    counts = v.imports().groupBy("account_date").agg(F.count(F.lit(1)).alias("records"))
    month = periods.to_month(F.col("account_date"), "MM/YYYY")
    eu = periods.from_month(month, "0YYYYMM")
    return counts.select("account_date", month.alias("dashed"), periods.from_month(month, "YYYYMM").alias("plain"),
                         eu.alias("eu"), periods.from_month(periods.to_month(eu, "0YYYYMM"), "MM/YYYY").alias("back"),
                         "records")


# --- cubes


_NON_EU = "country, comcode, port, month, price, weight"
_EU = "country, comcode, month, consignments, price, weight"


@query("non_eu_imports_cube", f"SELECT {_NON_EU} FROM imp_cube")
def non_eu_imports_cube(v):
    return cube_of(v, "imports")


@query("non_eu_exports_cube", f"SELECT {_NON_EU} FROM exp_cube")
def non_eu_exports_cube(v):
    return cube_of(v, "exports")


@query("eu_arrivals_cube", f"SELECT {_EU} FROM arr_cube")
def eu_arrivals_cube(v):
    return cube_of(v, "arrivals")


@query("eu_dispatches_cube", f"SELECT {_EU} FROM disp_cube")
def eu_dispatches_cube(v):
    return cube_of(v, "dispatches")


@query("selected_imports_cube", f"""SELECT {_NON_EU} FROM imp_cube
WHERE comcode[1:2] BETWEEN '01' AND '05' AND month BETWEEN '1998-01' AND '1998-12'
  AND country IN (SELECT countrycode FROM country WHERE countryname IN ('NATION_1', 'NATION_2', 'NATION_4'))
  AND port IN (SELECT portcode FROM port WHERE portname IN ('Port 05', 'Port 06', 'Port 07', 'Port 08'))""")
def selected_imports_cube(v):
    spec = QuerySpec(start="1998-01", end="1998-12", codes2=("01", "02", "03", "04", "05"),
                     countries=("NATION_1", "NATION_2", "NATION_4"),
                     ports=("Port 05", "Port 06", "Port 07", "Port 08"))
    return cube_of(v, "imports", spec)


# --- roll-ups


def _pair_sql(a: str, b: str, table: str = "imp_cube") -> str:
    return (f"SELECT {a}, {b}, month, cast(sum(price) AS bigint) AS price, cast(sum(weight) AS bigint) AS weight "
            f"FROM {table} GROUP BY ALL")


@query("pair_country_code", _pair_sql("country", "comcode"))
def pair_country_code(v):
    return cube.pair_rollup(cube_of(v, "imports", keys=("country", "comcode", "month")), "country", "comcode")


@query("pair_code_port", _pair_sql("comcode", "port"))
def pair_code_port(v):
    return cube.pair_rollup(cube_of(v, "imports", keys=("comcode", "port", "month")), "comcode", "port")


@query("pair_country_port", _pair_sql("country", "port", "exp_cube"))
def pair_country_port(v):
    return cube.pair_rollup(cube_of(v, "exports", keys=("country", "port", "month")), "country", "port")


@query("pair_grouping_sets", " UNION ALL ".join(
    f"SELECT {i} AS step, {', '.join(c if c in s else f'NULL AS {c}' for c in ('comcode', 'country', 'port'))}, month, "
    "cast(sum(price) AS bigint) AS price, cast(sum(weight) AS bigint) AS weight FROM imp_cube GROUP BY ALL"
    for i, s in enumerate([("country", "comcode"), ("comcode", "port"), ("country", "port")])))
def pair_grouping_sets(v):
    steps = (("country", "comcode"), ("comcode", "port"), ("country", "port"))
    return cube.pair_rollups(cube_of(v, "imports"), steps)


@query("all_months_pairs", "SELECT country, comcode, cast(sum(price) AS bigint) AS price, "
                           "cast(sum(weight) AS bigint) AS weight FROM imp_cube GROUP BY ALL")
def all_months_pairs(v):
    return cube.drop_month(cube.pair_rollup(cube_of(v, "imports"), "country", "comcode"))


@query("month_slice", f"SELECT country, comcode, cast(sum(price) AS bigint) AS price, cast(sum(weight) AS bigint) AS weight "
                      f"FROM imp_cube WHERE month = '{MONTH}' GROUP BY ALL")
def month_slice(v):
    one = cube_of(v, "imports", QuerySpec(start=MONTH, end=MONTH), ("country", "comcode", "month"))
    return filters.slice_month(cube.pair_rollup(one, "country", "comcode"), MONTH)


@query("unit_price", "SELECT country, comcode, cast(sum(price) AS bigint) AS value FROM imp_cube GROUP BY ALL")
def unit_price(v):
    return filters.select_unit(cube_of(v, "imports", keys=("country", "comcode")), "price")


@query("unit_weight", "SELECT country, comcode, cast(sum(weight) AS bigint) AS value FROM exp_cube GROUP BY ALL")
def unit_weight(v):
    return filters.select_unit(cube_of(v, "exports", keys=("country", "comcode")), "weight")


@query("unit_consignments", "SELECT country, comcode, cast(sum(consignments) AS bigint) AS value FROM arr_cube GROUP BY ALL")
def unit_consignments(v):
    return filters.select_unit(cube_of(v, "arrivals", keys=("country", "comcode")), "consignments")


@query("country_totals", "SELECT country, cast(sum(price) AS bigint) AS value FROM imp_cube GROUP BY ALL")
def country_totals(v):
    pairs = cube_of(v, "imports", keys=("country",))
    return cube.country_totals(filters.select_unit(pairs, "price"))


@query("eu_country_totals", "SELECT country, cast(sum(weight) AS bigint) AS value FROM disp_cube GROUP BY ALL")
def eu_country_totals(v):
    pairs = cube_of(v, "dispatches", keys=("country",))
    return cube.country_totals(filters.select_unit(pairs, "weight"))


# --- ratios


def _rounded(df):
    return df.withColumn("value", F.round("value", 6))


_RATIO = "round(sum(price)::double / nullif(sum(weight), 0)::double, 6) AS value"


@query("ppk_pairs", f"SELECT country, comcode, {_RATIO} FROM imp_cube GROUP BY ALL")
def ppk_pairs(v):
    return _rounded(cube.price_per_kilo(cube_of(v, "imports", keys=("country", "comcode")), ["country", "comcode"]))


@query("ppk_country", f"SELECT country, {_RATIO} FROM imp_cube GROUP BY ALL")
def ppk_country(v):
    return _rounded(cube.price_per_kilo(cube_of(v, "imports", keys=("country",)), ["country"]))


@query("ppk_ieee", """SELECT country, comcode, CASE WHEN sum(weight) = 0 THEN 'infinite' ELSE 'finite' END AS kind,
  round(sum(price)::double / nullif(sum(weight), 0)::double, 6) AS value FROM imp_cube GROUP BY ALL""")
def ppk_ieee(v):
    ratios = cube.price_per_kilo(cube_of(v, "imports", keys=("country", "comcode")), ["country", "comcode"], "ieee")
    infinite = F.col("value") == float("inf")
    return ratios.select("country", "comcode", F.when(infinite, "infinite").otherwise("finite").alias("kind"),
                         F.when(~infinite, F.round("value", 6)).alias("value"))


@query("eu_sum_of_ratios", "SELECT country, round(sum(price::double / nullif(weight, 0)::double), 4) AS value FROM arr_cube GROUP BY ALL")
def eu_sum_of_ratios(v):
    summed = cube.sum_of_ratios(cube_of(v, "arrivals"), ["country"])
    return summed.withColumn("value", F.round("value", 4))


@query("eu_map_ratios", """
SELECT country, round(sum(price::double / nullif(weight, 0)::double), 4) AS value FROM (
  SELECT country, comcode, sum(price) AS price, sum(weight) AS weight FROM disp_cube GROUP BY ALL) p GROUP BY country""")
def eu_map_ratios(v):
    pairs = cube_of(v, "dispatches", keys=("country", "comcode"))
    return cube.sum_of_ratios(pairs, ["country"]).withColumn("value", F.round("value", 4))


@query("eu_series_sum_of_ratios", "SELECT month, comcode, round(sum(price::double / nullif(weight, 0)::double), 4) AS value "
                                  "FROM arr_cube GROUP BY ALL")
def eu_series_sum_of_ratios(v):
    summed = cube.sum_of_ratios(cube_of(v, "arrivals"), ["month", "comcode"])
    return summed.withColumn("value", F.round("value", 4))


# --- series


def _series(key: str, table: str, fact: str, dim: str, unit: str) -> None:
    if unit == measures.PRICE_PER_KILO:
        value = _RATIO
    else:
        value = f"cast(sum({unit}) AS bigint) AS value"

    @query(key, f"SELECT month, {dim}, {value} FROM {table} GROUP BY ALL")
    def build(v):
        out = cube.series(cube_of(v, fact, keys=("month", dim)), dim, unit)
        return _rounded(out) if unit == measures.PRICE_PER_KILO else out


_series("series_code", "imp_cube", "imports", "comcode", "price")
_series("series_country", "imp_cube", "imports", "country", "weight")
_series("series_port", "exp_cube", "exports", "port", "price")
_series("series_ppk_code", "imp_cube", "imports", "comcode", "price_per_kilo")
_series("series_ppk_country", "exp_cube", "exports", "country", "price_per_kilo")
_series("series_ppk_port", "imp_cube", "imports", "port", "price_per_kilo")
_series("eu_series_code", "disp_cube", "dispatches", "comcode", "price")
_series("eu_series_country", "arr_cube", "arrivals", "country", "consignments")


@query("series_one_month", f"SELECT month, country, cast(sum(price) AS bigint) AS value FROM exp_cube WHERE month = '{MONTH}' GROUP BY ALL")
def series_one_month(v):
    return cube.series(cube_of(v, "exports", QuerySpec(start=MONTH, end=MONTH), ("month", "country")), "country", "price", MONTH)


@query("scalar_bundle", """
SELECT comcode[1:2] AS chapter, right(comcode, 2) AS tail, upper(trim('  ab ' || comcode || ' ')) AS cleaned,
  replace(comcode, '0', '') AS stripped, CASE WHEN coo_alpha = '01' THEN 'X1' ELSE coo_alpha END AS fixed,
  lpad(cast(quantity_1 % 13 AS varchar), 2, '0') AS padded, coalesce(coo_alpha, port_alpha) AS first_known,
  port_alpha || '/' || coalesce(coo_alpha, '') AS united, abs(value - 50000) AS distance,
  'caf' || chr(233) || ' / ' || comcode AS latin, 'a' || comcode AS uncontrolled FROM imports""")
def scalar_bundle(v):
    from tradewind.functions import text
    code, country = F.col("comcode"), F.col("coo_alpha")
    return v.imports().select(
        code_prefix(code, 2).alias("chapter"), F.right(code, F.lit(2)).alias("tail"),
        F.upper(F.trim(F.concat(F.lit("  ab "), code, F.lit(" ")))).alias("cleaned"),
        F.regexp_replace(code, "0", "").alias("stripped"), text.fix_code(country, {"01": "X1"}).alias("fixed"),
        text.pad2(F.col("quantity_1") % 13).alias("padded"), F.coalesce(country, F.col("port_alpha")).alias("first_known"),
        text.unite(F.concat("port_alpha", F.lit("/")), country).alias("united"),
        F.abs(F.col("value") - 50000).alias("distance"),
        text.to_latin1(F.concat(F.lit("café € "), code)).alias("latin"),
        text.strip_control(F.concat(F.lit("a\x1a"), code)).alias("uncontrolled"))


# --- monitoring


def _period_sql(table: str, col: str, measure: str, where: str = "TRUE") -> str:
    if col == "account_date":
        return f"SELECT account_date[4:7] || account_date[1:2] AS period, {measure} AS records FROM {table} WHERE {where} GROUP BY 1"
    return f"SELECT {col}[2:7] AS period, {measure} AS records FROM {table} WHERE {col} LIKE '020%' AND {where} GROUP BY 1"


_FACT_PERIODS = [("imports", "account_date"), ("exports", "account_date"),
                 ("arrivals", "smk_period_reference"), ("dispatches", "smk_period_reference")]


def _aligned_sql(parts: list[str]) -> str:
    names = ("i", "e", "a", "d")
    ctes = ", ".join(f"{n} AS ({p})" for n, p in zip(names, parts))
    return (f"{ctes}, aligned AS (SELECT i.period, i.records AS \"Import\", e.records AS \"Export\", a.records AS \"Arrival\", "
            "d.records AS \"Dispatch\" FROM i LEFT JOIN e ON i.period = e.period LEFT JOIN a ON i.period = a.period "
            "LEFT JOIN d ON i.period = d.period)")


_RECORDS = [_period_sql(t, c, f"count({c})") for t, c in _FACT_PERIODS]
_FOOD = [_period_sql(t, c, f"cast(sum({monitor.FOOD_MEASURES[t]}) AS bigint)",
                     f"length({FACTS[t].code}) = 8 AND {FACTS[t].code}[1:2] BETWEEN '01' AND '23'") for t, c in _FACT_PERIODS]
_LONG = " UNION ALL ".join(f"SELECT period, '{f}' AS type, \"{f}\" AS records FROM aligned" for f in monitor.FLOWS)


def _records(v):
    return monitor.records_of_flows(v.flows())


def _food(v):
    return monitor.balance_of_flows(v.flows())


@query("records_per_period", " UNION ALL ".join(f"SELECT '{f}' AS flow, * FROM ({p}) x" for f, p in zip(monitor.FLOWS, _RECORDS)))
def records_per_period(v):
    return _records(v).withColumnRenamed("type", "flow")


@query("food_per_period", " UNION ALL ".join(f"SELECT '{f}' AS flow, * FROM ({p}) x" for f, p in zip(monitor.FLOWS, _FOOD)))
def food_per_period(v):
    return _food(v).withColumnRenamed("type", "flow")


@query("aligned_periods", f"WITH {_aligned_sql(_RECORDS)} SELECT * FROM aligned")
def aligned_periods(v):
    return monitor.pivot_flows(_records(v))


@query("period_long", f"WITH {_aligned_sql(_RECORDS)} SELECT * FROM ({_LONG}) x WHERE period[1:4] NOT IN ('1995')")
def period_long(v):
    return monitor.to_long(monitor.pivot_flows(_records(v)), ["1995"])


@query("food_long", f"WITH {_aligned_sql(_FOOD)} SELECT * FROM ({_LONG}) x WHERE period[1:4] NOT IN ('1995', '1996')")
def food_long(v):
    return monitor.to_long(monitor.pivot_flows(_food(v)), ["1995", "1996"])


@query("tick_periods", f"WITH i AS ({_RECORDS[0]}) SELECT period FROM (SELECT period, row_number() OVER (ORDER BY period) AS n "
                       "FROM (SELECT DISTINCT period FROM i) d) r WHERE n % 3 = 1")
def tick_periods(v):
    from tradewind.operators.ordering import every_nth
    return every_nth(stage(monitor.records_per_period(v.imports(), IMPORTS), "periods"), "period", 3)
