"""Table builds and the views of one query."""

import re

import pytest
from rows import rows
from pyspark.sql import functions as F
from test_operators import COUNTRY, FACTS, SPEC, imports, port

from tradewind.operators import cube, monitor
from tradewind.plans import builds
from tradewind.plans.explore import FlowResult
from tradewind.plans.registry import load_all
from tradewind.schema import ARRIVALS, FACTS as SHAPES, IMPORTS
from tradewind.spec import QuerySpec


def result(spark, spec=SPEC):
    country = spark.createDataFrame(COUNTRY, "countryname string, countrycode string")
    codes = spark.createDataFrame([("01", "Animals"), ("01010000", "Horses")], "commoditycode string, description string")
    gates = port(spark).withColumn("type", F.lit("Seaport"))
    return FlowResult(imports(spark, FACTS), IMPORTS, spec, country, codes, gates)


def test_views_of_a_query(spark):
    r = result(spark)
    assert rows(r.status()) == [("Non-EU", "Imports", 3, "", False)]
    assert rows(r.legend()) == [("01010000", "Horses"), ("02010000", None)]
    assert rows(r.legend("1998-02")) == [("01010000", "Horses")]
    nodes, links = r.graph()
    names = dict(rows(nodes.select("id", "label")))
    assert sorted((names[s], names[t], v) for s, t, v in rows(links)) == sorted([
        ("France", "01010000", 15), ("United States", "01010000", 7), ("Namibia", "02010000", 3),
        ("01010000", "Port of Dover with a very long", 15), ("01010000", "Felixstowe", 7), ("02010000", "Felixstowe", 3)])
    nodes, links = r.country_port_graph("weight", "1998-01")
    assert links.count() == 2 and nodes.count() == 4
    assert dict(rows(r.totals())) == {"FR": 15, "NA": 3, "US": 7}
    assert dict(rows(r.totals("price_per_kilo"))) == {"FR": 7.5, "NA": 3.0, "US": None}
    assert rows(r.series("country", "price", "1998-01"), "country") == [("1998-01", "France", 15), ("1998-01", "Namibia", 3)]
    assert rows(r.series("comcode", "weight"), "month", "comcode") == [
        ("1998-01", "01010000", 2), ("1998-01", "02010000", 1), ("1998-02", "01010000", 0)]
    assert r.extract().count() == 3 and "portname" in r.extract().columns
    points = spark.createDataFrame([("FR", 1, 1, 0.0, 1.0)], "region string, grp int, ord int, lng double, lat double")
    assert rows(r.map(points).select("region", "value")) == [("France", 15)]
    assert rows(r.scaled_map(points).select("region", "value", "suffix")) == [("France", 15.0, "")]
    assert rows(r.bar_layout("country")) == [(2, "dodge")]


def test_scaled_by_what_the_map_shows(spark):
    """A country without an outline does not set the scale."""
    base = result(spark)
    big = imports(spark, FACTS).withColumn("value", F.when(F.col("coo_alpha") == "FR", F.lit(3_000_000_000)).when(F.col("coo_alpha") == "US", F.lit(5_000_000_000_000))
                           .otherwise(F.col("value")).cast("bigint"))
    r = FlowResult(big, IMPORTS, SPEC, base.country, base.comcode, base.port)
    points = spark.createDataFrame([("FR", 1, 1, 0.0, 1.0)], "region string, grp int, ord int, lng double, lat double")
    (name, value, suffix), = rows(r.scaled_map(points).select("region", "value", "suffix"))
    assert name == "France" and suffix == "m" and value >= 3000


def test_nothing_found(spark):
    r = result(spark, QuerySpec(start="2010-01", end="2010-12", codes2=("01",)))
    assert rows(r.status()) == [("Non-EU", "Imports", 0, "01", True)]
    assert r.graph()[1].count() == 0 and r.legend().count() == 0 and r.extract().count() == 0


def test_eu_views(spark):
    facts = spark.createDataFrame([("01010000", "FR", "0199801", 2, 10, 2), ("01010000", "FR", "0199802", 3, 9, 3), ("02010000", "FR", "0199801", 1, 8, 2)],
                                  "smk_comcode string, smk_cod_alpha string, smk_period_reference string, smk_no_of_consignments long, smk_stat_value long, smk_nett_mass long")
    base = result(spark)
    r = FlowResult(facts, ARRIVALS, SPEC, base.country, base.comcode)
    assert dict(rows(r.totals("consignments"))) == {"FR": 6}
    assert dict(rows(r.totals("price_per_kilo"))) == {"FR": 19 / 5 + 4}
    assert rows(r.series("country", "price_per_kilo"), "month") == [("1998-01", "France", 9.0), ("1998-02", "France", 3.0)]
    nodes, links = r.graph("consignments")
    assert sorted(v for _, _, v in rows(links)) == [1, 5] and nodes.count() == 3
    assert r.extract().columns[-2:] == ["consignments", "description"]
    with pytest.raises(ValueError):
        r.country_port_graph()


def test_unknown_spellings_share_a_row(spark):
    odd = [("01010000", c, p, "01/1998", 1, 1) for c in (None, "") for p in (None, "")]
    got = rows(cube.flow_cube(imports(spark, odd), IMPORTS, QuerySpec(start="1998-01", end="1998-01", keep_unknown=True),
                              result(spark).country, port(spark)))
    assert got == [("Unknown Country", "01010000", "Unknown Port", "1998-01", 4, 4)]


def test_code_table(spark):
    nomen = spark.createDataFrame([(1, "I", None, "Section"), (2, "01", "I", "Animals"), (3, "010121", None, "Breeding")],
                                  "line_no long, commoditycode string, parent string, description string")
    control = spark.createDataFrame([("01012100", "Horses"), ("010121", "other text"), ("02030000", "Pork")], "commoditycode string, description string")
    got = builds.build_code_table(nomen, control).orderBy("place", "place_rank").select("commoditycode", "parent", "description")
    assert rows(got) == [("I", "", "Section"), ("01", "I", "Animals"), ("010121", "01", "Breeding"),
                         ("01012100", "010121", "Horses"), ("02030000", "", "Pork")]


def test_port_table(spark):
    ports = spark.createDataFrame([("DOVER", "DVR", "Seaport"), ("Small quay", "DVR", "Seaport"), ("Hull", "HUL", "Seaport"), ("Lost", "LST", "Seaport")],
                                  "portname string, portcode string, type string")
    locode = spark.createDataFrame([("DVR", "Dover", 51.0, 1.0), ("DVR", "Deal", 51.2, 1.4), ("HUL", "Kingston", 53.0, -0.3)],
                                   "portcode string, portname string, lat double, long double")
    extra = spark.createDataFrame([("Dover", "DVR", "Seaport", 9.0, 9.0), ("Dover docks", "DVR", "Seaport", 51.1, None)],
                                  "portname_x string, portcode string, type string, lat double, long double")
    assert rows(builds.build_port_table(ports, locode, extra), "portname") == [
        ("DOVER", "DVR", "Seaport", 51.0, 1.0), ("Hull", "HUL", "Seaport", 53.0, -0.3), ("Lost", "LST", "Seaport", 56.0, 0.0)]
    assert builds.build_port_table(ports, locode, extra, single=False).where("portcode = 'DVR'").count() == 2


def _fact_scans(df):
    return len(re.findall(r"FileScan parquet \[l_", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("name", ["records_per_period", "food_per_period", "aligned_periods", "period_long", "food_long"])
def test_monitoring_scans_the_facts_once(spark, name):
    assert _fact_scans(load_all()[0][name](spark, "/root/testdata/sf0.001")) == 1


@pytest.mark.parametrize("name", ["normalise_file_names", "missing_periods", "country_flags", "non_eu_only", "observed_countries", "tick_periods",
                                  "month_calendar", "end_months", "ascending_range", "scaled_totals", "value_labels", "node_labels", "parse_fact_records"])
def test_monitoring_reads_stored_counts(spark, name):
    assert _fact_scans(load_all()[0][name](spark, "/root/testdata/sf0.001")) == 0


def test_all_flows_at_once(spark):
    data = [("imports", "01010000", "1999-01", 5, 2), ("imports", "30010000", "1999-01", 5, 2), ("imports", "01010000", "2000-02", 1, None),
            ("exports", "02010000", "2000-02", 7, 3), ("arrivals", "01010000", "1999-01", 8, 1), ("arrivals", "01010000", "2000-02", 9, 1),
            ("dispatches", "01010000", "2003-01", 4, 1)]
    flows = spark.createDataFrame(data, "table_name string, comcode string, month string, price long, weight long")
    assert rows(monitor.pivot_flows(monitor.records_of_flows(flows)).select("period", *monitor.FLOWS), "period") == [
        ("199901", 2, None, None, None), ("200002", 1, 1, 1, None)]
    assert rows(monitor.pivot_flows(monitor.balance_of_flows(flows)).select("period", *monitor.FLOWS), "period") == [
        ("199901", 2, None, None, None), ("200002", None, 3, 9, None)]
    assert set(flows.select("table_name").distinct().toPandas().table_name) == set(SHAPES)
