"""Operators against small tables and brute force."""

import random

from rows import rows
from pyspark.sql import functions as F

from tradewind.operators import cube, dims, extract, filters, geo, graph, hierarchy, monitor, ordering
from tradewind.schema import ARRIVALS, EXPORTS, IMPORTS
from tradewind.spec import QuerySpec

COUNTRY = [("France", "FR"), ("Namibia", "NA"), ("United States", "US")]
PORT = [("Port of Dover with a very long name", "DOV"), ("Felixstowe", "FXT")]


def country(spark):
    return spark.createDataFrame(COUNTRY, "countryname string, countrycode string")


def port(spark):
    return spark.createDataFrame(PORT, "portname string, portcode string")


def imports(spark, data):
    return spark.createDataFrame(data, "comcode string, coo_alpha string, port_alpha string, account_date string, value long, quantity_1 long")


FACTS = [("01010000", "FR", "DOV", "01/1998", 10, 2), ("01010000", "FR", "DOV", "01/1998", 5, 0),
         ("01010000", "US", "FXT", "02/1998", 7, 0), ("02010000", "NA", "FXT", "01/1998", 3, 1),
         ("02010000", None, "DOV", "01/1998", 100, 1), ("02010000", "ZZ", "DOV", "01/1998", 100, 1),
         ("02010000", "US", "", "01/1998", 100, 1), ("0201", "US", "DOV", "01/1998", 100, 1),
         ("02010000", "US", "DOV", "01/1997", 100, 1)]
SPEC = QuerySpec(start="1998-01", end="1998-12")


def test_all_means_listed(spark):
    got = rows(cube.flow_cube(imports(spark, FACTS), IMPORTS, SPEC, country(spark), port(spark)), "country")
    assert got == [("FR", "01010000", "DOV", "1998-01", 15, 2), ("NA", "02010000", "FXT", "1998-01", 3, 1),
                   ("US", "01010000", "FXT", "1998-02", 7, 0)]


def test_unknown_kept_on_request(spark):
    spec = QuerySpec(start="1998-01", end="1998-12", keep_unknown=True)
    got = rows(cube.flow_cube(imports(spark, FACTS), IMPORTS, spec, country(spark), port(spark)).select("country", "port", "price"),
               "country", "port")
    assert ("Unknown Country", "DOV", 100) in got and ("US", "Unknown Port", 100) in got and len(got) == 5


def test_stored_months_give_the_same_cube(spark):
    raw = imports(spark, FACTS)
    dated = raw.withColumn("month", F.concat(F.substring("account_date", 4, 4), F.lit("-"), F.substring("account_date", 1, 2)))
    a, b = [cube.flow_cube(f, IMPORTS, SPEC, country(spark), port(spark)) for f in (raw, dated)]
    assert sorted(rows(a)) == sorted(rows(b))


def test_narrow_cubes_are_sums_of_the_full_one(spark):
    for spec in (SPEC, QuerySpec(start="1998-01", end="1998-12", keep_unknown=True),
                 QuerySpec(start="1998-01", end="1998-12", countries=("United States",), ports=("Felixstowe",))):
        full = cube.flow_cube(imports(spark, FACTS), IMPORTS, spec, country(spark), port(spark))
        for keys in (("country",), ("port", "month"), ("comcode",), ("country", "comcode", "port")):
            narrow = cube.flow_cube(imports(spark, FACTS), IMPORTS, spec, country(spark), port(spark), keys)
            assert sorted(rows(narrow)) == sorted(rows(cube.sum_by(full, *keys)))


def test_empty_selection(spark):
    none = cube.flow_cube(imports(spark, FACTS), IMPORTS, QuerySpec(start="2010-01", end="2010-02"), country(spark), port(spark))
    assert none.count() == 0
    status = filters.result_status(none, ["01______", "0203____"], "Non-EU", "Imports")
    assert rows(status) == [("Non-EU", "Imports", 0, "01,0203", True)]
    nodes, links = graph.flow_graph(none, graph.FULL_INBOUND, dims.desc_lookup(port(spark), country(spark)))
    assert nodes.count() == 0 and links.count() == 0


def random_cube(spark, n=300, seed=1):
    rnd = random.Random(seed)
    data = {(rnd.choice("ABCDE") * 2, f"{rnd.randrange(1, 9):02d}{rnd.randrange(5):06d}", f"P{rnd.randrange(6)}", f"1998-0{rnd.randrange(1, 4)}"):
            (rnd.randrange(1000), rnd.randrange(50)) for _ in range(n)}
    data = [(*k, *v) for k, v in data.items()]
    return data, spark.createDataFrame(data, "country string, comcode string, port string, month string, price long, weight long").repartition(4)


def test_totals_are_kept_by_rollups(spark):
    data, df = random_cube(spark)
    total = sum(r[4] for r in data)
    for a, b in (("country", "comcode"), ("comcode", "port"), ("country", "port")):
        pairs = cube.pair_rollup(df, a, b)
        assert pairs.agg(F.sum("price")).first()[0] == total
        assert cube.drop_month(pairs).agg(F.sum("price")).first()[0] == total
    steps = (("country", "comcode"), ("comcode", "port"), ("country", "port"))
    by_step = rows(cube.pair_rollups(df, steps).groupBy("step").agg(F.sum("price")), "step")
    assert by_step == [(0, total), (1, total), (2, total)]


def expected_graph(data, steps):
    """Nodes and named links the long way round."""
    names = ["country", "comcode", "port"]
    links = []
    for a, b in steps:
        sums = {}
        for r in data:
            k = (r[names.index(a)], r[names.index(b)])
            sums[k] = sums.get(k, 0) + r[4]
        links += [(*k, v) for k, v in sorted(sums.items())]
    nodes = list(dict.fromkeys([x[0] for x in links] + [x[1] for x in links]))
    return nodes, links


def test_graph_against_brute_force(spark):
    data, df = random_cube(spark)
    lookup = spark.createDataFrame([("AA", "Name of A"), ("P1", "x" * 40)], "key_name string, value string")
    for steps in (graph.FULL_INBOUND, graph.FULL_OUTBOUND, graph.COUNTRY_PORT_INBOUND, graph.EU_OUTBOUND):
        want_nodes, want_links = expected_graph(data, steps)
        nodes, links = graph.flow_graph(df, steps, lookup)
        got = rows(nodes.select("id", "name", "label"), "id")
        assert [g[:2] for g in got] == list(enumerate(want_nodes))
        labels = {name: label for _, name, label in got}
        assert labels.get("AA", "Name of A") == "Name of A" and labels.get("P1", "x" * 30) == "x" * 30
        index = {n: i for i, n in enumerate(want_nodes)}
        assert sorted(rows(links)) == sorted((index[s], index[t], v) for s, t, v in want_links)


def test_ratio_of_sums_and_sum_of_ratios(spark):
    df = spark.createDataFrame([("FR", 10, 2), ("FR", 5, 0), ("US", 7, 0), ("NA", 9, 3), ("NA", 8, 2)], "country string, price long, weight long")
    assert dict(rows(cube.price_per_kilo(df, ["country"]))) == {"FR": 7.5, "US": None, "NA": 3.4}
    assert dict(rows(cube.price_per_kilo(df, ["country"], "ieee")))["US"] == float("inf")
    assert dict(rows(cube.sum_of_ratios(df, ["country"]))) == {"FR": 5.0, "US": None, "NA": 7.0}


def test_country_groups(spark):
    dim = spark.createDataFrame([("A", "AA", True, True), ("B", "BB", False, True), ("C", "CC", True, False), ("D", "DD", False, False)],
                                "countryname string, countrycode string, eu boolean, non_eu boolean")
    eu, other = dims.country_groups(dim)
    assert [r.countrycode for r in eu.orderBy("countrycode").collect()] == ["AA", "CC"]
    assert [r.countrycode for r in other.collect()] == ["BB"]


# --- hierarchy


CODES = ["01", "0101", "010121", "01012100", "01022900", "010229", "02031100", "02", "0203", "09999999", "0988", "098877"]


def codes(spark, items=CODES):
    return spark.createDataFrame([(c,) for c in items], "commoditycode string")


def test_parents(spark):
    nearest = dict(rows(hierarchy.derive_parent(codes(spark))))
    for c in CODES:
        up = [c[:n] for n in range(len(c) - 2, 0, -2) if c[:n] in CODES]
        assert nearest[c] == (up[0] if up else "")
    two = dict(rows(hierarchy.derive_parent(codes(spark), "two_step")))
    for c in CODES:
        up = c[:-2]
        assert two[c] == (up if up in CODES else up[:-2])


def test_descendants(spark):
    dim = codes(spark).join(hierarchy.derive_parent(codes(spark)), "commoditycode")
    parent = dict(rows(dim.select("commoditycode", "parent")))

    def below(roots):
        kids = {c for c in CODES if parent[c] in [r for r in roots if len(r) < 8]}
        return kids | below(kids) if kids else set()

    for roots in (["01"], ["01", "02"], ["0101", "01"], ["01012100"], ["0988"], ["77"]):
        got = [r[0] for r in hierarchy.descendants(dim, roots).collect()]
        assert len(got) == len(set(got)) and set(got) == below(roots)
        for c in got:
            assert any(c.startswith(r) for r in roots)


def test_descendants_of_a_section(spark):
    dim = spark.createDataFrame([("I", ""), ("01", "I"), ("0101", "01"), ("010121", "0101"), ("01012100", "010121"), ("02", "II")],
                                "commoditycode string, parent string")
    assert sorted(r[0] for r in hierarchy.descendants(dim, ["I"]).collect()) == ["01", "0101", "010121", "01012100"]


def test_cascade(spark):
    dim = codes(spark).join(hierarchy.derive_parent(codes(spark)), "commoditycode").withColumn("description", F.lit("d"))
    assert [r[0] for r in hierarchy.cascade(dim, 6, ["01"]).collect()] == ["010121", "010229"]
    assert [r[1] for r in hierarchy.cascade(dim, 4, None).collect()] == ["0101 - d", "0203 - d", "0988 - d"]


def test_sections_are_put_before_their_code(spark):
    nomen = spark.createDataFrame([(1, "I", None, "S1"), (2, "01", "I", "c1"), (3, "0101", "01", "c"), (4, "II", None, "S2"), (5, "02", "II", "c2")],
                                  "line_no long, commoditycode string, parent string, description string")
    starts = hierarchy.section_starts(nomen)
    assert rows(starts.select("commoditycode", "before_code"), "commoditycode") == [("I", "01"), ("II", "02")]
    table = hierarchy.attach_sections(nomen.drop("line_no"), starts)
    assert [(r.commoditycode, r.parent) for r in table.orderBy("place", "place_rank").collect()] == [
        ("I", ""), ("01", "I"), ("0101", "01"), ("II", ""), ("02", "II")]


# --- order


def test_next_in_order_over_buckets(spark):
    rnd = random.Random(3)
    places = sorted(rnd.sample(range(10_000), 500))
    df = spark.createDataFrame([(p, f"v{p}" if p % 7 else None) for p in places], "pos long, v string").repartition(5)
    want = {p: (f"v{q}" if q % 7 else None) for p, q in zip(places, places[1:])} | {places[-1]: None}
    assert {r.pos: r.next_value for r in ordering.next_in_order(df, "v", ["pos"]).collect()} == want


def test_global_rank(spark):
    names = sorted({f"{random.Random(i).randrange(10**6):06d}" for i in range(400)})
    df = spark.createDataFrame([(n,) for n in names], "n string").repartition(6)
    assert rows(ordering.global_rank(df, ["n"]), "id") == [(n, i) for i, n in enumerate(names)]
    assert ordering.global_rank(df.limit(0), ["n"]).count() == 0


def test_ranges_hold_their_share_of_equal_keys(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id")).alias("k"), "id").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # so few rows would be one range
    try:
        ranges, sizes = ordering.ranges_in_order(df, ["k", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sizes.count() > 2 and sizes.agg(F.max("_n")).first()[0] < 2 * 20_000 / sizes.count()
    got = rows(ordering.global_rank(df, ["k", "id"], "at"), "at")
    assert [r[:2] for r in got] == sorted((7 if i % 3 else i, i) for i in range(20_000)) and [r[2] for r in got] == list(range(20_000))


def test_late_page_reads_one_range(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k"), F.lit("x" * 50).alias("v"))
    late = ordering.page(df, ["k"], 25, 3_900)
    want = sorted(i * 7919 % 100_003 for i in range(100_000))[3_899 * 25:3_900 * 25]
    assert [r.k for r in late.collect()] == want
    assert "PushedFilters: [" in (plan := late._jdf.queryExecution().executedPlan().toString()) and "GreaterThanOrEqual(_at," in plan
    assert ordering.page(df, ["k"], 25, 5_000).count() == 0


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "q"), ("b", None, "w"), ("b", 3, "v")],
                               "k string, o int, v string")
    assert rows(ordering.first_per_key(df, "k", ["o"]), "k") == [(None, 5, "q"), ("a", 1, "y"), ("b", None, "w")]


def test_ticks_and_pages(spark):
    df = spark.createDataFrame([(f"{y}{m:02d}",) for y in (1998, 1999) for m in range(1, 13)] * 2, "period string")
    assert [r[0] for r in ordering.every_nth(df, "period", 3).orderBy("period").collect()] == [
        f"{y}{m:02d}" for y in (1998, 1999) for m in (1, 4, 7, 10)]
    assert [r[0] for r in ordering.page(df.distinct(), ["period"], 5, 2).collect()] == ["199806", "199807", "199808", "199809", "199810"]


# --- lookups


def brute_resolve(ports, coords):
    pairs = []
    for p in ports:
        hits = [c for c in coords if c[1] == p[1]]
        pairs += [(p, c) for c in hits] or [(p, None)]
    count = {}
    for p, _ in pairs:
        count[p[1]] = count.get(p[1], 0) + 1
    return [(p[0], p[1], c and c[2]) for p, c in pairs
            if count[p[1]] == 1 or (c and p[0][:3] == c[0][:3])]


def test_ports_against_brute_force(spark):
    rnd = random.Random(5)
    name = lambda: rnd.choice(["DOVER", "DOVer", "HULL", "Hull", "Leith"]) + str(rnd.randrange(3))
    ports = list({(name(), f"P{rnd.randrange(12)}", "Seaport") for _ in range(30)})
    coords = list({(name(), f"P{rnd.randrange(15)}"): 0 for _ in range(25)})
    coords = [(n, c, float(i), -float(i)) for i, (n, c) in enumerate(coords)]
    p = spark.createDataFrame(ports, "portname string, portcode string, type string")
    c = spark.createDataFrame(coords, "portname string, portcode string, lat double, long double")
    got = [(r.portname, r.portcode, r.lat) for r in dims.resolve_ports(p, c).collect()]
    assert sorted(got, key=str) == sorted(brute_resolve(ports, coords), key=str)

    many = {x[1]: sum(y[1] == x[1] for y in ports) for x in ports}
    want = sorted(x for x in ports if many[x[1]] == 1 or x[0][:3].isupper())
    assert sorted(rows(dims.keep_main_ports(p))) == want


def test_lookup_prefers_ports(spark):
    ports = spark.createDataFrame([("Zeta", "AA"), ("Alpha", "AA"), ("", "BB")], "portname string, portcode string")
    places = spark.createDataFrame([("Country A", "AA"), ("Country B", "BB"), (None, "CC")], "countryname string, countrycode string")
    assert rows(dims.desc_lookup(ports, places), "key_name") == [("AA", "Alpha"), ("BB", "Country B")]


def test_legend_lists_only_codes_in_play(spark):
    data, df = random_cube(spark)
    dim = spark.createDataFrame([(c, "d" + c) for c in {r[1] for r in data[:50]}] + [("99999999", "no")], "commoditycode string, description string")
    legend = rows(dims.code_legend(df, dim))
    assert [x[0] for x in legend] == sorted({r[1] for r in data})


def test_missing_positions(spark):
    df = spark.createDataFrame([("P", None, 1.5), ("Q", 50.0, None)], "portcode string, lat double, long double")
    assert rows(filters.fill_unknown(df), "portcode") == [("P", 56.0, 1.5), ("Q", 50.0, 0.0)]


# --- maps and extracts


def test_scaling(spark):
    for top, suffix, want in ((5e8, "", 5e8), (2e9, "m", 2e3), (3e12, "b", 3e3)):
        df = spark.createDataFrame([("A", int(top)), ("B", 10)], "country string, value long")
        got = {r.country: (r.value, r.suffix) for r in geo.scale_values(df).collect()}
        assert got["A"] == (want, suffix)


def test_rings_in_pieces(spark):
    pts = spark.createDataFrame([(g, i, float(i), float(-i)) for g in (1, 2) for i in range(25)], "grp int, ord int, lng double, lat double").repartition(5)
    got = geo.polygon_rings(pts, piece=10).orderBy("grp", "piece").collect()
    assert [len(r.ring) for r in got] == [10, 10, 5] * 2
    assert [p.lng for r in got if r.grp == 1 for p in r.ring] == [float(i) for i in range(25)]


def test_whole_rings(spark):
    pts = spark.range(25_000).select(F.lit(1).alias("grp"), F.col("id").alias("ord"), F.col("id").cast("double").alias("lng"), F.lit(0.0).alias("lat")).repartition(7)
    got = geo.polygon_rings(pts.unionByName(pts.where("ord < 3").withColumn("grp", F.lit(2))), whole=True).orderBy("grp").collect()
    assert [len(r.ring) for r in got] == [25_000, 3] and [p.lng for p in got[0].ring] == [float(i) for i in range(25_000)]


def test_choropleth_keeps_infinite_drops_missing(spark):
    points = spark.createDataFrame([("RS", 1, 1, 0.0, 0.0), ("FR", 2, 1, 1.0, 1.0), ("US", 3, 1, 2.0, 2.0), ("NA", 4, 1, 2.0, 2.0)],
                                   "region string, grp int, ord int, lng double, lat double")
    totals = spark.createDataFrame([("XS", 5.0), ("FR", float("inf")), ("US", None), ("NA", float("nan"))], "country string, value double")
    got = rows(geo.choropleth(points, totals, country(spark)).select("region", "grp", "value"), "grp")
    assert got == [(None, 1, 5.0), ("France", 2, float("inf"))]


def test_bar_layout(spark):
    df = spark.createDataFrame([(f"1998-{m:02d}",) for m in range(1, 8)], "month string")
    assert rows(geo.bar_layout(df)) == [(7, "stack")]
    assert rows(geo.bar_layout(df.where("month < '1998-07'"))) == [(6, "dodge")]


def test_extract(spark):
    df = cube.flow_cube(imports(spark, FACTS), IMPORTS, SPEC, country(spark), port(spark))
    dim = spark.createDataFrame([("01", "Live animals"), ("01010000", "Horses")], "commoditycode string, description string")
    gates = port(spark).withColumn("type", F.lit("Seaport"))
    out = extract.with_headers(extract.enrich_extract(df, dim, country(spark), gates))
    assert out.columns[0] == "2-Digit Comcode" and "Value (£)" in out.columns and len(out.columns) == 12
    assert out.count() == 3
    first = out.where("`Country Code` = 'FR'").first()
    assert first["2-Digit Description"] == "Live animals" and first["Commodity Description"] == "Horses"
    assert out.where("`Country Code` = 'NA'").first()["2-Digit Description"] is None


# --- monitoring


def test_reports(spark):
    i = monitor.records_per_period(imports(spark, FACTS + [("1", "FR", "DOV", None, 1, 1)]), IMPORTS)
    assert sorted(rows(i), key=str) == [("199701", 1), ("199801", 7), ("199802", 1), (None, 0)]
    eu = spark.createDataFrame([("01010000", "FR", "0200101", 1, 2, 3), ("24010000", "FR", "0200101", 1, 2, 3), ("01010000", "FR", "0199801", 1, 2, 3)],
                               "smk_comcode string, smk_cod_alpha string, smk_period_reference string, smk_no_of_consignments long, smk_stat_value long, smk_nett_mass long")
    assert rows(monitor.records_per_period(eu, ARRIVALS)) == [("200101", 2)]
    assert rows(monitor.chapter_balance(eu, ARRIVALS)) == [("200101", 2)]
    exp = imports(spark, FACTS[:2]).withColumnRenamed("coo_alpha", "cod_alpha")
    e = monitor.records_per_period(exp, EXPORTS)
    aligned = monitor.align_by_period(i.where("period is not null"), e, monitor.records_per_period(eu, ARRIVALS), e)
    long = rows(monitor.to_long(aligned, ["1997"]), "period", "type")
    assert long == [("199801", "Arrival", None), ("199801", "Dispatch", 2), ("199801", "Export", 2), ("199801", "Import", 7),
                    ("199802", "Arrival", None), ("199802", "Dispatch", None), ("199802", "Export", None), ("199802", "Import", 1)]


def test_missing_files(spark):
    span = spark.createDataFrame([("1998-11", "1999-01")], "first string, last string")
    expected = monitor.expected_files(span, {"imports": "SMKI19", "exports": "SMKE19"})
    present = spark.createDataFrame([("SMKI199811",), ("SMKE199901",), ("SMKX469901",)], "file string")
    got = sorted(r.file for r in monitor.missing_files(expected, present).collect())
    assert got == ["SMKE199811", "SMKE199812", "SMKI199812", "SMKI199901"]
    counts = spark.createDataFrame([("SMKI199811", 10, 0), ("SMKE199901", 5, 2)], "file string, loaded long, rejected long")
    report = {r.file: tuple(r)[1:] for r in monitor.load_report(expected, counts).collect()}
    assert len(report) == 6 and report["SMKI199811"] == ("loaded", 10, 0)
    assert report["SMKE199901"] == ("rejects", 5, 2) and report["SMKE199812"] == ("missing", 0, 0)


def test_search(spark):
    dim = spark.createDataFrame([("0101", "Live horses"), ("0102", "Live cattle"), ("02", "Meat")], "commoditycode string, description string")
    assert [r[0] for r in filters.search_codes(dim, "LIVE 02").collect()] == ["0102"]
    assert filters.search_codes(dim, codes=["02", "0101"]).count() == 2


def test_calendar(spark):
    day = spark.createDataFrame([("2018-03-16",)], "d string").select(F.to_date("d").alias("d"))
    months = [r[0] for r in filters.available_months(day, "d").orderBy("month").collect()]
    assert months[0] == "2009-01" and months[-1] == "2018-01" and len(months) == 109
    cal = filters.available_months(day, "d")
    assert [r[0] for r in filters.ascending_range(cal, "2017-11", "2018-01").collect()] == ["2017-11", "2017-12", "2018-01"]
    assert filters.end_months(cal, "2017-12").count() == 2


def test_open_ended_months(spark):
    from tradewind.operators import cube
    from tradewind.schema import IMPORTS
    from tradewind.spec import QuerySpec
    facts = spark.createDataFrame([("01011010", "A", "P", m, 1, 2) for m in ("03/1990", "07/2031", "06/1998")],
                                  "comcode string, coo_alpha string, port_alpha string, account_date string, value long, quantity_1 long")
    country = spark.createDataFrame([("A", "Aland")], "countrycode string, countryname string")
    port = spark.createDataFrame([("P", "Porto")], "portcode string, portname string")
    def months(**bounds):
        return sorted(r.month for r in cube.flow_cube(facts, IMPORTS, QuerySpec(**bounds), country, port).collect())
    assert months() == ["1990-03", "1998-06", "2031-07"]
    assert months(start="1995-01") == ["1998-06", "2031-07"]
    assert months(end="2001-12") == ["1990-03", "1998-06"]
    assert months(start="1995-01", end="2001-12") == ["1998-06"]


def test_closure(spark):
    chain = ["I", "01", "0101", "01011", "010110", "0101100", "01011001"]
    dim = spark.createDataFrame([*zip(chain[1:], chain), ("99", "98"), ("98", "99"), ("77", ""), ("88", None)], "commoditycode string, parent string")
    reach = hierarchy.closure(dim)
    want = {(chain[a], chain[b], b - a) for a in range(7) for b in range(a + 1, 7)} | {("98", "99", 1), ("99", "98", 1), ("98", "98", 2), ("99", "99", 2)}
    assert set(rows(reach)) == want and reach.count() == len(want)
    assert {r[0] for r in hierarchy.descendants(dim, ["0101"], reach).collect()} == set(chain[3:])
    assert hierarchy.closure(dim.limit(0)).count() == 0


def test_descendants_of_a_deep_chain_and_a_circle(spark):
    chain = ["I", "01", "0101", "01011", "010110", "0101100", "01011001"]
    dim = spark.createDataFrame([*zip(chain[1:], chain), ("99", "98"), ("98", "99")], "commoditycode string, parent string")
    assert {r.commoditycode for r in hierarchy.descendants(dim, ["I"]).collect()} == set(chain[1:])
    assert {r.commoditycode for r in hierarchy.descendants(dim, ["99"]).collect()} == {"98", "99"}
    assert hierarchy.descendants(dim, []).count() == 0


def test_order_keeps_null_keys(spark):
    df = spark.createDataFrame([("1998-01",), ("1998-02",), (None,)], "n string")
    got = {r.n: r.id for r in ordering.global_rank(df, ["n"]).collect()}
    assert got == {None: 0, "1998-01": 1, "1998-02": 2}
