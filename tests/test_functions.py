"""Codes, periods, text and ratios."""

import math

import pytest
from pyspark.sql import functions as F

from tradewind.functions import codes, measures, periods, text
from tradewind.spec import QuerySpec
from tradewind.sources.files import safe_names


def values(spark, inputs, build, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


@pytest.mark.parametrize("picked, patterns", [
    ({}, ["________"]),
    ({"codes2": ("01", "02")}, ["01______", "02______"]),
    ({"codes2": ("01",), "codes4": ("0207",)}, ["0207____"]),
    ({"codes2": ("01",), "codes4": ("All",)}, ["01______"]),
    ({"codes4": ("0102",), "codes6": ("010203",), "codes8": ("All",)}, ["010203__"]),
    ({"codes6": ("010203",), "codes8": ("01020304", "11121314")}, ["01020304", "11121314"]),
])
def test_deepest_level_wins(picked, patterns):
    assert QuerySpec(start="1998-01", end="1998-01", **picked).patterns == patterns


def test_patterns_match_whole_codes_only(spark):
    inputs = ["01020304", "0102030", "010203045", "02020304", "01", None, "1%020304"]
    got = values(spark, inputs, lambda c: codes.code_matches(c, ["01______"]))
    assert got == [True, False, False, False, False, None, False]
    assert values(spark, inputs, lambda c: codes.code_matches(c, ["__02____"])) == [
        True, False, False, True, False, None, True]
    assert values(spark, inputs, lambda c: codes.code_matches(c, ["1%______"]))[-1] is True
    assert values(spark, inputs, lambda c: codes.code_matches(c, ["________"]))[:3] == [True, False, False]
    assert values(spark, ["01020304"], lambda c: codes.code_matches(c, [])) == [False]


def test_long_pattern_lists_give_the_same_rows(spark):
    inputs = [f"{i:04d}0000" for i in range(0, 400, 3)]
    many = [f"{i:04d}____" for i in range(200)]
    assert values(spark, inputs, lambda c: codes.code_matches(c, many)) == [int(x[:4]) < 200 for x in inputs]


def test_labels(spark):
    assert values(spark, ["0101 - Live - horses", "All", "0101"], codes.code_from_label) == ["0101", "All", None]
    assert codes.strip_wildcards(["01______", "020304__"]) == "01,020304"


def test_periods_round_trip(spark):
    for style, raw in [("MM/YYYY", "03/2014"), ("0YYYYMM", "0201403"), ("YYYYMM", "201403"), ("YYYY-MM", "2014-03")]:
        assert values(spark, [raw], lambda c, s=style: periods.to_month(c, s)) == ["2014-03"]
        assert values(spark, ["2014-03"], lambda c, s=style: periods.from_month(c, s)) == [raw]
        assert periods.spell_month("2014-03", style) == raw
    assert periods.month_list("2013-11", "2014-02") == ["2013-11", "2013-12", "2014-01", "2014-02"]
    assert periods.next_month("2013-12") == "2014-01"


def test_publication_lag(spark):
    days = ["2018-03-14", "2018-03-15", "2018-03-16", "2018-01-31", "2018-02-01"]
    on = lambda rule: values(spark, days, lambda c: periods.latest_month(F.to_date(c), 15, rule))
    assert on("from") == ["2017-12", "2018-01", "2018-01", "2017-11", "2017-11"]
    assert on("after") == ["2017-12", "2017-12", "2018-01", "2017-11", "2017-11"]


def test_positions(spark):
    spots = ["5130N 00007W", "5130S 00107E", None, "bad"]
    assert [None if x is None else round(x, 6) for x in values(spark, spots, text.parse_latitude)] == [51.5, -51.5, None, None]
    lon = values(spark, spots, text.parse_longitude)
    assert [None if x is None else round(x, 6) for x in lon] == [-0.116667, 1.116667, None, None]
    odd = values(spark, spots[:2], lambda c: text.parse_longitude(c, "DDMMS"))
    assert [round(x, 6) for x in odd] == [round(-7 / 3600, 6), round(10 / 60 + 7 / 3600, 6)]


def test_text(spark):
    assert values(spark, ["a\x1ab", " é€x "], text.clean_text) == ["ab", "é/x"]
    assert values(spark, ["RS", "GB", "RSA"], lambda c: text.fix_code(c, {"RS": "XS"})) == ["XS", "GB", "RSA"]


def test_ratio_by_zero(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (-1, 0), (0, 0), (None, 0)], "a long, b long")
    null = [r[0] for r in df.select(measures.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert null == [0.5, None, None, None, None]
    ieee = [r[0] for r in df.select(measures.safe_ratio(F.col("a"), F.col("b"), "ieee")).collect()]
    assert ieee[:3] == [0.5, math.inf, -math.inf] and math.isnan(ieee[3]) and ieee[4] is None


def test_safe_names():
    assert safe_names(["SMK-COMCODE", "SMK-SUITE INDICATOR", "A.b", "a  B", "a-b", "1x", "_y", "", "In"]) == [
        "smk_comcode", "smk_suite_indicator", "a_b", "a_b_1", "a_b_2", "X1x", "X_y", "X", "in_"]


def test_prefix_ranges():
    assert codes.prefix_ranges(["02", "01", "0103", "05"]) == [("01", "03"), ("05", "06")]
    assert codes.prefix_ranges([f"{i:02d}" for i in range(10)]) == [("00", "0:")]
    assert codes.prefix_ranges(["\U0010ffff"]) == [("\U0010ffff", "")] and codes.prefix_ranges([]) == []
    ranges = codes.prefix_ranges([f"{i:04d}" for i in range(0, 3000, 3)])
    few = codes.bounds(ranges)
    assert len(ranges) == 1000 and len(few) == 16 and (few[0][0], few[-1][1]) == ("0000", "2998")
    assert all(any(a <= low and high <= b for a, b in few) for low, high in ranges) and codes.bounds(ranges[:5]) == ranges[:5]


@pytest.mark.parametrize("n", [1, 65, 1000])
def test_any_number_of_prefixes_reaches_the_scan(spark, tmp_path, n):
    rnd = __import__("random").Random(n)
    picked = {f"{rnd.randrange(10_000):04d}" for _ in range(n)} | {"77"}
    stored = [f"{rnd.randrange(10**8):08d}" for _ in range(5000)] + ["0101", "77", "7700000X"]
    spark.createDataFrame([(x,) for x in stored], "code string").write.parquet(str(tmp_path / "t"))
    found = spark.read.parquet(str(tmp_path / "t")).where(codes.code_matches(F.col("code"), [p.ljust(8, "_") for p in picked]))
    assert sorted(r.code for r in found.collect()) == sorted(x for x in stored if len(x) == 8 and any(x.startswith(p) for p in picked))
    pushed = found._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(code," in pushed
