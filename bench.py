"""Headline timings as one JSON line.

Each query is timed end to end (plan, run, all rows produced): the better of two runs after an untimed
one. ``store_*`` queries run on fact tables that were loaded first, as a user would have them: Parquet by
month.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.operators import cube, dims, graph, hierarchy, monitor  # noqa: E402
from tradewind.plans.flows import ALL, CHAPTERS_1998  # noqa: E402
from tradewind.plans.lookups import parented  # noqa: E402
from tradewind.plans.registry import load_all  # noqa: E402
from tradewind.plans.views import Views  # noqa: E402
from tradewind.schema import FACTS  # noqa: E402
from tradewind.sources.sinks import append_period  # noqa: E402
from tradewind.sources.stage import stage  # noqa: E402
from tradewind.sources.tables import read_facts  # noqa: E402

DIRECT = ["non_eu_imports_cube", "eu_arrivals_cube", "pair_grouping_sets", "series_ppk_country", "records_per_period",
          "flow_links", "flow_nodes", "choropleth", "extract_non_eu", "guarded_append", "upsert_descriptions",
          "nearest_parent", "sections", "parse_fact_records", "load_report"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g").config("spark.checkpoint.dir", work).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def finish(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def timed(name: str, run, warm: bool = True) -> None:
        taken = []
        for _ in range(3 if warm else 1):
            start = time.time()
            run()
            taken.append(time.time() - start)
        times[name] = round(min(taken[1:] or taken), 3)

    queries, _ = load_all()
    for name in DIRECT:
        timed(name, lambda q=queries[name]: finish(q(spark, sf_dir)))

    v = Views(spark, sf_dir)

    def load() -> None:
        base = Views(spark, sf_dir).keep_base()
        for shape in FACTS.values():
            append_period(base.fact(shape.name), f"{work}/{shape.name}", shape, mode="overwrite")

    timed("store_load", load, warm=False)
    country, port, codes = stage(v.country(), "country"), stage(v.port(), "port"), parented(v)
    lookup = stage(dims.desc_lookup(port, country), "lookup")

    def fact(name: str):
        return read_facts(spark, f"{work}/{name}", FACTS[name])

    def stored(name: str, spec, keys=None):
        return cube.flow_cube(fact(name), FACTS[name], spec, country, port if FACTS[name].port else None, keys)

    for name in FACTS:
        timed(f"store_{name}_year", lambda n=name: finish(stored(n, CHAPTERS_1998)))
        timed(f"store_{name}_all", lambda n=name: finish(stored(n, ALL)))
    timed("store_flow_links", lambda: finish(graph.flow_graph(
        stored("imports", ALL, graph.ends_of(graph.FULL_INBOUND)), graph.FULL_INBOUND, lookup)[1]))
    timed("store_series", lambda: finish(cube.series(
        stored("imports", ALL, ("month", "country")), "country", "price_per_kilo")))
    timed("store_records", lambda: finish(monitor.align_by_period(
        *[monitor.records_per_period(fact(n), FACTS[n]) for n in FACTS])))
    timed("code_closure", lambda: hierarchy.closure(codes))
    reach = hierarchy.closure(codes)
    timed("descendants_01_02", lambda: finish(hierarchy.descendants(codes, ["01", "02"], reach)))

    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
