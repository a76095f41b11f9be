"""Run every registered query against its SQL and report differences (also used by the tests)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    return str(x) if x is not None else "\0"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, build, sql, sf_dir):
    """(number of rows, seconds in Spark, None when equal or else a short text)."""
    t = time.time()
    df = build(spark, sf_dir)
    got_names = list(df.columns)
    got = rows_of(got_names, df.collect())
    return len(got), time.time() - t, _differs(con, sql, got_names, got)


def _differs(con, sql, got_names, got):
    con.execute(sql)
    want_names = [d[0] for d in con.description]
    want = rows_of(want_names, con.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b]
        return f"{len(diff)} rows differ, e.g. {diff[0]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = set(sys.argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), e.oracle_sql(), 0
    for name, build in e.queries().items():
        if only and name not in only:
            continue
        n, t = 0, 0.0
        try:
            if name in sql:
                n, t, problem = compare(spark, con, name, build, sql[name], sf_dir)
            else:
                problem = f"no sql, {build(spark, sf_dir).count()} rows"
        except Exception as ex:  # noqa: BLE001
            problem = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {n} rows {t:.1f}s {problem or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
