"""Stored tables, guard, upsert, incremental loads."""

import io
import zipfile

from rows import rows
from pyspark.sql import functions as F

from tradewind.operators import cube, extract, monitor
from tradewind.schema import COMCODE_SCHEMA, CONTROL_COLUMNS, IMPORTS
from tradewind.sources import sinks, stage, store, tables
from tradewind.spec import QuerySpec
from tradewind.streaming import ingest


def facts(spark, month, n, value=1):
    return spark.range(n).select(F.lit("01010000").alias("comcode"), F.lit("FR").alias("coo_alpha"), F.lit("DOV").alias("port_alpha"),
                                 F.lit(month).alias("account_date"), F.lit(value).cast("long").alias("value"),
                                 F.col("id").alias("quantity_1"))


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_or_replace(spark, COMCODE_SCHEMA, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).schema == COMCODE_SCHEMA


def test_months_are_pruned(spark, tmp_path):
    path = str(tmp_path / "facts")
    sinks.append_period(facts(spark, "01/1998", 60).unionByName(facts(spark, "02/1998", 30)), path, IMPORTS)
    sinks.append_period(facts(spark, "03/1998", 10), path, IMPORTS)
    stored = tables.read_facts(spark, path, IMPORTS)
    assert dict(stored.dtypes)["month"] == "string"
    assert rows(stored.groupBy("month").count(), "month") == [("1998-01", 60), ("1998-02", 30), ("1998-03", 10)]
    assert sinks.period_count(stored, "account_date", "02/1998") == 30
    country = spark.createDataFrame([("France", "FR")], "countryname string, countrycode string")
    port = spark.createDataFrame([("Dover", "DOV")], "portname string, portcode string")
    spec = QuerySpec(start="1998-02", end="1998-03", codes2=("01",))
    out = cube.flow_cube(stored, IMPORTS, spec, country, port)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "GreaterThanOrEqual(comcode,01), LessThan(comcode,02)" in plan
    assert "quantity_2" not in plan
    assert rows(out.select("month", "price"), "month") == [("1998-02", 30), ("1998-03", 10)]


def test_stored_counts_read_no_columns(spark, tmp_path):
    path = str(tmp_path / "facts")
    raw = facts(spark, "01/1998", 60).unionByName(facts(spark, "02/1998", 30))
    sinks.append_period(raw, path, IMPORTS)
    stored = tables.read_facts(spark, path, IMPORTS)
    counts = monitor.records_per_period(stored, IMPORTS)
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()
    assert rows(counts, "period") == rows(monitor.records_per_period(raw, IMPORTS), "period") == [("199801", 60), ("199802", 30)]
    assert rows(monitor.chapter_balance(stored, IMPORTS), "period") == rows(monitor.chapter_balance(raw, IMPORTS), "period")


def test_guard(spark):
    old = facts(spark, "01/1998", 50).unionByName(facts(spark, "02/1998", 51))
    new = facts(spark, "01/1998", 3).unionByName(facts(spark, "02/1998", 3)).unionByName(facts(spark, "03/1998", 3)) \
        .unionByName(facts(spark, None, 2))
    kept = sinks.guarded_append(new, old, "account_date")
    assert sorted(rows(kept.groupBy("account_date").count()), key=str) == [("01/1998", 3), ("03/1998", 3), (None, 2)]
    both = old.unionByName(kept.select(old.columns))
    again = sinks.guarded_append(new, both, "account_date")
    assert again.where("account_date = '02/1998'").count() == 0 and again.where("account_date = '01/1998'").count() == 0


def test_upsert_follows_load_order(spark):
    data = [("A", "s1", "first", 1), ("A", "s2", "second", 2), ("A", "s3", "third", 3), ("B", None, "only", 2)]
    df = spark.createDataFrame(data, "k string, s string, d string, n int").repartition(3)
    assert rows(sinks.upsert_descriptions(df, "k", ["d"], ["n"]), "k") == [("A", "s1", "third"), ("B", None, "only")]
    turned = df.withColumn("n", -F.col("n"))
    assert rows(sinks.upsert_descriptions(turned, "k", ["d"], ["n"]), "k") == [("A", "s3", "first"), ("B", None, "only")]
    stored = spark.createDataFrame([("A", "s0", "old"), ("C", "s9", "kept")], "k string, s string, d string")
    assert rows(sinks.upsert_table(stored, df, "k", ["d"], ["n"]), "k") == [
        ("A", "s0", "third"), ("B", None, "only"), ("C", "s9", "kept")]


def test_extract_file(spark, tmp_path):
    df = spark.createDataFrame([("01", "Live, \"wild\"", "01010000", "FR", "France", "1998-01", 5, 2, "Horses")], ", ".join(
        f"{c} {'long' if c in ('price', 'consignments') else 'string'}" for c in extract.EU_EXTRACT))
    sinks.write_extract(df, str(tmp_path / "x"))
    back = spark.read.csv(str(tmp_path / "x"), header=True, escape='"')
    assert back.columns == [extract.HEADERS[c] for c in extract.EU_EXTRACT]
    assert back.first()["2-Digit Description"] == 'Live, "wild"'


def test_staged_tables(spark):
    df = stage.stage(spark.range(5).withColumn("x", F.col("id") * 2), "demo")
    assert "/tradewind/" in df.inputFiles()[0] and sorted(rows(df)) == [(i, 2 * i) for i in range(5)]


def import_line(date, value):
    f = [""] * 26
    f[0], f[6], f[7], f[9], f[23], f[24] = "0101210000", "US", date, "DOV", str(value), "1"
    return "|".join(f)


def drop_file(folder, name, lines):
    (folder / name).write_text("\n".join(["HEAD", *lines, "TAIL"]) + "\n")


def test_new_checkpoint_loads_no_month_twice(spark, tmp_path):
    src, dst = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for month in ("01", "02"):
        drop_file(src, f"SMKI1998{month}", [import_line(f"{month}/1998", i) for i in range(60)])
    for n in range(2):
        ingest.ingest_available(spark, str(src), str(dst), str(tmp_path / f"ckpt{n}"), IMPORTS)
        got = rows(tables.read_facts(spark, str(dst / "facts"), IMPORTS).groupBy("month").count(), "month")
        assert got == [("1998-01", 60), ("1998-02", 60)]


def test_incremental_facts(spark, tmp_path):
    src, dst, ckpt = tmp_path / "in", tmp_path / "out", str(tmp_path / "ckpt")
    src.mkdir()
    run = lambda: ingest.ingest_available(spark, str(src), str(dst), ckpt, IMPORTS)
    counts = lambda: rows(tables.read_facts(spark, str(dst / "facts"), IMPORTS).groupBy("month").count(), "month")
    drop_file(src, "SMKI199801", [import_line("01/1998", i) for i in range(60)] + [import_line("01/1998", "bad")])
    drop_file(src, "SMKI199802", [import_line("02/1998", i) for i in range(20)])
    run()
    assert counts() == [("1998-01", 60), ("1998-02", 20)]
    run()                                                   # nothing new
    assert counts() == [("1998-01", 60), ("1998-02", 20)]
    drop_file(src, "SMKI199801B", [import_line("01/1998", i) for i in range(5)])     # month already loaded
    drop_file(src, "SMKI199802B", [import_line("02/1998", i) for i in range(5)])     # 20 rows so far: still open
    drop_file(src, "SMKI199803", [import_line("03/1998", i) for i in range(7)])
    run()
    assert counts() == [("1998-01", 60), ("1998-02", 25), ("1998-03", 7)]
    assert spark.read.parquet(str(dst / "rejects")).count() == 1
    report = spark.read.parquet(str(dst / "reports"))
    assert sorted((r.file.rsplit("/", 1)[-1], r.status, r.lines, r.rows, r.stored, r.rejects) for r in report.collect()) == [
        ("SMKI199801", "rejects", 63, 60, 60, 1), ("SMKI199801B", "skipped", 7, 5, 0, 0), ("SMKI199802", "loaded", 22, 20, 20, 0),
        ("SMKI199802B", "loaded", 7, 5, 5, 0), ("SMKI199803", "loaded", 9, 7, 7, 0)]


def test_load_with_encoding_and_missing_values(spark, tmp_path):
    src, dst = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "SMKI199801").write_bytes(("\n".join(["HEAD", import_line("01/1998", 1).replace("US", "NA"), import_line("01/1998", 2).replace("DOV", "É"), "TAIL"])).encode("latin-1"))
    drop_file(src, "SMKI199802", [])
    ingest.ingest_available(spark, str(src), str(dst), str(tmp_path / "ckpt"), IMPORTS, encoding="ISO-8859-1", na_strings=["NA"])
    stored = tables.read_facts(spark, str(dst / "facts"), IMPORTS)
    assert rows(stored.select("value", "coo_alpha", "port_alpha"), "value") == [(1, None, "DOV"), (2, "US", "É")]
    report = spark.read.parquet(str(dst / "reports"))
    assert rows(report.select("status", "stored"), "status") == [("empty", 0), ("loaded", 2)]


def test_incremental_control(spark, tmp_path):
    src, dst, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    line = lambda code, sitc, text: "|".join([code, *["x"] * 6, sitc, *["x"] * 18, text])
    assert len(line("0", "0", "0").split("|")) == len(CONTROL_COLUMNS)
    drop_file(src, "SMKA121201", [line("0101210000", "s1", "old"), line("0101290000", "s1", "kept")])
    ingest.ingest_control(spark, str(src), dst, ckpt)
    drop_file(src, "SMKA121202", [line("0101210000", "s2", "new"), line("0102000000", "s2", "added")])
    ingest.ingest_control(spark, str(src), dst, ckpt)
    table = ingest.read_control_table(spark, dst)
    assert rows(table.select("mk_comcode", "mk_sitc_no", "mk_commodity_alpha_1"), "mk_comcode") == [
        ("01012100", "s1", "new"), ("01012900", "s1", "kept"), ("01020000", "s2", "added")]


def month_of(rows_by_month, issue):
    return rows_by_month.withColumn("issue", F.lit(issue)).withColumn("file", F.lit(f"v{issue}")).transform(lambda d: sinks.with_month(d, IMPORTS))


def totals(spark, dst):
    return rows(store.read_store(spark, dst, IMPORTS).groupBy("month").agg(F.count("*"), F.sum("value")), "month")


def test_later_issue_takes_the_month(spark, tmp_path):
    old, new = month_of(facts(spark, "05/2014", 60), 1), month_of(facts(spark, "05/2014", 70, value=2), 2)
    other = month_of(facts(spark, "06/2014", 5), 1)
    for name, order in (("up", [(old, "a"), (new, "b")]), ("down", [(new, "b"), (old, "a")]), ("again", [(old, "a"), (new, "b"), (new, "c"), (old, "a")])):
        dst = str(tmp_path / name)
        for df, load_id in order:
            store.write_load(df.unionByName(other) if load_id == "a" else df, dst, IMPORTS, load_id)
        assert totals(spark, dst) == [("2014-05", 70, 140), ("2014-06", 5, 5)]
    both = str(tmp_path / "both")
    store.write_load(old.unionByName(new), both, IMPORTS, "one")
    assert totals(spark, both) == [("2014-05", 70, 140)]


def test_compaction(spark, tmp_path):
    dst = str(tmp_path / "t")
    for i in range(3):
        store.write_load(month_of(facts(spark, "01/2015", 20, value=i).unionByName(facts(spark, None, 2)), 1), dst, IMPORTS, f"l{i}")
    store.write_load(month_of(facts(spark, "02/2015", 5), 1), dst, IMPORTS, "l3")
    before = totals(spark, dst)
    assert before == [(None, 6, 6), ("2015-01", 60, 60), ("2015-02", 5, 5)]
    sinks.append_period(facts(spark, "01/2015", 99), f"{dst}/facts/load_id=compact-dead", IMPORTS)     # died before its manifest line
    assert totals(spark, dst) == before
    load_id = store.compact(spark, dst, IMPORTS)
    assert totals(spark, dst) == before and store.compact(spark, dst, IMPORTS) is None
    live = store.live_months(spark, dst)
    assert rows(live.select("month", "load_id"), "month") == [(None, load_id), ("2015-01", load_id), ("2015-02", "l3")]
    store.write_load(month_of(facts(spark, "01/2015", 5), 1), dst, IMPORTS, "late")                    # 60 rows by now: closed
    store.write_load(month_of(facts(spark, "01/2015", 7, value=3), 2), dst, IMPORTS, "second")          # a later issue still goes in
    assert totals(spark, dst) == [(None, 6, 6), ("2015-01", 7, 21), ("2015-02", 5, 5)]
    assert store.dead_folders(spark, dst, IMPORTS).where("load_id = 'l1'").count() == 2


def test_empty_store(spark, tmp_path):
    dst = str(tmp_path / "none")
    assert store.read_store(spark, dst, IMPORTS).count() == 0 and store.compact(spark, dst, IMPORTS) is None
    store.write_load(month_of(facts(spark, "01/2015", 0), 1), dst, IMPORTS, "x")
    assert store.read_store(spark, dst, IMPORTS).count() == 0


def test_undecodable_file_is_set_aside(spark, tmp_path):
    src, dst = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    drop_file(src, "SMKI199801", [import_line("01/1998", i) for i in range(3)])
    (src / "SMKI199802").write_bytes(("\n".join(["HEAD", import_line("02/1998", 1), "É", "TAIL"])).encode("latin-1"))
    ingest.ingest_available(spark, str(src), dst, str(tmp_path / "ckpt"), IMPORTS)
    assert totals(spark, dst) == [("1998-01", 3, 3)]
    report = spark.read.parquet(f"{dst}/reports")
    assert sorted((r.file[-2:], r.status, r.lines, r.stored) for r in report.collect()) == [("01", "loaded", 5, 3), ("02", "unreadable", 4, 0)]


def test_load_from_archives(spark, tmp_path):
    src, dst, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    text = lambda month, n, value=1: "\n".join(["HEAD", *[import_line(month, value)] * n, "TAIL"])
    control = "\n".join(["HEAD", "|".join(["0101210000", *["x"] * 25, "HORSES"]), "TAIL"])

    def pack(name, *members):
        with zipfile.ZipFile(src / name, "w", zipfile.ZIP_DEFLATED) as z:
            for n, content in members:
                z.writestr(n, content)

    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("smki199803.txt", text("03/1998", 4))
    pack("a.zip", ("SMKI199801.TXT", text("01/1998", 60)), ("SMKI199802", text("02/1998", 3)), ("SMKI199803.zip", inner.getvalue()), ("SMKA129801", control), ("readme", "?"))
    (src / "bad.zip").write_bytes(b"PK nothing")
    load = lambda: ingest.ingest_archives(spark, str(src), dst, ckpt)
    load()
    first = [("1998-01", 60, 60), ("1998-02", 3, 3), ("1998-03", 4, 4)]
    assert totals(spark, f"{dst}/imports") == first
    assert ingest.read_control_table(spark, f"{dst}/control").first().mk_commodity_alpha_1 == "HORSES"
    load()                                                  # nothing new
    assert totals(spark, f"{dst}/imports") == first
    pack("b.zip", ("SMKI199801V2.TXT", text("01/1998", 8, 5)), ("SMKI199803", text("03/1998", 2)))
    load()
    assert totals(spark, f"{dst}/imports") == [("1998-01", 8, 40), ("1998-02", 3, 3), ("1998-03", 6, 6)]
    aside = spark.read.parquet(f"{dst}/archives").where("error IS NOT NULL")
    assert sorted((r.archive.rsplit("/", 1)[-1], r.file, r.error.split(":")[0]) for r in aside.collect()) == [
        ("a.zip", "README", "no known family"), ("bad.zip", None, "BadZipFile")]
    report = spark.read.parquet(f"{dst}/imports/reports")
    assert sorted((r.file.rsplit("!", 1)[-1], r.status, r.stored) for r in report.collect()) == [
        ("SMKI199801", "loaded", 8), ("SMKI199801", "loaded", 60), ("SMKI199802", "loaded", 3), ("SMKI199803", "loaded", 2), ("SMKI199803", "loaded", 4)]
    assert spark.read.parquet(f"{dst}/exports/reports").count() == 0


def test_loads_without_a_manifest_are_adopted(spark, tmp_path):
    dst = str(tmp_path / "old")
    for load_id, month, n in (("a", "01/2015", 60), ("b", "02/2015", 5)):
        sinks.append_period(facts(spark, month, n), f"{dst}/facts/load_id={load_id}", IMPORTS)
    assert totals(spark, dst) == []
    store.adopt(spark, dst, IMPORTS)
    store.write_load(month_of(facts(spark, "01/2015", 3).unionByName(facts(spark, "02/2015", 3)), 1), dst, IMPORTS, "c")
    store.adopt(spark, dst, IMPORTS)
    assert totals(spark, dst) == [("2015-01", 60, 60), ("2015-02", 8, 8)]
