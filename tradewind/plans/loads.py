"""Queries over the loads: parsing, casting, guard, upsert, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import monitor
from tradewind.plans.registry import query
from tradewind.schema import EXPORTS, FILE_FAMILIES, IMPORTS
from tradewind.sources import archives, files, sinks, store, tables
from tradewind.sources.stage import new_folder, stage
from tradewind.streaming import ingest

_FILE = "'SMKI19' || account_date[6:7] || account_date[1:2]"


def _parsed(v):
    """The month files as they would lie in a folder, parsed."""
    return files.fact_records(v.fact_lines(), IMPORTS)


@query("parse_fact_records", f"""
SELECT {_FILE} AS file, comcode, coalesce(coo_alpha, '') AS coo_alpha, port_alpha, account_date,
  cast(value AS varchar) || CASE WHEN l_linenumber = 3 THEN 'x' ELSE '' END AS value,
  CASE WHEN l_linenumber <> 2 THEN cast(quantity_1 AS varchar) END AS quantity_1 FROM import_rows""")
def parse_fact_records(v):
    return _parsed(v).select("file", "comcode", "coo_alpha", "port_alpha", "account_date", "value", "quantity_1")


@query("archive_records", f"""
SELECT {_FILE} AS file, 1 + cast(account_date[1:2] IN ('05', '06') AS int) AS issue, comcode, account_date,
  cast(value AS varchar) || CASE WHEN l_linenumber = 3 THEN 'x' ELSE '' END AS value FROM import_rows""")
def archive_records(v):
    """The month files read from yearly archives, some as second issues."""
    read, _ = archives.read_members(_yearly_archives(v, new_folder(v.spark, "zips"), issues=True))
    return files.fact_records(read, IMPORTS, keep=["issue"]).select("file", "issue", "comcode", "account_date", "value")


@query("ingested_archives", """
SELECT account_date[4:7] || '-' || account_date[1:2] AS month, count(*) FILTER (l_linenumber <> 3) AS n,
  cast(coalesce(sum(value) FILTER (l_linenumber <> 3), 0) AS bigint) AS total, count(*) FILTER (l_linenumber = 3) AS rejects FROM import_rows GROUP BY 1""")
def ingested_archives(v):
    """The archives loaded by the stream, twice: what the second run finds has been loaded."""
    folder, dst = new_folder(v.spark, "arrivals"), new_folder(v.spark, "store")
    _yearly_archives(v, folder, issues=False)
    checkpoint = new_folder(v.spark, "checkpoint")
    for _ in range(2):
        ingest.ingest_archives(v.spark, folder, dst, checkpoint, {"imports": IMPORTS})
    stored = store.read_store(v.spark, f"{dst}/imports", IMPORTS).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    wrong = v.spark.read.parquet(f"{dst}/imports/rejects").groupBy(F.col("month").cast("string").alias("_m")).agg(F.count(F.lit(1)).alias("rejects"))
    both = stored.join(wrong, F.col("month") == F.col("_m"), "full")
    return both.select(F.coalesce("month", "_m").alias("month"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0)).alias("total"),
                       F.coalesce("rejects", F.lit(0)).alias("rejects"))


@query("stored_periods", "SELECT account_date AS period, count(*) AS n FROM exports WHERE account_date IN ('02/1996', '03/1996', '07/1998') GROUP BY 1")
def stored_periods(v):
    """A table created empty, then filled in two goes; periods are counted as the guard counts them."""
    path = new_folder(v.spark, "exports")
    sinks.create_or_replace(v.spark, tables.fact_schema(EXPORTS), f"{path}/month=none")
    rows = stage(v.exports(), "exports")
    for part in (rows.where("value % 2 = 0"), rows.where("value % 2 = 1")):
        sinks.append_period(part, path, EXPORTS)
    stored = tables.read_facts(v.spark, path, EXPORTS)
    counted = [(p, sinks.period_count(stored, "account_date", p)) for p in ("02/1996", "03/1996", "07/1998")]
    return v.spark.createDataFrame([x for x in counted if x[1]], "period string, n long")


def _yearly_archives(v, folder: str, issues: bool) -> DataFrame:
    """The month files packed by year; every other year as archives in an archive."""
    lines, year, mm = v.fact_lines(), F.substring("file", 7, 2), F.substring("file", 9, 2)
    late = F.when(F.lit(issues) & mm.isin("05", "06"), "v2").otherwise("")
    named = lines.select(F.concat(F.lit("SMKI19_"), year, F.lit("archive.zip")).alias("archive"), year.cast("int").alias("year"),
                         F.concat(F.lower("file"), late, F.lit(".txt")).alias("file"), "pos", "line")
    return archives.write_archives(named.where("year % 2 = 0"), folder).unionByName(
        archives.write_archives(named.where("year % 2 = 1"), folder, nested=True))


@query("cast_measures", """
SELECT comcode, account_date, CASE WHEN l_linenumber <> 3 THEN value END AS value,
  CASE WHEN l_linenumber NOT IN (2, 3) THEN quantity_1 END AS quantity_1,
  CASE WHEN l_linenumber = 3 THEN 'value' ELSE '' END AS rejected FROM import_rows""")
def cast_measures(v):
    marked = files.mark_rejects(_parsed(v).select("comcode", "account_date", "value", "quantity_1"), ["value", "quantity_1"])
    kept = F.col("rejected_columns") == ""
    return marked.select("comcode", "account_date", F.when(kept, F.col("value")).alias("value"),
                         F.when(kept, F.col("quantity_1")).alias("quantity_1"),
                         F.col("rejected_columns").alias("rejected"))


@query("parse_control_records", """
SELECT 'SMKA12' || lpad(cast(p_size AS varchar), 2, '0') AS file,
  lpad(cast(p_partkey % 24 + 1 AS varchar),2,'0') || lpad(cast(p_size AS varchar),2,'0') ||
  lpad(cast(p_partkey % 7 AS varchar),2,'0') || lpad(cast(p_partkey % 100 AS varchar),2,'0') AS mk_comcode,
  trim(p_brand) AS mk_qty1_alpha,
  CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1) || p_name[strpos(p_name, ' ') + 1:] ELSE p_name END AS mk_commodity_alpha_1
FROM part""")
def parse_control_records(v):
    parsed = files.parse_control_lines(files.drop_file_ends(v.control_lines()))
    return parsed.select("file", "mk_comcode", "mk_qty1_alpha", "mk_commodity_alpha_1")


@query("safe_names", """
SELECT smk_cod_alpha, smk_period_reference AS smk_period_reference_1, cast(sum(smk_stat_value) AS bigint) AS smk_stat_value,
  cast(sum(smk_nett_mass) AS bigint) AS "X1_nett_mass" FROM arrivals GROUP BY ALL""")
def safe_names(v):
    raw = v.arrivals().select(F.col("smk_cod_alpha").alias("SMK-COD-ALPHA"), F.col("smk_comcode").alias("SMK.Period  Reference"),
                              F.col("smk_period_reference").alias("SMK PERIOD-REFERENCE"),
                              F.col("smk_stat_value").alias("Smk (Stat) Value"), F.col("smk_nett_mass").alias("1 NETT MASS"))
    named = files.db_safe_names(raw)
    return named.groupBy("smk_cod_alpha", "smk_period_reference_1").agg(
        F.sum("smk_stat_value").alias("smk_stat_value"), F.sum("X1_nett_mass").alias("X1_nett_mass"))


# --- guard and upsert


@query("guarded_append", """
SELECT * FROM dispatches WHERE smk_period_reference NOT IN
  (SELECT smk_period_reference FROM arrivals WHERE smk_period_reference IS NOT NULL GROUP BY 1 HAVING count(*) > 50)""")
def guarded_append(v):
    return sinks.guarded_append(v.dispatches(), v.arrivals(), "smk_period_reference").select(*v.dispatches().columns)


@query("upsert_descriptions", """
WITH batches AS (SELECT comcode AS mk_comcode, account_date[4:7] || account_date[1:2] AS batch, min(port_alpha) AS mk_sitc_no,
  'Item at ' || cast(max(value) AS varchar) AS mk_commodity_alpha_1 FROM imports GROUP BY ALL)
SELECT f.mk_comcode, f.mk_sitc_no, l.mk_commodity_alpha_1
FROM (SELECT *, row_number() OVER (PARTITION BY mk_comcode ORDER BY batch) AS rn FROM batches) f
JOIN (SELECT *, row_number() OVER (PARTITION BY mk_comcode ORDER BY batch DESC) AS rn FROM batches) l
  ON f.mk_comcode = l.mk_comcode AND f.rn = 1 AND l.rn = 1""")
def upsert_descriptions(v):
    return sinks.upsert_descriptions(v.control_batches(), "mk_comcode", ["mk_commodity_alpha_1"], ["batch"])


@query("reissued_months", """
SELECT account_date[4:7] || '-' || account_date[1:2] AS month, count(*) AS n,
  cast(sum(value + CASE WHEN account_date[1:2] = '12' THEN 1 ELSE 0 END) AS bigint) AS total, 1 AS loads
FROM import_rows WHERE l_linenumber <> 5 OR account_date[1:2] = '12' GROUP BY 1""")
def reissued_months(v):
    """Months whose second issue comes before the first, or after it, or never; then compacted."""
    mm = F.substring("account_date", 1, 2)
    rows = stage(sinks.with_month(v.import_rows().withColumn("file", F.lit("f")), IMPORTS), "imports")
    first = rows.withColumn("issue", F.lit(1)).withColumn("value", F.col("value") + 1).drop("l_orderkey", "l_linenumber")
    second = rows.where((F.col("l_linenumber") != 5) & (mm != "12")).withColumn("issue", F.lit(2)).drop("l_orderkey", "l_linenumber")
    dst = new_folder(v.spark, "store")
    store.write_load(first.where(mm > "06").unionByName(second.where((mm <= "06") & (F.col("value") % 2 == 0))), dst, IMPORTS, "a")
    store.write_load(first.where(mm <= "06").unionByName(second.where(mm > "06")), dst, IMPORTS, "b")
    store.write_load(second.where((mm <= "06") & ((F.col("value") % 2 != 0) | F.col("value").isNull())), dst, IMPORTS, "c", threshold=1 << 60)
    store.compact(v.spark, dst, IMPORTS)
    return store.read_store(v.spark, dst, IMPORTS).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count_distinct("load_id").cast("int").alias("loads"))


# --- files: names, presence, report


def _fact_months(v) -> DataFrame:
    """Rows per table and month, written once: a few hundred rows."""
    months = v.flows().groupBy("table_name", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))
    return stage(months, "fact-months")


def _family():
    return F.element_at(F.create_map(*[F.lit(x) for kv in FILE_FAMILIES.items() for x in kv]), F.col("table_name"))


_FACT_MONTHS = """fact_months AS (
  SELECT 'SMKI19' AS family, account_date[4:7] || '-' || account_date[1:2] AS month, count(*) AS n, sum(value) AS total FROM imports GROUP BY 2
  UNION ALL SELECT 'SMKE19', account_date[4:7] || '-' || account_date[1:2] AS m, count(*), sum(value) FROM exports GROUP BY m
  UNION ALL SELECT 'SMKM46', smk_period_reference[2:5] || '-' || smk_period_reference[6:7] AS m, count(*), sum(smk_stat_value) FROM arrivals GROUP BY m
  UNION ALL SELECT 'SMKX46', smk_period_reference[2:5] || '-' || smk_period_reference[6:7] AS m, count(*), sum(smk_stat_value) FROM dispatches GROUP BY m),
expected AS (SELECT family, strftime(d, '%Y-%m') AS month, family || strftime(d, '%y%m') AS file FROM (
  SELECT unnest(generate_series(cast(min(month) || '-01' AS timestamp), cast(max(month) || '-01' AS timestamp), INTERVAL 1 MONTH)) AS d FROM fact_months) s,
  (VALUES ('SMKI19'), ('SMKE19'), ('SMKM46'), ('SMKX46'), ('SMKA12')) f(family)),
present AS (SELECT family || month[3:4] || month[6:7] AS file FROM fact_months WHERE total % 3 <> 0
  UNION ALL SELECT 'SMKA12' || month[3:4] || month[6:7] FROM fact_months WHERE family = 'SMKI19' AND n % 4 <> 0)"""


def _expected(months):
    span = months.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    return monitor.expected_files(span, FILE_FAMILIES)


def _file_of():
    return F.concat(_family(), F.substring("month", 3, 2), F.substring("month", 6, 2))


@query("normalise_file_names", f"""WITH {_FACT_MONTHS}
SELECT lower(family) || CASE WHEN month[6:7] = '02' THEN '~1' ELSE month[3:4] || month[6:7] END
    || CASE WHEN month[6:7] IN ('05', '06') THEN 'v2' ELSE '' END || '.txt' AS raw,
  family || CASE WHEN month[6:7] = '02' THEN '0902' ELSE month[3:4] || month[6:7] END AS file, n FROM fact_months""")
def normalise_file_names(v):
    mm = F.substring("month", 6, 2)
    raw = F.concat(F.lower(_family()), F.when(mm == "02", "~1").otherwise(F.concat(F.substring("month", 3, 2), mm)),
                   F.when(mm.isin("05", "06"), "v2").otherwise(""), F.lit(".txt"))
    named = _fact_months(v).select(raw.alias("raw"), "n")
    return named.select("raw", files.normalise_file_name(F.col("raw")).alias("file"), "n")


@query("missing_periods", f"""WITH {_FACT_MONTHS}
SELECT file FROM expected WHERE file NOT IN (SELECT file FROM present)""")
def missing_periods(v):
    months = _fact_months(v)
    control = months.where((F.col("table_name") == "imports") & (F.col("n") % 4 != 0)).withColumn("table_name", F.lit("control"))
    present = months.where(F.col("total") % 3 != 0).unionByName(control).select(_file_of().alias("file"))
    return monitor.missing_files(_expected(months), present).select("file")


@query("load_report", f"""WITH {_FACT_MONTHS},
counts AS (SELECT {_FILE} AS file, count(*) FILTER (l_linenumber <> 3) AS loaded, count(*) FILTER (l_linenumber = 3) AS rejected FROM import_rows GROUP BY 1)
SELECT e.file, CASE WHEN c.file IS NULL THEN 'missing' WHEN rejected > 0 THEN 'rejects' ELSE 'loaded' END AS status,
  coalesce(loaded, 0) AS rows, coalesce(rejected, 0) AS rejects FROM expected e LEFT JOIN counts c ON e.file = c.file""")
def load_report(v):
    marked = files.mark_rejects(_parsed(v).select("file", "value", "quantity_1"), ["value", "quantity_1"])
    kept = F.col("rejected_columns") == ""
    counts = marked.groupBy("file").agg(F.count_if(kept).alias("loaded"), F.count_if(~kept).alias("rejected"))
    return monitor.load_report(_expected(_fact_months(v)), counts)
