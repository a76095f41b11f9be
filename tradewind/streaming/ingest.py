"""Loading newly arrived monthly files, plain or in archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.schema import FACTS, FILE_FAMILIES, FactShape
from tradewind.sources.archives import Opener, open_path, read_members
from tradewind.sources.files import cast_measures, clean_lines, drop_file_ends, fact_records, file_issue, parse_control_lines
from tradewind.sources.sinks import GUARD_ROWS, upsert_table, with_month
from tradewind.sources.stage import stage
from tradewind.sources.store import read_or_none, write_load


def _arrivals_of(spark: SparkSession, src: str, encoding: str = "UTF-8") -> DataFrame:
    """Stream of lines, with ``broken`` where the bytes are not text. A batch holds whole files, so header and trailer can be found per batch."""
    line, broken = F.col("value"), ~F.is_valid_utf8("value")
    if encoding.upper() != "UTF-8":
        line, broken = F.decode(line.cast("binary"), encoding), F.lit(False)
    return spark.readStream.text(src).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        line.alias("line"), broken.alias("broken"))


def _positioned(lines: DataFrame) -> DataFrame:
    """Lines with their place, written once: they come from one pass over the files."""
    pos = F.struct("block", F.monotonically_increasing_id().alias("row"))
    return stage(lines.select("file", pos.alias("pos"), "line", "broken"), "lines")


def _load_id(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Names a batch for good: the id that Spark gave the checkpoint, and the batch's number."""
    written = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
    return f"{written}-{batch_id}"


def _run(stream: DataFrame, each_batch, checkpoint: str) -> None:
    query = (stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())
    query.awaitTermination()


def _report(lines: DataFrame, good: DataFrame, rejects: DataFrame, stored: DataFrame, key: str = "file") -> DataFrame:
    """``file, status, lines, rows, stored, rejects`` of every file that arrived.

    Status is ``unreadable`` (nothing of it was loaded), ``empty`` (no records), ``rejects`` (some records are wrong), ``skipped`` (a month, or all
    of them, was loaded before) or ``loaded``. ``lines`` has one row per file: ``file``, ``lines``, ``error``.
    """
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("_file")).agg(F.count(F.lit(1)).alias(name))

    out = lines
    for df, name in ((good, "rows"), (stored, "stored"), (rejects, "rejects")):
        out = out.join(count(df, name), F.col(key) == F.col("_file"), "left").drop("_file").fillna(0, [name])
    status = (F.when(F.col("error").isNotNull(), "unreadable").when(F.col("rows") + F.col("rejects") == 0, "empty")
               .when(F.col("rejects") > 0, "rejects").when(F.col("stored") < F.col("rows"), "skipped").otherwise("loaded"))
    return out.withColumn("status", status)


def _load(lines: DataFrame, files: DataFrame, dst: str, shape: FactShape, load_id: str, threshold: int, na_strings: Sequence[str]) -> None:
    """Records of whole files into the store, rejected ones and the report beside it.

    ``lines`` has ``file`` (distinct per file), ``issue``, ``pos``, ``line``; ``files`` a row per file with ``file``, ``lines`` and ``error``.
    """
    records = fact_records(lines, shape, na_strings, keep=["issue"])
    good, rejects = cast_measures(with_month(records, shape), shape.integers)
    stored = write_load(good, dst, shape, load_id, threshold)
    rejects.write.mode("overwrite").parquet(f"{dst}/rejects/load_id={load_id}")
    report = _report(files, good, rejects, stored)
    report.select("file", "status", "lines", "rows", "stored", "rejects", "error").write.mode("overwrite").parquet(f"{dst}/reports/load_id={load_id}")


def ingest_available(spark: SparkSession, src: str, dst: str, checkpoint: str, shape: FactShape,
                     threshold: int = GUARD_ROWS, encoding: str = "UTF-8", na_strings: Sequence[str] = ()) -> None:
    """Load the fact files that arrived in ``src`` since the last run, then stop.

    The checkpoint makes each file count once; the guard skips months that any other batch has loaded, of this
    checkpoint or another, unless a file is a later issue (``V2`` in its name), which takes the month over. Every batch
    writes its own folder, replaced as a whole if the batch is run again, and rejected records and a report with one row per file go
    beside it (``rejects``, ``reports``). A file with bytes that are not text is reported and left out. Files are read once.
    """
    def each_batch(lines: DataFrame, batch_id: int) -> None:
        placed = _positioned(lines).withColumn("issue", file_issue(F.element_at(F.split("file", "/"), -1)))
        error = F.when(F.max("broken"), f"not {encoding} text")
        files = stage(placed.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), error.alias("error")), "files")
        bad = files.where("error IS NOT NULL").select(F.col("file").alias("_bad"))
        _load(placed.join(bad, F.col("file") == F.col("_bad"), "left_anti").drop("broken"), files, dst, shape,
              _load_id(lines.sparkSession, checkpoint, batch_id), threshold, na_strings)

    _run(_arrivals_of(spark, src, encoding), each_batch, checkpoint)


def ingest_archives(spark: SparkSession, src: str, dst: str, checkpoint: str, shapes: dict[str, FactShape] = FACTS, threshold: int = GUARD_ROWS,
                    encoding: str = "latin-1", na_strings: Sequence[str] = (), opener: Opener = open_path) -> None:
    """Load what arrived in ``src`` since the last run in zip archives, fact files of every family and control files, then stop.

    The stream brings the names of archives; members are read by tasks of their own (``read_members``). A member belongs to the table
    whose family its name begins with; tables lie under ``dst`` by name, as ``ingest_available`` and ``ingest_control`` leave them, with the same
    guard and the same reports by member. Damaged archives and members, and members of no family, are listed under
    ``dst/archives`` with the reason; all others load.
    """
    def each_batch(arrived: DataFrame, batch_id: int) -> None:
        load_id = _load_id(arrived.sparkSession, checkpoint, batch_id)
        lines, members = read_members(stage(arrived, "archives"), encoding, opener)
        family = lambda name: F.col("file").startswith(FILE_FAMILIES[name])
        for name, shape in shapes.items():
            counts = lines.where(family(name)).groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("lines"))
            files = (members.where(family(name)).join(counts, F.col("source") == F.col("_s"), "left").fillna(0, ["lines"])
                     .select(F.concat_ws("!", "source", "file").alias("file"), "lines", "error"))
            _load(lines.where(family(name)).select(F.concat_ws("!", "source", "file").alias("file"), "issue", "pos", "line"), files,
                  f"{dst}/{name}", shape, load_id, threshold, na_strings)
        control = parse_control_lines(drop_file_ends(lines.where(family("control"))))
        _merge_control(control, f"{dst}/control", load_id, ["file", "issue", "pos"])
        known = F.lit(False)
        for name in (*shapes, "control"):
            known = known | family(name)
        problem = F.coalesce("error", F.when(~known, F.lit("no known family")))
        members.withColumn("error", problem).write.mode("overwrite").parquet(f"{dst}/archives/load_id={load_id}")

    stream = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.{zip,ZIP}").load(src).select("path"))
    _run(stream, each_batch, checkpoint)


def _merge_control(batch: DataFrame, dst: str, load_id: str, order: Sequence[str]) -> None:
    """A new version of the control table with one batch in it, unless the batch is empty."""
    spark = batch.sparkSession
    versions, own, top = read_or_none(spark, dst), None, None
    if versions is not None:
        own, top = versions.agg(F.max(F.when(F.col("load_id") == load_id, F.col("version"))), F.max("version")).first()
    elif batch.isEmpty():
        return
    version = own if own is not None else 0 if top is None else top + 1      # a batch that is run again replaces its own
    stored = read_control_table(spark, dst, before=version)
    columns = [c for c in batch.columns if c not in ("archive", "source", *order)]
    current = batch.limit(0).select(columns) if stored is None else stored
    merged = upsert_table(current, batch.select(*columns, *order), "mk_comcode", ["mk_commodity_alpha_1"], order)
    merged.write.mode("overwrite").parquet(f"{dst}/version={version}/load_id={load_id}")


def ingest_control(spark: SparkSession, src: str, dst: str, checkpoint: str) -> None:
    """Bring the control table up to date with the control files that arrived since the last run.

    Each batch writes a full new version; readers take the highest one.
    """
    def each_batch(lines: DataFrame, batch_id: int) -> None:
        batch = parse_control_lines(drop_file_ends(_positioned(lines).drop("broken")))
        _merge_control(batch, dst, _load_id(lines.sparkSession, checkpoint, batch_id), ["file", "pos"])

    _run(_arrivals_of(spark, src), each_batch, checkpoint)


def read_control_table(spark: SparkSession, dst: str, before: int | None = None) -> DataFrame | None:
    """Latest version of the control table, or the latest below ``before``."""
    versions = read_or_none(spark, dst)
    if versions is None:
        return None
    if before is not None:
        versions = versions.where(F.col("version") < before)
    top = versions.agg(F.max("version")).first()[0]
    return None if top is None else versions.where(F.col("version") == top).drop("version", "load_id")
