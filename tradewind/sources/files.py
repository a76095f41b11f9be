"""Reading the monthly files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.codes import LEAF_LENGTH
from tradewind.functions.text import clean_text, strip_control, unite
from tradewind.schema import CONTROL_COLUMNS, FactShape
from tradewind.sources.stage import stage


# Words that cannot stand alone as a column name and get a trailing "_".
_RESERVED = {"if", "else", "repeat", "while", "function", "for", "in", "next", "break"}


def safe_names(names: Sequence[str]) -> list[str]:
    """Lower case, runs of other characters to ``_``, ``X`` before a leading digit or ``_``, repeats numbered."""
    out: list[str] = []
    for raw in names:
        name = re.sub("[^a-z0-9]+", "_", raw.lower())
        if not name[:1].isalpha():
            name = "X" + name
        elif name in _RESERVED:
            name += "_"
        unique, n = name, 0
        while unique in out:
            n += 1
            unique = f"{name}_{n}"
        out.append(unique)
    return out


def db_safe_names(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))


def read_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files as ``file, pos, line``; files are split between tasks like any text input.

    ``pos`` sorts the lines of one file: start of the split, then row number within the task.
    """
    line = F.col("value")
    if encoding.upper() != "UTF-8":
        line = F.decode(line.cast("binary"), encoding)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("pos"),
        line.alias("line"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Lines without control characters; empty ones, also those that only a SUB character makes look otherwise, are gone."""
    clean = lines.withColumn("line", strip_control(F.col("line")))
    return clean.where(F.trim(F.replace("line", F.lit("\r"), F.lit(""))) != "")


def without_file_ends(rows: DataFrame) -> DataFrame:
    """Rows without each file's first and last one by ``pos``. ``rows`` must be staged, so that positions stay what they are.

    A file is a ``file``, of an ``archive`` or ``source`` where there is such a column. The ends, one row per file, are staged: small, they
    go to every task by their known size, and rows stay where they are.
    """
    key = [c for c in ("archive", "source", "file") if c in rows.columns]
    ends = stage(rows.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.min("pos").alias("_head"), F.max("pos").alias("_tail")), "file-ends")
    met = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in key])
    return rows.join(ends, met).where((F.col("pos") != F.col("_head")) & (F.col("pos") != F.col("_tail"))).select(*rows.columns)


def drop_file_ends(lines: DataFrame) -> DataFrame:
    """Lines without each file's first (header) and last (trailer) record, empty lines not counting.

    The text is scanned once: lines are staged with the position that this scan gave them.
    """
    return without_file_ends(stage(clean_lines(lines), "lines"))


def _fields(line: Column) -> Column:
    return F.split(line, r"\|", -1)


def parse_fact_lines(lines: DataFrame, shape: FactShape, na_strings: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Fact records from ``file, pos, line``: text columns in file order, short records padded with NULL.

    Codes keep their first 8 characters. ``na_strings`` lists texts to read as NULL, ``keep`` other columns to pass on.
    """
    names = safe_names(shape.columns)
    cut = lines.where(F.trim("line") != "").select("file", *keep, _fields(strip_control(F.col("line"))).alias("_f"))

    def field(i: int, name: str) -> Column:
        c = F.get(F.col("_f"), F.lit(i))
        if name == shape.code:
            c = F.substring(c, 1, LEAF_LENGTH)
        if na_strings:
            c = F.when(~c.isin(list(na_strings)), c)
        return c.alias(name)

    return cut.select("file", *keep, *[field(i, n) for i, n in enumerate(names)])


def fact_records(lines: DataFrame, shape: FactShape, na_strings: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Fact records of whole files, header and trailer left out. Lines are read and parsed once, the records staged."""
    own = [c for c in ("archive", "source") if c in lines.columns]
    kept = list(dict.fromkeys([*own, "pos", *keep]))
    parsed = without_file_ends(stage(parse_fact_lines(clean_lines(lines), shape, na_strings, kept), "records"))
    return parsed.drop(*[c for c in kept if c not in keep])


def parse_control_lines(lines: DataFrame) -> DataFrame:
    """Control records: fields trimmed, a description split over two fields joined again, 27 columns."""
    names = safe_names(CONTROL_COLUMNS)
    last = len(names) - 1
    more = [c for c in ("archive", "source", "issue") if c in lines.columns]
    cut = lines.where(F.trim("line") != "").select("file", "pos", *more, _fields(strip_control(F.col("line"))).alias("_f"))
    part = [F.trim(F.get(F.col("_f"), F.lit(i))) for i in range(last + 2)]
    code = F.substring(part[0], 1, LEAF_LENGTH).alias(names[0])
    description = clean_text(unite(part[last], part[last + 1])).alias(names[last])
    return cut.select("file", "pos", *more, code, *[p.alias(n) for p, n in zip(part[1:last], names[1:last])], description)


def mark_rejects(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Measures as bigint, and ``rejected_columns``: names, comma-separated, of those that are not whole numbers.

    Blank text counts as missing, not as wrong.
    """
    def wrong(c: str) -> Column:
        return F.when((F.trim(c) != "") & F.col(c).try_cast("bigint").isNull(), F.lit(c))

    return df.select(*[F.col(c).try_cast("bigint").alias(c) if c in cols else F.col(c) for c in df.columns],
                     F.concat_ws(",", *[wrong(c) for c in cols]).alias("rejected_columns"))


def cast_measures(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records with their measures as bigint, and apart, as text, the records where one is not a whole number."""
    kept = F.struct(*[F.col(c) for c in cols])
    marked = mark_rejects(df.withColumn("_text", kept), cols)
    good = marked.where(F.col("rejected_columns") == "").drop("rejected_columns", "_text")
    rejects = marked.where(F.col("rejected_columns") != "").select(
        *[F.col("_text")[c].alias(c) if c in cols else F.col(c) for c in df.columns], "rejected_columns")
    return good, rejects


def read_fact_files(spark: SparkSession, paths: str | Sequence[str], shape: FactShape,
                    na_strings: Sequence[str] = (), encoding: str = "UTF-8") -> DataFrame:
    """Monthly fact files as text columns plus ``file``."""
    return fact_records(read_lines(spark, paths, encoding), shape, na_strings)


def read_control_files(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Control files as text columns plus ``file`` and ``pos``."""
    return parse_control_lines(drop_file_ends(read_lines(spark, paths, encoding)))


def normalise_file_name(name: Column) -> Column:
    """Upper case, ``.TXT`` dropped, ``~1`` to ``0902``, ``V2`` dropped (first of each)."""
    up = F.regexp_replace(F.upper(name), "^(.*?)\\.TXT", "$1")
    feb = F.regexp_replace(up, "^(.*?)~1", "$10902")   # group 1, then 0902
    return F.regexp_replace(feb, "^(.*?)V2", "$1")


def file_issue(name: Column) -> Column:
    """Which issue of its month a file is: 2 of ``SMKE191405V2.TXT``, 1 of a name without a number."""
    found = F.regexp_extract(F.upper(name), r"V([0-9]{1,4})(\.[A-Z]+)?$", 1)
    return F.coalesce(F.when(found != "", found.cast("int")), F.lit(1))
