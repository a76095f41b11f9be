"""Small helpers of the operators in this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """The text, a null as the empty one."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def opaque(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns c0, c1, ..., so that no column of the caller's meets a working column, and their names."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of several columns."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def prefix_sums(df: DataFrame, group: Sequence[str], block: str, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the group that come before this one.

    ``block`` must follow ``order`` within a group and hold few rows a value: rows are summed inside their
    block, and a table with one row per block supplies what comes before it. So a group with a third of
    all rows is spread over as many tasks as it has blocks. ``df`` is read twice.
    """
    keys = [*group, block]
    starts = (df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
                .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_sum"))
    before = (Window.partitionBy(*[f"_k{i}" for i in range(len(group))]).orderBy(f"_k{len(group)}")
                    .rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, same(df, starts, [(k, f"_k{i}") for i, k in enumerate(keys)]))
    total = F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn(name, total).select(*df.columns, name)


def short_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Sends whole texts to Python in batches of fewer rows, so that a batch with long texts stays small.

    Changes the session's setting where it is larger, for every later query of the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def worker_memo(name: str, make: Callable[[], object]) -> object:
    """An object made once per Python worker, such as a loaded vocabulary."""
    memo = sys.modules.setdefault("_worker_memo", types.ModuleType("_worker_memo"))
    if name not in memo.__dict__:
        memo.__dict__[name] = make()
    return memo.__dict__[name]


def row_cuts(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """First row and end row of slices with about ``most`` bytes; a longer row is a slice of its own."""
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end
        row = end


def text_chunks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a column of texts with about ``most`` bytes: first row, end row, bytes, row offsets.

    A longer text is a slice of its own; a null is an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for row, end in row_cuts(offsets, most):
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    def run(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    kept = worker_memo("powers", dict)
    if len(kept.get("p", ((),))[0]) < n:
        kept["p"] = (run(_BASE), run(pow(_BASE, -1, 1 << 64)))
    return kept["p"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from one running sum over all bytes."""
    up, down = _powers(max(1 << 20, len(data) + 1))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words come before each row (one more entry than rows)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
