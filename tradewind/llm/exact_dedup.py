"""Exact dedup by two-pass Bloom filtering.

Pass one marks two cells of a Bloom filter for each row's text hash and finds the cells that were marked
more than once. Pass two tests each row: if one of its cells was marked only by itself, its text is unique
and the row passes straight through. The rest, repeats and about one in seventy others, is grouped by
hash. Which rows are repeats is decided by the SHA-256 of the text, never by the filter alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import SPACES, opaque, text_of
from tradewind.sources.stage import stage

_SEGMENT = 4096         # cells that share a row of the filter; both cells of a text lie in one
_BAND = 64              # segments that are merged together
_FLUSH = 1 << 21        # hashes that a task keeps before it hands its cells on


def normalised(text: str) -> Column:
    """The text with every run of white space as one space; a null is the empty text."""
    return F.regexp_replace(text_of(text), SPACES, " ")


def _mark(slices: int, segments: int):
    def cells(hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        h = hashes.view(np.uint64)
        part = (h >> np.uint64(40)) % np.uint64(slices)
        segment = (h >> np.uint64(24)) & np.uint64(segments - 1)
        for r in range(slices):
            own = part == r
            at = segment[own] * np.uint64(_SEGMENT)
            low = h[own]
            code = np.concatenate((at + (low & np.uint64(4095)), at + ((low >> np.uint64(12)) & np.uint64(4095))))
            code, times = np.unique(code.astype(np.uint32), return_counts=True)
            marked = code | np.where(times > 1, np.uint32(1 << 31), np.uint32(0))
            band = code // np.uint32(_SEGMENT * _BAND)
            cuts = np.flatnonzero(np.diff(band)) + 1
            groups = np.split(marked, cuts) if len(code) else []
            if groups:
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([r] * len(groups), pa.int32()),
                    "band": pa.array(band[np.concatenate(([0], cuts))].astype(np.int32)),
                    "cells": pa.array([g.tobytes() for g in groups], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            n += len(held[-1])
            if n >= _FLUSH:
                yield from cells(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from cells(np.concatenate(held))
    return run


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one band: the segments that have a cell marked twice, as bit sets."""
    cells = np.concatenate([np.frombuffer(c, np.uint32) for c in rows["cells"]])
    code, times = np.unique(cells & np.uint32((1 << 31) - 1), return_counts=True)
    again = np.union1d(code[times > 1], cells[cells >> np.uint32(31) == 1] & np.uint32((1 << 31) - 1))
    segment, cell = again // np.uint32(_SEGMENT), again % np.uint32(_SEGMENT)
    kept, place = np.unique(segment, return_inverse=True)
    bits = np.zeros((len(kept), _SEGMENT // 64), np.uint64)
    np.bitwise_or.at(bits, (place, cell >> np.uint32(6)), np.uint64(1) << (cell & np.uint32(63)).astype(np.uint64))
    return pd.DataFrame({"slice": np.full(len(kept), rows["slice"].iloc[0], np.int32), "segment": kept.astype(np.int64),
                         "bits": [x.tolist() for x in bits.view(np.int64)]})


def repeat_filter(hashes: DataFrame, column: str, rows: int, max_filter_bytes: int) -> tuple[DataFrame, int, int]:
    """The filter of cells marked twice (staged), its number of slices and of segments a slice."""
    cells = 16 * max(1, rows)                                  # eight cells for each of the two marks
    most = min(1 << 28, 1 << max(18, (max_filter_bytes * 8).bit_length() - 1))
    segments = max(_BAND, min(most, 1 << (cells - 1).bit_length()) // _SEGMENT)
    slices = -(-cells // most)
    marked = hashes.select(column).mapInArrow(_mark(slices, segments), "slice int, band int, cells binary")
    merged = marked.groupBy("slice", "band").applyInPandas(_merge, "slice int, segment long, bits array<long>")
    return stage(merged, "repeat-filter"), slices, segments


def flag_possible_repeats(df: DataFrame, column: str, rows: int, max_filter_bytes: int, hashes: DataFrame) -> DataFrame:
    """Adds ``_maybe``: false for a row whose hash surely occurs once."""
    found, slices, segments = repeat_filter(hashes, column, rows, max_filter_bytes)
    h = F.col(column)
    tagged = (df.withColumn("_slice", F.pmod(F.shiftrightunsigned(h, 40), F.lit(slices)).cast("int"))
                .withColumn("_segment", F.shiftrightunsigned(h, 24).bitwiseAND(F.lit(segments - 1).cast("long"))))
    if slices > 1:      # laid out by slice, so that each test below reads its own rows only
        tagged = stage(tagged, "by-slice", by="_slice")

    def bit(cell: str) -> Column:
        return F.expr(f"coalesce(shiftright(bits[cast(shiftright({cell}, 6) as int)], cast({cell} & 63 as int)) & 1L, 0L) = 1L")

    parts = []
    for r in range(slices):
        one = F.broadcast(found.where(F.col("slice") == r).select(F.col("segment").alias("_segment"), "bits"))
        part = (tagged.where(F.col("_slice") == r).join(one, "_segment", "left")
                      .withColumn("_maybe", bit(f"(`{column}` & 4095L)") & bit(f"(shiftright(`{column}`, 12) & 4095L)"))
                      .select(*df.columns, "_maybe"))
        parts.append(part if slices == 1 else stage(part, f"slice-{r}"))   # one slice is in memory at a time
    return reduce(DataFrame.unionByName, parts)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after white space is normalised; a null text is empty. The smallest id
    of a group stays; a null id stays only in a group that has no other. Rows that repeat an id and its
    text count each in ``group_size`` and share one decision. An empty table gives an empty one; other
    columns are left out. The filter is broadcast, never beyond ``max_filter_bytes`` (and the few bytes a
    segment that rows add): a larger input is laid out by slices of the hash range, and tested slice by slice.
    """
    digests = stage(docs.select(F.col(id_col), F.sha2(normalised(text_col), 256).alias("text_sha256"))
                        .withColumn("_hash", F.xxhash64("text_sha256")), "digests")
    flagged = flag_possible_repeats(digests, "_hash", digests.count(), max_filter_bytes, digests)
    once = flagged.where(~F.col("_maybe")).select(
        F.col(id_col), F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    rest = flagged.where("_maybe").select(id_col, "text_sha256")
    # staged, so that the join below has a shuffle on either side and a group with many rows can be split
    groups = stage(rest.groupBy(F.col("text_sha256").alias("_sha")).agg(
        F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    back = rest.join(groups, F.col("text_sha256") == F.col("_sha")).select(
        F.col(id_col), "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return once.unionByName(back)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = 32 << 20) -> DataFrame:
    """The rows of ``docs`` with the row of smallest id of each group of equal texts, all columns kept.

    Rows whose text is surely unique are neither shuffled nor grouped. Of rows that repeat id and text one stays.
    """
    plain, names = opaque(docs)
    ident = names[id_col]
    tagged = plain.withColumn("_sha", F.sha2(normalised(names[text_col]), 256)).withColumn("_hash", F.xxhash64("_sha"))
    hashes = stage(tagged.select("_hash"), "hashes")
    flagged = flag_possible_repeats(tagged, "_hash", hashes.count(), max_filter_bytes, hashes)
    rest = flagged.where("_maybe")
    smallest = stage(rest.groupBy(F.col("_sha").alias("_key")).agg(F.min(ident).alias("_keep")), "smallest")
    stay = (rest.join(smallest, F.col("_sha") == F.col("_key"))
                .where(F.col(ident).eqNullSafe(F.col("_keep"))).dropDuplicates(["_sha"]))
    back = [F.col(n).alias(c) for c, n in names.items()]
    return flagged.where(~F.col("_maybe")).select(*back).unionByName(stay.select(*back))
