"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of seven bytes marks the ends of chunks: where its low bits are all ones, so that the marks
of a larger block size are among those of a smaller one. A text of one byte over and over has no chunk ends or
only such; its fingerprint tells it from its edit only as a whole. A fingerprint has one character for each chunk, at
a block size that suits the text's length, or the largest smaller one that gives half of a signature, and at twice that size. Two fingerprints are compared by edit
distance where they have a block size in common. An edit changes the chunks it touches and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import _powers, mixed, short_batches, text_chunks
from tradewind.sources.stage import stage

_WINDOW = 7
_LEAST = 2                  # log2 of the smallest block size
_LENGTH = 64                # characters of a signature at most
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_RUN = 4                    # characters in a row that like signatures share; half of a shorter one


def _levels(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a chunk may end, and the log2 of the largest block size for which it does."""
    rolled = np.zeros(len(data), np.uint32)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for j in range(min(_WINDOW, len(data))):
        factor = np.uint32((0x9E3779B1 * pow(0x01000193, j + 1, 1 << 32)) & 0xFFFFFFFF | 1)
        part = (data[:len(data) - j].astype(np.uint32) + np.uint32(1)) * factor
        rolled[j:] += np.where(place[j:] >= j, part, np.uint32(0))
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x2C1B3C6D)
    rolled ^= rolled >> np.uint32(12)
    at = np.flatnonzero((rolled & np.uint32((1 << _LEAST) - 1)) == (1 << _LEAST) - 1)
    zeros = ~rolled[at].astype(np.uint64) & np.uint64(0xFFFFFFFF) | np.uint64(1 << 32)
    low = zeros & (~zeros + np.uint64(1))
    return at + 1, np.log2(low.astype(np.float64)).astype(np.int64)


def _signature(cuts: np.ndarray, start: int, end: int, sums: np.ndarray, down: np.ndarray) -> str:
    """One character a chunk; what comes after the last character's place is one chunk with it."""
    edges = cuts if len(cuts) and cuts[-1] == end else np.append(cuts, end)
    if len(edges) > _LENGTH:
        edges = np.append(edges[:_LENGTH - 1], end)
    before = np.concatenate(([start], edges[:-1]))
    hashed = mixed((sums[edges] - sums[before]) * down[before] + (edges - before).astype(np.uint64))
    return _ALPHABET[(hashed >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprints(texts: pa.Array) -> list[str]:
    """``block:signature:signature at twice the block`` of each text; of the empty text without characters."""
    out: list[str] = []
    for _, _, data, offsets in text_chunks(texts):
        up, down = _powers(max(1 << 20, len(data) + 1))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        at, level = _levels(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        first = np.searchsorted(at, offsets, "right")
        for i in range(len(offsets) - 1):
            a, b = int(offsets[i]), int(offsets[i + 1])
            if a == b:
                out.append(f"{1 << _LEAST}::")
                continue
            cuts, levels = at[first[i]:first[i + 1]], level[first[i]:first[i + 1]]
            block = _LEAST
            while (b - a) >> block > _LENGTH:
                block += 1
            while block > _LEAST and np.count_nonzero(levels >= block) < _LENGTH // 2 - 1:
                block -= 1
            pair = [_signature(cuts[levels >= k], a, b, sums, down) for k in (block, block + 1)]
            out.append(f"{1 << block}:{pair[0]}:{pair[1]}")
    return out


def _alike(pairs: list[tuple[str, str]]) -> np.ndarray:
    """1 - edit distance (insertions and deletions) / lengths, or 0 without a common run; all pairs at once."""
    n = len(pairs)
    score = np.zeros(n)
    if not n:
        return score
    size = np.array([(len(a), len(b)) for a, b in pairs])
    grid = np.zeros((2, n, _LENGTH), np.uint8)
    for i, p in enumerate(pairs):
        for side in (0, 1):
            grid[side, i, :len(p[side])] = np.frombuffer(p[side].encode(), np.uint8)
    left, right = grid
    # the longest common subsequence, a row of its table as the bits of one word
    rows, ones = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF)), np.uint64(1) << np.arange(_LENGTH, dtype=np.uint64)
    for j in range(int(size[:, 1].max(initial=0))):
        same = np.where((left == right[:, j:j + 1]) & (left != 0), ones, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        met = rows & same
        rows = (rows + met) | (rows - met)
    common = np.array([bin(~int(r) & 0xFFFFFFFFFFFFFFFF).count("1") for r in rows])
    both = size.sum(axis=1)
    score = np.where(both > 0, 2 * common / np.maximum(both, 1), 1.0)
    for i in np.flatnonzero((score > 0) & (score < 1)):
        a, b = pairs[i]
        run = max(1, min(_RUN, len(a) // 2, len(b) // 2))
        if not {a[k:k + run] for k in range(len(a) - run + 1)} & {b[k:k + run] for k in range(len(b) - run + 1)}:
            score[i] = 0.0
    return score


def likeness(first: list[str], second: list[str]) -> np.ndarray:
    """From 0 to 1: the best score at a block size that both fingerprints have; 0 if they have none. Equal ones: 1."""
    pairs, owner = [], []
    for i, (x, y) in enumerate(zip(first, second)):
        bx, sx, tx = x.split(":")
        by, sy, ty = y.split(":")
        for k, s in ((int(bx), sx), (2 * int(bx), tx)):
            for m, t in ((int(by), sy), (2 * int(by), ty)):
                if k == m:
                    pairs.append((s, t))
                    owner.append(i)
    out = np.zeros(len(first))
    if pairs:
        np.maximum.at(out, owner, _alike(pairs))
    return np.where([x == y for x, y in zip(first, second)], 1.0, out)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first as many characters of another (or all)."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _described(ids: pa.Array, texts: list[str], after: list[str]) -> list[pa.Array]:
    """The result columns of documents and the texts that follow them."""
    import hashlib
    made = [edited(a, b) for a, b in zip(texts, after)]
    n = len(texts)
    prints = fingerprints(pa.array([*texts, *made, *after[-1:]], pa.large_string()))
    mine, theirs = prints[:n], prints[n:2 * n]
    # the texts that follow are the next rows, but for the last
    following = [mine[i + 1] if i + 1 < n and after[i] is texts[i + 1] else None for i in range(n)]
    lone = [i for i in range(n) if following[i] is None]
    for i, x in zip(lone, fingerprints(pa.array([after[i] for i in lone], pa.large_string()))):
        following[i] = x
    return [ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in made], pa.string()),
            pa.array(mine, pa.string()), pa.array(theirs, pa.string()), pa.array(likeness(mine, theirs)), pa.array(likeness(mine, following))]


_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted batches of (id, text) to results; the last row, which another task's first row follows, stays open.

    An open row gives a row with ``part``, id, the task's first text and its own text.
    """
    part, head, ids, texts, size = TaskContext.get().partitionId(), None, None, [], 0

    def done():
        columns = _described(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:])
        none = pa.nulls(len(texts) - 1, pa.string())
        return pa.RecordBatch.from_arrays([pa.array([None] * (len(texts) - 1), pa.int32()), *columns, none, none], ["part", *_NAMES, "head", "tail"])

    for batch in batches:
        row = 0
        read = batch.column(1)
        while row < batch.num_rows:
            stop = row
            while stop < batch.num_rows and size < 1 << 21:
                texts.append(read[stop].as_py())
                size += len(texts[-1])
                stop += 1
            if head is None:
                head = texts[0]
            new = batch.column(0).slice(row, stop - row)
            ids = new if ids is None else pa.concat_arrays([ids, new])
            row = stop
            if size >= 1 << 21 and len(texts) > 1:
                yield done()
                ids, texts, size = ids.slice(len(texts) - 1), texts[-1:], 0
            elif size >= 1 << 21:
                size = 0
    if texts:
        if len(texts) > 1:
            yield done()
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), ids.slice(len(texts) - 1), *blank, pa.array([head], pa.string()),
                                          pa.array([texts[-1]], pa.string())], ["part", *_NAMES, "head", "tail"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text, following text) to results."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays(_described(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()), _NAMES)


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    One row per input row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. The edited text has its last floor(n_chars / 3) characters replaced by the first as
    many (or all) of the next document in descending order of id; after the last comes the first. Rows with equal
    id are ordered by a hash of their text, null ids come last, a null text is empty. A single row is followed by
    itself; an empty table gives an empty one; other columns are left out.

    Texts move once, to be sorted by id over the cluster; the last row of each task meets the first of the next in
    a second pass with one row a task.
    """
    short_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    kind = f"id {wanted.schema['id'].dataType.simpleString()}"
    sorted_ = wanted.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    found = stage(sorted_.mapInArrow(_inside, f"part int, {kind}, {_FIELDS}, head string, tail string"), "fingerprints")
    ends = found.where("part IS NOT NULL").select("part", "id", "head", "tail")
    parts = ends.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"))           # one row a task
    first = parts.agg(F.min("part").alias("first"))
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("following"))
    nexts = parts.join(F.broadcast(first)).select("part", F.coalesce("next", "first").alias("next"))
    met = ends.select("part", "id", "tail").join(nexts, "part").join(heads, "next").select("id", "tail", "following")
    return (found.where("part IS NULL").select(*_NAMES).unionByName(met.mapInArrow(_across, f"{kind}, {_FIELDS}"))
                 .withColumnRenamed("id", id_col))
