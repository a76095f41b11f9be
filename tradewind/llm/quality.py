"""Quality classifier: nearest labelled neighbours in a latent-semantic space vote by similarity."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import opaque, short_batches, text_chunks

GRAMS = 1024            # hashed byte trigrams
SHAPES = 8
DIMENSIONS = 48
NEIGHBOURS = 15
_BLOCK = 1024           # labelled vectors in one product


class Space(NamedTuple):
    """What is learned from the labelled sample; its size is bounded by the sample's."""
    weight: np.ndarray      # of each trigram
    mean: np.ndarray        # of each shape
    spread: np.ndarray
    axes: np.ndarray        # (GRAMS + SHAPES) x DIMENSIONS
    vectors: np.ndarray     # labelled rows, unit length
    labels: np.ndarray


def counts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed byte trigrams, and shapes of the text (shares of kinds of characters and of repetition), for each row."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    grams = np.zeros((rows, GRAMS), np.int64)
    shapes = np.zeros((rows, SHAPES))
    if not len(data):
        return grams, shapes
    owner = np.repeat(np.arange(rows), size)
    wide = data.astype(np.uint32)
    code = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA6B) ^ wide[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    whole = owner[:-2] == owner[2:]
    at = owner[:-2][whole] * GRAMS + (code[whole] >> np.uint32(22)).astype(np.int64)
    grams = np.bincount(at, minlength=rows * GRAMS).reshape(rows, GRAMS)
    upper, lower = (data >= 65) & (data <= 90), ((data >= 97) & (data <= 122)) | (data >= 128)
    digit, space = (data >= 48) & (data <= 57), (data == 32) | ((data >= 9) & (data <= 13))
    some = np.maximum(size, 1)
    for j, kind in enumerate((upper, digit, space, ~(upper | lower | digit | space), data == 10)):
        shapes[:, j] = np.bincount(owner[kind], minlength=rows) / some
    total = np.maximum(grams.sum(axis=1), 1)
    shapes[:, 5] = np.sqrt((grams.astype(np.float64) ** 2).sum(axis=1)) / total
    shapes[:, 6] = grams.max(axis=1) / total
    shapes[:, 7] = np.count_nonzero(grams, axis=1) / np.minimum(total, GRAMS)
    return grams, shapes


def _vectors(grams: np.ndarray, shapes: np.ndarray, weight: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    words = np.log1p(grams) * weight
    words /= np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)
    return np.hstack((words, 0.25 * np.clip((shapes - mean) / spread, -4, 4))).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit_space(grams: np.ndarray, shapes: np.ndarray, labels: np.ndarray) -> Space:
    """Latent-semantic axes of the labelled rows: the largest singular directions of their weighted vectors."""
    rows = max(1, len(labels))
    weight = np.log((1 + rows) / (1 + np.count_nonzero(grams, axis=0)))
    weight = 0.1 + weight
    mean, spread = (shapes.mean(axis=0), shapes.std(axis=0) + 1e-3) if len(labels) else (np.zeros(SHAPES), np.ones(SHAPES))
    x = _vectors(grams, shapes, weight, mean, spread).astype(np.float64)
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    return Space(weight, mean, spread, axes, _unit((x @ axes).astype(np.float32)), labels.astype(np.float32))


def vote(x: np.ndarray, space: Space, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """For each vector: the mean label of the labelled vectors of largest cosine, by similarity; exact, block by block."""
    best, label = np.zeros((len(x), 0), np.float32), np.zeros((len(x), 0), np.float32)
    for a in range(0, len(space.labels), _BLOCK):
        best = np.hstack((best, x @ space.vectors[a:a + _BLOCK].T))
        label = np.hstack((label, np.broadcast_to(space.labels[a:a + _BLOCK], (len(x), len(space.labels[a:a + _BLOCK])))))
        if best.shape[1] > neighbours:
            kept = np.argpartition(-best, neighbours - 1, axis=1)[:, :neighbours]
            best, label = np.take_along_axis(best, kept, 1), np.take_along_axis(label, kept, 1)
    share = np.maximum(best, 0).astype(np.float64) ** 8 + 1e-12
    if not label.shape[1]:
        return np.full(len(x), 0.5)
    return np.clip((share * label).sum(axis=1) / share.sum(axis=1), 0.0, 1.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (label, order, text) to the counts and shapes of each."""
    for batch in batches:
        for a, b, data, offsets in text_chunks(batch.column(2)):
            grams, shapes = counts_of(data, offsets)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([g.astype(np.float32).tobytes() for g in grams], pa.binary()),
                pa.array([s.tobytes() for s in shapes], pa.binary())], ["label", "place", "grams", "shapes"])


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = 4096) -> Space:
    """The space of a bounded sample of labelled rows: at most ``most``, half of either label, by smallest hash of the id.

    Held-out ids and null labels are left out; an id with several labels counts with the smallest.
    """
    short_batches(docs.sparkSession)
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(id_col))
                   .groupBy(F.col(id_col).alias("_id")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("label"))
                   .withColumn("place", F.xxhash64("_id")))
    picked = [known.where(F.col("label") == v).orderBy("place", "_id").limit(most // 2) for v in (0, 1)]
    sample = picked[0].unionByName(picked[1])                       # at most ``most`` rows
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                .join(F.broadcast(sample), F.col("id") == F.col("_id")).select("label", "place", "text")
                .mapInArrow(_count, "label int, place long, grams binary, shapes binary")
                .orderBy("place", "grams").limit(most).collect())
    return fit_space(np.array([np.frombuffer(r["grams"], np.float32) for r in rows]).reshape(len(rows), GRAMS),
                     np.array([np.frombuffer(r["shapes"]) for r in rows]).reshape(len(rows), SHAPES), np.array([r["label"] for r in rows]))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            scores = []
            for _, _, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                x = _vectors(*counts_of(data, offsets), space.weight, space.mean, space.spread)
                scores.append(vote(_unit(x @ space.axes), space))
            score = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], [*batch.schema.names[:-1], "score"])
    return run


def score_quality(docs: DataFrame, space: Space, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` (0 to 1, higher where label 1 is likelier), ``predicted``.

    The whole text decides, and nothing else. A null text is empty; without labelled rows every score is 0.5. Null and
    repeated ids stay, a row each; an empty table gives an empty one; other columns are left out. The space is
    broadcast; it holds at most the sample's vectors. Nothing is shuffled.
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(space)
    wanted = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    made = wanted.mapInArrow(_score(shared), f"id {wanted.schema['id'].dataType.simpleString()}, held_out boolean, score double")
    return made.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, space: Space, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, all columns kept; nothing is shuffled."""
    plain, names = opaque(docs)
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(space)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    made = (plain.withColumn("_text", F.col(names[text_col]).cast("string"))
                 .mapInArrow(_score(shared), f"{schema}, score double").where("score >= 0.5"))
    return made.select(*[F.col(n).alias(c) for c, n in names.items()])
