"""Connected components: links are contracted in bounded batches, and star steps join the batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.sources.stage import stage

_BATCH = 1 << 20        # links that one task contracts


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars: each node with the smallest node that these links reach."""
    above: dict = {}

    def root(x):
        top = x
        while above[top] != top:
            top = above[top]
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            above.setdefault(a, a)
            above.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    nodes = [x for x in above if root(x) != x]
    for i in range(0, len(nodes), 1 << 16):
        part = nodes[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array([root(x) for x in part], pa.binary()), pa.array(part, pa.binary())], ["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    return edges.join(least, edges["a"] == least["n"]).select(F.col("m").alias("a"), "b").where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = stage(edges.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m")), "least")
    moved = edges.join(least, edges["b"] == least["n"]).select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.where("a <> b").unionByName(least.select(F.col("m").alias("a"), F.col("n").alias("b"))).distinct()


def components(links: DataFrame, batch: int = _BATCH) -> DataFrame:
    """``node`` and ``label``, the smallest node that the links ``a`` - ``b`` (binary) reach, for nodes that have links.

    Each task contracts at most about ``batch`` links to stars; a large-star and a small-star step then
    move the stars of different tasks towards each other, until nothing changes or one batch holds all that is
    left. Every step is written out, so no plan grows and a lost executor costs one step; the number
    of steps grows with the logarithm of the longest chain. Rows of a node with very many links are split
    where a join meets them. No links give an empty table.
    """
    edges, before = stage(links.select("a", "b"), "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        parts = max(1, -(-now[0] // batch))
        if now == before:
            break
        before = now
        edges = stage(edges.coalesce(parts).mapInArrow(_contract, "a binary, b binary"), "stars")
        if parts == 1:
            break
        edges = stage(_small_star(stage(_large_star(edges), "large")), "small")
    return stage(edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
                      .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct(), "labels")
