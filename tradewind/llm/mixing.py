"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import WORD, opaque, prefix_sums, text_of
from tradewind.operators.ordering import global_rank, ranges_in_order
from tradewind.sources.stage import stage


def word_count(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, cycle: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``rows``, ``rank``, ``target`` for each source (staged).

    Sources by code point, null last, weigh ``cycle`` over and over and share ``share`` times all words by
    weight. A target stops at ``most`` times its source's words; what is beyond goes to the others by
    weight. The level at which all is shared out is found from two sums at a time, so the sources need not
    fit in one task.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    keyed = sources.withColumn("_null", F.col("source").isNull()).withColumn("_text", F.coalesce("source", F.lit("")))
    ranked = global_rank(keyed, ["_null", "_text"], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("rank") % len(cycle) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight).drop("_null", "_text"), "sources")
    cap = F.lit(float(most)) * F.col("source_size")
    level, total = 0.0, None
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        row = ranked.agg(F.sum("source_size"), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        total = share * (row[0] or 0)
        reached = max(level, (total - (row[1] or 0.0)) / row[2]) if row[2] else level
        if reached == level:
            break
        level = reached
    target = F.least(cap, F.lit(level) * F.col("weight"))
    return stage(ranked.withColumn("target", target).select("source", "source_size", "rows", "rank", "target"), "targets")


def mix(sized: DataFrame, targets: DataFrame, share: float = 1.5, block_rows: int = 5_000, seed: str = "mix") -> DataFrame:
    """The mix: one row for each time a document is taken, in its order of training.

    ``sized`` has a distinct ``row``, ``id``, ``source`` and ``size``. Each source's documents are shuffled
    (by a hash of seed, round and id) and queued, again in a new order for a second round where the target
    asks for more than the source has. A document's virtual finish time is the number of its source's words
    up to its end over the source's target, so every source should end at time 1. Rows are sorted into ranges by
    that time over all sources, equal times by source, round and hash, so a range holds its share of rows whatever the times, and
    end at the budget; the document in service at its source's target is taken up to there. Returns ``row``, ``copy``, ``size``, ``taken``, ``finish``, ``position`` (words before).
    """
    near = targets.where("source_size > 0 and target > 0")
    picked = sized.where("size > 0").join(
        near.select(F.col("source").alias("_s"), "source_size", "rows", "rank", "target"),
        F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rounds = F.sequence(F.lit(0), F.ceil(F.col("target") / F.col("source_size")).cast("int") - 1)
    queued = (picked.withColumn("copy", F.explode(rounds))
              .withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.col("copy"), F.coalesce(F.col("id").cast("string"), F.lit("null"))))))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    queued = stage(queued.withColumn("block", F.floor(place * F.ceil(F.col("rows") / block_rows)).cast("long"))
                         .select("row", "id", "size", "source_size", "rank", "target", "copy", "key", "block"), "queued")
    ordered = prefix_sums(queued, ["rank", "copy"], "block", ["key", "id", "size", "row"], "size", "ahead")
    start = F.col("copy") * F.col("source_size") + F.col("ahead")
    served = (ordered.withColumn("start", start).where("start < floor(target)")
              .withColumn("taken", F.least(F.col("size"), F.floor("target") - F.col("start")))
              .withColumn("finish", F.least(F.lit(1.0), (F.col("start") + F.col("size")) / F.col("target"))))
    sorted_rows, _ = ranges_in_order(served, ["finish", "rank", "copy", "key", "id", "size", "row"])
    in_ranges = sorted_rows.withColumn("slot", F.shiftright("_at", 33))
    budget = F.lit(math.floor(share * (targets.agg(F.sum("source_size")).first()[0] or 0)))
    line = prefix_sums(in_ranges, [], "slot", ["_at"], "taken", "position")
    return (line.withColumn("taken", F.least(F.col("taken"), budget - F.col("position"))).where("taken > 0")
                .select("row", "copy", "size", "taken", "finish", "position").orderBy("position"))


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``row`` (distinct), ``id``, ``source``, ``size`` in words, staged; a null text has none."""
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                             F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size")), "sizes")


def taken_words(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                cycle: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Each input row with ``size``, ``source_size``, ``target`` of its source and ``taken`` words of the mix.

    Documents without words are taken 0 words of; a null source is a source. Rows that repeat an id are
    documents of their own. Without any words all targets are 0. Other columns are left out.
    """
    sized = sizes(docs, id_col, source_col, text_col)
    targets = source_targets(sized, cycle, share, most)
    taken = mix(sized, targets, share).groupBy(F.col("row").alias("_row")).agg(F.sum("taken").alias("taken"))
    out = (sized.join(targets.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s")))
                .join(taken, F.col("row") == F.col("_row"), "left"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  cycle: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents of the mix, all columns kept: a document is there as often as the mix takes it.

    A document that the mix cuts short is there whole if at least half of that copy's words are taken, else it
    is not; documents without words are left out. Rows with equal id, source and text are taken as often as the mix
    takes all of them, with the other columns of one of them. Null sources, repeated rows and empty tables are as in ``taken_words``.
    """
    plain, names = opaque(docs)
    parts = [F.col(names[c]).cast("string") for c in (id_col, source_col, text_col)]
    keyed = plain.withColumn("key", F.md5(F.to_json(F.array(*parts))))
    sized = stage(keyed.select(F.col("key").alias("row"), F.col(names[id_col]).alias("id"), F.col(names[source_col]).cast("string").alias("source"),
                               word_count(names[text_col]).alias("size")), "sizes")
    picks = mix(sized, source_targets(sized, cycle, share, most), share).where("2 * taken >= size")
    copies = picks.groupBy(F.col("row").alias("key")).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    out = keyed.dropDuplicates(["key"]).join(copies, "key").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
