"""The prefix trie of conversations, built as a burst trie.

Conversations that start with the same turns meet in a container under a head of the trie. A container with more
than ``limit`` turns bursts: the turns that all its conversations share become its chain, and those that follow
deal its conversations into new containers by their next turn. What remains is small: each container is sorted in
one task and swept into nodes. Then the chains of burst containers, from the deepest up, take the totals of what
hangs below them. Long conversations are cut into slabs of ``slab`` turns, which meet again by a digest of all turns
before the slab, so no row holds more than one slab and no task more than a container.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import prefix_sums, text_of
from tradewind.operators.ordering import global_rank
from tradewind.sources.stage import stage

NODE = ("top string, first boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
_NODE_TYPES = [pa.string(), pa.bool_(), *[pa.int64()] * 7, pa.string()]
_ROOT = "0:0"
_ROW = ["top", "head", "base", "root_least", "ids", "chars", "n", "least", "ends", "kids", "leaves", "saved"]


def turn_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 0), ``tid`` (digest of role and text), ``chars`` of each turn, and its conversation's ``n`` turns (staged).

    Turns are numbered by turn, null first, equal numbers by digest. Positions come from a sort of all turns by ranges, so a
    conversation with a third of them is spread over tasks. Rows without a conversation are left out.
    """
    role, text = text_of(role_col), text_of(text_col)
    rows = stage(turns.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256), 1, 32).alias("tid"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row")).where("conv IS NOT NULL"), "turns")
    placed = global_rank(rows, ["conv", F.col("turn").asc_nulls_first(), "tid", "row"], "at")
    firsts = stage(placed.groupBy(F.col("conv").alias("_c")).agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("n")), "lengths")
    return stage(placed.join(firsts, F.col("conv") == F.col("_c")).select("conv", (F.col("at") - F.col("_first")).alias("pos"), "tid", "chars", "n"), "placed")


def share_openings(rows: DataFrame, span: int = 100, modulus: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations with ``length``, and their turns, each rebuilt on the opening of the first conversation of its span.

    A conversation c takes the first h turns of conversation c - c % span (h = crc32 of c as text, modulo ``modulus``),
    all if that one has fewer, none if there is none, and then its own turns after its first h.
    """
    convs = rows.where("pos = 0").select("conv", "n", (F.col("conv") - F.col("conv") % span).alias("base"),
                                         (F.crc32(F.col("conv").cast("string").cast("binary")) % modulus).alias("h"))
    sizes = convs.select(F.col("conv").alias("_b"), F.col("n").alias("_n"))
    convs = stage(convs.join(sizes, F.col("base") == F.col("_b"), "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("_n", F.lit(0))).alias("got"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own")), "conversations")
    opening = rows.where(F.col("pos") < modulus - 1).select(F.col("conv").alias("_b"), "pos", "tid", "chars")
    heads = convs.join(opening, (F.col("base") == F.col("_b")) & (F.col("pos") < F.col("h"))).select("conv", "pos", "tid", "chars")
    tails = (rows.join(convs.select(F.col("conv").alias("_c"), "h", "got"), F.col("conv") == F.col("_c")).where("pos >= h")
             .select("conv", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "tid", "chars"))
    return convs.select("conv", (F.col("got") + F.col("own")).alias("length")), heads.unionByName(tails)


def _digest(convs: Column) -> Column:
    """SHA-256 of the conversations in ascending order, joined by commas."""
    return F.sha2(F.array_join(F.transform(F.sort_array(convs), lambda c: c.cast("string")), ","), 256)


def _sequences(convs: DataFrame, turns: DataFrame, slab: int) -> DataFrame:
    """Each distinct slab: ``slab``, ``top`` (digest of all turns before), ``next`` (with its own), ids, chars, members, least, ends (staged)."""
    cut = turns.withColumn("slab", F.expr(f"pos div {slab}")).groupBy("conv", "slab").agg(
        F.sort_array(F.collect_list(F.struct("pos", "tid", "chars"))).alias("items"))
    cut = cut.select("conv", "slab", F.transform("items", lambda x: x["tid"]).alias("ids"), F.transform("items", lambda x: x["chars"]).alias("chars"))
    sha = F.sha2(F.concat(F.col("slab").cast("string"), F.lit(":"), F.array_join("ids", ",")), 256)
    number = lambda at: F.conv(F.substring(sha, at, 12), 16, 10).cast("decimal(38,0)")
    cut = stage(cut.withColumn("own", number(1) * F.lit(1 << 48).cast("decimal(15,0)") + number(13))
                   .withColumn("own", F.col("own").cast("decimal(38,0)")).withColumn("block", F.expr("slab div 1024")), "slabs")
    summed = prefix_sums(cut, ["conv"], "block", ["slab"], "own", "ahead")
    key = lambda n, s: F.concat(n.cast("string"), F.lit(":"), s.cast("decimal(38,0)").cast("string"))
    keyed = (summed.join(convs.select(F.col("conv").alias("_c"), "length"), F.col("conv") == F.col("_c"))
             .withColumn("top", key(F.col("slab"), F.col("ahead"))).withColumn("next", key(F.col("slab") + 1, F.col("ahead") + F.col("own")))
             .withColumn("last", F.col("length") <= (F.col("slab") + 1) * slab))
    return stage(keyed.groupBy("slab", "top", "next").agg(
        F.first("ids").alias("ids"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"),
        _digest(F.collect_list(F.when(F.col("last"), F.col("conv")))).alias("ends")), "sequences")


def _nodes(head: list) -> Iterator[tuple]:
    """The nodes of one container, its rows in ascending order of their turns."""
    nodes, path, last, empty = [], [], [], head[0]["none"]
    for row in head:
        ids, k = row["ids"], 0
        while k < len(last) and k < len(ids) and last[k] == ids[k]:
            k += 1
        del path[k:]
        for i in path:
            nodes[i][1] += row["n"]
            nodes[i][2] = min(nodes[i][2], row["least"])
        for d in range(k, len(ids)):
            path.append(len(nodes))     # depth, members, least, children, leaves, saved, chars, ends, parent
            nodes.append([d + 1, row["n"], row["least"], 0, 0, 0, row["chars"][d], empty, path[-2] if d else -1])
        nodes[path[-1]][3:6] = row["kids"], row["leaves"], row["saved"]
        nodes[path[-1]][7] = row["ends"]
        last = ids
    for node in reversed(nodes):        # a node's children come after it
        node[4] = node[4] if node[3] else 1
        node[5] += (node[1] - 1) * node[6]
        if node[8] >= 0:
            above = nodes[node[8]]
            above[3] += 1
            above[4] += node[4]
            above[5] += node[5]
    top, base, least = head[0]["top"], head[0]["base"], head[0]["root_least"]
    for node in nodes:
        yield (top, node[0] == 1, node[2], base + node[0], least if node[8] < 0 else nodes[node[8]][2], node[1], node[3], node[4], node[5], node[7])


def _sweep(none: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def containers():
            held: list[dict] = []
            for batch in batches:
                for row in batch.to_pylist():
                    row["none"] = none
                    if held and held[0]["head"] != row["head"]:
                        yield held
                        held = []
                    held.append(row)
            if held:
                yield held

        out: list[tuple] = []
        for head in containers():
            for node in _nodes(head):
                out.append(node)
                if len(out) == 10_000:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _NODE_TYPES)], names=[x.split()[0] for x in NODE.split(", ")])


_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"    # SHA-256 of no bytes


def _swept(rows: DataFrame) -> DataFrame:
    """The nodes of all containers (staged); a container lies in one task, in order."""
    return stage(rows.select(*_ROW).repartition("head").sortWithinPartitions("head", "ids").mapInArrow(_sweep(_EMPTY), NODE), "nodes")


def _totals(nodes: DataFrame) -> DataFrame:
    """What hangs directly below each head."""
    return nodes.where("first").groupBy(F.col("top").alias("_top")).agg(
        F.count(F.lit(1)).alias("_kids"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))


def _child(head: Column, turn: Column) -> Column:
    return F.sha2(F.concat(head, F.lit("/"), turn), 256)


def burst(rows: DataFrame, limit: int) -> DataFrame:
    """The nodes of containers (by ``head``) of any size."""
    chains: list[DataFrame] = []
    settled: list[DataFrame] = []       # containers that are small enough, by the pass that found them so
    rows = stage(rows, "containers")
    while True:
        large = stage(rows.groupBy(F.col("head").alias("_h")).agg(
            F.sum(F.size("ids")).alias("_turns"), F.count(F.lit(1)).alias("_rows"), F.min(F.struct("ids", "chars")).alias("_lo"), F.max("ids").alias("_hi"),
            F.sum("n").alias("_n"), F.min("least").alias("_least")).where(f"_turns > {limit} AND _rows > 1"), "large")
        if large.isEmpty():
            settled.append(rows)
            break
        same = F.zip_with(F.col("_lo")["ids"], "_hi", lambda a, b: a.eqNullSafe(b))
        large = large.withColumn("_skip", F.array_position(same, False).cast("int") - 1)     # lowest and highest differ: turns shared by all
        hit = rows.join(large, F.col("head") == F.col("_h"))
        chains.append(stage(hit.groupBy("top", "head", "base", "root_least").agg(
            F.first(F.slice(F.col("_lo")["ids"], F.lit(1), F.col("_skip"))).alias("ids"), F.first(F.slice(F.col("_lo")["chars"], F.lit(1), F.col("_skip"))).alias("chars"),
            F.first("_n").alias("n"), F.first("_least").alias("least"),
            F.coalesce(F.max(F.when(F.size("ids") == F.col("_skip"), F.col("ends"))), F.lit(_EMPTY)).alias("ends")), "chains"))
        rest = lambda c: F.slice(c, F.col("_skip") + 1, F.size(c) - F.col("_skip"))
        dealt = hit.where(F.size("ids") > F.col("_skip")).select(
            F.col("head").alias("top"), _child(F.col("head"), F.get("ids", F.col("_skip"))).alias("head"), (F.col("base") + F.col("_skip")).alias("base"),
            F.col("_least").alias("root_least"), rest("ids").alias("ids"), rest("chars").alias("chars"), "n", "least", "ends", "kids", "leaves", "saved")
        settled.append(rows.join(large, F.col("head") == F.col("_h"), "left_anti"))
        rows = stage(dealt, "containers")       # only what burst is looked at again
    nodes = _swept(reduce(DataFrame.unionByName, settled))
    for chain in reversed(chains):
        above = chain.join(_totals(nodes), F.col("head") == F.col("_top")).withColumns(
            {"kids": F.col("_kids"), "leaves": F.col("_leaves"), "saved": F.col("_saved")})
        nodes = nodes.unionByName(_swept(above))
    return nodes


def prefix_trie(convs: DataFrame, turns: DataFrame, limit: int = 1 << 11, slab: int = 1024) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    ``convs`` has ``conv`` and its ``length`` in turns, ``turns`` has ``conv``, ``pos`` from 0, ``tid``, ``chars``. Conversations without turns end at
    the root; without any conversation there is no node. Equal conversations are one row of a container, so thousands of copies
    make it no larger; their numbers are gathered in one row for the digest of a node's ends, as the digest needs.
    Passes: one per slab of the longest conversation, and in each as many as containers burst below one another.
    """
    found = _sequences(convs, turns, slab)
    everyone = convs.agg(F.min("conv"), F.count(F.lit(1)), F.max("length")).first()
    if not everyone[1]:
        return found.sparkSession.createDataFrame([], NODE).drop("top", "first")
    none = {c: F.coalesce(f"_{c}", F.lit(0)) for c in ("kids", "leaves", "saved")}
    below, parts = None, []
    for k in reversed(range(-(-everyone[2] // slab))):
        rows = found.where(F.col("slab") == k)
        if k:
            least = found.where(F.col("slab") == k - 1).select(F.col("next").alias("_next"), F.col("least").alias("root_least"))
            rows = rows.join(least, F.col("top") == F.col("_next"))
        else:
            rows = rows.withColumn("root_least", F.lit(everyone[0]).cast("long"))
        rows = rows.join(below, F.col("next") == F.col("_top"), "left").withColumns(none) if below is not None else rows.withColumns(
            {c: F.lit(0).cast("long") for c in none})
        rows = rows.withColumn("head", _child(F.col("top"), F.get("ids", F.lit(0)))).withColumn("base", F.lit(k * slab).cast("long"))
        parts.append(burst(rows.select(*_ROW), limit))
        below = _totals(parts[-1])
    ended = convs.where("length = 0").agg(_digest(F.collect_list("conv")).alias("ends"))
    hanging = below.where(F.col("_top") == _ROOT) if below is not None else convs.sparkSession.createDataFrame([], "_top string, _kids long, _leaves long, _saved long")
    root = hanging.agg(F.sum("_kids").alias("kids"), F.sum("_leaves").alias("leaves"), F.sum("_saved").alias("saved")).select(
        F.lit(everyone[0]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(everyone[1]).cast("long").alias("n_convs"), F.coalesce("kids", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.lit(ended.first()[0]).alias("ends_sha256"))
    return reduce(DataFrame.unionByName, [p.drop("top", "first") for p in parts], root)
