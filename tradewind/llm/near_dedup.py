"""MinHash near-dedup with an LSH forest.

Documents with the same set of shingles are one node. Every node's MinHash signature is put in several
orders (the trees of the forest); each tree is sorted over the whole cluster, and a node's candidates are
its neighbours in that order, those with the longest common prefix. So the depth adapts to the region:
where few signatures begin alike a short common prefix is enough, in a crowded region only the
longest count. The trees are sorted by range with the node as last key, so no region, however large,
is a single task; rows at the cuts between tasks are compared in a second, small pass. Every link
is confirmed on the two full sets of shingles.

A region may hold more nodes than a node is compared with. Nodes of such a crowded region are compared exactly
as well: two sets that are alike enough share one of the rarest shingles of each, so nodes meet by those, if
the links found so far do not connect them yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import lowered, mixed, opaque, short_batches, span_hashes, text_chunks, words_of
from tradewind.llm.components import components
from tradewind.sources.stage import stage

VALUES = 128            # MinHash values of a signature
TREES, DEPTH = 16, 16   # orders of the signature, and values of it that an order sorts by
NEIGHBOURS = 4          # following nodes of a tree that a node is compared with
LEAST_PREFIX = 3        # values that a candidate shares at least at the start of a tree's order
LEAST_ALIKE = 10        # of the DEPTH values of that tree (at similarity 0.85, 13.6 are expected)
CROWD_PREFIX = 4        # a node is in a crowded region if its last compared neighbour shares so many values at the start
LEAST_PERCENT = 75      # likeness for which the four numbers above hold: 3 of the first values agree in an order with 0.9998, 4 with 0.998
SKETCH_BITS = 21        # the counts that say which shingles are rare: 2 ** bits of 4 bytes, sent to every task


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. A text with fewer words is one shingle, without words none."""
    data = lowered(data)
    starts, ends, first = words_of(data, offsets)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    h = span_hashes(data, starts, ends)
    n = max(0, len(h) - words + 1)
    rolled = np.full(n, words, np.uint64)
    for i in range(words):
        rolled = mixed(rolled + h[i:i + n])
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        else:
            whole = np.array([b - a], np.uint64)
            for i in range(a, b):
                whole = mixed(whole + h[i:i + 1])
            out.append(whole if b > a else np.zeros(0, np.uint64))
    return out


def _set_key(own: np.ndarray) -> bytes:
    """128 bits that name a set of shingles; none for the empty set."""
    return np.array([own.sum(dtype=np.uint64), mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(own))]).tobytes()


def _signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """MinHash values (the upper half of each minimum) of each set that has shingles."""
    full = np.concatenate(sets)
    cuts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    factors = mixed(np.arange(1, values + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((len(sets), values), np.uint32)
    for k, factor in enumerate(factors):
        out[:, k] = np.minimum.reduceat(full * factor, cuts) >> np.uint64(32)
    return out


def _describe(words: int, values: int):
    """Batches of (id, text) to id, size and key of the set, signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, words)
                some = [i for i, s in enumerate(sets) if len(s)]
                signed = _signatures([sets[i] for i in some], values) if some else None
                rows = dict(zip(some, signed)) if some else {}
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([rows[i].tobytes() if i in rows else None for i in range(len(sets))], pa.binary())],
                    ["id", "n_shingles", "node", "signature"])
    return run


def _plant(trees: int, depth: int):
    """Batches of (node, signature) to one row a tree: the values in the tree's order, as sortable bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            signed = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, -1)
            step = signed.shape[1] // trees
            for t in range(trees):
                order = (np.arange(depth) + t * step) % signed.shape[1]
                keys = np.ascontiguousarray(signed[:, order]).astype(">u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(0)], ["tree", "key", "node"])
    return run


def _neighbours(depth: int, reach: int, prefix: int, alike: int, edges: bool):
    """Sorted batches of (tree, key, node) to candidate pairs (kind 0), the first and last rows of the task
    if asked for (1) and the nodes of crowded regions (2)."""
    crowd: set[bytes] = set()

    def pairs(tree, key, node, fresh):
        """Of rows in order, where those before ``fresh`` have been compared with each other."""
        for lag in range(1, reach + 1):
            at = np.arange(max(lag, fresh), len(tree))
            same = (key[at] == key[at - lag]) & (tree[at] == tree[at - lag])[:, None]
            ok = same[:, :prefix].all(axis=1) & (same.sum(axis=1) >= alike)
            for i in at[ok]:
                yield min(node[i], node[i - lag]), max(node[i], node[i - lag]), int(same[i - at[0]].sum())
            if lag == reach:
                for i in at[same[:, :CROWD_PREFIX].all(axis=1)]:
                    crowd.update((node[i], node[i - lag]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind, rows):
            return pa.RecordBatch.from_pydict({
                "kind": pa.array([kind] * len(rows), pa.int32()), "tree": pa.array([r[2] for r in rows], pa.int32()),
                "a": pa.array([r[0] for r in rows], pa.binary()), "b": pa.array([r[1] for r in rows], pa.binary())})
        held = None
        seen, opening = 0, []
        crowd.clear()
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy(zero_copy_only=False)
            raw, node = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            key = np.frombuffer(b"".join(raw), ">u4").reshape(-1, depth)
            if len(opening) < reach:
                opening += [(raw[i], node[i], int(tree[i])) for i in range(min(reach - len(opening), len(raw)))]
            fresh = 0
            if held is not None:
                fresh = len(held[0])
                tree, key, node, raw = np.concatenate((held[0], tree)), np.concatenate((held[1], key)), held[2] + node, held[3] + raw
            found = list(pairs(tree, key, node, fresh))
            if found:
                yield out(0, found)
            if crowd:
                yield out(2, [(n, n, 0) for n in crowd])
                crowd.clear()
            seen += batch.num_rows
            held = (tree[-reach:], key[-reach:], node[-reach:], raw[-reach:])
        if edges and held is not None:
            last = [(held[3][i], held[2][i], int(held[0][i])) for i in range(len(held[2]))]
            last = last[max(0, len(opening) + len(last) - seen):]       # a row that opens and ends the task is sent once
            yield out(1, opening + last)
    return run


def candidate_pairs(nodes: DataFrame, trees: int = TREES, depth: int = DEPTH, reach: int = NEIGHBOURS,
                    prefix: int = LEAST_PREFIX, alike: int = LEAST_ALIKE) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs ``a`` < ``b`` of neighbours in some tree, with ``alike``, their most equal values there, and
    the nodes of crowded regions (both staged)."""
    planted = nodes.select("node", "signature").mapInArrow(_plant(trees, depth), "tree int, key binary, node binary")
    ordered = planted.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    schema = "kind int, tree int, a binary, b binary"
    found = stage(ordered.mapInArrow(_neighbours(depth, reach, prefix, alike, True), schema), "neighbours")
    cuts = (found.where("kind = 1").select("tree", F.col("a").alias("key"), F.col("b").alias("node"))
                 .coalesce(1).sortWithinPartitions("tree", "key", "node"))      # 2 * reach rows of each task
    met = found.unionByName(stage(cuts.mapInArrow(_neighbours(depth, reach, prefix, alike, False), schema), "across"))
    pairs = met.where("kind = 0").groupBy("a", "b").agg(F.max("tree").alias("alike"))
    return stage(pairs, "pairs"), stage(met.where("kind = 2").select(F.col("a").alias("node")).distinct(), "crowded")


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, words)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])
    return run


def _confirm(percent: int):
    """Batches of (a, b, shingles of a, shingles of b) to the pairs that are alike enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
                 .mapInArrow(_confirm(percent), "a binary, b binary"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends no link connects yet."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
                 .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select(*pairs.columns))


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (node, shingles) to how many shingles of the task fall on each counter."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for own in batch.column(1):
            np.add.at(counts, np.frombuffer(own.as_buffer(), np.uint64) >> np.uint64(64 - SKETCH_BITS), 1)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["counter", "n"])


def _rarest(counts, percent: int):
    """Batches of (node, shingles, label) to the rarest shingles, of which two sets that are alike enough share one.

    Rare by the counters, then by hash: one order for all sets, so the counters' collisions lose nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rare, sizes = [], []
                for set_bytes in part.column(1):
                    own = np.frombuffer(set_bytes.as_buffer(), np.uint64)
                    first = np.argsort(counts.value[own >> np.uint64(64 - SKETCH_BITS)], kind="stable")
                    rare.append(own[first[:len(own) - -(-percent * len(own) // 100) + 1]])
                    sizes.append(len(own))
                lengths = np.array([len(r) for r in rare])
                row = np.repeat(np.arange(part.num_rows), lengths)
                before = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(rare).view(np.int64)), part.column(0).take(pa.array(row)),
                    pa.array(np.array(sizes, np.int64)[row]), pa.array(before), part.column(2).take(pa.array(row))],
                    ["shingle", "node", "n", "place", "label"])
    return run


def crowded_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Every pair ``a`` < ``b`` of ``sets`` (node, shingles) that may be alike enough and that no link connects yet (staged).

    Two sets with 100 * shared >= percent * all share at least one of the n - ceil(percent * n / 100) + 1 first
    shingles of each in any common order; the rarest come first here, so what many documents share brings
    few together. Of the first shingle that two sets share, neither has more after it than can be shared: a meeting
    counts only if those would do. Shingles whose nodes are all connected already are left out before nodes meet.
    """
    counted = sets.mapInArrow(_count_shingles, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    got = counted.toArrow()         # at most 2 ** SKETCH_BITS rows
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    counts[got["counter"].to_numpy()] = np.minimum(got["n"].to_numpy(), 0xFFFFFFFF)
    sent = sets.sparkSession.sparkContext.broadcast(counts)
    known = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    named = (sets.join(known, F.col("node") == F.col("_node"), "left")
                 .select("node", "shingles", F.coalesce("_label", "node").alias("label")))
    rare = stage(named.mapInArrow(_rarest(sent, percent), "shingle long, node binary, n long, place long, label binary"), "rare")
    mixed_up = (rare.groupBy(F.col("shingle").alias("_shingle")).agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
                    .where("_low < _high").select("_shingle"))
    rare = stage(rare.join(mixed_up, F.col("shingle") == F.col("_shingle")).drop("_shingle"), "meeting")
    x, y = rare.alias("x"), rare.alias("y")
    fits = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) \
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) \
        & ((100 + percent) * F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= percent * (F.col("x.n") + F.col("y.n")))
    return stage(x.join(y, fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "crowded-pairs")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                    reach: int = NEIGHBOURS) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if 100 * shared shingles >= ``percent`` * all shingles of the two; ``component_id`` is the
    smallest id that links reach. Shingles are runs of ``words`` words in lower case (A-Z); a shorter text is
    one shingle. Texts without words and null texts are linked with nothing: their component is their own id.
    Equal sets are one node, so repeated rows and groups of copies cost one candidate search. Null ids
    take part and get the component's id, null if it has no other. An empty table gives an empty one; other columns
    are left out. Candidates are probable, not sure: see the README for the measured recall.

    Pairs are confirmed in two rounds: first each node's likest neighbour on either side, then of the other pairs those that
    the links found so far do not connect, so that a group of thousands does not confirm all its pairs. A third round
    has the pairs of crowded regions, where more nodes begin alike than ``reach`` compares. The search is made for likeness of
    ``LEAST_PERCENT`` and more: below, pairs would be missed, so a lower ``percent`` is refused.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent must be {LEAST_PERCENT} or more")
    short_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    described = stage(wanted.mapInArrow(_describe(words, VALUES), f"id {wanted.schema['id'].dataType.simpleString()}, n_shingles long, node binary, signature binary"), "described")
    nodes = stage(described.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.first("signature").alias("signature")), "nodes")
    pairs, crowded = candidate_pairs(nodes, reach=reach)
    involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(crowded).distinct()
    chosen = stage(nodes.join(involved, "node", "left_semi").select("node", "id"), "involved")
    texts = wanted.join(chosen.select(F.col("id").alias("_id")).distinct(), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    sets = (texts.select("id", "text").mapInArrow(_sets(words), "node binary, shingles binary"))
    sets = stage(sets.join(chosen.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")

    likest = pairs.select("a", "b", F.struct("alike", "a", "b").alias("rank"))
    first = (likest.groupBy("a").agg(F.max("rank").alias("r")).select("r")
             .union(likest.groupBy("b").agg(F.max("rank").alias("r")).select("r")).select("r.a", "r.b").distinct())
    links = stage(confirmed(first, sets, percent), "links")
    labels = components(links)
    rest = _apart(pairs.join(first, ["a", "b"], "left_anti"), labels)
    links = links.unionByName(stage(confirmed(rest, sets, percent), "links"))
    labels = components(links)
    if not crowded.isEmpty():
        more = crowded_pairs(sets.join(crowded, "node", "left_semi"), labels, percent)
        more = stage(confirmed(more, sets, percent), "links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))

    group = stage(nodes.select("node", "id").join(labels, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label")), "groups")
    smallest = group.groupBy(F.col("label").alias("_label")).agg(F.min("id").alias("component_id"))
    named = stage(group.join(smallest, F.col("label") == F.col("_label")).select(F.col("node").alias("_node"), "component_id"), "named")
    out = described.join(named, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns kept. Ids should be distinct: rows share the decision on their id."""
    found = near_duplicates(docs, id_col, text_col, words, percent)
    plain, names = opaque(docs)
    stay = stage(found.where("kept").select(F.col(id_col).alias("_id")).distinct(), "kept")
    kept = plain.join(stay, F.col(names[id_col]).eqNullSafe(F.col("_id")), "left_semi")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
