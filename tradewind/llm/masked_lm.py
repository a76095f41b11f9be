"""Masked pseudo-likelihood: a bidirectional window network predicts every word from both sides.

The network sums learned vectors of the words around a place, weighted by position, and predicts the word
in two steps, its class and the word in the class, so that each probability is normalised over all ids. An
id is a frequent word or a bucket of all others by hash; a word of a bucket has the share of the bucket's
probability that it has of the bucket's occurrences. Those are counted for every word, in a Spark table that
grows with the corpus, and joined on the word's hash. It is trained in numpy on the cluster: each learner runs over its part of the
corpus, the changes of all learners are averaged block by block, and the next round starts from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import lowered, mixed, row_cuts, short_batches, span_hashes, text_chunks, words_of
from tradewind.sources.stage import stage

CLASSES, PER_CLASS = 64, 64
WORDS = CLASSES * PER_CLASS     # ids: the most frequent words, then buckets for all others
BUCKETS = 512
COMMON = 1 << 20                # a word of a bucket that has this part of all words of buckets is looked up without a join
WIDTH, REACH = 32, 2            # size of a vector; words seen on either side
ROUNDS = 2
STRIDE = 2                      # a round masks every STRIDE-th word, so that many rounds mask every word
LEARNER_WORDS = 1 << 22         # words that one learner learns from in a round
_BATCH = 4096
_OFFSETS = [k for k in range(-REACH, REACH + 1) if k]
_SHAPES = {"embed": (WORDS + 1, WIDTH), "place": (len(_OFFSETS), WIDTH), "bias": (WIDTH,), "kind": (CLASSES, WIDTH), "kind_bias": (CLASSES,),
           "word": (WORDS, WIDTH), "word_bias": (WORDS,)}


def hashes_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word in lower case, and how many words come before each row."""
    hashes, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in row_cuts(offsets, 1 << 17):         # as much as a core's cache holds
        part = lowered(data[offsets[a]:offsets[b]])
        starts, ends, before = words_of(part, offsets[a:b + 1] - offsets[a])
        if len(starts):
            hashes.append(span_hashes(part, starts, ends))
        first.append(first[-1][-1] + before[1:])
    return np.concatenate(hashes), np.concatenate(first)


def find_hashes(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are in ``known`` (sorted), and the place there of each that is."""
    if not len(known):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    top = np.uint64(48)         # hashes are spread evenly: few known words share their first 16 bits, so a few steps from there replace a binary search
    alike = np.bincount((known >> top).astype(np.int64), minlength=1 << 16)
    at = np.minimum(np.cumsum(alike) - alike, len(known) - 1)[(hashes >> top).astype(np.int64)]
    for _ in range(alike.max() - 1):
        at = np.minimum(at + (known[at] < hashes), len(known) - 1)
    return known[at] == hashes, at


def word_ids(hashes: np.ndarray, known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ids of words: their rank if known (``known`` sorted), else a bucket by hash."""
    bucket = WORDS - BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
    if not len(known):
        return bucket
    found, at = find_hashes(hashes, known)
    return np.where(found, ids[at], bucket)


def contexts(ids: np.ndarray, first: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The ids around each word, or around those ``at`` some places; beyond the ends of its document, WORDS."""
    rows = len(first) - 1
    place = np.arange(len(ids)) + REACH * (np.repeat(np.arange(rows), np.diff(first)) + 1)
    padded = np.full(len(ids) + REACH * (rows + 1), WORDS, np.int64)
    padded[place] = ids
    place = place[at]
    return np.stack([padded[place + k] for k in _OFFSETS], axis=1)


def sums_of_rows(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of the hashes of each document's words, modulo 2^64."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes, dtype=np.uint64)))[first]
    return sums[1:] - sums[:-1]


def places_of_round(sums: np.ndarray, first: np.ndarray, round_: int, rounds: int) -> np.ndarray:
    """The words that a round predicts, from the sum of each document's hashes."""
    stride = min(STRIDE, rounds)
    offset = (mixed(sums) % np.uint64(stride)).astype(np.int64)
    place = np.arange(first[-1]) + np.repeat(offset - first[:-1], np.diff(first))
    return np.flatnonzero(place % stride == round_ % stride)


def masked_places(hashes: np.ndarray, first: np.ndarray, round_: int, rounds: int) -> np.ndarray:
    """The words that a round predicts: every word is one of them in at least one of ``rounds`` rounds.

    A hash of its words says where a document begins, so that short ones do not all fall into the same round.
    """
    return places_of_round(sums_of_rows(hashes, first), first, round_, rounds)


def _less_top(x: np.ndarray) -> np.ndarray:
    """Takes the largest value of each row from the row, in place; found by argmax, which numpy runs faster than max along short rows."""
    x -= x.reshape(-1)[x.argmax(axis=1) + np.arange(0, x.size, x.shape[1])][:, None]
    return x


def _softmax(x: np.ndarray, parts: list[slice]) -> np.ndarray:
    """Softmax of each row, in place; rows are summed part by part."""
    np.exp(_less_top(x), out=x)
    sums, ones = np.empty(len(x), x.dtype), np.ones(x.shape[1], x.dtype)
    for at in parts:
        sums[at] = x[at] @ ones
    x /= sums[:, None]
    return x


def _log_chance(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at one column; ``x`` is overwritten."""
    wanted = _less_top(x)[np.arange(len(x)), own]
    return wanted - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def _sums_by(ids: np.ndarray, rows: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different ids (below 2^16), sorted, and the sum of the rows of each: row i has id i, or with ``of`` row of[i].

    Most ids have few rows: up to 8 are added place by place, for all such ids at once, in reduceat's own order of adding.
    """
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    ids = ids[order]
    if of is not None:
        order = of[order]
    starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    times = np.concatenate((starts[1:], [len(ids)])) - starts
    few = (9 - np.minimum(times, 9)).astype(np.uint8)
    found, by = ids[starts], np.argsort(few, kind="stable")         # those of most rows first
    starts, times = starts[by], times[by]
    more = np.searchsorted(few[by], np.arange(9, 0, -1).astype(np.uint8)).tolist()     # ids before it have more than k rows
    many = more[8]
    sums = np.take(rows, order[starts], axis=0)
    rest = np.take(rows, order[starts[many:more[1]] + 1], axis=0)
    for k in range(2, 8):
        rest[:more[k] - many] += np.take(rows, order[starts[many:more[k]] + k], axis=0)
    sums[many:more[1]] += rest
    if many:
        n = times[:many]
        at = np.cumsum(n) - n
        own = np.repeat(starts[:many] - at, n) + np.arange(n.sum())
        sums[:many] = np.add.reduceat(np.take(rows, order[own], axis=0), at, axis=0)
    place = np.empty_like(by)
    place[by] = np.arange(len(by))
    return found, np.take(sums, place, axis=0)


def _hidden(net: dict, around: np.ndarray) -> np.ndarray:
    h = np.repeat(net["bias"][None, :], len(around), axis=0)
    for a in range(0, len(around), _BATCH):         # as much as a core's cache holds
        total = h[a:a + _BATCH]
        for j in range(around.shape[1]):
            part = np.take(net["embed"], around[a:a + _BATCH, j], axis=0)
            part *= net["place"][j]
            total += part
        np.tanh(total, out=total)
    return h


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of the targets by class, and where each class lies in it."""
    kind = (targets % CLASSES).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    cuts = np.searchsorted(kind[order], np.arange(CLASSES + 1))
    return order, [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


def _cuts(n: int) -> list[slice]:
    """Parts of at least _BATCH rows, of fewer only if there are no more."""
    starts = list(range(0, max(n - _BATCH, 0) + 1, _BATCH))
    return [slice(a, b) for a, b in zip(starts, [*starts[1:], n])]


def _of_classes(rows: np.ndarray) -> np.ndarray:
    """Rows by word as rows by class and word in it."""
    return np.ascontiguousarray(rows.reshape(PER_CLASS, CLASSES, -1).swapaxes(0, 1))


def log_probabilities(net: dict, around: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log-probability of each target given the words around it."""
    out = np.zeros(len(targets), np.float32)
    words, biases = _of_classes(net["word"]), _of_classes(net["word_bias"])[:, :, 0]
    for a in range(0, len(targets), 1 << 15):
        own = targets[a:a + (1 << 15)]
        order, classes = _by_class(own)
        own, h = own[order], _hidden(net, around[a:a + (1 << 15)][order])
        kinds, places = own % CLASSES, own // CLASSES
        part = np.empty(len(own), h.dtype)
        for b in _cuts(len(own)):
            x = h[b] @ net["kind"].T
            x += net["kind_bias"]
            part[b] = _log_chance(x, kinds[b])
        for c, at in classes:
            x = h[at] @ words[c].T
            x += biases[c]
            part[at] += _log_chance(x, places[at])
        out[a + order] = part
    return out


def gradients(net: dict, around: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the summed log-loss."""
    n = len(targets)
    order, classes = _by_class(targets)
    around, targets = np.ascontiguousarray(around.T)[:, order].T, targets[order]
    h = _hidden(net, around)
    kinds = h @ net["kind"].T
    kinds += net["kind_bias"]
    _softmax(kinds, [slice(None)])
    kinds[np.arange(n), targets % CLASSES] -= 1
    back = kinds @ net["kind"]
    found = {k: np.zeros_like(net[k]) for k in ("embed", "place")}
    found["kind"], found["kind_bias"] = kinds.T @ h, kinds.sum(axis=0)
    words, biases = _of_classes(net["word"]), _of_classes(net["word_bias"])[:, :, 0]
    word, word_bias = np.zeros_like(words), np.zeros_like(biases)
    chances, part = kinds, np.empty_like(back)      # kinds are used up
    rows = [(c, chances[at], h[at], part[at]) for c, at in classes]
    for c, x, own, _ in rows:
        np.matmul(own, words[c].T, out=x)
        x += biases[c]
    _softmax(chances, [at for _, at in classes])
    chances[np.arange(n), targets // CLASSES] -= 1
    for c, x, own, to in rows:
        np.matmul(x, words[c], out=to)
        np.matmul(x.T, own, out=word[c])
        np.add.reduce(x, axis=0, out=word_bias[c])
    back += part
    found["word"], found["word_bias"] = word.swapaxes(0, 1).reshape(WORDS, WIDTH), word_bias.T.reshape(WORDS)
    h *= h
    back *= np.subtract(1, h, out=h)
    found["bias"] = back.sum(axis=0)
    seen = around.shape[1]
    keys = (around.T + np.arange(0, seen * (WORDS + 1), WORDS + 1)[:, None]).reshape(-1)     # all places at once
    at, sums = _sums_by(keys, back, np.tile(np.arange(n), seen))
    cuts = np.searchsorted(at, np.arange(0, (seen + 1) * (WORDS + 1), WORDS + 1))
    for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
        own, part = at[a:b] - j * (WORDS + 1), sums[a:b]
        found["embed"][own] += part * net["place"][j]
        part *= np.take(net["embed"], own, axis=0)
        found["place"][j] = part.sum(axis=0)
    return found


def train_step(net: dict, past: dict, around: np.ndarray, targets: np.ndarray, rate: float) -> None:
    """One step of adaptive gradient descent; ``past`` sums the squared gradients of the task so far."""
    for name, g in gradients(net, around, targets).items():
        for a in range(0, len(g), 1 << 10):         # rows that a core's cache holds
            at = slice(a, a + (1 << 10))
            past[name][at] += g[at] * g[at]
            size = np.sqrt(past[name][at])
            size += np.float32(1e-6)
            g[at] *= np.float32(rate)
            g[at] /= size
            net[name][at] -= g[at]


def fresh_net() -> dict[str, np.ndarray]:
    made = np.random.default_rng(7)
    net = {k: (made.standard_normal(s) * 0.1).astype(np.float32) for k, s in _SHAPES.items()}
    net["place"] += np.float32(1)
    for k in ("bias", "kind_bias", "word_bias"):
        net[k][:] = 0
    return net


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def summed():
        every, times = np.concatenate([h for h, _ in held]), np.concatenate([n for _, n in held])
        known, place = np.unique(every, return_inverse=True)
        return known, np.bincount(place, weights=times).astype(np.int64)

    def out(known, times):
        return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(times)], ["word", "n"])

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            held.append(np.unique(hashes_of(data, offsets)[0], return_counts=True))
            size += len(held[-1][0])
        if size > 1 << 21:
            held = [summed()]
            size = len(held[0][0])
            if size > 1 << 20:
                yield out(*held[0])
                held, size = [], 0
    if size:
        yield out(*summed())


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (a hash) and ``n`` of every different word of all documents, written once."""
    short_batches(docs.sparkSession)
    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count_words, "word long, n long")
    return stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")


def vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most frequent words, sorted, and their ranks. As many as the model has ids of their own for."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(WORDS - BUCKETS).collect()
    known = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], order.astype(np.int64)


def _bucket_rows(known: np.ndarray, ids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bucket = word_ids(words.view(np.uint64), known, ids) - (WORDS - BUCKETS)
            at = bucket >= 0
            yield pa.RecordBatch.from_arrays([pa.array(words[at]), pa.array(n[at]), pa.array(bucket[at].astype(np.int32))], ["word", "n", "bucket"])
    return run


def bucketed_words(counts: DataFrame, known: np.ndarray, ids: np.ndarray) -> DataFrame:
    """``word``, ``n`` and ``bucket`` of the words without an id of their own."""
    return counts.select("word", "n").mapInArrow(_bucket_rows(known, ids), "word long, n long, bucket int")


def bucket_sizes(bucketed: DataFrame) -> np.ndarray:
    """How many words of all documents each bucket holds."""
    sizes = np.zeros(BUCKETS, np.int64)
    for r in bucketed.groupBy("bucket").agg(F.sum("n").alias("n")).collect():   # BUCKETS rows
        sizes[r["bucket"]] = r["n"]
    return sizes


def _train(shared, round_: int, rounds: int, rate: float):
    """The changes of each learner (rows come learner by learner) from the network that the round starts with."""
    def changes(start: dict, net: dict, past: dict, learner: int, seen: int) -> Iterator[pa.RecordBatch]:
        for name, value in net.items():
            change, met = (value - start[name]).ravel(), (past[name] > 0).ravel()
            for i, a in enumerate(range(0, len(change), 1 << 14)):
                yield pa.RecordBatch.from_pydict({
                    "name": [name], "block": pa.array([i], pa.int32()), "learner": pa.array([learner], pa.int64()),
                    "weight": [float(seen)], "change": pa.array([change[a:a + (1 << 14)].tobytes()], pa.binary()),
                    "met": pa.array([np.packbits(met[a:a + (1 << 14)]).tobytes()], pa.binary())})

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            learner = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(learner)) + 1).tolist(), len(learner)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    yield int(learner[a]), batch.slice(a, b - a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        for learner, group in groupby(rows_of(batches), key=lambda x: x[0]):
            net, past = {k: v.copy() for k, v in start.items()}, {k: np.zeros_like(v) for k, v in start.items()}
            held, waiting, seen = [], 0, 0

            def learn():
                around, targets = np.concatenate([r[0] for r in held]), np.concatenate([r[1] for r in held])
                for a in range(0, len(targets), _BATCH):
                    train_step(net, past, around[a:a + _BATCH], targets[a:a + _BATCH], rate)

            for _, rows in group:
                for own, first, sums in id_chunks(rows):
                    if not len(own):
                        continue
                    masked = places_of_round(sums, first, round_, rounds)
                    held.append((contexts(own, first, masked), own[masked]))
                    waiting += len(masked)
                    if waiting >= _BATCH:
                        learn()
                        seen, held, waiting = seen + waiting, [], 0
            if waiting:
                learn()
                seen += waiting
            if seen:
                yield from changes(start, net, past, learner, seen)
    return run


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    """The mean change of one block, by the number of places each learner learned from; a number counts the learners that moved it."""
    total, mass = 0.0, 0.0
    for r in rows.sort_values("learner").itertuples():
        change = np.frombuffer(r.change, np.float32).astype(np.float64)
        total = total + r.weight * change
        mass = mass + r.weight * np.unpackbits(np.frombuffer(r.met, np.uint8), count=len(change))
    mean = np.where(mass > 0, total / np.maximum(mass, 1e-9), 0.0)
    return pd.DataFrame({"name": [rows["name"].iloc[0]], "block": [rows["block"].iloc[0]], "change": [mean.astype(np.float32).tobytes()]})


def _ids(shared):
    """A row per text: its words' ids, the sum of their hashes, and its length in bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids = shared.value
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                hashes, first = hashes_of(data, offsets)
                held = word_ids(hashes, known, ids).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), pa.array(sums_of_rows(hashes, first).view(np.int64)),
                     pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(2 * first.astype(np.int64)), pa.py_buffer(held)]).cast(pa.binary())],
                    ["learner", "size", "sum", "ids"])
    return run


def id_chunks(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of rows of ``learners``, those of about a megabyte of text at a time: ids, how many come before each row, sums of hashes."""
    sums = rows.column(2).to_numpy().view(np.uint64)
    texts, held = np.concatenate(([0], np.cumsum(rows.column(1).to_numpy()))), rows.column(3).cast(pa.large_binary())
    _, ends, data = held.buffers()
    first = np.frombuffer(ends, np.int64)[held.offset:held.offset + len(held) + 1] // 2
    ids = np.frombuffer(data, "<u2") if data is not None else np.zeros(0, "<u2")
    for a, b in row_cuts(texts):
        yield ids[first[a]:first[b]].astype(np.int64), first[a:b + 1] - first[a], sums[a:b]


def learners(docs: DataFrame, counts: DataFrame, known: np.ndarray, ids: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             words: int = LEARNER_WORDS) -> DataFrame:
    """``learner`` and word ids of all documents (staged): about ``words`` words a learner, in an order of its own.

    Which learner a document is dealt to and when it comes follows from the document, not from how the table is partitioned.
    Words are hashed and looked up here once, not in every round; ``sum`` (of their hashes) and ``size`` (bytes of the text) say how a
    round masks and cuts the documents.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    number = max(1, round(total / words))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("key", F.xxhash64("id", "text"))
    dealt = own.select(F.pmod(F.xxhash64("key"), F.lit(number)).alias("learner"), "key", "text")
    ordered = dealt.repartitionByRange(number, "learner").sortWithinPartitions("learner", "key").select("learner", "text")
    shared = docs.sparkSession.sparkContext.broadcast((known, ids))
    return stage(ordered.mapInArrow(_ids(shared), "learner long, size long, sum long, ids binary"), "learners")


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, rate: float = 0.1, id_col: str = "doc_id",
          words: int = LEARNER_WORDS) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, DataFrame]:
    """The model, from all documents: every word is counted and predicted in at least one round.

    That is the network, its vocabulary (hashes, ids), the sizes of the buckets, and the table of the words in buckets.

    Two rounds mask half of the words each; more go on with the other half in turn. Learners of ``words`` words each start a
    round from the same network; how many there are follows from the words of the corpus, so the model does not depend on
    the table's partitions and a learner learns no less on a larger cluster.
    """
    counts = count_words(docs, text_col)
    known, ids = vocabulary(counts)
    bucketed = bucketed_words(counts, known, ids)
    sizes = bucket_sizes(bucketed)
    dealt = learners(docs, counts, known, ids, id_col, text_col, words)
    net, context = fresh_net(), docs.sparkSession.sparkContext
    for r in range(rounds):
        shared = context.broadcast(net)
        changes = dealt.mapInArrow(_train(shared, r, rounds, rate), "name string, block int, learner long, weight double, change binary, met binary")
        mean = changes.groupBy("name", "block").applyInPandas(_average, "name string, block int, change binary").collect()   # the model's size
        for name, value in net.items():
            parts = sorted((m["block"], m["change"]) for m in mean if m["name"] == name)
            if parts:
                net[name] = value + np.concatenate([np.frombuffer(c, np.float32) for _, c in parts]).reshape(value.shape)
    return net, known, ids, sizes, bucketed


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, known, ids, sizes, common, logs = shared.value
        once = -np.log(sizes + 1.0)     # of a word that its bucket holds once, or of all that it does not hold
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                hashes, first = hashes_of(data, offsets)
                n = np.diff(first)
                total, rare, cuts = np.zeros(len(n)), np.zeros(0, np.int64), np.zeros(len(n) + 1, np.int32)
                if len(hashes):
                    own, doc = word_ids(hashes, known, ids), np.repeat(np.arange(len(n)), n)
                    chances = log_probabilities(net, contexts(own, first), own).astype(np.float64)
                    at = np.flatnonzero(own >= WORDS - BUCKETS)
                    found, place = find_hashes(hashes[at], common)
                    chances[at] += once[own[at] - (WORDS - BUCKETS)]
                    chances[at[found]] += logs[place[found]]
                    at = at[~found]
                    total = np.bincount(doc, weights=chances, minlength=len(n))
                    rare, cuts = hashes[at].view(np.int64), np.searchsorted(at, first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(n))), batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(total),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(rare))], ["row", "id", "n_words", "total", "rare"])
                row += len(n)
    return run


def score_documents(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words``, ``log_likelihood`` (sum over all words), ``mean_log_likelihood``.

    Words are in lower case (A-Z). A word in a bucket of N counted words has n / (N + 1) of the bucket's probability if it was
    counted n times, and all words never counted share 1 / (N + 1). A null text is empty: no words, sum 0, null mean.
    Null and repeated ids stay, a row each; an empty table gives an empty one; other columns are left out. Only words in
    buckets are shuffled; of these, the at most COMMON ones that have a COMMON-th of their occurrences each are broadcast with
    their counts instead.
    """
    short_batches(docs.sparkSession)
    net, known, ids, sizes, bucketed = model
    least = max(2, -(-int(sizes.sum()) // COMMON))
    often = bucketed.where(F.col("n") >= least).select("word", "n").toArrow()
    common, times = (often.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(common.view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast((net, known, ids, sizes, common.view(np.uint64)[order], np.log(times[order])))
    wanted = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    made = stage(wanted.mapInArrow(_score(shared), f"row long, id {wanted.schema['id'].dataType.simpleString()}, n_words long, total double, rare array<long>"),
                 "scored")
    again = bucketed.where((F.col("n") > 1) & (F.col("n") < least)).select("word", F.log("n").alias("more"))     # of a word counted once the logarithm is 0
    more = (made.select("row", F.explode("rare").alias("word")).join(again, "word")
                .groupBy("row").agg(F.sum("more").alias("more")))
    whole = made.select("row", "id", "n_words", "total").join(more, "row", "left").withColumn("log_likelihood", F.col("total") + F.coalesce("more", F.lit(0.0)))
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return whole.select(F.col("id").alias(id_col), "n_words", "log_likelihood", mean.alias("mean_log_likelihood"))
