"""Phrase collocations by stripes.

Each word keys a stripe: a counter of what follows it, the next word and the one after (each may be the end of the
piece). One stripe holds all that is needed of the phrases its word begins: its sum is the word's frequency, the sum
over equal next words that of a pair, its entries are the triples, and the largest entry of a next word tells whether a longer
phrase explains the pair. Tasks add up their own stripes first. Stripes of one bucket travel together and are merged
element by element. A word that fills a noticeable part of the corpus has its stripe cut into segments by its
next word (a pair that does, by the word after as well), and partial sums are added up afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import lowered, mixed, short_batches, span_hashes, text_chunks, text_of
from tradewind.operators.ordering import global_rank
from tradewind.sources.stage import stage

_FLUSH = 3 << 18            # words that a task holds before it hands its stripes on
_MERGE = 1 << 20            # entries that are held before they are merged
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2

#: Words, and for each entry the places of its three words and its count.
Stripes = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _words(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Lower-cased words, the row of each, and whether it begins a piece."""
    for first, _, data, offsets in text_chunks(texts, 4 << 20):
        kind = _KIND[data]
        inside = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.concatenate(([False], inside)), np.concatenate((inside, [False]))
        starts, ends = np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))
        if not len(starts):
            continue
        row = np.searchsorted(offsets, starts, "right") - 1
        cuts = np.concatenate(([0], np.cumsum(kind == 2)))[starts]
        fresh = np.concatenate(([True], (np.diff(cuts) > 0) | (np.diff(row) > 0)))
        body = lowered(data)[inside]
        places = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        yield pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(body)), first + row, fresh


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """For each language in turn: words of some texts, and whether each begins a piece."""
    held: dict[str, list] = {}

    def flush():
        for lang, parts in held.items():
            yield lang, pa.concat_arrays([w for w, _ in parts]), np.concatenate([f for _, f in parts])
        held.clear()

    n = 0
    for batch in batches:
        codes = batch.column(0).cast(pa.string()).fill_null("und").dictionary_encode()
        names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy()
        for words, row, fresh in _words(batch.column(1)):
            of = code[row]
            for i in np.unique(of):
                own = np.flatnonzero(of == i)
                held.setdefault(names[i], []).append((words if len(own) == len(of) else words.take(pa.array(own)), fresh[own]))
            n += len(of)
            if n >= _FLUSH:
                yield from flush()
                n = 0
    yield from flush()


def _after(values: np.ndarray, fresh: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The value of the next word and of the one after, within the piece."""
    ends = np.concatenate((fresh[1:], [True]))
    one = np.where(ends, none, np.concatenate((values[1:], [none])))
    two = np.where(ends | np.concatenate((ends[1:], [True])), none, np.concatenate((values[2:], [none, none]))[:len(values)])
    return one, two


def _hashes(words: pa.Array) -> np.ndarray:
    words = words.cast(pa.large_string())
    _, ends, data = words.buffers()
    places = np.frombuffer(ends, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out, row = np.zeros(len(words), np.uint64), 0
    while row < len(words):         # a megabyte at a time, as the running sums take many times its room
        end = max(row + 1, int(np.searchsorted(places, places[row] + (1 << 20), "right")) - 1)
        cut = places[row:end + 1]
        out[row:end] = span_hashes(data[cut[0]:cut[-1]], cut[:-1] - cut[0], cut[1:] - cut[0])
        row = end
    return out


def _first_key(lang: str, h: np.ndarray) -> np.ndarray:
    return mixed(h ^ _hashes(pa.array([lang + " "]))[0])


def _pair_key(first: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mixed(first + h * np.uint64(3))


def _heavy(share: float):
    """Keys that fill a share of the words a task holds, and the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys, times = 0, [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for lang, words, fresh in _by_lang(batches):
            first = _first_key(lang, (h := _hashes(words)))
            for key in (first, _pair_key(first, _after(h, fresh, np.uint64(0))[0])):
                found, n = np.unique(key, return_counts=True)
                much = n >= max(2, share * len(words))
                keys.append(found[much])
                times.append(n[much])
            total += len(words)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(([np.zeros(1, np.uint64), *keys])).view(np.int64)), pa.array(np.concatenate(([total], *times)).astype(np.int64)),
            pa.array([True] + [False] * sum(map(len, keys)))], names=["key", "n", "total"])
    return run


def merged(parts: list[Stripes]) -> Stripes:
    """Stripes added up element by element, ordered by the places of their words."""
    words = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    place, base = words.indices.to_numpy().astype(np.int64), np.cumsum([0] + [len(p[0]) for p in parts])
    a, b, c = (np.concatenate([place[p[i] + base[k]] for k, p in enumerate(parts)]) for i in (1, 2, 3))
    n, size = np.concatenate([p[4] for p in parts]), len(words.dictionary)
    pairs, at = np.unique(a * size + b, return_inverse=True)
    key = at * size + c
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    pair = pairs[key[starts] // size]
    return words.dictionary, pair // size, pair % size, key[starts] % size, np.add.reduceat(n[order], starts)


class _Dealer:
    """The bucket of each entry; stripes of hot words and pairs have several."""

    def __init__(self, buckets: int, hot: dict[int, int]):
        self.buckets = np.uint64(buckets)
        self.keys = np.array(sorted(hot), np.int64).view(np.uint64)
        self.keys.sort()
        self.segments = np.array([hot[int(k)] for k in self.keys.view(np.int64)], np.uint64)

    def of(self, key: np.ndarray) -> np.ndarray:
        """Segments of each key, 1 unless it is hot."""
        if not len(self.keys):
            return np.ones(len(key), np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.segments[at], np.uint64(1))

    def deal(self, lang: str, stripes: Stripes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of each entry, and whether its word and its pair are hot."""
        words, a, b, c, _ = stripes
        h = _hashes(words)
        first = _first_key(lang, h)[a]
        split, apart = self.of(first), self.of(_pair_key(first, h[b]))
        segment = mixed(h[b] + np.where(apart > 1, mixed(h[c]), np.uint64(0))) % np.maximum(split, apart)
        return (first + segment) % self.buckets, split > 1, apart > 1


def _stripes(dealer: _Dealer):
    """Stripes of a task's texts, one row a language and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, fresh in _by_lang(batches):
            coded = words.dictionary_encode()
            own = coded.indices.to_numpy().astype(np.int64) + 1
            names = pa.concat_arrays([pa.array([""], pa.large_string()), coded.dictionary])
            stripes = merged([(names, own, *_after(own, fresh, 0), np.ones(len(own), np.int64))])
            bucket = dealer.deal(lang, stripes)[0].astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            names, a, b, c, n = stripes[0].cast(pa.string()), *(x[order] for x in stripes[1:])
            bucket = bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(bucket) > 0, [True])))
            head = np.flatnonzero(np.concatenate(([True], (np.diff(bucket) > 0) | (np.diff(a) != 0))))
            stops = np.searchsorted(head, cuts)

            def joined(ends, places):
                return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names.take(pa.array(places))), " ")

            def numbers(ends, values):
                return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))

            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(cuts) - 1), pa.string()), pa.array(bucket[cuts[:-1]]), joined(stops, a[head]),
                numbers(stops, np.diff(np.append(head, len(a)))), joined(cuts, b), joined(cuts, c), numbers(cuts, n)], names=_NAMES)
    return run


_NAMES = ["lang", "bucket", "w1", "sizes", "w2", "w3", "n"]
_ROWS = "lang string, bucket long, w1 string, sizes array<int>, w2 string, w3 string, n array<int>"
_GRAMS = "lang string, words int, w1 string, w2 string, w3 string, f long, most long"


def _read(batch: pa.RecordBatch, i: int) -> Stripes:
    def split(name):
        return pc.split_pattern(batch.column(name).slice(i, 1).cast(pa.large_string()), " ").flatten()

    def numbers(name):
        return batch.column(name).slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    w1, w2, w3, sizes = split("w1"), split("w2"), split("w3"), numbers("sizes")
    return (pa.concat_arrays([w1, w2, w3]), np.repeat(np.arange(len(w1)), sizes), len(w1) + np.arange(len(w2)),
            len(w1) + len(w2) + np.arange(len(w3)), numbers("n"))


def _merge(dealer: _Dealer, least: int):
    """Frequencies of words, pairs and triples from whole stripes; of hot ones, parts that are still to be added up."""
    def grams(lang: str, stripes: Stripes) -> pa.RecordBatch:
        words, a, b, c, n = stripes
        blank = pc.equal(words, "").to_numpy(zero_copy_only=False)
        _, hot, apart = dealer.deal(lang, stripes)
        one = np.flatnonzero(np.concatenate(([True], np.diff(a) != 0)))
        two = np.flatnonzero(np.concatenate(([True], (np.diff(a) != 0) | (np.diff(b) != 0))))
        f1, f2 = np.add.reduceat(n, one), np.add.reduceat(n, two)
        most = np.maximum.reduceat(np.where(blank[c] | (n < least), 0, n), two)
        keep1, keep2 = (f1 >= least) | hot[one], ~blank[b[two]] & ((f2 >= least) | apart[two])
        keep3 = np.flatnonzero(~blank[c] & (n >= least))
        one, two = one[keep1], two[keep2]
        length = np.concatenate(([0], np.full(len(one), 1), np.full(len(two), 2), np.full(len(keep3), 3)))

        def names(places: np.ndarray, from_length: int) -> pa.Array:
            return words.take(pa.array(np.where(length >= from_length, places, 0), mask=length < from_length)).cast(pa.string())

        at = np.concatenate(([0], one, two, keep3))
        none = np.zeros(1 + len(one), np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([lang] * len(at), pa.string()), pa.array(length.astype(np.int32)), names(a[at], 1), names(b[at], 2), names(c[at], 3),
            pa.array(np.concatenate(([n.sum()], f1[keep1], f2[keep2], n[keep3]))),
            pa.array(np.concatenate((none, most[keep2], np.zeros(len(keep3), np.int64))))], names=[x.split()[0] for x in _GRAMS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in batches:
            langs, buckets = batch.column("lang").to_pylist(), batch.column("bucket").to_pylist()
            for i, now in enumerate(zip(langs, buckets)):
                if now != key and held:
                    yield grams(key[0], merged(held))
                    held, size = [], 0
                key = now
                held.append(_read(batch, i))
                size += len(held[-1][4])
                if size >= _MERGE:
                    held = [merged(held)]
                    size = len(held[0][4]) // 2     # what is merged may stay; the next merge comes after as much again
        if held:
            yield grams(key[0], merged(held))
    return run


def gram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, bucket_words: int = 1 << 19, share: float = 1 / 8192) -> DataFrame:
    """Frequency ``f`` of every word, pair and triple of words that occurs ``least`` times: ``lang``, ``words``, ``w1``, ``w2``, ``w3``, ``f``, ``most`` (staged).

    ``most`` is the largest frequency of a triple that begins with the pair. A row with ``words = 0`` has the number of
    all words of a language. Keys that fill ``share`` of all words are found in a first pass over all texts; the
    driver gets their hashes, 2 / ``share`` at most. Nothing but rare phrases is left out, and those only once their count is whole.
    """
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    seen = stage(texts.mapInArrow(_heavy(share), "key long, n long, total boolean"), "heavy")
    total = seen.where("total").agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_words))
    hot = {r["key"]: math.ceil(4 * r["n"] * buckets / total) for r in seen.where("NOT total").groupBy("key").agg(F.sum("n").alias("n")).where(
        F.col("n") >= share * total).collect()} if total else {}
    dealer = _Dealer(buckets, {k: s for k, s in hot.items() if s > 1})
    dealt = texts.mapInArrow(_stripes(dealer), _ROWS).repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    parts = dealt.mapInArrow(_merge(dealer, least), _GRAMS)
    whole = parts.groupBy("lang", "words", "w1", "w2", "w3").agg(F.sum("f").alias("f"), F.max("most").alias("most"))
    return stage(whole.where(F.col("words").isin(0) | (F.col("f") >= least)), "grams")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    big = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", big(a) * big(a) * F.lit(1_000_000).cast("decimal(7,0)"), big(left) * big(right))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """The best phrases of two or three words of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and those into words at spaces and tabs. A null language is
    ``und``, a null text empty. A phrase that occurs ``a >= least`` times scores by its weakest cut, floor(10^6 a^2 / (l r)) of the frequencies of its
    two sides, ties to the first cut. Pairs of which ``percent`` % of occurrences or more lie in one triple are left out. Ties of
    the score go to the larger ``a``, then the smaller phrase. Rows that repeat count each; other columns are left out; an
    empty table gives an empty one.
    """
    grams = gram_counts(docs, lang_col, text_col, least)
    of = lambda k: grams.where(F.col("words") == k)

    def side(k: int, name: str, *keys: str) -> DataFrame:
        return of(k).select(F.col("lang").alias("lang"), *[F.col(f"w{i + 1}").alias(w) for i, w in enumerate(keys)], F.col("f").alias(name))

    left = of(3).groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("f").alias("_most"))
    pairs = (of(2).join(left, ["lang", "w1", "w2"], "left")
             .where(100 * F.greatest(F.col("most"), F.coalesce("_most", F.lit(0))) < percent * F.col("f"))
             .join(side(1, "l", "w1"), ["lang", "w1"]).join(side(1, "r", "w2"), ["lang", "w2"])
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), "l", "r", _score(F.col("f"), F.col("l"), F.col("r")).alias("score")))
    triples = (of(3).join(side(2, "l2", "w1", "w2"), ["lang", "w1", "w2"]).join(side(2, "r1", "w2", "w3"), ["lang", "w2", "w3"])
               .join(side(1, "l1", "w1"), ["lang", "w1"]).join(side(1, "r2", "w3"), ["lang", "w3"])
               .withColumns({"s1": _score(F.col("f"), F.col("l1"), F.col("r1")), "s2": _score(F.col("f"), F.col("l2"), F.col("r2"))}))
    first = F.col("s1") <= F.col("s2")
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                             F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    # ranked over sorted ranges, so a language with most of the phrases is spread over tasks
    best_first = ["lang", F.col("score").desc(), F.col("a").desc()]
    placed = global_rank(pairs.unionByName(triples), [*best_first, "phrase"], "at", by=[*best_first, F.substring("phrase", 1, 100)])
    firsts = placed.groupBy("lang").agg(F.min("at").alias("_first")).join(side(0, "n"), "lang")
    firsts = stage(firsts.withColumnRenamed("lang", "_lang"), "languages")      # a row each, of known size
    ranked = placed.join(firsts, F.col("lang") == F.col("_lang")).withColumn("rank", F.col("at") - F.col("_first") + 1)
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
