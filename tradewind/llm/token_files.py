"""Token ids in ORC files: run-length encoded integers, row indexes, and Bloom filters on document ids.

Files are cut at stripes, so readers work stripe by stripe, and statistics and Bloom filters let a look-up
of some documents skip stripes and row groups without reading their ids.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import mixed, short_batches, span_hashes, worker_memo
from tradewind.sources.stage import shared_folder, stage

_KNOWN = 1_000_000      # words after which a worker starts a new memo; it keeps the one before it, too
_PIECES = 100_000       # the same for pieces that are not words
_PLACE = re.compile(r"(?= \S)")
_RUN = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|\z)"    # a space that white space or the end follows
_LONG = 64              # characters from which a piece is not remembered
_CHUNK = 8 << 20        # bytes of text encoded at once


def _tokenizer(path: str):
    def make():
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True       # pieces hold none, see encode_batch
        size = made.get_vocab_size()
        # a byte is one character in the vocabulary's spelling; special tokens do not occur
        return made, np.array([len(made.id_to_token(i) or "") for i in range(size)], np.int64)
    return worker_memo(f"tokenizer {path}", make)


def _learn(tokenizer, lengths: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words with a space before each, and how many each has: 256 words are one text, told apart by their bytes."""
    texts = [" " + " ".join(words[i:i + 256]) for i in range(0, len(words), 256)]
    ids = np.fromiter(chain.from_iterable(e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)), "<i4")
    sizes = [1 + (len(p) if p.isascii() else len(p.encode())) for p in words]
    ends = np.searchsorted(np.cumsum(lengths[ids]), np.cumsum(sizes)) + 1
    return ids, np.diff(np.concatenate(([0], ends)))


class _Known:
    """Ids of words, found by 128 bits that are made of a word's bytes."""

    def __init__(self):
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), at, -1)

    def append(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keeps ids, and returns where those of each word begin."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(len(self.flat), np.int32)))
        self.flat[self.used:self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        return starts

    def remember(self, keys: np.ndarray, checks: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        keys, first = np.unique(keys, return_index=True)
        at = np.searchsorted(self.keys, keys)
        fresh = at == np.searchsorted(self.keys, keys, "right")      # of two words with one key the first is remembered
        at, first = at[fresh], first[fresh]
        self.keys, self.checks = np.insert(self.keys, at, keys[fresh]), np.insert(self.checks, at, checks[first])
        self.starts, self.sizes = np.insert(self.starts, at, starts[first]), np.insert(self.sizes, at, sizes[first])


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``flat``, one after the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def _numbers(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each word, and its bytes: a hash of all bytes, and one of the first and last eight."""
    words = words.cast(pa.large_string())
    _, ends, data = words.buffers()
    places = np.frombuffer(ends, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None else np.zeros(0, np.uint8)
    starts, stops = places[:-1] - places[0], places[1:] - places[0]
    size, padded = stops - starts, np.concatenate((data, np.zeros(8, np.uint8)))
    head, tail = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    for k in range(8):
        inside = size > k
        head |= np.where(inside, padded[np.minimum(starts + k, len(data))], 0).astype(np.uint64) << np.uint64(8 * k)
        tail |= np.where(inside, padded[np.maximum(stops - 1 - k, 0)], 0).astype(np.uint64) << np.uint64(8 * k)
    return span_hashes(data, starts, stops), mixed(head + mixed(tail + size.astype(np.uint64))), size


def _word_ids(parts: list[_Known], words: pa.Array, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after the other, and how many each has. Long words are not remembered.

    Words that are met again move from the old part to the young one, so frequent ones stay.
    """
    if len(parts[0].keys) > _KNOWN or parts[0].used > 8 * _KNOWN:
        parts[:] = _Known(), parts[0]
    young, old = parts
    keys, checks, size = _numbers(words)
    place = young.find(keys, checks)
    known = place >= 0
    starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    starts[known], sizes[known] = young.starts[place[known]], young.sizes[place[known]]
    rest = np.flatnonzero(~known)
    place = old.find(keys[rest], checks[rest])
    again, new = rest[place >= 0], rest[place < 0]
    place = place[place >= 0]
    sizes[again] = old.sizes[place]
    starts[again] = young.append(_gathered(old.flat, old.starts[place], sizes[again]), sizes[again])
    if len(new):
        ids, sizes[new] = learn(words.take(pa.array(new)).to_pylist())
        starts[new] = young.append(ids, sizes[new])
    kept = np.concatenate((again, new[size[new] < _LONG]))
    young.remember(keys[kept], checks[kept], starts[kept], sizes[kept])
    return _gathered(young.flat, starts, sizes), sizes


def _recall(memos: list[dict[str, bytes]], pieces: list[str], learn: Callable[[list[str]], Iterable[bytes]]) -> list[bytes]:
    """The ids of each piece; ``learn`` gives those of new ones. Long pieces are not remembered.

    Pieces move from the old memo to the young one when they are met again, so frequent ones stay.
    """
    if len(memos[0]) > _PIECES:
        memos[:] = {}, memos[0]
    young, old = memos
    missing = [p for p in pieces if p not in young]
    young.update([(p, old[p]) for p in missing if p in old])
    new = list({p for p in missing if p not in young})
    if new:
        young.update(zip(new, learn(new)))
    out = list(map(young.__getitem__, pieces))
    for p in new:
        if len(p) >= _LONG:
            del young[p]
    return out


def encode_batch(texts: pa.Array, path: str, end_id: int | None = None) -> pa.ListArray:
    """The ids of each text as the library gives them for it, then ``end_id``: each different piece of text is encoded once a worker.

    Texts (no nulls) are cut at the spaces that something other than white space follows. The byte-level pattern starts
    a token at every such space, and what follows a piece does not change the tokens in it. Where each space of a text is such a
    place, Arrow cuts it and numbers its different words; other texts are cut by the pattern. A text that holds the string of a
    special token is given to the library whole, which makes that token of it.
    """
    tokenizer, lengths = _tokenizer(path)
    special = [pc.match_substring(texts, t.content) for t in tokenizer.get_added_tokens_decoder().values() if t.content]
    whole = np.flatnonzero(reduce(np.logical_or, [m.to_numpy(zero_copy_only=False) for m in special], np.zeros(len(texts), bool)))
    if len(whole):
        tokenizer.encode_special_tokens = False
        of_whole = [np.array(e.ids, "<i4").tobytes() for e in tokenizer.encode_batch_fast(texts.take(pa.array(whole)).to_pylist(), add_special_tokens=False)]
        tokenizer.encode_special_tokens = True
        hidden = np.zeros(len(texts), bool)
        hidden[whole] = True
        texts = pc.if_else(pa.array(hidden), "", texts)
    plain, spaced = worker_memo(f"known {path}", lambda: ([{}, {}], [_Known(), _Known()]))

    def learn_plain(new: list[str]) -> Iterable[bytes]:
        return (np.array(e.ids, "<i4").tobytes() for e in tokenizer.encode_batch_fast(new, add_special_tokens=False))

    odd = pc.match_substring_regex(texts, _RUN)
    cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
    offsets = cut.offsets.to_numpy()
    coded = cut.values.dictionary_encode()
    words = coded.dictionary
    flat, sizes = _word_ids(spaced, words, lambda new: _learn(tokenizer, lengths, new))

    heads = cut.values.take(pa.array(offsets[:-1])).to_pylist()         # what comes before a text's first space
    pieces = [_PLACE.split(t) if rare else [h] for h, t, rare in zip(
        heads, pc.if_else(odd, texts, "").to_pylist(), odd.to_pylist())]
    first = iter(_recall(plain, list(chain.from_iterable(pieces)), learn_plain))
    ids = [b"".join(islice(first, len(p))) for p in pieces]
    for row, own in zip(whole, of_whole if len(whole) else ()):
        ids[row] = own
    ids.append(b"" if end_id is None else np.int32(end_id).tobytes())

    codes = coded.indices.to_numpy().copy()
    codes[offsets[:-1]] = len(words) + np.arange(len(texts))
    codes = np.insert(codes, offsets[1:], len(words) + len(texts))
    sizes = np.concatenate((sizes, np.fromiter(map(len, ids), np.int64, len(ids)) // 4))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    table = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate((flat, np.frombuffer(b"".join(ids), "<i4")))))
    ends = np.concatenate(([0], np.cumsum(sizes[codes])))[offsets + np.arange(len(offsets))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(pa.array(codes)).values)


def _write(path: str, end_id: int):
    """Sorted batches of (id, text) to id, part, ids before this row in its part, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            row = 0
            while row < len(texts):
                before = int(ends[row - 1]) if row else 0
                stop = max(row + 1, int(np.searchsorted(ends, before + _CHUNK, "right")))
                each = encode_batch(texts.slice(row, stop - row), path, end_id)
                offsets = each.offsets.to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, stop - row), pa.array(np.full(stop - row, part, np.int32)),
                    pa.array(at + offsets[:-1]), each], ["id", "part", "before", "ids"])
                at += int(offsets[-1])
                row = stop
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``id_col``, ``part``, ``before`` and ``ids`` of every document in ascending order of id.

    Rows with equal id are ordered by text, null ids come first; a null text is empty and has the end id only. Each
    file is one range of ids, its number and the place of a row's ids in it are stored with the row. An empty
    table gives files without rows.
    """
    short_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = wanted.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    kind = wanted.schema["id"].dataType.simpleString()
    made = ordered.mapInArrow(_write(tokenizer_path, end_id), f"id {kind}, part int, before long, ids array<int>")
    (made.withColumnRenamed("id", id_col).write.option("compression", "snappy").option("orc.stripe.size", 16 << 20)
         .option("orc.row.index.stride", 10_000).option("orc.bloom.filter.columns", id_col)
         .option("orc.bloom.filter.fpp", 0.01).option("orc.dictionary.key.threshold", 0).orc(folder))


def read_tokens(spark: SparkSession, folder: str, schema: str = "doc_id long, part int, before long, ids array<int>") -> DataFrame:
    """The rows of the files; a filter on the document id skips stripes by their statistics and Bloom filters."""
    return spark.read.schema(schema).orc(folder)


def file_starts(rows: DataFrame) -> DataFrame:
    """``_part`` and ``_base``, the number of ids in the files before, from ``part``, ``before`` and ``n_tokens``."""
    sizes = rows.groupBy(F.col("part").alias("_part")).agg(F.max(F.col("before") + F.col("n_tokens")).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)       # one row a file
    return sizes.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")


def _checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        flat = np.ascontiguousarray(flat, "<u4")
        yield pa.RecordBatch.from_arrays([
            *[batch.column(i) for i in range(3)], pa.array(np.diff(offsets).astype(np.int64)),
            pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])], pa.int64())],
            ["id", "part", "before", "n_tokens", "ids_crc32"])


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files to the shared folder and reads back, for each document: id, ``start``, ``n_tokens``, ``ids_crc32``."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tradewind/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, tokenizer_path, end_id, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = read_tokens(spark, folder, f"`{id_col}` {kind}, part int, before long, ids array<int>")
    summed = stage(rows.select(F.col(id_col).alias("id"), "part", "before", "ids").mapInArrow(
        _checksum, f"id {kind}, part int, before long, n_tokens long, ids_crc32 long"), "read-back")
    out = summed.join(file_starts(summed), F.col("part") == F.col("_part"))
    return out.select(F.col("id").alias(id_col), (F.col("_base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
