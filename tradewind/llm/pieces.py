"""SentencePiece encoding that keeps the original byte span of every piece, and decoding.

The library's piece ids are projected to the original text in two steps: longest-prefix normalisation
through the model's compiled character map records, for each byte of the normalised text, the original
bytes it came from; and the pieces cover the normalised text without gaps, so their byte lengths give
their spans there.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import short_batches, worker_memo

_MARK = "▁".encode()           # stands for a space


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: number and value (whole number, or bytes)."""
    def whole(i):
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 128:
                return value, i
    i = 0
    while i < len(data):
        tag, i = whole(i)
        if tag & 7 == 0:
            value, i = whole(i)
        elif tag & 7 == 2:
            n, i = whole(i)
            value, i = data[i:i + n], i + n
        else:
            n = {1: 8, 5: 4}[tag & 7]
            value, i = data[i:i + n], i + n
        yield tag >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie from byte strings to places in a block of replacements."""

    def __init__(self, compiled: bytes):
        self.units, self.replacements = np.zeros(0, np.uint32), b""
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4)
            self.replacements = compiled[4 + size:]
        # bytes that start no entry can be passed over at once
        self.starts = np.zeros(256, bool)
        if len(self.units):
            for c in range(1, 256):
                self.starts[c] = self._step(self._base(0), c) is not None

    def _base(self, node: int) -> int:
        unit = int(self.units[node])
        return node ^ ((unit >> 10) << ((unit & (1 << 9)) >> 6))

    def _step(self, base: int, c: int) -> int | None:
        at = base ^ c
        return at if at < len(self.units) and int(self.units[at]) & ((1 << 31) | 0xFF) == c else None

    def longest(self, text: bytes, i: int) -> tuple[int, bytes] | None:
        """Length of the longest entry that the text has at ``i``, and its replacement."""
        found, base, j = None, self._base(0) if len(self.units) else 0, i
        while len(self.units) and j < len(text) and text[j]:
            node = self._step(base, text[j])
            if node is None:
                break
            j, base = j + 1, self._base(node)
            if int(self.units[node]) >> 8 & 1:
                at = int(self.units[base]) & ((1 << 31) - 1)
                found = j - i, self.replacements[at:self.replacements.index(b"\0", at)]
        return found


class Normaliser:
    """Longest-prefix normalisation as the model's settings say, with the source of every byte."""

    def __init__(self, model: bytes):
        spec, trainer = {}, {}
        self.pieces: list[tuple[bytes, int]] = []
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece.get(1, b""), piece.get(3, 1)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
        self.map = CharacterMap(spec.get(2, b""))
        self.dummy, self.squeeze, self.marks = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        self.owned = sorted({p for p, kind in self.pieces if kind == 4 and p}, key=len, reverse=True)     # user-defined: kept as they are

    def _units(self, text: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Replacement, start and end of each unit of the original text."""
        i = 0
        while i < len(text):
            own = next((p for p in self.owned if text.startswith(p, i)), None)
            hit = (len(own), own) if own else self.map.longest(text, i) if self.map.starts[text[i]] else None
            if hit is None:
                lead = text[i]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = n, text[i:i + n]
            yield hit[1], i, i + hit[0]
            i += hit[0]

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The normalised text; for each of its bytes, where the original bytes it stands for start and end."""
        if not len(self.map.units) and not self.owned and not self.squeeze and self.marks and not self.suffix:
            return self._identity(text)
        space = _MARK if self.marks else b" "
        units = list(self._units(text))
        if self.squeeze:
            while units and not units[0][0].strip(b" "):
                units.pop(0)
        out, starts, ends = [], [], []

        def put(data, a, b):
            out.append(data)
            starts.extend([a] * len(data))
            ends.extend([b] * len(data))

        if units and self.dummy and not self.suffix:
            put(space, units[0][1], units[0][1])
        blank = self.squeeze
        for data, a, b in units:
            if blank:
                data = data.lstrip(b" ")
            for c in (data.replace(b" ", space),) if data else ():
                put(c, a, b)
            if data:
                blank = self.squeeze and data.endswith(b" ")
        whole = b"".join(out)
        if self.squeeze:
            while whole.endswith(space):
                whole = whole[:-len(space)]
        if units and self.dummy and self.suffix:
            put(space, units[-1][2], units[-1][2])
            whole += space
        return whole, np.array(starts[:len(whole)], np.int64), np.array(ends[:len(whole)], np.int64)

    def _identity(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Without a character map, only spaces change: all bytes at once."""
        data = np.frombuffer(text, np.uint8)
        wide = np.where(data == 32, 3, 1)
        starts = np.repeat(np.arange(len(data)), wide)
        whole = text.replace(b" ", _MARK)
        if self.dummy and text:
            whole, starts = _MARK + whole, np.concatenate((np.zeros(3, np.int64), starts))
        ends = starts + 1
        if self.dummy and text:
            ends[:3] = 0
        return whole, starts, ends


def piece_lengths(normaliser: Normaliser) -> np.ndarray:
    """Bytes of the normalised text that each piece covers; 0 for the unknown piece, whose length its text decides."""
    return np.array([1 if kind == 6 else 0 if kind in (2, 3) else len(p) for p, kind in normaliser.pieces], np.int64)


def piece_spans(ids: np.ndarray, normaliser: Normaliser, lengths: np.ndarray, text: bytes, surfaces=None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each piece in the original bytes; ``surfaces``: the normalised bytes of each piece, needed where some are unknown."""
    whole, starts, ends = normaliser(text)
    sizes = lengths[ids] if surfaces is None else np.array([len(s) for s in surfaces], np.int64)
    cuts = np.cumsum(sizes)
    if len(ids) and cuts[-1] != len(whole):
        raise ValueError(f"pieces cover {cuts[-1]} of {len(whole)} normalised bytes")
    return (starts[cuts - sizes], ends[cuts - 1]) if len(ids) else (np.zeros(0, np.int64),) * 2


def load(model_path: str):
    import sentencepiece

    def make():
        with open(model_path, "rb") as f:
            model = f.read()
        normaliser = Normaliser(model)
        return sentencepiece.SentencePieceProcessor(model_proto=model), normaliser, piece_lengths(normaliser)
    return worker_memo(f"pieces {model_path}", make)


def encoded(text: str, model, normaliser: Normaliser, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
    """Piece ids, start and end of each in the text's bytes, and the decoded text."""
    listed = model.encode(text, num_threads=1)
    ids = np.array(listed, np.int64)
    surfaces = None
    if len(ids) and not lengths[ids].all():
        surfaces = [p.surface.encode() for p in model.encode_as_immutable_proto(normaliser(text.encode())[0].decode()).pieces]
        if sum(map(len, surfaces)) != len(normaliser(text.encode())[0]):
            surfaces = [p.encode() for p in model.encode_as_pieces(text)]
    starts, ends = piece_spans(ids, normaliser, lengths, text.encode(), surfaces)
    return ids, starts, ends, model.decode(listed)


def _encode(model_path: str, make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = load(model_path)
        for batch in batches:
            held, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                held.append((key, *make(text, *encoded(text, *tools))))
                size += len(text)
                if size > 1 << 22:
                    yield to_batch(held)
                    held, size = [], 0
            if held:
                yield to_batch(held)

    def to_batch(rows):
        return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)
    schema, names = make.schema, make.schema.names
    return run


class _Pieces:
    """Ids, spans and decoded text."""
    fields = "ids array<int>, starts array<long>, ends array<long>, decoded string"

    def __init__(self, key: pa.DataType):
        self.schema = pa.schema([("id", key), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())),
                                 ("ends", pa.list_(pa.int64())), ("decoded", pa.string())])

    def __call__(self, text, ids, starts, ends, decoded):
        return ids, starts, ends, decoded


class _Ids:
    """Ids, and whether decoding gives the text back."""
    fields = "ids array<int>, lossless boolean"

    def __init__(self, key: pa.DataType):
        self.schema = pa.schema([("id", key), ("ids", pa.list_(pa.int32())), ("lossless", pa.bool_())])

    def __call__(self, text, ids, starts, ends, decoded):
        return ids, decoded == text


class _Digest:
    """Lengths and digests of the ids, the spans and the decoded text."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, lossless boolean"

    def __init__(self, key: pa.DataType):
        self.schema = pa.schema([("id", key), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                                 ("spans_crc32", pa.int64()), ("lossless", pa.bool_())])

    def __call__(self, text, ids, starts, ends, decoded):
        import hashlib
        import zlib
        listed = ",".join(map(str, ids.tolist())).encode()
        return (len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
                zlib.crc32(np.stack((starts, ends)).astype("<u4").tobytes()), decoded == text)


def _run(docs: DataFrame, model_path: str, id_col: str, text_col: str, kind) -> DataFrame:
    short_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type
    key = wanted.schema["id"].dataType
    made = wanted.mapInArrow(_encode(model_path, kind(to_arrow_type(key))), f"id {key.simpleString()}, {kind.fields}")
    return made.withColumnRenamed("id", id_col)


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids``, ``starts``, ``ends`` (bytes of the original UTF-8 text, end exclusive), ``decoded``.

    Whole texts, no begin or end ids, no sampling. A mark put before the text has an empty span. A null text is
    empty: no pieces. Null and repeated ids stay as they are, one row each; an empty table gives an empty one; other
    columns are left out. Nothing is shuffled. ``model_path`` must exist on every executor.
    """
    return _run(docs, model_path, id_col, text_col, _Pieces)


def digest_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_pieces``, but digests made where the pieces are: ``n_tokens``, ``ids_sha256`` (decimal ids joined
    by commas), ``decoded_sha256``, ``spans_crc32`` (all starts, then all ends), ``lossless``."""
    return _run(docs, model_path, id_col, text_col, _Digest)


def encode_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_pieces``, with ``ids`` and ``lossless`` (whether they decode to the text) only."""
    return _run(docs, model_path, id_col, text_col, _Ids)
