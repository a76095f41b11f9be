"""Zip archives of monthly files, read member by member.

A first small job reads the directory of each archive and lists its members, those of archives inside it as well.
Then every member is a row of its own, and a task streams the members it was dealt: one archive with many members is
spread over many tasks, and no member is in memory whole. What cannot be read becomes a row with the reason, beside
the lines of all that can.
"""

from __future__ import annotations

import codecs
import io
import lzma
import struct
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.files import file_issue, normalise_file_name
from tradewind.sources.stage import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of the package

Opener = Callable[[str], BinaryIO]

_INDEX = "archive string, chain array<int>, member string, size long, error string"
_LINES = "archive string, source string, member string, pos long, line string, error string"
_MOST_TASKS = 10_000
_READ = 1 << 22            # bytes of a member read at once
_PIECE_LINES = 500_000
_CHUNK = 1 << 18           # bytes of a row of compressed ones


def _located(path: str):
    """The store and the path inside it."""
    from pyarrow import fs
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class _Places(io.RawIOBase):
    """A file read at any place. A place before its start, as damaged directories name, is damage and not a failure of the store."""

    def __init__(self, file):
        self.file, self.size, self.at = file, file.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + (0, self.at, self.size)[whence]
        if place < 0:
            raise zipfile.BadZipFile("place before the start of the file")
        self.at = place
        return place

    def readinto(self, buffer) -> int:
        found = self.file.read_at(max(0, min(len(buffer), self.size - self.at)), self.at)
        buffer[:len(found)] = found
        self.at += len(found)
        return len(found)

    def close(self) -> None:
        self.file.close()
        super().close()


def open_path(path: str) -> BinaryIO:
    """A file of any store that pyarrow knows, open for reading at any place."""
    store, inner = _located(path)
    return io.BufferedReader(_Places(store.open_input_file(inner)), 1 << 18)


def _index(opener: Opener):
    # What a damaged file raises; a store that fails raises something else, and the task is tried again.
    damage = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, RuntimeError)

    def entries(blob: BinaryIO, chain: list[int], names: str) -> Iterator[tuple]:
        with zipfile.ZipFile(blob) as archive:
            for i, info in enumerate(archive.infolist()):
                if info.is_dir():
                    continue
                if not info.filename.lower().endswith(".zip"):
                    yield [*chain, i], names + info.filename, info.file_size, None
                    continue
                try:
                    with archive.open(info) as inner:
                        yield from list(entries(inner, [*chain, i], names + info.filename + "/"))
                except damage as e:
                    yield [*chain, i], names + info.filename, info.file_size, f"{type(e).__name__}: {e}"

    def run(frames):
        import pandas as pd
        for frame in frames:
            out = []
            for path in frame["path"]:
                with opener(path) as blob:
                    try:
                        out += [(path, *x) for x in entries(blob, [], "")]
                    except damage as e:
                        out.append((path, [], None, None, f"{type(e).__name__}: {e}"))
            if out:
                yield pd.DataFrame(out, columns=["archive", "chain", "member", "size", "error"])
    return run


def archive_index(archives: DataFrame, opener: Opener = open_path) -> DataFrame:
    """``archive, chain, member, size, error``: one row per member, also of archives in archives, or per one that is damaged.

    ``archives`` has the ``path`` of each. ``chain`` leads to the member: its place in the archive, or the place of the archive
    it lies in and its place there. Reads the directories only, and the bytes of inner archives.
    """
    return archives.select("path").mapInPandas(_index(opener), _INDEX)


def _unpack(opener: Opener, encoding: str, batch: int):
    damage = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, RuntimeError, UnicodeDecodeError)

    def texts(blob: BinaryIO, chain: Sequence[int]) -> Iterator[str]:
        """The member in stretches of whole lines."""
        with zipfile.ZipFile(blob) as archive, archive.open(archive.infolist()[chain[0]]) as member:
            if len(chain) > 1:
                yield from texts(member, chain[1:])
                return
            decoder, held = codecs.getincrementaldecoder(encoding)(), []
            while data := member.read(_READ):
                text = decoder.decode(data)
                end = text.rfind("\n") + 1
                if end:
                    yield "".join(held) + text[:end]
                    held = []
                held.append(text[end:])
            yield "".join(held) + decoder.decode(b"", True)

    def frame_of(row, source: str, pos: int, lines: list, error: str | None):
        import pandas as pd
        import pyarrow as pa
        n = len(lines)
        same = {"archive": row.archive, "source": source, "member": row.member, "error": error}
        made = {k: pa.nulls(n, pa.string()) if v is None else pa.repeat(pa.scalar(v, pa.string()), n) for k, v in same.items()}
        made |= {"pos": pa.array(range(pos, pos + n), pa.int64()), "line": pa.array(lines, pa.string())}
        return pd.DataFrame({k: pd.arrays.ArrowExtensionArray(made[k]) for k in columns})

    columns = [x.split()[0] for x in _LINES.split(", ")]

    def run(frames):
        for frame in frames:
            for row in frame.itertuples():
                source, pos = f"{row.archive}!{'.'.join(map(str, row.chain))}", 0
                try:
                    with opener(row.archive) as blob:
                        for text in texts(blob, row.chain):
                            lines = text.split("\n")
                            if not lines[-1]:
                                lines.pop()
                            if "\r" in text:
                                lines = [x.rstrip("\r") for x in lines]
                            for a in range(0, len(lines), batch):
                                yield frame_of(row, source, pos + a, lines[a:a + batch], None)
                            pos += len(lines)
                except damage as e:
                    yield frame_of(row, source, -1, [None], f"{type(e).__name__}: {e}")
    return run


def read_members(archives: DataFrame, encoding: str = "latin-1", opener: Opener = open_path, batch: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """Lines of all members that can be read whole, and a row per member with what is wrong with the others (both staged).

    Lines: ``archive, source, file, issue, pos, line``; ``source`` is one member, ``file`` its normalised name. Members: ``archive, source,
    file, issue, size, error``. A member that fails half-way gives no lines. Members are dealt to as many tasks as
    there are members, ten thousand at most.
    """
    index = stage(archive_index(archives, opener), "members")
    fine = index.where("error IS NULL")
    tasks = max(1, min(_MOST_TASKS, fine.count()))
    dealt = fine.repartitionByRange(tasks, "archive", "chain")
    read = stage(dealt.mapInPandas(_unpack(opener, encoding, batch), _LINES), "unpacked")
    failed = stage(read.where("error IS NOT NULL").select(F.col("source").alias("_source"), F.col("error").alias("_error")), "failed")
    name = F.element_at(F.split(F.regexp_replace("member", r"\\", "/"), "/"), -1)
    members = stage(index.withColumn("source", F.concat_ws("!", "archive", F.array_join("chain", "."))).join(
        failed, F.col("source") == F.col("_source"), "left").select(
        "archive", "source", normalise_file_name(name).alias("file"), file_issue(name).alias("issue"), "size",
        F.coalesce("error", "_error").alias("error")), "members")
    # Names are made once a member: the table of whole members is small, and goes to every task by its known size.
    whole = stage(members.where("error IS NULL").select(F.col("source").alias("_source"), "file", "issue").dropDuplicates(["_source"]), "members")
    lines = read.select("archive", "source", "pos", "line").join(whole, F.col("source") == F.col("_source")).select(
        "archive", "source", "file", "issue", "pos", "line")
    return lines, members


def expand_archives(spark: SparkSession, paths: str | Sequence[str], batch: int = 50_000, encoding: str = "latin-1", opener: Opener = open_path) -> DataFrame:
    """Lines of every readable member of (nested) zip archives, see ``read_members``."""
    return read_members(spark.read.format("binaryFile").load(paths).select("path"), encoding, opener, batch)[0]


def _crc_product(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, lowest power in the highest bit."""
    product = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            product ^= b
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
    return product


def crc_joined(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings on end, from theirs and the size of the second."""
    shift, power = 1 << 31, 1 << 23     # 1, and x^8: a byte
    while size:
        if size & 1:
            shift = _crc_product(power, shift)
        power, size = _crc_product(power, power), size >> 1
    return _crc_product(shift, first) ^ second


class _Deflated:
    """Bytes deflated as a piece that others can follow, with the size and checksum that they have before."""

    def __init__(self):
        self.made, self.size, self.crc = zlib.compressobj(-1, zlib.DEFLATED, -zlib.MAX_WBITS), 0, 0

    def write(self, data) -> bytes:
        self.size, self.crc = self.size + len(data), zlib.crc32(data, self.crc)
        return self.made.compress(data)

    def end(self) -> bytes:
        return self.made.flush(zlib.Z_FULL_FLUSH)


class _Entry:
    """A member of an archive that is being written, from pieces deflated before."""

    def __init__(self, archive: zipfile.ZipFile, name: str):
        self.archive, self.info = archive, zipfile.ZipInfo(name)
        self.info.compress_type, self.info.flag_bits, self.info.external_attr = zipfile.ZIP_DEFLATED, 8, 0o600 << 16
        self.info.CRC, self.info.header_offset = 0, archive.fp.tell()
        archive.fp.write(self.info.FileHeader(zip64=True))

    def count(self, size: int, crc: int, packed: int) -> None:
        self.info.CRC = crc_joined(self.info.CRC, crc, size)
        self.info.file_size += size
        self.info.compress_size += packed

    def add(self, size: int, crc: int, data: bytes) -> None:
        self.count(size, crc, len(data))
        self.archive.fp.write(data)

    def write(self, data: bytes) -> None:
        """What an archive inside this one writes between its pieces."""
        piece = _Deflated()
        packed = piece.write(data) + piece.end()
        self.add(piece.size, piece.crc, packed)

    def tell(self) -> int:
        return self.info.file_size

    def flush(self) -> None:
        pass

    def close(self) -> None:
        self.add(0, 0, b"\x03\x00")     # the empty block that ends a deflated stream
        self.archive.fp.write(struct.pack("<LLQQ", 0x08074B50, self.info.CRC, self.info.compress_size, self.info.file_size))
        self.archive.filelist.append(self.info)
        self.archive.NameToInfo[self.info.filename] = self.info
        self.archive.start_dir = self.archive.fp.tell()


def _deflate(nested: bool):
    """Pieces of the files that a task has lines of, in rows of little more than ``_CHUNK`` bytes; rows come by archive, file and place."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        class Piece:
            def __init__(self, archive, file, pos):
                self.key, self.pos, self.chunk, self.held, self.waiting = (archive, file), pos, 0, [], 0
                self.text, self.packed = _Deflated(), _Deflated()

            def take(self, data) -> Iterator[pa.RecordBatch]:
                for a in range(0, len(data), _CHUNK):
                    self.keep(self.text.write(data[a:a + _CHUNK]))
                    if self.waiting >= _CHUNK:
                        yield self.row()

            def keep(self, data):
                data = self.packed.write(data) if nested else data
                self.held.append(data)
                self.waiting += len(data)

            def end(self) -> Iterator[pa.RecordBatch]:
                self.keep(self.text.end())
                if nested:
                    self.held.append(self.packed.end())
                yield self.row()

            def row(self) -> pa.RecordBatch:
                made = pa.RecordBatch.from_arrays([
                    pa.array([self.key[0]], pa.string()), pa.array([self.key[1]], pa.string()), self.pos, pa.array([self.chunk], pa.int32()),
                    *[pa.array([x], pa.int64()) for x in (self.text.size, self.text.crc, self.packed.size, self.packed.crc)],
                    pa.array([b"".join(self.held)], pa.binary())], ["archive", "file", "pos", "chunk", "size", "crc", "packed", "packed_crc", "data"])
                self.chunk, self.held, self.waiting = self.chunk + 1, [], 0
                for x in (self.text, self.packed):
                    x.size, x.crc = 0, 0
                return made

        piece = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if any(batch.column(i).null_count for i in (0, 1, 3)):
                raise ValueError("archive, file and line must not be null")
            names = [batch.column(i) for i in (0, 1)]
            other = [pc.not_equal(x.slice(1), x.slice(0, n - 1)) for x in names]
            starts = np.flatnonzero(pc.or_(*other).to_numpy(zero_copy_only=False)) + 1
            text = batch.column(3).cast(pa.large_string())
            _, ends, data = text.buffers()
            ends = np.frombuffer(ends, np.int64)[text.offset:text.offset + n + 1]
            for a, b in zip([0, *starts.tolist()], [*starts.tolist(), n]):
                key = names[0][a].as_py(), names[1][a].as_py()
                if piece is None or piece.key != key:
                    if piece is not None:
                        yield from piece.end()
                    piece = Piece(*key, batch.column(2).slice(a, 1))
                yield from piece.take(memoryview(data)[ends[a]:ends[b]])
        if piece is not None:
            yield from piece.end()
    return run


def _assemble(folder: str, nested: bool):
    """Archives from their pieces, a stream each; rows come by archive, file, place and chunk."""
    def run(batches):
        import pyarrow as pa
        store, top = _located(folder)
        out, archive, entry, inner, inside, now = None, None, None, None, None, (None, None)

        def end_file():
            if inside is not None:
                inside.close()
                inner.close()
            if entry is not None:
                entry.close()

        def end_archive():
            if archive is not None:
                archive.close()
                out.close()

        paths = []
        for batch in batches:
            for i in range(batch.num_rows):
                name, file, _, _, size, crc, packed, packed_crc, data = [c[i].as_py() for c in batch.columns]
                if (name, file) != now:
                    end_file()
                    entry = inner = inside = None
                    if name != now[0]:
                        end_archive()
                        store.create_dir(top, recursive=True)
                        out = store.open_output_stream(f"{top}/{name}")
                        archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                        paths.append(f"{folder}/{name}")
                    now = (name, file)
                    entry = _Entry(archive, file.rsplit(".", 1)[0] + ".zip" if nested else file)
                    if nested:
                        inner = zipfile.ZipFile(entry, "w", zipfile.ZIP_DEFLATED)
                        inside = _Entry(inner, file)
                if nested:
                    inside.count(size, crc, packed)
                    entry.add(packed, packed_crc, data)
                else:
                    entry.add(size, crc, data)
        end_file()
        end_archive()
        if paths:
            yield pa.RecordBatch.from_pydict({"path": paths})
    return run


def write_archives(lines: DataFrame, folder: str, nested: bool = False, piece_lines: int = _PIECE_LINES) -> DataFrame:
    """Writes ``archive, file, pos, line`` as zip archives of text files into ``folder``; returns the ``path`` of each (staged).

    With ``nested`` every file is an archive of its own in the archive, without its ``.txt``. Lines are dealt by ranges of
    archive, file and place, about ``piece_lines`` to a task, which deflates its part of each file, for a nested one twice; one
    task an archive then only strings the pieces together, as a stream. A task that is run again writes the same file again.
    ``lines`` is read three times (counted, sampled, dealt), so stage what is costly to make.
    """
    wanted = lines.select("archive", "file", "pos", F.concat("line", F.lit("\n")).alias("line"))
    tasks = max(1, min(_MOST_TASKS, -(-lines.count() // piece_lines)))
    keys, pos = ("archive", "file", "pos"), wanted.schema["pos"].dataType.simpleString()
    dealt = wanted.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    pieces = stage(dealt.mapInArrow(_deflate(nested), f"archive string, file string, pos {pos}, chunk int, size long, crc long, "
                                                      "packed long, packed_crc long, data binary"), "pieces")
    ordered = pieces.repartition("archive").sortWithinPartitions(*keys, "chunk")
    return stage(ordered.mapInArrow(_assemble(folder, nested), "path string"), "archives")
