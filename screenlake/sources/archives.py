"""Archives as ranges of files: the members of an archive are indexed first, then read where they lie.

An entry is an archive or a file in one: a range of a file that tasks open themselves, or its bytes where
the store can only be read by Spark. Ranges are cheap to send around, and no archive is too large for them.
"""

from __future__ import annotations

import bz2
import fnmatch
import functools
import gzip
import io
import itertools
import os
import posixpath
import re
import shutil
import tarfile
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Decompressed archives up to this size stay in memory, larger ones in a file of the task.
SPOOL = 64 << 20
# An archive ends with two empty blocks.
END = bytes(2 * tarfile.BLOCKSIZE)
# Rows leave a task in Arrow batches of so many rows or bytes, and are taken from one so many at a time.
BATCH_ROWS, BATCH_BYTES, SLICE_ROWS = 10_000, 4 << 20, 256
# Text and tar headers are small at any level; the higher ones only cost time.
GZIP_LEVEL = 4
# Members are compressed when so many bytes of them are there.
PACK_BYTES = 256 << 10
# The header of a file with nothing but zeros and blanks in the fields that differ, and the sum of its bytes.
_HEADER = tarfile.TarInfo("").tobuf(tarfile.GNU_FORMAT)
_HEADER_SUM = sum(_HEADER) - sum(_HEADER[124:136]) - sum(_HEADER[148:156]) + 8 * ord(" ")
# Behind its name: a regular file with octal numbers of full length and no prefix of the name.
_PLAIN = re.compile(rb"(?s)(?:[0-7]{7}[\0 ]){3}([0-7]{11})[\0 ][0-7]{11}[\0 ]([0-7]{6})\0 0.{172}(?:[0-7]{7}[\0 ]|\0{8}){2}\0")
# Folders are split up among tasks when there are so many of them.
FOLDERS = 1000
LISTED = "path STRING, size LONG"
ENTRY = "path STRING, content BINARY, file STRING, offset LONG, size LONG, error STRING"


class Entry(NamedTuple):
    path: str
    content: bytes | None = None
    file: str | None = None
    offset: int = 0
    size: int = 0
    error: str | None = None


class BadArchive(Exception):
    """An archive that cannot be read to its end."""


class Member(NamedTuple):
    name: str
    offset: int
    size: int


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Spark writes it, and the path there."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def qualified(spark: SparkSession, root: str) -> str:
    """The path with its store, as tasks need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def can_seek(spark: SparkSession, root: str) -> bool:
    """Whether files below `root` can be opened without Spark; others are read whole, by Spark."""
    try:
        file_system(qualified(spark, root))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def partitions_for(spark: SparkSession) -> int:
    """A number of partitions to be given: small shuffles are not put together, as the work is in the tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark leaves out, and those that are no text."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    if name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"):
        return True
    return not name.isascii() and any("\ud800" <= c <= "\udfff" for c in name)


def _children(folder: str, folders: bool) -> Iterator[tuple[str, int | None]]:
    """Paths and sizes of the files in a folder, or those of its folders without a size; one that is gone has none."""
    store, where = file_system(folder)
    if isinstance(store, fs.LocalFileSystem):
        try:
            with os.scandir(where) as found:
                for entry in found:
                    if _hidden(entry.name, folders) or entry.is_dir() != folders:
                        continue
                    try:
                        yield f"{folder}/{entry.name}", None if folders else entry.stat().st_size
                    except FileNotFoundError:
                        continue
        except FileNotFoundError:
            return
    else:
        for info in store.get_file_info(fs.FileSelector(where, allow_not_found=True)):
            if not _hidden(info.base_name, folders) and (info.type == fs.FileType.Directory) == folders:
                yield f"{folder}/{info.base_name}", None if folders else info.size


def _walk(folder: str, deep: bool) -> Iterator[tuple[str, int]]:
    yield from _children(folder, False)
    if deep:
        for inner, _ in _children(folder, True):
            yield from _walk(inner, True)


def listed(spark: SparkSession, root: str, glob: str) -> DataFrame | None:
    """(path, size) of the files below `root` whose name fits, those that Spark's readers would find.

    Tasks list the folders, so the driver sees no more than the names of some folders, however many files there are. It goes
    down until there are enough folders to be split up. None where Spark has to list them, or where nothing is.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) if can_seek(spark, root) else None
    if not found:
        return None
    at = [(status.getPath().toString(), status.isDirectory(), status.getLen()) for status in found]
    fits, arrow, count = re.compile(fnmatch.translate(glob)), arrow_schema(LISTED), partitions_for(spark)
    below = arrow_schema("path STRING, deep BOOLEAN")

    def folders_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((inner, True) for path, _ in rows_of(batches) for inner, _ in _children(path, True)), below)

    def files_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = (file for path, deep in rows_of(batches) for file in _walk(path, deep))
        # As with Spark's readers, files of zero bytes and hidden ones are none.
        return batches_of((file for file in files if file[1] and fits.match(posixpath.basename(file[0]))), arrow)

    def frame(rows: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, min(len(rows), count))), schema)

    level, flat = [(path, False) for path, is_folder, _ in at if is_folder], []
    while level:
        flat += level
        inner = frame(level, "path STRING, deep BOOLEAN").mapInArrow(folders_in, "path STRING, deep BOOLEAN")
        some = inner.take(FOLDERS)
        if len(some) == FOLDERS:
            break
        level = [(row["path"], False) for row in some]
    single = [(path, size) for path, is_folder, size in at if not is_folder and size and not _hidden(posixpath.basename(path), False) and fits.match(posixpath.basename(path))]
    folders = frame(flat, "path STRING, deep BOOLEAN")
    files = (folders.unionAll(inner) if level else folders).repartition(count, "path").mapInArrow(files_in, LISTED)
    return (files.unionAll(frame(single, LISTED)) if single else files).repartition(count, "path")


def list_entries(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """One entry per file below `root` whose name fits; contents are read only where files cannot be opened."""
    files = listed(spark, root, glob)
    if files is not None:
        return files.select(
            "path", F.lit(None).cast("binary").alias("content"), F.col("path").alias("file"),
            F.lit(0).cast("long").alias("offset"), "size", F.lit(None).cast("string").alias("error"),
        )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return as_entries(files.select("path", "content"))


def _blocks(data: bytes, chunk: Callable[[bytes], bytes]) -> bytes:
    """Blocks as Hadoop's codecs write them: their length, then chunks, each behind its own, until it is reached."""
    out, at = [], 0
    number = lambda i: int.from_bytes(data[i : i + 4], "big")
    while at < len(data):
        left, at = number(at), at + 4
        while left > 0:
            size = number(at)
            if at + 4 + size > len(data):
                raise EOFError("a compressed file is cut")
            out.append(chunk(data[at + 4 : at + 4 + size]))
            left, at = left - len(out[-1]), at + 4 + size
    return b"".join(out)


def _snappy(data: bytes) -> bytes:
    size = shift = at = 0
    while True:
        size, shift, at = size | (data[at] & 127) << shift, shift + 7, at + 1
        if data[at - 1] < 128:
            return pa.Codec("snappy").decompress(data, size, asbytes=True)


def _lz4(data: bytes) -> bytes:
    size = at = 0

    def length(first: int) -> int:
        nonlocal at
        total, more = first, 255 if first == 15 else 0
        while more == 255:
            more, at = data[at], at + 1
            total += more
        return total

    while at < len(data):
        token, at = data[at], at + 1
        literals = length(token >> 4)
        at, size = at + literals, size + literals
        if at < len(data):
            at += 2
            size += 4 + length(token & 15)
    return pa.Codec("lz4_raw").decompress(data, size, asbytes=True)


# How files are unpacked, by their ending, as Spark's text reader does.
UNPACK = {
    ".gz": gzip.decompress,
    ".bz2": bz2.decompress,
    ".deflate": zlib.decompress,
    ".snappy": lambda data: _blocks(data, _snappy),
    ".lz4": lambda data: _blocks(data, _lz4),
    ".zst": lambda data: pa.input_stream(pa.BufferReader(data), compression="zstd").read(),
}


@functools.lru_cache(maxsize=256)
def _store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """Stores are asked for once a folder, not once a file."""
    return file_system(folder)


# Characters that Java quotes in the path of a URI.
_QUOTED = re.compile(r"""[\x00-\x20\x7f-\xa0"#%<>?\[\\\]^`{|}\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]""")


def contents(files: DataFrame) -> DataFrame:
    """(path, content) of listed files, each opened by the task that has it and unpacked as its ending says.

    Paths are quoted like those in the metadata of Spark's readers.
    """
    schema = "path STRING, content BINARY"
    arrow = arrow_schema(schema)

    def content(path: str) -> bytes:
        folder, name = posixpath.split(path)
        store, where = _store_of(folder)
        with store.open_input_file(f"{where.rstrip('/')}/{name}") as file:
            data = file.read()
        return UNPACK.get(posixpath.splitext(name)[1].lower(), bytes)(data)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((_QUOTED.sub(lambda c: quote(c[0], safe=""), path), content(path)) for (path,) in rows_of(batches)), arrow)

    return files.select("path").mapInArrow(read, schema)


def as_entries(archives: DataFrame) -> DataFrame:
    """(path, content) rows as entries."""
    nothing = {"file": "string", "offset": "long", "size": "long", "error": "string"}
    return archives.select("path", "content", *(F.lit(None).cast(t).alias(n) for n, t in nothing.items()))


def entries_of(frame: pd.DataFrame) -> Iterator[Entry]:
    for path, content, file, offset, size, error in frame[["path", "content", "file", "offset", "size", "error"]].itertuples(index=False):
        known = isinstance(file, str)
        yield Entry(path, content, file if known else None, int(offset) if known else 0, int(size) if known else 0,
                    error if isinstance(error, str) else None)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, made a few at a time: of a batch with long contents there is one copy, in Arrow."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, SLICE_ROWS).columns))


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def batches_of(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded rows and bytes."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        for value in row:
            if isinstance(value, (str, bytes)):
                size += len(value)
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def per_group(rows: DataFrame, by: list[str], order: list, make: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """What `make(key, rows)` gives for each group of the columns `by`; they come first in the rows it sees.

    Rows are sorted inside their tasks, by group and `order`, and stream through: no group is whole in memory.
    """
    first = [*by, *(c for c in rows.columns if c not in by)]
    ordered = rows.select(*first).repartition(partitions_for(rows.sparkSession), *by).sortWithinPartitions(*by, *order)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = itertools.groupby(rows_of(batches), key=lambda row: row[: len(by)])
        return batches_of((out for key, some in groups for out in make(key, some)), arrow)

    return ordered.mapInArrow(run, schema)


def entries_in(batches: Iterable[pa.RecordBatch]) -> Iterator[Entry]:
    """Entries of Arrow batches with the columns of ENTRY."""
    for path, content, file, offset, size, error in rows_of(batches):
        yield Entry(path, content, file, offset if file is not None else 0, size if file is not None else 0, error)


def frame_of(entries: list[Entry]) -> pd.DataFrame:
    return pd.DataFrame(entries, columns=Entry._fields).astype({"offset": "Int64", "size": "Int64"})


class _Range(io.RawIOBase):
    """A range of a file as a file of its own."""

    def __init__(self, file: pa.NativeFile, offset: int, size: int):
        self.file, self.first, self.size, self.at = file, offset, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, to: int, whence: int = io.SEEK_SET) -> int:
        self.at = max(0, to + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence])
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        wanted = min(len(buffer), max(0, self.size - self.at))
        data = self.file.read_at(wanted, self.first + self.at) if wanted else b""
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


@contextmanager
def _bytes_of(entry: Entry) -> Iterator[BinaryIO]:
    """The entry as a file. Errors of the store are no BadArchive: the task fails and is run again."""
    if entry.file is None:
        yield io.BytesIO(entry.content or b"")
        return
    store, where = file_system(entry.file)
    with store.open_input_file(where) as file:
        yield io.BufferedReader(_Range(file, entry.offset, entry.size))


@contextmanager
def opened(entry: Entry) -> Iterator[tuple[BinaryIO, bool]]:
    """The entry without gzip compression, seekable, and whether it was stored so. It is decompressed once."""
    with _bytes_of(entry) as file:
        packed = file.read(2) == b"\x1f\x8b"
        file.seek(0)
        if not packed:
            yield file, True
            return
        with tempfile.SpooledTemporaryFile(max_size=SPOOL) as plain:
            try:
                with gzip.GzipFile(fileobj=file) as unpacked:
                    shutil.copyfileobj(unpacked, plain, 1 << 20)
            except (EOFError, zlib.error, gzip.BadGzipFile) as exc:
                raise BadArchive(f"{type(exc).__name__}: {exc}") from exc
            plain.seek(0)
            yield plain, False


def _plain_members(file: BinaryIO) -> list[Member] | None:
    """The files of a whole tar of regular files with short names; any other one is left to tarfile, at ten times the cost a file."""
    found, at = [], 0
    while True:
        file.seek(at)
        block = file.read(tarfile.BLOCKSIZE)
        if not (header := _PLAIN.match(block, 100)):
            return found if block + file.read(tarfile.BLOCKSIZE) == END else None
        # Sums of half a block are below the modulus of adler32, which gives them exactly; the sum is taken over blanks in its own place.
        total = (zlib.adler32(block[:256]) & 0xFFFF) + (zlib.adler32(block[256:]) & 0xFFFF) - 2
        if total - sum(block[148:156]) + 8 * ord(" ") != int(header[2], 8):
            return None
        name, size = block[:100].partition(b"\0")[0].decode("utf-8", "surrogateescape"), int(header[1], 8)
        found.append(Member(name, at + tarfile.BLOCKSIZE, size))
        at += tarfile.BLOCKSIZE + size + -size % tarfile.BLOCKSIZE


def index(file: BinaryIO) -> list[Member]:
    """The files in a tar, in order; only headers are read. An archive that is cut, anywhere, is a BadArchive."""
    if (plain := _plain_members(file)) is not None:
        return plain
    found = []
    file.seek(0)
    try:
        with tarfile.open(fileobj=file, mode="r:") as tar:
            while (member := tar.next()) is not None:
                if member.isfile():
                    found.append(Member(member.name, member.offset_data, member.size))
                tar.members.clear()
            end = tar.offset
    except (tarfile.TarError, EOFError) as exc:
        raise BadArchive(f"{type(exc).__name__}: {exc}") from exc
    file.seek(end)
    if file.read(len(END)) != END:
        raise BadArchive(f"no end of archive after {len(found)} files")
    return found


def read_member(file: BinaryIO, member: Member) -> bytes:
    file.seek(member.offset)
    return file.read(member.size)


def members(entry: Entry) -> Iterator[tuple[str, bytes]]:
    """Names and contents of the files in an archive; a broken one raises BadArchive before its first file."""
    if entry.error is not None:
        raise BadArchive(entry.error)
    with opened(entry) as (file, _):
        for member in index(file):
            yield member.name, read_member(file, member)


def read_entry(entry: Entry) -> bytes:
    """The bytes of an entry; that of a broken archive raises BadArchive."""
    if entry.error is not None:
        raise BadArchive(entry.error)
    with _bytes_of(entry) as file:
        return file.read()


def inner_entries(entry: Entry, endings: tuple[str, ...] = ("",), below: bool = False) -> list[Entry]:
    """The files with these endings in an archive, as entries below its folder, or below its own path with
    `below`; a broken archive is one with `error`."""
    folder, out = entry.path if below else posixpath.dirname(entry.path), []
    try:
        with opened(entry) as (file, stored):
            for member in index(file):
                if member.name.endswith(endings):
                    path = posixpath.join(folder, member.name)
                    if stored and entry.file is not None:
                        out.append(Entry(path, None, entry.file, entry.offset + member.offset, member.size))
                    else:
                        out.append(Entry(path, read_member(file, member)))
    except BadArchive as exc:
        return [Entry(entry.path, error=str(exc))]
    return out


def unpacked(entries: DataFrame, endings: tuple[str, ...] = ("",), below: bool = False) -> DataFrame:
    """Entries of the files inside archives; a broken archive is one entry with its own path and `error`."""
    arrow = arrow_schema(ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of((inner for entry in entries_in(batches) for inner in inner_entries(entry, endings, below)), arrow)

    return entries.select(*Entry._fields).mapInArrow(run, ENTRY)


@contextmanager
def written(path: str) -> Iterator[BinaryIO]:
    """A new file that gets its name when it is whole; a task that runs again replaces it."""
    store, where = file_system(path)
    store.create_dir(posixpath.dirname(where), recursive=True)
    part = f"{posixpath.dirname(where)}/.{posixpath.basename(where)}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as file:
        yield file
    store.move(part, where)


def add(tar: tarfile.TarFile, name: str, data: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size = len(data)
    tar.addfile(info, io.BytesIO(data))


def header_of(name: str, size: int) -> bytes:
    """The header of a file in a tar, the bytes that tarfile gives; it is asked for long names and large files only."""
    short, digits = name.encode("utf-8", "surrogateescape"), b"%011o" % size
    if len(short) > tarfile.LENGTH_NAME or len(digits) > 11:
        info = tarfile.TarInfo(name)
        info.size = size
        return info.tobuf(tarfile.GNU_FORMAT)
    total = b"%06o\0 " % (_HEADER_SUM + sum(short) + sum(digits))
    return b"".join((short.ljust(100, b"\0"), _HEADER[100:124], digits, b"\0", _HEADER[136:148], total, _HEADER[156:]))


def write_gzip_tar(out: BinaryIO, members: Iterable[tuple[str, bytes]]) -> None:
    """Names and contents as a `.tar.gz`, one after the other."""
    held, size = [], 0
    with gzip.GzipFile("", "wb", GZIP_LEVEL, out, 0) as packed:
        for name, data in members:
            held += header_of(name, len(data)), data, bytes(-len(data) % tarfile.BLOCKSIZE)
            size += len(data) + tarfile.BLOCKSIZE
            if size >= PACK_BYTES:
                packed.write(b"".join(held))
                held, size = [], 0
        packed.write(b"".join(held) + END)


def gzip_tar(members: Iterable[tuple[str, bytes]]) -> bytes:
    buffer = io.BytesIO()
    write_gzip_tar(buffer, members)
    return buffer.getvalue()


_COLLECTION = ["collection", "ligand", "format", "pos", "content"]


def _collection_path(collection: str) -> str:
    tranche, number = collection.rsplit("_", 1)
    return f"{tranche[:2]}/{tranche}/{number}.tar.gz"


def _members_of(collection: str, rows: Iterator[tuple]) -> Iterator[tuple[str, bytes]]:
    number = collection.rsplit("_", 1)[1]
    return ((f"{number}/{ligand}.{ending}", content.encode()) for _, ligand, ending, _, content in rows)


def _per_collection(ligands: DataFrame, make, schema: str) -> DataFrame:
    order = [F.asc_nulls_last(c) for c in ("pos", "ligand")]
    return per_group(ligands.select(*_COLLECTION), ["collection"], order, make, schema)


def pack_collections(ligands: DataFrame) -> DataFrame:
    """(path, content): `<meta>/<tranche>/<ID>.tar.gz` per collection, with `<ID>/<ligand>.<format>` in the order of `pos`."""

    def pack(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        yield _collection_path(key[0]), gzip_tar(_members_of(key[0], rows))

    return _per_collection(ligands, pack, "path STRING, content BINARY")


def write_files(files: DataFrame, root: str) -> None:
    """(path, content) rows as files below `root`, each written by the task that has it; files of the same name are replaced."""
    whole, counted = qualified(files.sparkSession, root), arrow_schema("n LONG")

    def write_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for name, content in rows_of(batches):
            with written(f"{whole}/{name}") as file:
                file.write(content)
            n += 1
        return batches_of([(n,)], counted)

    files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(write_each, "n LONG").agg(F.sum("n")).collect()


def write_library(ligands: DataFrame, root: str, layout: str = "tranche") -> None:
    """A ligand library below `root`: (collection, ligand, format, pos, content) rows in archives.

    layout `collection`: `<meta>/<tranche>/<ID>.tar.gz`; `tranche`: `<meta>/<tranche>.tar` holding
    `<tranche>/<ID>.tar.gz`. A collection is packed in one task, ligand by ligand, straight into a file; the files of
    a tranche are then copied into its archive by one task, block by block. Only their names are shuffled.
    """
    whole = qualified(ligands.sparkSession, root)
    parts = f"{whole}/.parts-{uuid.uuid4().hex}" if layout == "tranche" else whole

    def write_collection(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        path = _collection_path(key[0])
        with written(f"{parts}/{path}") as file:
            write_gzip_tar(file, _members_of(key[0], rows))
        yield posixpath.dirname(path), path

    def write_tranche(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        (tranche,), n = key, 0
        with written(f"{whole}/{tranche}.tar") as file, tarfile.open(fileobj=file, mode="w|") as tar:
            for _, path in rows:
                store, where = file_system(f"{parts}/{path}")
                with store.open_input_file(where) as packed:
                    info = tarfile.TarInfo(posixpath.join(posixpath.basename(tranche), posixpath.basename(path)))
                    info.size = packed.size()
                    tar.addfile(info, packed)
                n += 1
        yield tranche, n

    packed = _per_collection(ligands, write_collection, "tranche STRING, path STRING")
    if layout == "tranche":
        try:
            per_group(packed, ["tranche"], ["path"], write_tranche, "tranche STRING, n LONG").agg(F.sum("n")).collect()
        finally:
            store, where = file_system(parts)
            if store.get_file_info(where).type != fs.FileType.NotFound:
                store.delete_dir(where)
    else:
        packed.agg(F.count("path")).collect()
