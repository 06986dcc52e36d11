"""Zip archives: members dealt to tasks, records streamed out of the first XML member of each archive."""

from __future__ import annotations

import codecs
import contextlib
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from typing import IO

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentlake.functions.scalars import archive_rank, basename

ARCHIVE_ROWS = "path string, member string, doc_seq long, record_xml string, error string"
ROWS_PER_BATCH = 1000


def find_archives(spark: SparkSession, folder: str, glob: str = "*.zip") -> DataFrame:
    """Archives below a folder (path, filename, archive_rank), to be taken by rank and name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path")
    return files.withColumn("filename", basename(F.col("path"))).withColumn("archive_rank", archive_rank(F.col("filename")))


DEEPEST = 16  # archives within archives
BLOCK = 1 << 20
_DECLARED = re.compile(rb"<\?xml[^>]*encoding=[\"']([A-Za-z0-9._-]+)")
_MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def _encoding(head: bytes) -> str:
    """Of an XML file by its byte order mark or declaration."""
    declared = _DECLARED.search(head)
    return next((name for mark, name in _MARKS if head.startswith(mark)), declared[1].decode() if declared else "utf-8")


class CutOff(ValueError):
    """A member ends within a record."""


def _stream(handle: io.BufferedIOBase, tag: str) -> Iterator[str]:
    """Records of an XML file, read in blocks; what is held is one record and a block, and no byte is searched twice.

    A record without an end is an error, after all that come before it.
    """
    opening = re.compile(rf"<((?:[\w.-]+:)?{re.escape(tag)})(?=[\s>/])[^>]*>")
    begun = re.compile(rf"<(?:[\w.-]+:)?{re.escape(tag)}[\s/]")
    block = handle.read(BLOCK)
    text = codecs.getincrementaldecoder(_encoding(block[:200]))()
    held, at, parts, closing = "", 0, [], None  # at: of what is held, read so far; parts: of a record that is open, without the end that a closing tag may begin in
    while block:
        held, at = held[at:] + text.decode(block), 0
        while True:
            m = (opening if closing is None else closing).search(held, at)
            if m is None:
                last = held.rfind("<", at)  # of a tag that may go on
                upto = last if last >= 0 and held.find(">", last) < 0 else len(held)
                if closing is not None:
                    parts.append(held[at:upto])
                at = upto
                break
            if closing is not None:
                yield "".join([*parts, held[at : m.end()]])
                parts, closing = [], None
            elif m.group().endswith("/>"):
                yield m.group()
            else:
                closing, parts = re.compile(rf"</{re.escape(m[1])}\s*>"), [m.group()]
            at = m.end()
        block = handle.read(BLOCK)
    text.decode(b"", True)
    if closing is not None or begun.search(held, at):
        raise CutOff("the member ends within a record")


class _File(io.RawIOBase):
    """A file of Arrow's with the errors that the zip reader expects."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, to: int, whence: int = 0) -> int:
        try:
            return self.file.seek(to, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def read(self, n: int = -1) -> bytes:
        return self.file.read(None if n is None or n < 0 else n)

    def close(self) -> None:
        self.file.close()
        super().close()


class _Window(io.RawIOBase):
    """Bytes of another file: a member that is stored as it is."""

    def __init__(self, file: io.RawIOBase, start: int, size: int) -> None:
        self.file, self.start, self.size, self.at = file, start, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, to: int, whence: int = 0) -> int:
        to += (0, self.at, self.size)[whence]
        if to < 0:
            raise OSError("a place before the first byte")
        self.at = to
        return to

    def read(self, n: int = -1) -> bytes:
        left = max(self.size - self.at, 0)
        self.file.seek(self.start + self.at)
        out = self.file.read(left if n is None or n < 0 else min(n, left))
        self.at += len(out)
        return out


def _inner(z: zipfile.ZipFile, name: str) -> io.RawIOBase | IO[bytes]:
    """An archive within an archive: one that is stored is read where it lies, others are unpacked in blocks as they are read."""
    info = z.getinfo(name)
    if info.compress_type != zipfile.ZIP_STORED or info.flag_bits & 1:
        return z.open(info)
    z.fp.seek(info.header_offset + 26)
    sizes = struct.unpack("<HH", z.fp.read(4))  # of the name and of what follows it
    return _Window(z.fp, info.header_offset + 30 + sum(sizes), info.file_size)


def _xml_members(z: zipfile.ZipFile, depth: int = 0) -> Iterator[tuple[str, ...]]:
    """Where an archive's records lie: its first XML member, or else those of the archives in it, as names from the outside in."""
    if depth > DEEPEST:
        raise zipfile.BadZipFile(f"more than {DEEPEST} archives within each other")
    names = z.namelist()
    first = next((n for n in names if n.endswith(".xml")), None)
    if first is not None:
        yield (first,)
        return
    for n in names:
        if n.endswith(".zip"):
            with _inner(z, n) as inner, zipfile.ZipFile(inner) as archive:
                yield from ((n, *rest) for rest in _xml_members(archive, depth + 1))


def _opened(path: str) -> _File:
    """A file of any store that Arrow knows, read where it is asked for."""
    uri = re.sub(r"^file:/(?!/)", "file:///", path).replace("s3a://", "s3://", 1)
    store, name = fs.FileSystem.from_uri(uri)
    return _File(store.open_input_file(name))


def _member_rows(path: str, names: tuple[str, ...], tag: str, data: io.RawIOBase) -> Iterator[tuple]:
    """Rows of one member, from its archive's bytes; what is wrong with it is the last one's error."""
    k = -1
    try:
        with contextlib.ExitStack() as stack:
            handle = data
            for name in names[:-1]:
                handle = stack.enter_context(_inner(stack.enter_context(zipfile.ZipFile(handle)), name))
            handle = stack.enter_context(stack.enter_context(zipfile.ZipFile(handle)).open(names[-1]))
            for k, xml in enumerate(_stream(handle, tag)):
                yield path, "/".join(names), k, xml, None
    except BROKEN as e:
        yield path, "/".join(names), k + 1, None, str(e) or type(e).__name__


#: what a broken archive or member raises
BROKEN = (zipfile.BadZipFile, zlib.error, struct.error, EOFError, LookupError, UnicodeDecodeError, CutOff, NotImplementedError)
_NAMES = ["path", "member", "doc_seq", "record_xml", "error"]
_SEEKABLE = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def _frames(rows: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    """Batches bounded by rows and by characters."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[3] or "")
        if len(some) >= ROWS_PER_BATCH or size >= BLOCK:
            yield pd.DataFrame(some, columns=_NAMES)
            some, size = [], 0
    if some:
        yield pd.DataFrame(some, columns=_NAMES)


def list_members(files: DataFrame) -> DataFrame:
    """(path, names, error) of the members with records in archives at `path`, by their directories alone; a broken archive is a row with an error."""

    def run(it: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows: list[tuple] = []
            for path in pdf["path"]:
                try:
                    with _opened(path) as data, zipfile.ZipFile(data) as z:
                        rows += [(path, list(names), None) for names in _xml_members(z)]
                except BROKEN as e:
                    rows.append((path, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "names", "error"])

    return files.select("path").mapInPandas(run, "path string, names array<string>, error string")


def dealt(members: DataFrame) -> DataFrame:
    """Members of list_members over all tasks: their rows are small, and without a number adaptive execution would leave them in one."""
    spark = members.sparkSession
    return members.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "names")


def read_members(members: DataFrame, tag: str = "exchange-document") -> DataFrame:
    """Records of members from list_members; each member is one row to deal to tasks, and its archive is read by seeks, never whole."""

    def run(it: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for pdf in it:
                for path, names, error in zip(pdf["path"], pdf["names"], pdf["error"], strict=True):
                    if names is None:
                        yield path, None, -1, None, error
                        continue
                    with _opened(path) as data:
                        yield from _member_rows(path, tuple(names), tag, data)

        yield from _frames(rows())

    return members.mapInPandas(run, ARCHIVE_ROWS)


def read_archives(spark: SparkSession, folder: str, tag: str = "exchange-document", glob: str = "*.zip") -> DataFrame:
    """Records of all archives below a folder, with their position in their member.

    An archive without XML has no rows. A broken one is a row with an error; a member that
    is broken, ends within a record, or isn't in the encoding it declares has the records
    before that place and then such a row. Archives are listed by their directories, and
    members dealt to tasks; in a store that Arrow can't open an archive comes whole into a task.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    scheme = folder.partition(":")[0] if ":" in folder else spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()
    if scheme in _SEEKABLE:
        return read_members(dealt(list_members(files)), tag)

    def run(it: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for pdf in it:
                for path, content in zip(pdf["path"], pdf["content"], strict=True):
                    try:
                        with zipfile.ZipFile(io.BytesIO(content)) as z:
                            found = list(_xml_members(z))
                    except BROKEN as e:
                        yield path, None, -1, None, str(e)
                        continue
                    for names in found:
                        yield from _member_rows(path, names, tag, io.BytesIO(content))

        yield from _frames(rows())

    return files.select("path", "content").mapInPandas(run, ARCHIVE_ROWS)


def write_archives(rows: DataFrame, folder: str, name: str, record: str, tag: str = "exchange-documents") -> None:
    """A zip below folder for each name (which may hold sub-folders), with the records of that name in one XML file.

    Every second archive, by the hash of its name, lies in another one. An archive is
    written by one task as its records come, a batch at a time, however many there are.
    """

    @contextlib.contextmanager
    def member(path: str, nested: bool) -> Iterator[IO[bytes]]:
        with contextlib.ExitStack() as stack:
            store, root = fs.FileSystem.from_uri(folder)
            store.create_dir(f"{root}/{path}".rpartition("/")[0], recursive=True)
            out = stack.enter_context(store.open_output_stream(f"{root}/{path}"))
            if nested:
                out = stack.enter_context(stack.enter_context(zipfile.ZipFile(out, "w")).open("inner.zip", "w", force_zip64=True))
            handle = stack.enter_context(stack.enter_context(zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)).open("records.xml", "w", force_zip64=True))
            handle.write(f"<{tag}>".encode())
            yield handle
            handle.write(f"</{tag}>".encode())

    def run(it: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with contextlib.ExitStack() as stack:
            of, handle = None, None
            for pdf in it:
                for path, some in pdf.groupby("name", sort=False):
                    if path != of:
                        stack.close()
                        of, handle = path, stack.enter_context(member(f"{path}.zip", bool(some["nested"].iloc[0])))
                    handle.write("".join(some["record"]).encode())
        yield pd.DataFrame({"path": pd.Series([], dtype=str)})

    named = rows.select(F.col(name).alias("name"), F.col(record).alias("record"), (F.pmod(F.xxhash64(name), F.lit(2)) == 1).alias("nested"))
    written = named.repartition("name").sortWithinPartitions("name").mapInPandas(run, "path string")
    written.write.format("noop").mode("overwrite").save()
