"""Token ids in length-delimited binary records.

A shard is a file of records. A record frames one payload:

    length of the payload   unsigned 64 bit
    masked CRC-32 of those 8 bytes   unsigned 32 bit
    payload: 1 byte (1: the document has an id), 1 byte (bytes of an id: 2 if the vocabulary
        has at most 65,536 ids, else 4), document id (signed 64 bit), ids (unsigned)
    masked CRC-32 of the payload   unsigned 32 bit

all little-endian. A mask rotates the checksum right by 15 bits and adds 0xA282EAD8, so
that checksums of data that hold checksums stay apart. Beside each shard lies its index:
for each record its place and its payload's length (two unsigned 64-bit integers), with
which records can be read in any order. The shards follow each other in ascending order
of the document id. `manifest` is a Parquet table with a row for each shard.

Executors write shards with pyarrow's file systems into the folder that the cluster
shares; a shard gets its name when it is complete, so that a task that is run again
replaces its shard by the same bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patentlake.llm._io import bounded
from patentlake.llm.tokens import batches, vocabulary_path, word_encoder
from patentlake.sources.shared import shared_folder

END_ID = 1
_LENGTH, _CRC, _HEAD, _PLACE = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BBq"), struct.Struct("<QQ")
FRAME_BYTES = _LENGTH.size + 2 * _CRC.size
PLACE_BYTES = _PLACE.size
READ_BYTES = 1 << 22


class BadRecord(ValueError):
    """A checksum or a length of a shard is wrong."""


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = _LENGTH.pack(len(payload))
    return b"".join((size, _CRC.pack(masked(size)), payload, _CRC.pack(masked(payload))))


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int] | None:
    """The payload at a place and the place after it; None if the record isn't all there."""
    if len(data) - at < _LENGTH.size + _CRC.size:
        return None
    size = data[at : at + _LENGTH.size]
    if masked(size) != _CRC.unpack_from(data, at + _LENGTH.size)[0]:
        raise BadRecord(f"length of the record at {at}")
    lo = at + _LENGTH.size + _CRC.size
    hi = lo + _LENGTH.unpack(size)[0]
    if len(data) < hi + _CRC.size:
        return None
    payload = data[lo:hi]
    if masked(payload) != _CRC.unpack_from(data, hi)[0]:
        raise BadRecord(f"payload of the record at {at}")
    return payload, hi + _CRC.size


def payload_for(doc: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(doc is not None, width, doc or 0) + ids


def place(at: int, size: int) -> bytes:
    return _PLACE.pack(at, size)


def unpack(payload: bytes) -> tuple[int | None, bytes]:
    """Document id, and ids as little-endian unsigned 32-bit integers."""
    has, width, doc = _HEAD.unpack_from(payload)
    ids = payload[_HEAD.size :]
    return (doc if has else None), ids if width == 4 else np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


def stream(handle) -> Iterator[bytes]:
    """Payloads of a shard in order, read in blocks."""
    held = b""
    while True:
        block = handle.read(READ_BYTES)
        held += block
        at = 0
        while (got := unframe(held, at)) is not None:
            payload, at = got
            yield payload
        held = held[at:]
        if not block:
            break
    if held:
        raise BadRecord(f"{len(held)} bytes after the last record")


_MANIFEST = "shard long, path string, n_docs long, n_ids long, n_bytes long"


def write_records(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID) -> None:
    """Encode every row and write shards, their indexes and the manifest under folder.

    Null text: only the end id. A null doc_id sorts first and is kept as such; rows of equal
    doc_id follow each other. An empty table gives an empty manifest. Other columns aren't
    written. One shuffle, of the texts, by ranges of the document id.
    """
    path = path or vocabulary_path()
    source = bounded(docs).select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    spread = source.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        name, part = f"{root}/shard-{shard:06d}", f"{root}/_writing-{shard:06d}-{task.taskAttemptId()}"
        encoder = word_encoder(path)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        n_docs = n_ids = at = 0
        out = index = None
        for batch in it:
            ids = batch.column("id").to_pylist()
            for i, j, texts in batches(batch.column("text")):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out, index = store.open_output_stream(f"{part}.rec"), store.open_output_stream(f"{part}.idx")
                places, frames = [], []
                for doc, got in zip(ids[i:j], encoder.encode(texts), strict=True):
                    payload = payload_for(doc, got + end, encoder.width)
                    frames.append(frame(payload))
                    places.append(place(at, len(payload)))
                    at += len(payload) + FRAME_BYTES
                    n_ids += len(got) // encoder.width + 1
                n_docs += j - i
                out.write(b"".join(frames))
                index.write(b"".join(places))
        if out is not None:
            out.close(), index.close()
            for kind in ("idx", "rec"):
                store.move(f"{part}.{kind}", f"{name}.{kind}")
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}"], "n_docs": [n_docs], "n_ids": [n_ids], "n_bytes": [at]})

    spread.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with `before`: ids in all shards before each. A row for each shard, so one task sorts them."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("before", F.coalesce(before, F.lit(0)))


def read_records(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """Records of all shards: doc_id, start (ids of all documents before it), n_tokens and ids (or ids_crc32).

    Each shard is read by one task as a stream; lengths and checksums are verified.
    """
    shards = _shards(spark, folder)
    n = max(1, shards.count())
    last = "ids_crc32 long" if digest else "ids binary"

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for shard in batch.to_pylist():
                store, root = fs.FileSystem.from_uri(shard["path"])
                start, rows, size = shard["before"], [], 0
                with store.open_input_stream(f"{root}.rec") as handle:
                    for payload in stream(handle):
                        doc, ids = unpack(payload)
                        rows.append((doc, start, len(ids) // 4, zlib.crc32(ids) if digest else ids))
                        start += len(ids) // 4
                        size += len(payload)
                        if size > READ_BYTES or len(rows) >= 10000:
                            yield _batch(rows, digest)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, digest)

    return shards.repartition(n, "shard").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def _batch(rows: list[tuple], digest: bool) -> pa.RecordBatch:
    doc, start, n, last = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(last, pa.int64() if digest else pa.binary())], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """doc_id and ids of all records in an order drawn by seed, each fetched by its place in the index."""
    shards = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")

    def places(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path in batch.column("path").to_pylist():
                store, root = fs.FileSystem.from_uri(path)
                with store.open_input_stream(f"{root}.idx") as handle:
                    while block := handle.read(PLACE_BYTES * 65536):
                        rows = np.frombuffer(block, dtype="<u8").reshape(-1, 2).astype(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["path", "at", "size"])

    def fetch(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            handles, rows = {}, []
            for path, at, size in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "size")), strict=True):
                if path not in handles:
                    store, root = fs.FileSystem.from_uri(path)
                    handles[path] = store.open_input_file(f"{root}.rec")
                handles[path].seek(at)
                got = unframe(handles[path].read(size + FRAME_BYTES))
                if got is None:
                    raise BadRecord(f"{path}: record at {at} is cut off")
                rows.append(unpack(got[0]))
            for h in handles.values():
                h.close()
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["doc_id", "ids"])

    drawn = shards.mapInArrow(places, "path string, at long, size long").orderBy(F.xxhash64("path", "at", F.lit(seed)))
    return drawn.mapInArrow(fetch, "doc_id long, ids binary")


def written_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write every row's ids, read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "records")
    write_records(docs, folder, doc_id, text)
    return read_records(spark, folder, digest=True)
