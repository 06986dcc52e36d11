"""Media columns: ISO media containers whose boxes are walked and whose sample tables are decoded.

`probe` reads a column of containers and gives codec, duration, samples and the byte
ranges and times of keyframes from the boxes alone: payloads are neither decoded nor
copied. Sample tables (sizes of full and compact form, chunks, times, composition offsets,
edits, sync samples) and the runs of movie fragments are decoded; a track that lacks one
of those it needs, or whose tables disagree, is an error, never a track without samples.
`pack` stores bytes losslessly in such a container as frames of unsigned 8-bit samples
(one track, codec `raw `), and `payload_of` finds them again by the sample table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentlake.llm._io import bounded

FRAME = 64  # bytes of a frame; payloads are padded to a multiple of it
RATE = 8000  # samples a second
SYNC_EVERY = 64  # frames from one keyframe to the next
PER_CHUNK = 256  # frames of a chunk

DEEPEST = 64  # containers within each other; the format needs seven

#: boxes that hold boxes
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"mvex", b"moof", b"traf", b"udta"}


class Track(NamedTuple):
    codec: str
    timescale: int
    duration: int
    sizes: np.ndarray  # bytes of each sample
    offsets: np.ndarray  # its place in the file
    sync: np.ndarray  # indexes of keyframes
    times: np.ndarray  # when each sample is shown, in units of timescale, by its composition offset and the track's first edit


def boxes(data: memoryview, lo: int = 0, hi: int | None = None, within: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of box types, start and end of the content) of every box, parents before children, at any depth up to DEEPEST."""
    open_ = [(lo, len(data) if hi is None else hi, within)]
    while open_:
        lo, hi, within = open_.pop()
        if lo + 8 > hi:
            continue
        size, kind = struct.unpack_from(">I4s", data, lo)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, lo + 8)[0], 16
        end = hi if size == 0 else lo + size
        if end > hi or end < lo + head:
            raise ValueError(f"box {kind!r} at {lo} runs past its parent")
        path = (*within, kind)
        yield path, lo + head, end
        open_.append((end, hi, within))
        if kind in CONTAINERS:
            if len(path) > DEEPEST:
                raise ValueError(f"box {kind!r} at {lo} lies {len(path)} boxes deep")
            open_.append((lo + head, end, path))


def _table(data: memoryview, at: int, kind: str, columns: int = 1) -> np.ndarray:
    n = struct.unpack_from(">I", data, at)[0]
    out = np.frombuffer(data, dtype=kind, count=n * columns, offset=at + 4).astype(np.int64)
    return out.reshape(n, columns) if columns > 1 else out


def _runs(data: memoryview, at: int, n: int, kind: str, what: str) -> np.ndarray:
    """Values of n samples out of (count, value) pairs."""
    found = np.frombuffer(data, dtype=[("n", ">u4"), ("value", kind)], count=struct.unpack_from(">I", data, at + 4)[0], offset=at + 8)
    counts = found["n"].astype(np.int64)
    if int(counts.sum()) != n:
        raise ValueError(f"{what} has {int(counts.sum())} samples, not {n}")
    return np.repeat(found["value"].astype(np.int64), counts)


def _sizes(data: memoryview, t: dict[bytes, tuple[int, int]]) -> np.ndarray:
    """Bytes of each sample, by the full or the compact table."""
    if b"stsz" in t:
        at = t[b"stsz"][0]
        same, n = struct.unpack_from(">II", data, at + 4)
        if same * n > len(data):
            raise ValueError(f"{n} samples of {same} bytes are more than the file holds")
        return np.full(n, same, dtype=np.int64) if same else _table(data, at + 8, ">u4")
    at = t[b"stz2"][0]
    width, n = data[at + 7], struct.unpack_from(">I", data, at + 8)[0]
    if width == 4:
        halves = np.frombuffer(data, dtype=np.uint8, count=(n + 1) // 2, offset=at + 12)
        return np.column_stack([halves >> 4, halves & 15]).ravel()[:n].astype(np.int64)
    if width not in (8, 16):
        raise ValueError(f"sizes of {width} bits")
    return np.frombuffer(data, dtype=">u1" if width == 8 else ">u2", count=n, offset=at + 12).astype(np.int64)


def _offsets(data: memoryview, t: dict[bytes, tuple[int, int]], sizes: np.ndarray) -> np.ndarray:
    """Place of each sample, by the tables of chunks."""
    n = len(sizes)
    starts = _table(data, t[b"co64"][0] + 4, ">u8") if b"co64" in t else _table(data, t[b"stco"][0] + 4, ">u4")
    runs = _table(data, t[b"stsc"][0] + 4, ">u4", 3)
    lengths = np.diff(np.append(runs[:, 0], len(starts) + 1))
    if sum(k * m for k, m in zip(runs[:, 1].tolist(), lengths.tolist(), strict=True)) != n or (lengths < 0).any():
        raise ValueError(f"chunks don't hold the {n} samples")
    per = np.repeat(runs[:, 1], lengths)
    chunk = np.repeat(np.arange(len(starts)), per)[:n]
    before = np.cumsum(sizes) - sizes
    firsts = np.cumsum(per) - per
    return starts[chunk] + before - before[firsts[chunk]] if n else np.zeros(0, dtype=np.int64)


def _first_edit(data: memoryview, at: int, scale: int, movie: int) -> int:
    """What the edit list adds to times: minus the media time at which the track begins, plus what is shown before it."""
    wide, n = data[at] == 1, struct.unpack_from(">I", data, at + 4)[0]
    before = 0
    for k in range(n):
        length, begin = struct.unpack_from(">Qq" if wide else ">Ii", data, at + 8 + k * (20 if wide else 12))
        if begin >= 0:
            return before * scale // max(movie, 1) - begin
        before += length  # an empty edit
    return before * scale // max(movie, 1)


class _Fragment(NamedTuple):
    sizes: np.ndarray
    offsets: np.ndarray
    times: np.ndarray
    sync: np.ndarray  # of each sample


def _fragments(data: memoryview, traf: list[tuple[bytes, int, int]], moof: int, defaults: dict[int, tuple[int, int, int]], clock: dict[int, int]) -> tuple[int, list[_Fragment]]:
    """(track, its runs in one fragment). clock: the decode time at which each track goes on."""
    head = next((lo for kind, lo, _ in traf if kind == b"tfhd"), None)
    if head is None:
        raise ValueError("a fragment of no track")
    flags, track = struct.unpack_from(">II", data, head)
    flags &= 0xFFFFFF
    length, size, mark = defaults.get(track, (0, 0, 0))
    at, base = head + 8, moof
    if flags & 1:
        base, at = struct.unpack_from(">Q", data, at)[0], at + 8
    at += 4 * bool(flags & 2)
    if flags & 8:
        length, at = struct.unpack_from(">I", data, at)[0], at + 4
    if flags & 16:
        size, at = struct.unpack_from(">I", data, at)[0], at + 4
    if flags & 32:
        mark = struct.unpack_from(">I", data, at)[0]
    for kind, lo, _ in traf:
        if kind == b"tfdt":
            clock[track] = struct.unpack_from(">Q" if data[lo] == 1 else ">I", data, lo + 4)[0]
    out, place = [], base
    for kind, lo, hi in traf:
        if kind != b"trun":
            continue
        version, flags = data[lo], struct.unpack_from(">I", data, lo)[0] & 0xFFFFFF
        n, at = struct.unpack_from(">I", data, lo + 4)[0], lo + 8
        if flags & 1:
            place, at = base + struct.unpack_from(">i", data, at)[0], at + 4
        first = None
        if flags & 4:
            first, at = struct.unpack_from(">I", data, at)[0], at + 4
        names = [x for bit, x in ((0x100, "length"), (0x200, "size"), (0x400, "mark"), (0x800, "shift")) if flags & bit]
        if at + 4 * len(names) * n > hi or not names and n * max(size, 1) > len(data):
            raise ValueError(f"a run of {n} samples is more than its box holds")
        cells = np.frombuffer(data, dtype=">u4", count=len(names) * n, offset=at).reshape(n, len(names)).astype(np.int64) if names else np.zeros((n, 0), dtype=np.int64)
        of = lambda x, same: cells[:, names.index(x)] if x in names else np.full(n, same, dtype=np.int64)  # noqa: E731, B023
        lengths, sizes, marks, shift = of("length", length), of("size", size), of("mark", mark).copy(), of("shift", 0)
        if first is not None and n:
            marks[0] = first
        shift = np.where(shift >= 1 << 31, shift - (1 << 32), shift) if version else shift
        begin = clock.get(track, 0)
        out.append(_Fragment(sizes, place + np.cumsum(sizes) - sizes, begin + np.cumsum(lengths) - lengths + shift, (marks & 0x10000) == 0))
        clock[track] = begin + int(lengths.sum())
        place += int(sizes.sum())
    return track, out


def tracks(media: bytes) -> list[Track]:
    """Tracks of a container, from its sample tables and the runs of its fragments."""
    data = memoryview(media)
    found: list[dict[bytes, tuple[int, int]]] = []
    trafs: list[tuple[int, list[tuple[bytes, int, int]]]] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    movie = moof = 0
    for path, lo, hi in boxes(data):
        kind = path[-1]
        if kind == b"trak":
            found.append({})
        elif b"trak" in path and found:
            found[-1].setdefault(kind, (lo, hi))
        elif kind == b"mvhd":
            movie = struct.unpack_from(">I", data, lo + (20 if data[lo] == 1 else 12))[0]
        elif kind == b"trex":
            track, _, *rest = struct.unpack_from(">IIIII", data, lo + 4)
            defaults[track] = tuple(rest)
        elif kind == b"moof":
            moof = lo - 8
        elif kind == b"traf":
            trafs.append((moof, []))
        elif b"traf" in path and trafs:
            trafs[-1][1].append((kind, lo, hi))
    clock: dict[int, int] = {}
    pieces: dict[int, list[_Fragment]] = {}
    for base, traf in trafs:
        track, runs = _fragments(data, traf, base, defaults, clock)
        pieces.setdefault(track, []).extend(runs)
    out = []
    for t in found:
        missing = [x for x in (b"mdhd", b"stsd", b"stts", b"stsc") if x not in t]
        missing += [b"stsz"] if b"stsz" not in t and b"stz2" not in t else []
        missing += [b"stco"] if b"stco" not in t and b"co64" not in t else []
        if missing:
            raise ValueError(f"a track without {', '.join(x.decode() for x in missing)}")
        at = t[b"mdhd"][0]
        scale, duration = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
        codec = bytes(data[t[b"stsd"][0] + 12 : t[b"stsd"][0] + 16]).decode("latin-1")
        sizes = _sizes(data, t)
        n = len(sizes)
        offsets = _offsets(data, t, sizes)
        lengths = _runs(data, t[b"stts"][0], n, ">u4", "the table of times")
        times = np.cumsum(lengths) - lengths
        if b"ctts" in t:
            times = times + _runs(data, t[b"ctts"][0], n, ">i4" if data[t[b"ctts"][0]] else ">u4", "the table of composition offsets")
        sync = _table(data, t[b"stss"][0] + 4, ">u4") - 1 if b"stss" in t else np.arange(n)
        if len(sync) and (sync.min() < 0 or sync.max() >= n):
            raise ValueError("a keyframe that is no sample")
        if b"tkhd" in t:
            number = struct.unpack_from(">I", data, t[b"tkhd"][0] + (20 if data[t[b"tkhd"][0]] == 1 else 12))[0]
            for piece in pieces.pop(number, []):
                sync = np.concatenate([sync, len(sizes) + np.flatnonzero(piece.sync)])
                sizes, offsets, times = (np.concatenate(x) for x in ((sizes, piece.sizes), (offsets, piece.offsets), (times, piece.times)))
            duration = duration or clock.get(number, 0)
        if b"elst" in t:
            times = times + _first_edit(data, t[b"elst"][0], scale, movie)
        if len(sizes) and (offsets.min() < 0 or int((offsets + sizes).max()) > len(data)):
            raise ValueError("samples lie beyond the file")
        out.append(Track(codec, scale, duration, sizes, offsets, sync, times))
    if pieces:
        raise ValueError(f"fragments of tracks {sorted(pieces)} that the container doesn't have")
    return out


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _numbers(*values: int) -> bytes:
    return struct.pack(f">{len(values)}I", *values)


def pack(payload: bytes) -> bytes:
    """Container with the payload, whose length is a multiple of FRAME, as its only track's frames."""
    n = len(payload) // FRAME
    chunks = -(-n // PER_CHUNK)
    matrix = _numbers(0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    wide = len(payload) >= 1 << 31

    def head(first: int) -> bytes:
        places = first + FRAME * PER_CHUNK * np.arange(chunks, dtype=np.int64)
        runs = [(1, min(PER_CHUNK, n), 1)]
        if n > PER_CHUNK and n % PER_CHUNK:
            runs.append((chunks, n % PER_CHUNK, 1))
        sync = np.arange(1, n + 1, SYNC_EVERY, dtype=np.int64)
        sound = b"\0" * 6 + struct.pack(">H", 1) + b"\0" * 8 + struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16)
        stbl = _box(
            b"stbl",
            _box(b"stsd", _numbers(0, 1), _box(b"raw ", sound)),
            _box(b"stts", _numbers(0, 1, n, FRAME)),
            _box(b"stss", _numbers(0, len(sync)), sync.astype(">u4").tobytes()),
            _box(b"stsc", _numbers(0, len(runs)), *(_numbers(*r) for r in runs)),
            _box(b"stsz", _numbers(0, FRAME, n)),
            _box(b"co64" if wide else b"stco", _numbers(0, chunks), places.astype(">u8" if wide else ">u4").tobytes()),
        )
        dinf = _box(b"dinf", _box(b"dref", _numbers(0, 1), _box(b"url ", _numbers(1))))
        minf = _box(b"minf", _box(b"smhd", _numbers(0, 0)), dinf, stbl)
        hdlr = _box(b"hdlr", _numbers(0, 0), b"soun", _numbers(0, 0, 0), b"\0")
        mdia = _box(b"mdia", _box(b"mdhd", _numbers(0, 0, 0, RATE, len(payload)), b"\x55\xc4\0\0"), hdlr, minf)
        tkhd = _box(b"tkhd", _numbers(7, 0, 0, 1, 0, len(payload), 0, 0, 0, 0x01000000), matrix, _numbers(0, 0))
        mvhd = _box(b"mvhd", _numbers(0, 0, 0, RATE, len(payload), 0x10000, 0x01000000, 0, 0), matrix, b"\0" * 24, _numbers(2))
        return _box(b"ftyp", b"isom", _numbers(512), b"isomiso2") + _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    size = len(head(0)) + (16 if wide else 8)
    top = struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if wide else struct.pack(">I4s", len(payload) + 8, b"mdat")
    return head(size) + top + payload


def payload_of(media: bytes, track: Track) -> bytes:
    """Bytes of all samples of a track in order; samples that touch are read together."""
    if not len(track.sizes):
        return b""
    ends = track.offsets + track.sizes
    first = np.flatnonzero(np.append(True, track.offsets[1:] != ends[:-1]))
    last = np.append(first[1:] - 1, len(ends) - 1)
    return b"".join(media[a:b] for a, b in zip(track.offsets[first].tolist(), ends[last].tolist(), strict=True))


def keyframe_ranges(track: Track) -> list[tuple[int, int]]:
    return list(zip(track.offsets[track.sync].tolist(), track.sizes[track.sync].tolist(), strict=True))


def _columns(df: DataFrame, *results: str) -> tuple[list[str], list[str], str]:
    keep = [c for c in df.columns if c not in results]
    names = [f"k{i}" for i in range(len(keep))]
    return keep, names, "".join(f"{n} {df.schema[c].dataType.simpleString()}, " for c, n in zip(keep, names, strict=True))


def pack_texts(docs: DataFrame, text: str = "text", column: str = "media") -> DataFrame:
    """Every row with n_bytes and `column` (a container of its UTF-8 text, padded by zeros to a positive multiple of 64) in place of its text.

    Null text is empty: 64 zeros. Repeated rows give repeated rows; an empty table an empty
    one; columns named like a result are replaced, others pass through.
    """
    keep, names, kinds = _columns(docs, text, "n_bytes", column)
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = batch.column("text").to_pylist()
            media = [pack(t + b"\0" * (max(FRAME, -(-len(t) // FRAME) * FRAME) - len(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=[*names, "n_bytes", "media"])

    out = source.mapInArrow(run, f"{kinds}n_bytes long, media binary")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_bytes", F.col("media").alias(column))


PROBED = "codec string, timescale long, duration long, n_samples long, keyframes array<struct<offset:long,length:long,time:long>>, error string"


def probe(df: DataFrame, column: str = "media") -> DataFrame:
    """Every row with codec, timescale, duration, n_samples, keyframes (place, length, time of showing in units of timescale) and error of its first track.

    Null or broken containers, or ones without a track, give nulls and say why in `error`.
    Columns named like a result are replaced, others pass through.
    """
    results = [x.split()[0] for x in PROBED.replace("struct<offset:long,length:long,time:long>", "x").split(", ")]
    keep, names, kinds = _columns(df, *results)
    source = bounded(df).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)])
    at = names[keep.index(column)]

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("time", pa.int64())]))
        for batch in it:
            rows = []
            for media in batch.column(at):
                try:
                    t = tracks(media.as_py())[0]
                    rows.append((t.codec, t.timescale, t.duration, len(t.sizes), [{"offset": a, "length": n, "time": at} for (a, n), at in zip(keyframe_ranges(t), t.times[t.sync].tolist(), strict=True)], None))
                except (ValueError, IndexError, TypeError, KeyError, MemoryError, OverflowError, struct.error) as e:
                    rows.append((None, None, None, None, None, f"{type(e).__name__}: {e}"))
            got = zip(*rows, strict=True) if rows else [[]] * len(results)
            kinds_ = (pa.string(), pa.int64(), pa.int64(), pa.int64(), ranges, pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(list(g), k) for g, k in zip(got, kinds_, strict=True))], names=[*names, *results])

    out = source.mapInArrow(run, kinds + PROBED)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *results)


def feature_of(track: Track) -> str:
    """Codec, seconds, frames and keyframe byte ranges of a track in one string."""
    ranges = ",".join(f"{a}+{n}" for a, n in keyframe_ranges(track))
    return f"codec={track.codec.strip()};seconds={track.duration / max(track.timescale, 1):.6f};samples={len(track.sizes)};keyframes={ranges}"


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """Store every text as media, read the stored bytes back by their sample table and sum them up."""
    packed = pack_texts(docs, text, "media")
    results = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    keep, names, kinds = _columns(packed, "media", *results)
    source = packed.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], "media")

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for scalar in batch.column("media"):
                media = scalar.as_py()
                track = tracks(media)[0]
                payload = payload_of(media, track)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-FRAME:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(track)))
            got = zip(*rows, strict=True) if rows else [[]] * len(results)
            kinds_ = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(list(g), k) for g, k in zip(got, kinds_, strict=True))], names=[*names, *results])

    out = source.mapInArrow(run, f"{kinds}payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *results)
