"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than a chunk is cut into chunks that overlap; each is pre-tokenised on its
own, those of texts of more than `long_chars` in tasks of their own. Whether a match starts at a place and where it ends depends on the text from there on only, so that
two chunks that share one boundary agree on all later ones: the first common boundary in
the overlap is where they are stitched. The pieces between stitches are encoded, and the
ids joined in order. Where an overlap holds no common boundary (one pre-token longer than
the overlap) the document is pre-tokenised again with an overlap twice as large.
Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentlake.llm._io import bounded
from patentlake.llm.tokens import vocabulary_path

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK_CHARS = 1 << 13
OVERLAP_CHARS = 1 << 9
LONG_CHARS = 1 << 15  # longer texts' chunks are dealt over tasks
ROWS = 256  # taken from a record batch at a time, to bound what a worker holds


def small(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


@functools.lru_cache(maxsize=1)
def pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def boundaries(text: str, last: bool, chunk: int, overlap: int) -> list[int]:
    """Starts of pre-tokens where a chunk may meet its neighbours: those that what follows can't change and where a text may be cut."""
    matches = pattern().findall(text)
    ends = np.cumsum([len(m) for m in matches], dtype=np.int64)
    if len(ends) and ends[-1] == len(text):
        starts = np.append(0, ends[:-1])
    else:  # a pattern that leaves gaps
        spans = np.array([m.span() for m in pattern().finditer(text)], dtype=np.int64).reshape(-1, 2)
        starts, ends = spans[:, 0], spans[:, 1]
    # a match that ends before the last character has seen the character after it
    near = ((starts <= overlap) | (starts >= chunk)) & (last | (ends < len(text) - 1))
    # after white space no cut is safe, because white space at a text's end is matched in another way
    return [a for a in starts[near].tolist() if not text[a - 1 : a].isspace()]


def stitch(chunks: list[tuple[int, int, list[int]]]) -> list[int] | None:
    """Cut places between neighbouring chunks, given (start, length, boundaries) of each; None if one has no common boundary."""
    cuts, at = [], 0
    for (start, _, own), (nxt, _, other) in zip(chunks, chunks[1:], strict=False):
        true = {start + b for b in own if start + b >= max(at, nxt)}
        common = next((nxt + b for b in other if nxt + b in true), None)
        if common is None:
            return None
        cuts.append(common)
        at = common
    return cuts


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(start, chunk) with each chunk reaching `overlap` characters into the next."""
    return [(a, text[a : a + chunk + overlap]) for a in range(0, max(len(text), 1), chunk)]


def encode_in_chunks(text: str, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> np.ndarray:
    """Ids of one text, by overlapping chunks; the same ids as encoding it whole."""
    enc = encoding(path)
    if len(text) <= chunk:
        return enc.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, dtype=np.uint32)
    while True:
        parts = cut(text, chunk, overlap)
        cuts = stitch([(a, len(t), boundaries(t, a + len(t) >= len(text), chunk, overlap)) for a, t in parts])
        if cuts is not None:
            break
        overlap *= 2
        if overlap >= len(text):
            cuts = []
            break
    edges = [0, *cuts, len(text)]
    return np.concatenate([np.asarray(enc.encode_ordinary(text[a:b]), dtype=np.uint32) for a, b in zip(edges, edges[1:], strict=False)])


def encode_texts(docs: DataFrame, text: str = "text", path: str | None = None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, long_chars: int = LONG_CHARS) -> DataFrame:
    """Every row of docs with `ids` (binary: little-endian unsigned 32-bit integers) in place of its text.

    Null or empty text: empty ids. Repeated rows each get a row; an empty table gives an
    empty one. Other columns pass through; one named ids is replaced. Texts of up to
    long_chars need no shuffle; the chunks of longer ones are dealt over tasks and meet again by row.
    """
    path = path or vocabulary_path(RANKS)
    keep = [c for c in docs.columns if c not in (text, "ids")]
    names = [f"k{i}" for i in range(len(keep))]
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kinds = "".join(f"{n} {source.schema[n].dataType.simpleString()}, " for n in names)

    def whole(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(it):
            ids = [encode_in_chunks(t, path, chunk, overlap).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(ids, type=pa.binary())], names=[*names, "ids"])

    def plan(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in batch.to_pylist():
                t = row.pop("text")
                for k, (a, part) in enumerate(cut(t, chunk, overlap)):
                    yield pa.RecordBatch.from_pylist([row | {"part": k, "start": a, "size": len(t), "chunk": part}], schema=chunk_type)

    def edge_lists(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            near = [boundaries(c, a + len(c) >= n, chunk, overlap) for a, n, c in zip(*(batch.column(x).to_pylist() for x in ("start", "size", "chunk")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("row", "part", "start")), pa.array([len(c) for c in batch.column("chunk").to_pylist()], pa.int64()), pa.array(near, pa.list_(pa.int64()))], names=["row", "part", "start", "len", "near"])

    def join_cuts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        cuts = stitch([(r["start"], r["len"], r["near"]) for r in rows])
        if cuts is None:  # one pre-token longer than the overlap: the row is encoded whole
            edges = [(r["part"], -1, -1) for r in rows]
        else:
            ends = [0, *cuts, rows[-1]["start"] + rows[-1]["len"]]
            edges = [(r["part"], ends[i], ends[i + 1]) for i, r in enumerate(rows)]
        return pa.table({"row": [key[0].as_py()] * len(edges), "part": [e[0] for e in edges], "lo": [e[1] for e in edges], "hi": [e[2] for e in edges]}, schema=pa.schema([("row", pa.string()), ("part", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())]))

    def encode_pieces(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for batch in it:
            got = []
            for a, lo, hi, c in zip(*(batch.column(x).to_pylist() for x in ("start", "lo", "hi", "chunk")), strict=True):
                got.append(np.asarray(enc.encode_ordinary(c[lo - a : hi - a]), dtype="<u4").tobytes() if lo >= 0 else b"")
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("part"), batch.column("lo"), pa.array(got, pa.binary())], names=["row", "part", "lo", "piece"])

    def join_pieces(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            got = [b"".join(x) for x in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(got, pa.binary())], names=[*names, "ids"])

    short = source.where(F.length("text") <= long_chars).mapInArrow(whole, f"{kinds}ids binary")
    long = source.where(F.length("text") > long_chars).select("*", F.sha2("text", 256).alias("row"))
    chunk_type = pa.schema([("row", pa.string()), ("part", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("chunk", pa.string())])
    chunks = long.select("row", "text").dropDuplicates(["row"]).mapInArrow(plan, "row string, part long, start long, size long, chunk string").repartition("row", "part")
    edges = chunks.mapInArrow(edge_lists, "row string, part long, start long, len long, near array<long>").groupBy("row").applyInArrow(join_cuts, "row string, part long, lo long, hi long")
    parts = chunks.join(edges, ["row", "part"]).mapInArrow(encode_pieces, "row string, part long, lo long, piece binary")
    ids = parts.groupBy("row").agg(F.min("lo").alias("least"), F.array_sort(F.collect_list(F.struct("part", "piece"))).alias("pieces"))
    joined = long.join(ids, "row", "left")
    stitched = joined.where("least >= 0").select(*names, F.col("pieces.piece").alias("pieces")).mapInArrow(join_pieces, f"{kinds}ids binary")
    again = joined.where("least is null or least < 0").select(*names, "text").mapInArrow(whole, f"{kinds}ids binary")
    out = short.unionByName(stitched).unionByName(again)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "ids")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Rows with `ids` plus `decoded` (binary): the raw bytes of the ids, one after another. Null ids: empty."""
    path = path or vocabulary_path(RANKS)
    names = encoded.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "decoded")

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for batch in small(it):
            out = [enc.decode_bytes(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in batch.column("ids").to_pylist()]
            kept = [c for c in names if c != "decoded"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.binary())], names=[*kept, "decoded"])

    return encoded.mapInArrow(run, f"{kinds}, decoded binary")


def digests(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every row, in place of its text."""
    done = decode_ids(encode_texts(docs, text, **options))
    keep = [c for c in done.columns if c not in ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")]
    return done.select(*[F.col(f"`{c}`") for c in keep], (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def brute_digests(text: str | None, path: str) -> tuple[int, str, str]:
    """What tiktoken gives for one text."""
    ids = encoding(path).encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
