"""Prefix trie of conversations, by vertical bitmaps.

Each conversation becomes a path: the digests of its turns, in order. Paths are dealt to
tasks in ranges of their order (path, conversation id), so that the members of every node
lie next to each other, copies too. A task cuts its range into shards of at most
SHARD_CONVERSATIONS and about SHARD_TURNS turns. A shard indexes (position, turn) to a
bitset of its conversations; depth first, the intersection of a node's bitset with the
postings of the next position gives its children, popcounts give the members, and the
bitset of the paths that end at a depth gives the list of ends.

A node that no neighbouring shard can hold is done there, with the sums over its subtree.
The others lie on the first or last path of a task's range or on the path that two shards
of a task share; their parts are added up by key. What a shared path makes count twice
(children, leaves, words of a node) is taken off by one row for each of its nodes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patentlake.llm._io import bounded, discard, written

SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 18
#: every BASE-th conversation lends its first turns to those that follow it
BASE = 20
WORD = r"[^\x20\x09-\x0D]+"

_COLUMNS = ("key", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "first_end", "open", "parent_open", "part", "k", "path", "words")
_KINDS = "key binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, first_end long, open boolean, parent_open boolean, part int, k int, path array<binary>, words array<long>"
_ARROW = pa.schema([("key", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in _COLUMNS[2:9]), ("ends", pa.string()), ("first_end", pa.int64()), ("open", pa.bool_()), ("parent_open", pa.bool_()), ("part", pa.int32()), ("k", pa.int32()), ("path", pa.list_(pa.binary())), ("words", pa.list_(pa.int64()))])
_ROWS = 1024  # of a batch, in and out
_ROOT = b""


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, words): for each conversation the 16-byte digests of its turns in order, and their numbers of words.

    Turns are in the order of `turn`, null first; equal ones in the order of their digests.
    Null roles and texts are empty ones; rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.expr(rf"CAST(regexp_count(coalesce(CAST(`text` AS STRING), ''), r'{WORD}') AS LONG)")
    turn = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), digest.alias("digest"), words.alias("words")).alias("t"))
    of = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return of.select("conv_id", F.col("ts.digest").alias("path"), F.col("ts.words").alias("words"))


def rebuilt(paths: DataFrame, base: int = BASE) -> DataFrame:
    """Paths that begin with the first h turns of the conversation they branch from, h by the checksum of their id; then their own turns after h."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    bases = paths.where(F.col("conv_id") % base == 0).select(F.col("conv_id").alias("_base"), F.slice("path", 1, 3).alias("_path"), F.slice("words", 1, 3).alias("_words"))
    both = paths.withColumn("_h", h.cast("int")).withColumn("_base", F.col("conv_id") - F.col("conv_id") % base).join(bases, "_base", "left")

    def joined(own: str, lent: str) -> Column:
        return F.concat(F.coalesce(F.expr(f"slice({lent}, 1, _h)"), F.expr(f"slice({own}, 1, 0)")), F.expr(f"slice({own}, _h + 1, size({own}))"))

    return both.select("conv_id", joined("path", "_path").alias("path"), joined("words", "_words").alias("words"))


def _key(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


def _common(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


class Shard:
    """Conversations next to each other in the order of paths: (id, path, words) each.

    before and behind: the depths down to which nodes of the first and the last path may
    have members in the neighbouring shards.
    """

    def __init__(self, rows: list[tuple[int, list[bytes], list[int]]], before: int = -1, behind: int = -1) -> None:
        self.rows, self.before, self.behind = rows, before, behind
        self.postings: list[dict[bytes, int]] = [{} for _ in range(max((len(p) for _, p, _ in rows), default=0))]
        self.ends: dict[int, int] = {}
        for i, (_, path, _) in enumerate(rows):
            bit = 1 << i
            for at, turn in zip(self.postings, path, strict=False):
                at[turn] = at.get(turn, 0) | bit
            self.ends[len(path)] = self.ends.get(len(path), 0) | bit

    def children(self, node: int, depth: int) -> Iterator[tuple[bytes, int]]:
        """(turn, bitset) of each child of a node, in the order of their first members."""
        left = node & ~self.ends.get(depth, 0)
        while left:
            turn = self.rows[(left & -left).bit_length() - 1][1][depth]
            child = left & self.postings[depth][turn]
            yield turn, child
            left ^= child

    def _node(self, key: bytes, parent: dict | None, depth: int, bits: int) -> dict:
        members = list(_bits(bits))
        ends = [self.rows[i][0] for i in _bits(bits & self.ends.get(depth, 0))]
        is_open = (members[0] == 0 and depth <= self.before) or (members[-1] == len(self.rows) - 1 and depth <= self.behind)
        listed = ",".join(map(str, ends))
        return {
            "key": key, "depth": depth, "conv_id": min(self.rows[i][0] for i in members), "n_convs": len(members), "n_children": 0, "n_leaves": 0,
            "saved_tokens": (len(members) - 1) * self.rows[members[0]][2][depth - 1] if depth else 0,
            "ends": listed if is_open else hashlib.sha256(listed.encode()).hexdigest(), "first_end": ends[0] if ends else None, "open": is_open,
            "parent": parent and parent["key"], "parent_conv_id": parent and parent["conv_id"], "parent_open": bool(parent and parent["open"]),
        }

    def nodes(self) -> Iterator[dict]:
        """Every node, children before their parent, with sums over its subtree within the shard. Depth first, without recursion."""
        if not self.rows:
            return
        every = (1 << len(self.rows)) - 1
        stack = [(self._node(_ROOT, None, 0, every), self.children(every, 0))]
        while stack:
            at, left = stack[-1]
            step = next(left, None)
            if step is not None:
                at["n_children"] += 1
                node = self._node(_key(at["key"], step[0]), at, at["depth"] + 1, step[1])
                stack.append((node, self.children(step[1], node["depth"])))
                continue
            stack.pop()
            at["n_leaves"] = at["n_leaves"] or 1
            if stack:
                stack[-1][0]["n_leaves"] += at["n_leaves"]
                stack[-1][0]["saved_tokens"] += at["saved_tokens"]
            yield at


def overlap(last: list[bytes], words: list[int], first: list[bytes]) -> Iterator[dict]:
    """What two shards next to each other count twice, as one row for each node of the path they share.

    last and words: the last path of the one; first: the first path of the other.
    """
    shared, keys = _common(last, first), [_ROOT]
    for turn in last[:shared]:
        keys.append(_key(keys[-1], turn))
    below = 0
    for d in range(shared, -1, -1):
        below += words[d - 1] if d else 0
        yield {"key": keys[d], "depth": d, "n_convs": 0, "n_children": -int(d < shared), "n_leaves": -int(shared == len(last)), "saved_tokens": below, "open": True}


def shards(rows: Iterable[tuple[int, list[bytes], list[int]]], most: int, turns: int) -> Iterator[dict]:
    """Nodes and overlaps of one task's range; its first and last path (k 0 and 1) at the end."""
    first = last = None
    held: list[tuple[int, list[bytes], list[int]]] = []
    size = 0

    def done(following: tuple | None) -> Iterator[dict]:
        before = len(held[0][1]) if last is None else _common(last[1], held[0][1])
        behind = len(held[-1][1]) if following is None else _common(held[-1][1], following[1])
        yield from Shard(held, before, behind).nodes()
        if following is not None:
            yield from overlap(held[-1][1], held[-1][2], following[1])

    for row in rows:
        if held and (len(held) >= most or size + len(row[1]) > turns):
            yield from done(row)
            last, held, size = held[-1], [], 0
        first = first or row
        held.append(row)
        size += len(row[1])
    if held:
        yield from done(None)
        for k, (_, path, words) in enumerate((first, held[-1])):
            yield {"k": k, "path": path, "words": words}


def _batches(rows: Iterable[dict], part: int) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(itertools.islice(rows, _ROWS)):
        yield pa.RecordBatch.from_pylist([r | {"part": part} for r in some], schema=_ARROW)


def _rows(it: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in it:
        for i in range(0, batch.num_rows, _ROWS):
            yield from zip(*(batch.column(c).slice(i, _ROWS).to_pylist() for c in names), strict=True)


def _list_digests(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's list, from pieces that arrive in order; one piece is held at a time."""

    def digests() -> Iterator[dict]:
        for key, pieces in itertools.groupby(_rows(it, "key", "ends"), key=lambda r: r[0]):
            digest = hashlib.sha256()
            for n, (_, ends) in enumerate(pieces):
                digest.update((("," if n else "") + ends).encode())
            yield {"key": key, "ends_sha256": digest.hexdigest()}

    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    rows = digests()
    while some := list(itertools.islice(rows, _ROWS)):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def prefix_trie(turns: DataFrame, base: int = BASE, most: int = SHARD_CONVERSATIONS, size: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty ones, null turns come first, turns of equal number are
    ordered by digest; rows without a conv_id belong to none; an empty table has no node.
    Other columns are ignored. A conversation is one row of 24 bytes for each of its turns.
    Copies of a conversation, however many, lie in as many ranges as their number asks for.
    The SHA-256 of a list of ends is by nature computed in sequence: one task streams the
    pieces of a node's list, which the shards have joined already.
    """
    paths = written(conversation_paths(bounded(turns)), "paths")
    whole = written(rebuilt(paths, base), "rebuilt")

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(shards(_rows(it, "conv_id", "path", "words"), most, size), TaskContext.get().partitionId())

    dealt = whole.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = written(dealt.mapInArrow(run, _KINDS), "trie")
    discard(paths, whole)

    # one row for each task and end of its range
    borders = parts.where("k IS NOT NULL").select("part", "k", "path", "words")
    order = Window.orderBy("part", "k")
    met = borders.select("k", F.col("path").alias("first"), F.lag("path").over(order).alias("last"), F.lag("words").over(order).alias("words")).where("k = 0 AND last IS NOT NULL")
    shared = met.mapInArrow(lambda it: _batches((x for last, words, first in _rows(it, "last", "words", "first") for x in overlap(last, words, first)), -1), _KINDS)

    nodes = parts.where("k IS NULL")
    pieces = nodes.where("open AND first_end IS NOT NULL").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    lists = pieces.mapInArrow(_list_digests, "key binary, ends_sha256 string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    split = nodes.where("open").unionByName(shared).groupBy("key").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums, F.max("parent_conv_id").alias("parent_conv_id"), F.max("parent_open").alias("parent_open"))
    split = written(split.join(lists, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))), "split")

    out = [*(c for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), "ends_sha256"]
    every = nodes.where("NOT open").withColumn("ends_sha256", F.col("ends")).select("parent", "parent_open", *out).unionByName(split.select("parent", "parent_open", *out))
    above = split.select(F.col("key").alias("_key"), F.col("conv_id").alias("_conv_id"))
    hanging = every.where("parent_open").join(above, F.col("parent") == F.col("_key")).withColumn("parent_conv_id", F.col("_conv_id"))
    return every.where("NOT coalesce(parent_open, false)").select(*out).unionByName(hanging.select(*out))
