"""Suffix-array dedup of long repeated byte strings, by deep-shallow sorting.

Every byte covered by a string of `span` bytes that also starts elsewhere is removed. To
sort all suffixes of a corpus would move each byte `span` times; so the suffixes that can
matter are narrowed down first, without losing any:

1. Each window of `span` bytes has an anchor: the leftmost of its least-hashed grams of
   `gram` bytes. Equal windows have equal anchors at equal places, so windows fall into
   runs of neighbours that share an anchor, a run for about 90 bytes.
2. Equal runs are told by 128-bit digests of their bytes and are one from here on. A run
   that is there more than once (the inside of any repeated passage) needs no order.
3. What is left are anchors with several different runs: the ends of repeated passages.
   One copy of each run is fetched, and the suffixes that start at its windows are sorted
   with those of the runs of the same anchor. The sort is deep-shallow: multikey quicksort
   by the first 16 bytes, then blind tries for the groups that still agree. Neighbours in
   that order with a common prefix of `span` bytes are repeats.

Groups of more than `hot` different runs are dealt over tasks by blocks of `block`
window places relative to the anchor (only windows of one place can be equal), and each
block by what all of its windows cover. A task holds one such part of a group at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentlake.llm._io import bounded, discard, written
from patentlake.llm._text import prefix_hash, span_hash, text_slices

SPAN = 200
GRAM = 24
HOT = 256
BLOCK = 16
CHUNK_BYTES = 1 << 22  # a longer text is scanned in overlapping chunks
SORT_BYTES = 1 << 21  # runs that a task gathers before it sorts
SHALLOW = 2  # words of eight bytes that the quicksort looks at


def runs(data: np.ndarray, offs: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Rows, first windows, lengths, places of the anchor in the run, anchor hashes and two halves of a digest of the runs of a slice."""
    n = len(data)
    if n < span:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(7))
    at = np.arange(n - gram + 1)
    grams = span_hash(prefix_hash(data), at, at + gram)
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | at.astype(np.uint64)  # ties go to the leftmost
    width, have = span - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        step = width - have
        least = np.minimum(least[:-step], least[step:])
    anchor = (least & low).astype(np.int64)  # of the window that starts at each byte
    ends = np.repeat(offs[1:], np.diff(offs))[: len(anchor)]
    ok = np.arange(len(anchor)) + span <= ends
    first, last = ok.copy(), ok.copy()
    change = anchor[1:] != anchor[:-1]
    first[1:] &= ~ok[:-1] | change
    last[:-1] &= ~ok[1:] | change
    # windows of neighbouring texts never share an anchor: the grams of a window lie inside its text
    start, stop = np.flatnonzero(first), np.flatnonzero(last)
    raw = data.tobytes()
    digest = xxhash.xxh3_128_digest
    halves = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(start.tolist(), (stop + span).tolist(), strict=True)]), dtype=np.int64).reshape(-1, 2)
    return np.searchsorted(offs, start, side="right") - 1, start, stop - start + 1, anchor[start] - start, grams[anchor[start]].view(np.int64), halves[:, 0], halves[:, 1]


Word = Callable[[np.ndarray, np.ndarray], np.ndarray]  # the k-th word of each suffix


def multikey(order: np.ndarray, new: np.ndarray, word: Word, depth: int) -> None:
    """Quicksort each segment of order (it starts where new is set) by the first `depth` words, in place.

    All segments are parted at once by their middle member's word into less, equal and
    greater; equal ones go on with the next word. new then starts each run of equals.
    """
    slots, level = np.arange(len(order)), np.zeros(len(order), dtype=np.int64)
    fresh = new.copy()
    while len(slots):
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(slots)))
        keep = np.repeat((size > 1) & (level[first] < depth), size)
        slots, level, fresh = slots[keep], level[keep], fresh[keep]
        if not len(slots):
            return
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(slots)))
        member = order[slots]
        w = word(member, level)
        pivot = np.repeat(w[first + size // 2], size)
        side = np.where(w < pivot, 0, np.where(w > pivot, 2, 1))
        to, before = np.empty(len(slots), dtype=np.int64), first.copy()
        for part in range(3):
            own = side == part
            seen = np.cumsum(own)
            ahead = seen[first] - own[first]
            to[own] = (np.repeat(before - ahead, size) + seen - 1)[own]
            before = before + np.add.reduceat(own.astype(np.int64), first)
        member[to], side[to], level[to] = member.copy(), side.copy(), level.copy()
        order[slots] = member
        fresh[1:] |= side[1:] != side[:-1]
        new[slots] |= fresh
        level += side == 1


def blind_tries(order: np.ndarray, new: np.ndarray, word: Word, depth: int, width: int) -> np.ndarray:
    """Order each segment, whose members agree in `depth` words, by all `width` words, in place; returns whether each equals the next.

    A trie for each segment, all of a level at once: each member is compared with its
    trie's first; where they part gives the branch, and members that part at one place
    with one word make the next trie.
    """
    same = np.zeros(len(order), dtype=bool)
    slots, new = np.arange(len(order)), new.copy()
    known = np.full(len(order), depth, dtype=np.int64)
    while True:
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(new)))
        keep = np.repeat(size > 1, size)
        slots, known, trie = slots[keep], known[keep], np.repeat(np.arange(len(first)), size)[keep]
        if not len(slots):
            return same
        first = np.flatnonzero(np.append(True, trie[1:] != trie[:-1]))
        member = order[slots]
        leader = np.repeat(member[first], np.diff(np.append(first, len(trie))))
        place, key, side = known.copy(), np.zeros(len(slots), dtype=np.uint64), np.zeros(len(slots), dtype=np.int64)
        left = np.flatnonzero((place < width) & (member != leader))
        place[np.setdiff1d(np.arange(len(slots)), left, assume_unique=True)] = width
        while len(left):
            own, other = word(member[left], place[left]), word(leader[left], place[left])
            parts = own != other
            key[left[parts]], side[left[parts]] = own[parts], np.where(own[parts] < other[parts], -1, 1)
            left = left[~parts]
            place[left] += 1
            left = left[place[left] < width]
        branch = -side * place  # what parts early lies farther from the first
        by = np.lexsort((key, branch, side, trie))
        order[slots] = member[by]
        trie, side, branch, key, known = trie[by], side[by], branch[by], key[by], np.minimum(place[by] + 1, width)
        new = np.ones(len(by), dtype=bool)
        new[1:] = (trie[1:] != trie[:-1]) | (side[1:] != side[:-1]) | (branch[1:] != branch[:-1]) | (key[1:] != key[:-1])
        leaf = side == 0
        same[slots[:-1][leaf[:-1] & ~new[1:]]] = True
        slots, new, known = slots[~leaf], new[~leaf], known[~leaf]


def deep_shallow(groups: np.ndarray, word: Word, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes within their groups, which lie together, and whether each equals the next in all `width` words."""
    order = np.arange(len(groups))
    new = np.append(True, groups[1:] != groups[:-1])[: len(groups)]
    shallow = min(SHALLOW, width)
    multikey(order, new, word, shallow)
    # a segment of several goes on
    alone = new & np.append(new[1:], True)
    deep = np.flatnonzero(~alone)
    same = np.zeros(len(order), dtype=bool)
    if len(deep):
        part = order[deep]
        same[deep] = blind_tries(part, new[deep], word, shallow, width)
        order[deep] = part
    return order, same


def words_of(data: np.ndarray, start: np.ndarray, span: int) -> Word:
    """Big-endian words of the suffixes that start at the given bytes; beyond span they hold zeros. Eight bytes follow the last one."""
    eight = np.ndarray(len(data) - 7, dtype=">u8", buffer=data, strides=(1,))

    def word(member: np.ndarray, k: np.ndarray) -> np.ndarray:
        beyond = np.maximum(8 * k + 8 - span, 0).astype(np.uint64) << np.uint64(3)
        return (eight[start[member] + 8 * k].astype(np.uint64) >> beyond) << beyond

    return word


def repeated_windows(group: np.ndarray, place: np.ndarray, data: np.ndarray, at: np.ndarray, count: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Whether each window of runs, one after another, equals a window of another run of its group.

    Run k has `count[k]` windows, the first at data[at[k]], and its anchor `place[k]` bytes after that.
    """
    run = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    # windows that can be equal: of one group and place
    one = group[run] * np.int64(2 * span + 1) + (inner - place[run] + span)
    order = np.argsort(one, kind="stable")
    start = (at[run] + inner)[order]
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    sorted_, same = deep_shallow(one[order], words_of(padded, start, span), -(-span // 8))
    hit = same.copy()
    hit[1:] |= same[:-1]
    out = np.zeros(len(run), dtype=bool)
    out[order[sorted_[hit]]] = True
    return out


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: a run in one number: bits of its document beside the key, first byte, place of the anchor, number of windows
AT = (10, 31, 12, 10)


def _packed(more: np.ndarray, p: np.ndarray, o: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (((more << AT[1] | p) << AT[2] | o) << AT[3]) | n


def _unpacked(at: int) -> tuple[int, int, int, int]:
    n, at = at & ((1 << AT[3]) - 1), at >> AT[3]
    o, at = at & ((1 << AT[2]) - 1), at >> AT[2]
    return at >> AT[1], at & ((1 << AT[1]) - 1), o, n


def _find_runs(docs: DataFrame, span: int, gram: int) -> DataFrame:
    names = ["key", "at", "g", "s", "t"]

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keys, more = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "more"))
            for i, _, data, offs in text_slices(batch.column("text")):
                # only a text longer than a chunk makes a slice that needs cutting
                for lo in range(0, max(1, len(data)), CHUNK_BYTES):
                    part = data[lo : lo + CHUNK_BYTES + span - 1]
                    row, start, n, o, g, s, t = runs(part, np.clip(offs - lo, 0, len(part)) if lo or len(part) < len(data) else offs, span, gram)
                    at = _packed(more[i + row], start - offs[row] + lo, o, n)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[i + row], at, g, s, t)], names=names)

    return docs.mapInArrow(run, "key long, at long, g long, s long, t long")


def _fetch(texts: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """Bytes of each wanted run (key, at, g, c, k); runs of hot groups come in blocks."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("at", "g", "c", "k")).alias("want")).hint("shuffle_hash")
    names = ["key", "g", "blk", "same", "at", "c", "bytes"]

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: list[tuple] = []
            size = 0
            for key, more, text, want in zip(batch.column("key").to_pylist(), batch.column("more").to_pylist(), batch.column("text"), batch.column("want").to_pylist(), strict=True):
                raw = text.as_py().encode()
                for w in want:
                    of, p, o, n = _unpacked(w["at"])
                    if of != more:
                        continue
                    if w["k"] <= HOT:
                        cuts = [(0, 0, n, 0)]
                    else:  # window j lies at place j - o, between -span and 0
                        cuts = []
                        for b in range((span - o) // BLOCK, (span - o + n - 1) // BLOCK + 1):
                            least = b * BLOCK - span  # all windows of the block cover from its last place on to the end of its first window
                            same = xxhash.xxh3_64_intdigest(raw[p + o + least + BLOCK - 1 : p + o + least + span]) >> 1
                            cuts.append((b, max(0, least + o), min(n, least + BLOCK + o), same))
                    for b, lo, hi, same in cuts:
                        # the place of the anchor in what is left may lie before its first window or past its last
                        out.append((key, w["g"], b, same, _packed(more, p + lo, o - lo + OFF, hi - lo), w["c"], raw[p + lo : p + hi - 1 + span]))
                        size += hi - lo + span
                if size > SORT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=names)

    return texts.join(lists, "key").select("key", "more", "text", "want").mapInArrow(run, "key long, g long, blk long, same long, at long, c long, bytes binary")


def _sort_groups(fetched: DataFrame, span: int) -> DataFrame:
    """(key, at) of repeated windows in runs that occur once, by sorting each group's suffixes; their anchors' places are 0."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in it:
            ids = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in GROUP])
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            if last is not None and len(ids) and (ids[0] != last).any():
                cuts = np.append(0, cuts)
            before = np.append(0, np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy()))
            done = 0
            # what is enough is solved at the end of a group; a group that may go on is held
            while (k := int(np.searchsorted(before[cuts], before[done] + max(SORT_BYTES - size, 0)))) < len(cuts):
                held.append(batch.slice(done, cuts[k] - done))
                yield solve(pa.Table.from_batches(held))
                held, size, done = [], 0, int(cuts[k])
            held.append(batch.slice(done))
            size += int(before[-1] - before[done])
            last = ids[-1] if len(ids) else last
        if sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    def solve(table: pa.Table) -> pa.RecordBatch:
        groups = [table[x].to_numpy() for x in GROUP]
        key, at, c = (table[x].to_numpy() for x in ("key", "at", "c"))
        more, p, o, n = _unpacked(at)
        o = o - OFF
        raw = table["bytes"].to_pylist()
        first = np.cumsum([0, *(len(x) for x in raw)])[:-1]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        group = np.cumsum(np.append(True, np.any([x[1:] != x[:-1] for x in groups], axis=0)))
        hit = repeated_windows(group, o, data, first, n, span)
        hit[np.repeat(c > 1, n)] = False  # known to be repeated as a whole
        edges = np.cumsum(n)
        lo, hi = _intervals(hit)
        # intervals end with their run
        cut = np.unique(np.concatenate([lo, edges[:-1][hit[edges[:-1]] & hit[edges[:-1] - 1]]])) if len(lo) else lo
        stop = np.minimum(hi[np.searchsorted(lo, cut, side="right") - 1], np.append(cut[1:], len(hit))) if len(cut) else hi
        of = np.searchsorted(edges, cut, side="right")
        return pa.RecordBatch.from_arrays([pa.array(key[of]), pa.array(_packed(more[of], p[of] + cut - (edges[of] - n[of]), np.zeros(len(of), dtype=np.int64), stop - cut))], names=["key", "at"])

    return fetched.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(run, "key long, at long")


GROUP = ("g", "blk", "same")
OFF = 1024  # added to places of anchors, which may be negative in a block


def remove_repeats(docs: DataFrame, text: str = "text", span: int = SPAN, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """Every row of docs with n_bytes, n_removed, n_spans and kept (binary, or kept_sha256 with digest) in place of its text.

    Null text is empty and loses nothing, as does any text shorter than span that no other
    one overlaps. Equal rows are documents of their own: both lose what they share. An empty
    table gives an empty one. Columns named like a result are replaced, others pass through.
    span is at most 700.
    """
    if not gram < span <= 700:
        raise ValueError("span must lie between gram and 700")
    results = ("n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept")
    keep = [c for c in docs.columns if c not in (text, *results)]
    names = [f"k{i}" for i in range(len(keep))]
    plain = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    hashable = [F.col(n) for n in names if "map<" not in plain.schema[n].dataType.simpleString() and "variant" not in plain.schema[n].dataType.simpleString()]
    # a document's name: 64 bits to join by, 10 more to check
    plain = plain.withColumn("key", F.xxhash64(*hashable, "text")).withColumn("more", F.pmod(F.hash("text", *hashable), F.lit(1 << AT[0])).cast("long"))
    texts = plain.where(F.octet_length("text") >= span).select("key", "more", "text")
    found = written(_find_runs(texts, span, gram), "runs")
    one = [F.first(c).alias(c) for c in ("key", "at", "g")]  # any copy of a run
    parts = written(found.groupBy("s", "t").agg(F.count("*").alias("c"), *one), "parts")
    mixed = written(parts.groupBy("g").agg(F.count("*").alias("k")).where("k > 1"), "mixed")
    # both are joined with written tables, so that Spark can split a hot side at run time
    whole = written(found.join(parts.where("c > 1").select("s", "t"), ["s", "t"], "left_semi").select("key", "at"), "whole")
    discard(found)
    wanted = written(parts.join(mixed, "g").select("key", "at", "g", "c", "k"), "wanted")
    discard(parts, mixed)
    ends = written(_sort_groups(_fetch(texts, wanted, span), span), "ends")
    discard(wanted)
    spans = whole.unionByName(ends).groupBy("key").agg(F.collect_list("at").alias("spans")).hint("shuffle_hash")
    kinds = "".join(f"{n} {plain.schema[n].dataType.simpleString()}, " for n in names)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            size, removed, count, kept = [], [], [], []
            for value, more, spans_ in zip(batch.column("text"), batch.column("more").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw = value.as_py().encode()
                left, at, gone, n = [], 0, 0, 0
                end = -1
                own = (_unpacked(x) for x in spans_ or ())
                for p, q in sorted((p, p + count + span - 1) for of, p, _, count in own if of == more):
                    if p > end:
                        n += 1
                        left.append(raw[at:p])
                    if q > end:
                        gone += q - max(p, end)
                        at = end = q
                left.append(raw[at:])
                rest = b"".join(left)
                size.append(len(raw))
                removed.append(gone)
                count.append(n)
                kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(x, pa.int64()) for x in (size, removed, count)), pa.array(kept, pa.string() if digest else pa.binary())], names=[*names, *results])

    joined = plain.join(spans, "key", "left").select(*names, "more", "text", "spans")
    out = joined.mapInArrow(run, f"{kinds}n_bytes long, n_removed long, n_spans long, {results[-1]} {'string' if digest else 'binary'}")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *results)
