"""Benchmark decontamination: a prefix-filtered set join with exact containment.

An item is cut into windows of 13 words (an item of fewer is one window). A window is
found where all its shingles of five words are found, so one shingle that must be there is
a sufficient prefix: its rarest, by counts over the whole corpus. Documents are probed by
these prefix shingles only. A match gives the one place where the window can start
(positional bound), which must leave room for the window inside the document (length
bound); there the window's words are compared, by hash and then byte by byte.

Up to `block_windows` rows of windows and 64 MB (bounds on what is broadcast) documents aren't
shuffled: every task holds the windows. A larger benchmark is joined by a shuffle: of the
documents' shingles those that a sieve of fixed size lets pass, with the words around them,
meet the windows of their prefix; what is found meets the documents again by the hash of
their text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentlake.llm._io import bounded, written
from patentlake.llm._text import ALNUM_WORD, LOWER, shingle_hashes, text_slices, word_hashes, words

WINDOW = 13
SHINGLE = 5
BLOCK_WINDOWS = 100_000
BLOCK_BYTES = 1 << 26
SIEVE_BITS = 1 << 27  # at most; 16 MB


def _words_of(data: np.ndarray, offs: np.ndarray):
    low = LOWER[data]
    start, end, rows = words(low, offs, ALNUM_WORD)
    return low, start, end, rows, word_hashes(low, start, end)


def _window_rows(it: Iterable[pa.RecordBatch], window: int, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out = []
        ids = batch.column("item").to_pylist()
        for i, _, data, offs in text_slices(batch.column("text")):
            low, start, end, rows, wh = _words_of(data, offs)
            for r in range(len(rows) - 1):
                a, b = int(rows[r]), int(rows[r + 1])
                n = min(window, b - a)
                if not n:
                    continue
                s = min(shingle, n)
                whole, parts = shingle_hashes(wh[a:b], n).view(np.int64), shingle_hashes(wh[a:b], s).view(np.int64)
                terms = [low[x:y].tobytes() for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)]
                for k in range(len(whole)):
                    out.append((ids[i + r], n, s, int(whole[k]), b" ".join(terms[k : k + n]), parts[k : k + n - s + 1].tolist()))
        if out:
            item, n, s, h, text, parts = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(n, pa.int64()), pa.array(s, pa.int64()), pa.array(h, pa.int64()), pa.array(text, pa.binary()), pa.array(parts, pa.list_(pa.int64()))], names=["item", "n", "s", "hash", "words", "shingles"])


class Probe:
    """Sorted hashes behind a bitmap that turns most look-ups away."""

    BITS = np.uint64((1 << 22) - 1)

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[(keys & self.BITS).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Indexes of hashes that are among the keys."""
        at = np.flatnonzero(self.seen[(hashes & self.BITS).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0]
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        return at[self.keys[place] == hashes[at]]


def _inside(at: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
    """Which runs of n words from `at` stay within a row."""
    return at + n <= rows[np.searchsorted(rows, at, side="right")]


class Sieve:
    """A bitmap of hashes; lets all of them pass, and few others while it isn't full."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, np.uint64(64 * len(words) - 1)

    def passing(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return np.flatnonzero((self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))


def _sieve(hashes: DataFrame, column: str) -> Broadcast:
    """Sieve of a column of hashes; what reaches the driver is bounded by SIEVE_BITS."""
    n = hashes.agg(F.approx_count_distinct(column)).first()[0]
    bits = min(SIEVE_BITS, max(1 << 16, 1 << (16 * n + 1).bit_length()))
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    rows = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("bits")).toPandas()
    words = np.zeros(bits >> 6, dtype=np.uint64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(words)


def _shingle_counts(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """How often each of the given shingles (shingle, s) occurs in all documents."""
    sieve = _sieve(shingles, "shingle")
    sizes = [r[0] for r in shingles.select("s").distinct().collect()]  # at most five

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sieve(sieve.value)
        for batch in it:
            for _, _, data, offs in text_slices(batch.column("text")):
                _, _, _, rows, wh = _words_of(data, offs)
                for s in sizes:
                    hashes = shingle_hashes(wh, s)
                    at = held.passing(hashes)
                    some, n = np.unique(hashes[at[_inside(at, s, rows)]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(np.full(len(some), s)), pa.array(n)], names=["shingle", "s", "n"])

    counted = docs.select("text").mapInArrow(run, "shingle long, s long, n long").groupBy("shingle", "s").agg(F.sum("n").alias("n"))
    return counted.join(shingles, ["shingle", "s"], "left_semi")


class _Block:
    """Windows of a block by their prefix shingle."""

    def __init__(self, rows: dict[str, np.ndarray]) -> None:
        self.by_length = {}
        for s in np.unique(rows["s"]).tolist():
            own = np.flatnonzero(rows["s"] == s)
            prefix = rows["prefix"][own].view(np.uint64)
            order = own[np.argsort(prefix, kind="stable")]
            self.by_length[s] = (Probe(np.unique(prefix)), rows["prefix"][order].view(np.uint64), order)
        self.rows = rows

    def find(self, low, start, end, bounds, wh) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window."""
        places, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for s, (probe, prefixes, order) in self.by_length.items():
            hashes = shingle_hashes(wh, s)
            at = probe.hits(hashes)
            lo, hi = np.searchsorted(prefixes, hashes[at]), np.searchsorted(prefixes, hashes[at], side="right")
            reps = hi - lo
            window = order[np.repeat(lo, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)]
            at = np.repeat(at, reps)
            row = np.searchsorted(bounds, at, side="right") - 1
            first = at - self.rows["offset"][window]
            n = self.rows["n"][window]
            ok = (first >= bounds[row]) & (first + n <= bounds[row + 1])  # positional and length bounds
            first, window, n = first[ok], window[ok], n[ok]
            for size in np.unique(n).tolist():
                own = np.flatnonzero(n == size)
                f, w = first[own], window[own]
                h = shingle_hashes(wh, size)[f].view(np.int64) == self.rows["hash"][w]
                f, w = f[h], w[h]
                exact = [b" ".join(low[x:y].tobytes() for x, y in zip(start[a : a + size].tolist(), end[a : a + size].tolist(), strict=True)) == self.rows["words"][v] for a, v in zip(f.tolist(), w.tolist(), strict=True)]
                places.append(f[exact] if len(f) else f)
                found.append(w[exact] if len(w) else w)
        return np.concatenate(places), np.concatenate(found)


def _merge(spans: np.ndarray) -> np.ndarray:
    """Union of half-open intervals, as sorted disjoint ones."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return np.column_stack([spans[at, 0], np.append(reach[at[1:] - 1], reach[-1])])


def _broadcast_join(source: DataFrame, names: list[str], prefixed: DataFrame) -> DataFrame:
    """source with n_words, items and spans (word positions); the windows are held by every task."""
    pdf = prefixed.toPandas()
    rows = {c: pdf[c].to_numpy(dtype=np.int64) for c in ("n", "s", "hash", "offset", "prefix")} | {"words": [bytes(w) for w in pdf["words"]], "item": pdf["item"].tolist()}
    held = source.sparkSession.sparkContext.broadcast(rows)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, item, size = _Block(held.value), held.value["item"], held.value["n"]
        for batch in it:
            m = batch.num_rows
            n_words = np.zeros(m, dtype=np.int64)
            spans, items = [np.zeros((0, 2), dtype=np.int64)] * m, [[]] * m
            for i, _, data, offs in text_slices(batch.column("text")):
                low, start, end, bounds, wh = _words_of(data, offs)
                n_words[i : i + len(bounds) - 1] = np.diff(bounds)
                at, found = index.find(low, start, end, bounds, wh)
                row = np.searchsorted(bounds, at, side="right") - 1
                for r in np.unique(row).tolist():
                    own = row == r
                    f = at[own] - bounds[r]
                    spans[i + r] = _merge(np.column_stack([f, f + size[found[own]]]))
                    items[i + r] = sorted({item[v] for v in found[own].tolist()})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n_words), pa.array(items, pa.list_(pa.string())), pa.array([x.tolist() for x in spans], PAIRS)], names=[*names, "n_words", "items", "hit_spans"])

    return source.mapInArrow(run, _kinds(source, names) + "n_words long, items array<string>, hit_spans array<array<long>>")


def _shuffle_join(source: DataFrame, names: list[str], prefixed: DataFrame, window: int) -> DataFrame:
    """What _broadcast_join gives, with the windows met by a shuffle of the prefix shingles."""
    sieve = _sieve(prefixed, "prefix")
    sizes = [r[0] for r in prefixed.select("s").distinct().collect()]  # at most five
    said = F.coalesce("text", F.lit(""))
    named = source.withColumn("h1", F.xxhash64(said)).withColumn("h2", F.xxhash64(F.lit(1), said))

    def probes(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sieve(sieve.value)
        names_ = ["h1", "h2", "prefix", "s", "at", "first", "around"]
        for batch in it:
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            for i, _, data, offs in text_slices(batch.column("text")):
                low, start, end, bounds, wh = _words_of(data, offs)
                for s in sizes:
                    hashes = shingle_hashes(wh, s)
                    at = held.passing(hashes)
                    at = at[_inside(at, s, bounds)]
                    row = np.searchsorted(bounds, at, side="right") - 1
                    # all words that a window with this shingle can have
                    lo, hi = np.maximum(at - window + s, bounds[row]), np.minimum(at + window, bounds[row + 1])
                    around = [b" ".join(low[x:y].tobytes() for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(h1[i + row]), pa.array(h2[i + row]), pa.array(hashes[at].view(np.int64)), pa.array(np.full(len(at), s)), pa.array(at - bounds[row]), pa.array(lo - bounds[row]), pa.array(around, pa.binary())], names=names_)

    def verify(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ok, firsts = np.zeros(batch.num_rows, dtype=bool), np.zeros(batch.num_rows, dtype=np.int64)
            for r, x in enumerate(batch.select(["at", "first", "around", "offset", "n", "words"]).to_pylist()):
                firsts[r] = x["at"] - x["offset"]
                skip = firsts[r] - x["first"]  # positional bound: the window starts among these words, and they are enough
                ok[r] = skip >= 0 and b" ".join(x["around"].split(b" ")[skip : skip + x["n"]]) == x["words"]
            cols = [batch.column(c) for c in ("h1", "h2", "n", "item")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(firsts)], names=["h1", "h2", "n", "item", "first"]).filter(pa.array(ok))

    def count(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n_words = np.zeros(batch.num_rows, dtype=np.int64)
            for i, j, data, offs in text_slices(batch.column("text")):
                n_words[i:j] = np.diff(words(LOWER[data], offs, ALNUM_WORD)[2])
            spans = [_merge(np.array([(f, f + n) for f, n in zip(x or (), y or (), strict=True)], dtype=np.int64).reshape(-1, 2)).tolist() for x, y in zip(batch.column("firsts").to_pylist(), batch.column("ns").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n_words), batch.column("items"), pa.array(spans, PAIRS)], names=[*names, "n_words", "items", "hit_spans"])

    met = named.select("h1", "h2", "text").mapInArrow(probes, "h1 long, h2 long, prefix long, s long, at long, first long, around binary").join(prefixed, ["prefix", "s"])
    hits = met.mapInArrow(verify, "h1 long, h2 long, n long, item string, first long").distinct()
    found = written(hits.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("item")).alias("items"), F.collect_list(F.struct("first", "n")).alias("at")), "found")
    joined = named.join(found, ["h1", "h2"], "left").select(*names, "text", F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("at.first").alias("firsts"), F.col("at.n").alias("ns"))
    return joined.mapInArrow(count, _kinds(source, names) + "n_words long, items array<string>, hit_spans array<array<long>>")


PAIRS = pa.list_(pa.list_(pa.int64()))


def _kinds(source: DataFrame, names: list[str]) -> str:
    return "".join(f"{n} {source.schema[n].dataType.simpleString()}, " for n in names)


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Every row of docs with n_words, n_hit, items (sorted ids as strings) and hit_spans ([first word, end) pairs).

    Null or empty texts have no words. Items with null text have no windows; items with a
    null id are ignored; rows of one id are one item. Empty docs give an empty table; an
    empty benchmark hits nothing. Repeated rows each get a row; columns named like a
    result are replaced, others pass through. At most block_windows rows of windows (and
    BLOCK_BYTES) are broadcast; more are joined by a shuffle, with the same result.
    """
    results = ("n_words", "n_hit", "items", "hit_spans")
    keep = [c for c in docs.columns if c not in results]
    names = [f"k{i}" for i in range(len(keep))]
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").cast("string").alias("text"))

    tidy = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text")).where("item is not null")
    windows = tidy.mapInArrow(lambda it: _window_rows(it, window, shingle), "item string, n long, s long, hash long, words binary, shingles array<long>").distinct()
    windows = written(windows, "windows")
    each = windows.select("item", "n", "s", "hash", "words", F.posexplode("shingles").alias("offset", "shingle"))
    counts = _shingle_counts(source.select("text"), each.select("s", "shingle").distinct())
    rank = F.struct("count", "offset")
    # a window with a shingle that no document holds isn't found anywhere
    counted = each.join(counts.withColumnRenamed("n", "count"), ["shingle", "s"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    prefixed = counted.groupBy("item", "n", "s", "hash", "words").agg(F.min_by("offset", rank).alias("offset"), F.min_by("shingle", rank).alias("prefix"), F.min("count").alias("least")).where("least > 0").drop("least")
    prefixed = written(prefixed.withColumn("offset", F.col("offset").cast("long")), "prefixes")
    size = prefixed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words") + F.octet_length("item")), F.lit(0))).first()
    small = size[0] <= block_windows and size[1] <= BLOCK_BYTES
    out = _broadcast_join(source, names, prefixed) if small else _shuffle_join(source, names, prefixed, window)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0])
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_words", n_hit.alias("n_hit"), "items", "hit_spans")


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, **options) -> DataFrame:
    """find_items with `contaminated`: some words are hit, and at least one in `share`."""
    found = find_items(docs, items, **options)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
