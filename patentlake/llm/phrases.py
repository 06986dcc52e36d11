"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are runs of three words, edges runs of four. Texts are read twice: once to count
words, once to aggregate edges. A word that occurs fewer times than a phrase must is in no
phrase, so it ends a run like the end of a piece does. Every position gives the longest run
that begins there: an edge, or what is left at the end of a piece.

Only these are shuffled, dealt by their first two words; where both are hot words, by the
third too, and so on, so that no pair with many continuations lands in one task. Sorted,
they give the counts of all lengths in one pass: a node's is the flow out of it plus the
pieces that end in it, a pair's the flow of its nodes plus the pieces that end in it.

A node through which all comes from one edge and goes on to one (its count is both their
weights) is unary. Paths through unary nodes are compacted in rounds: each path picks one
of its ends by coins that its nodes toss, and two that meet at a node become one. Inside
a path all edges and nodes have its weight, so that only the nodes at its ends need
their own counts for the parts of a phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patentlake.llm._io import bounded, discard, written
from patentlake.llm._text import LOWER, mix, text_slices, word_hashes, words

LEAST, TOP = 30, 2000
LONGEST = 4
#: words with ids in every task, by at most so many hashes of 8 bytes; others go by their hash
MOST_WORDS = 1 << 20
#: a word with more than this part of all occurrences is hot
HOT_PART = 1000
ROUNDS = 6
#: the best of so many parts of a language are ranked on their own first
SALTS = 16
SLICE = 4 << 20

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_WORD = ~_BREAK
_WORD[[0x20, 9]] = False
_IDS = ("a", "b", "c", "d")


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Different languages of a batch, and the number of each row's."""
    coded = column.fill_null("und").dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def _language_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


@dataclass
class _Words:
    """Words of a slice: places, hashes (of language and word) and whether the next word is in the same piece."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    joined: np.ndarray


def _split(data: np.ndarray, offs: np.ndarray, language: np.ndarray) -> _Words:
    """language: hash of each row's."""
    low = LOWER[data]
    start, end, at = words(low, offs, _WORD)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(at))
    breaks = np.cumsum(_BREAK[low], dtype=np.int32) if len(low) else np.zeros(0, dtype=np.int32)
    joined = np.zeros(len(start), dtype=bool)
    if len(start):
        joined[:-1] = (row[1:] == row[:-1]) & (breaks[start[1:]] == breaks[end[:-1] - 1])
    return _Words(low, start, end, row, mix(word_hashes(low, start, end) + language[row]), joined)


def _gather(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as strings."""
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    at = np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(low[at]))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[str], np.ndarray, _Words]]:
    names, code = _languages(batch.column("lang"))
    hashes = np.array([_language_hash(x) for x in names], dtype=np.uint64)
    for i, j, data, offs in text_slices(batch.column("text"), SLICE):
        yield names, code[i:j], _split(data, offs, hashes[code[i:j]])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, hash, n) of docs with lang and text."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for names, code, w in _slices(batch):
                kept, first, n = np.unique(w.hash, return_index=True, return_counts=True)
                langs = pa.DictionaryArray.from_arrays(pa.array(code[w.row[first]]), pa.array(names, pa.string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs, _gather(w.low, w.start[first], w.end[first]), pa.array(kept.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "word", "hash", "n"])

    found = docs.mapInArrow(run, "lang string, word string, hash long, n long")
    return found.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Ids of frequent words, 1 the most frequent; 0: in no phrase. Words beyond the table have negative ids, from their hashes."""

    sorted: np.ndarray
    ids: np.ndarray
    complete: bool
    hot: int

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        other = np.int64(0) if self.complete else -(hashes >> np.uint64(1)).astype(np.int64) - 1
        if not len(self.sorted):
            return np.zeros(len(hashes), dtype=np.int64) + other
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.ids[at], other)


def vocabulary(counts: DataFrame, least: int, most_words: int = MOST_WORDS) -> Vocabulary:
    """The words of least occurrences or more; of more than most_words of them, those above a power of two that fit."""
    sizes = {r["e"]: (r["w"], r["n"]) for r in counts.where(F.col("n") >= least).groupBy(F.floor(F.log2("n")).alias("e")).agg(F.count("*").alias("w"), F.sum("n").alias("n")).collect()}
    total, from_, held = sum(n for _, n in sizes.values()), least, 0
    complete = sum(w for w, _ in sizes.values()) <= most_words
    if not complete:
        from_ = 1 << 62
        for e in sorted(sizes, reverse=True):
            held += sizes[e][0]
            if held > most_words:
                break
            from_ = max(1 << e, least)
    kept = counts.where(F.col("n") >= from_).select("hash", "n").toArrow()
    hashes, n = kept.column("hash").to_numpy().view(np.uint64), kept.column("n").to_numpy()
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two frequent words share a hash of 64 bits")
    order = np.lexsort((hashes, -n))
    ids = np.empty(len(n), dtype=np.int64)
    ids[order] = np.arange(1, len(n) + 1)
    by = np.argsort(hashes)
    return Vocabulary(hashes[by], ids[by], complete, int((n * HOT_PART > total).sum()))


def _longest(ids: np.ndarray, joined: np.ndarray) -> list[np.ndarray]:
    """For each word that another follows: ids of the run of up to four words there, 0 where it ends before."""
    n = len(ids)
    on = np.zeros(n + LONGEST, dtype=bool)
    if n:
        on[: n - 1] = joined[:-1] & (ids[:-1] != 0) & (ids[1:] != 0)
    far = np.concatenate([ids, np.zeros(LONGEST, dtype=np.int64)])
    out, going = [ids], np.ones(n, dtype=bool)
    for k in range(1, LONGEST):
        going = going & on[k - 1 : n + k - 1]
        out.append(np.where(going, far[k : n + k], 0))
    some = np.flatnonzero(out[1] != 0)
    return [x[some] for x in out]


def _summed(runs: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal runs once, with the sum of their numbers (a run may stay split where hashes meet)."""
    key = np.zeros(len(n), dtype=np.uint64)
    for x in runs:
        key = mix(key + x.view(np.uint64))
    order = np.argsort(key)
    runs = [x[order] for x in runs]
    first = np.ones(len(n), dtype=bool)
    first[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in runs]) if len(n) > 1 else False
    at = np.flatnonzero(first)
    return [x[at] for x in runs], np.add.reduceat(n[order], at) if len(at) else n


def longest_runs(docs: DataFrame, ids: Vocabulary) -> DataFrame:
    """(a, b, c, d, n): edges and what is left at the ends of pieces, summed up in each batch."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for _, _, w in _slices(batch):
                found = _longest(shared.value(w.hash), w.joined)
                runs, n = _summed(found, np.ones(len(found[0]), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*map(pa.array, runs), pa.array(n)], names=[*_IDS, "n"])

    return docs.mapInArrow(run, "a long, b long, c long, d long, n long")


class _Levels:
    """Counts of sorted runs by their first 4, 3 and 2 words, batch by batch; what a batch ends with waits for the next."""

    def __init__(self, least: int, hot: int) -> None:
        self.least, self.hot, self.waiting = least, hot, {}

    def _out(self, k: int, keys: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
        """Those that are frequent, or may have parts in other tasks: all their words but at most one are hot."""
        split = np.ones(len(n), dtype=bool)
        for x in keys[:k]:
            split &= (x > 0) & (x <= self.hot)
        some = np.flatnonzero((keys[k - 1] != 0) & ((n >= self.least) | (split if k < LONGEST else False)))
        return [*(x[some] for x in keys[:k]), *(np.zeros(len(some), dtype=np.int64) for _ in range(LONGEST - k)), n[some]]

    def add(self, runs: list[np.ndarray], n: np.ndarray) -> Iterator[list[np.ndarray]]:
        changed = np.zeros(len(n), dtype=bool)
        changed[0] = True
        for k in range(1, LONGEST + 1):
            changed[1:] |= runs[k - 1][1:] != runs[k - 1][:-1]
            if k == 1:
                continue
            at = np.flatnonzero(changed)
            keys, sums = [x[at] for x in runs[:k]], np.add.reduceat(n, at)
            if k in self.waiting:
                old, so_far = self.waiting[k]
                if all(x[0] == y for x, y in zip(keys, old, strict=True)):
                    sums[0] += so_far
                else:
                    keys, sums = [np.append(y, x) for x, y in zip(keys, old, strict=True)], np.append(so_far, sums)
            self.waiting[k] = [x[-1] for x in keys], sums[-1]
            yield self._out(k, [x[:-1] for x in keys], sums[:-1])

    def rest(self) -> Iterator[list[np.ndarray]]:
        for k, (keys, n) in self.waiting.items():
            yield self._out(k, [np.array([x]) for x in keys], np.array([n]))


def gram_counts(runs: DataFrame, least: int, hot: int) -> DataFrame:
    """(a, b, c, d, n) of all pairs (c and d 0), nodes (d 0) and edges with n >= least, by node flow and ends of pieces."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _Levels(least, hot)
        pack = lambda x: pa.RecordBatch.from_arrays([pa.array(y, pa.int64()) for y in x], names=[*_IDS, "n"])
        for batch in it:
            if batch.num_rows:
                ids = [batch.column(c).to_numpy() for c in _IDS]
                yield from map(pack, levels.add(ids, batch.column("n").to_numpy()))
        yield from map(pack, levels.rest())

    is_hot = [(F.col(c) > 0) & (F.col(c) <= hot) for c in _IDS]
    third, fourth = F.when(is_hot[0] & is_hot[1], F.col("c")), F.when(is_hot[0] & is_hot[1] & is_hot[2], F.col("d"))
    found = runs.repartition("a", "b", third, fourth).sortWithinPartitions(*_IDS).mapInArrow(run, "a long, b long, c long, d long, n long")
    return found.groupBy(*_IDS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def compacted(edges: DataFrame, nodes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(ids, n, f_start, f_end): paths through unary nodes, with the counts of the nodes where they begin and end.

    Each round merges about a quarter of the unary nodes that are left; a path that stays in pieces is as right.
    """
    start = nodes.select("a", "b", "c", F.col("n").alias("f_start"))
    end = nodes.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("c").alias("d"), F.col("n").alias("f_end"))
    paths = edges.join(start, ["a", "b", "c"]).join(end, ["b", "c", "d"]).select(F.array(*_IDS).alias("ids"), "n", "f_start", "f_end")
    for k in range(rounds):
        ends = [F.expr(f"element_at(ids, {i})") for i in (-3, -2, -1)]
        starts = [F.expr(f"element_at(ids, {i})") for i in (1, 2, 3)]
        coin = lambda node: F.xxhash64(*node, F.lit(k)) % 2 == 0  # noqa: E731, B023
        to_end = (F.col("f_end") == F.col("n")) & coin(ends)
        to_start = ~to_end & (F.col("f_start") == F.col("n")) & coin(starts)
        # at a node at most one path ends and one begins; a path that picks none is alone under its first edge
        meets = F.when(to_end, F.array(*ends)).when(to_start, F.array(*starts)).otherwise(F.slice("ids", 1, 4))
        path = F.struct("ids", "n", "f_start", "f_end")
        met = paths.groupBy(meets.alias("at")).agg(F.any_value(F.when(to_end, path), True).alias("l"), F.any_value(F.when(to_start, path), True).alias("r"), F.any_value(F.when(~to_end & ~to_start, path), True).alias("o"))
        both = F.struct(F.concat("l.ids", F.expr("slice(r.ids, 4, size(r.ids))")).alias("ids"), F.col("l.n").alias("n"), F.col("l.f_start").alias("f_start"), F.col("r.f_end").alias("f_end"))
        merged = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), F.array(both)).otherwise(F.array_compact(F.array("l", "r", "o")))
        paths = met.select(F.explode(merged).alias("p")).select("p.*")
    return paths


def _edges_of(paths: DataFrame) -> DataFrame:
    """(a, b, c, d, n, f_first, f_rest): the edges of paths, with the counts of the nodes before and behind."""
    at = paths.select("*", F.explode(F.expr("sequence(1, size(ids) - 3)")).alias("i"))
    ids = [F.expr(f"element_at(ids, i + {k})").alias(c) for k, c in enumerate(_IDS)]
    return at.select(*ids, "n", F.expr("if(i = 1, f_start, n)").alias("f_first"), F.expr("if(i = size(ids) - 3, f_end, n)").alias("f_rest"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), in decimals of up to 38 digits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(2000000).cast("decimal(7,0)") * wide(a), wide(left) + wide(right))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, most_words: int = MOST_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """The best `top` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its worst cut into two parts; phrases of which a longer one
    has 80 % of the occurrences are left out. Null texts are empty, null languages `und`;
    repeated rows count each time; an empty table has no phrases; other columns are ignored.
    A word, a pair or a language may have any share of the occurrences. Words are told
    apart by hashes of 64 bits of language and word; two frequent ones that share one are
    found and reported as an error.
    """
    docs = bounded(docs).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    counts = written(word_counts(docs), "words")
    ids = vocabulary(counts, least, most_words)
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def numbered(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value(batch.column("hash").to_numpy().view(np.uint64))), batch.column("lang"), batch.column("word"), batch.column("n")], names=["id", "lang", "word", "f"])

    known = written(counts.where(F.col("n") >= least).select("hash", "lang", "word", "n").mapInArrow(numbered, "id long, lang string, word string, f long"), "vocabulary")
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    grams = written(gram_counts(longest_runs(docs, ids), least, ids.hot), "grams")
    discard(counts)

    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    pairs = grams.where("c = 0").select("a", "b", "n")
    nodes = grams.where("c <> 0 AND d = 0").select("a", "b", "c", "n")
    paths = written(compacted(grams.where("d <> 0"), nodes, rounds), "paths")
    edges = _edges_of(paths)

    # the most frequent longer phrase around each node and pair; one of four words around a pair holds one of three
    around = edges.select(F.explode(F.array(F.struct("a", "b", "c"), F.struct(F.col("b").alias("a"), F.col("c").alias("b"), F.col("d").alias("c")))).alias("k"), "n").select("k.*", "n")
    around = around.unionByName(nodes.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")))).alias("k"), "n").select("k.*", zero.alias("c"), "n"))
    shorter = nodes.unionByName(pairs.withColumn("c", zero))
    own = shorter.select("a", "b", "c", "n", none.alias("longer")).unionByName(around.select("a", "b", "c", none.alias("n"), F.col("n").alias("longer")))
    left = own.groupBy("a", "b", "c").agg(F.max("n").alias("n"), F.max("longer").alias("longer")).where("n IS NOT NULL AND (longer IS NULL OR 100 * CAST(longer AS DECIMAL(20, 0)) < 80 * CAST(n AS DECIMAL(20, 0)))")
    found = edges.unionByName(left.select("a", "b", "c", zero.alias("d"), "n", none.alias("f_first"), none.alias("f_rest")))

    # counts of the parts: the first pair, the last pair, and single words
    found = found.withColumn("x", F.expr("CASE WHEN d <> 0 THEN c WHEN c <> 0 THEN b END")).withColumn("y", F.expr("CASE WHEN d <> 0 THEN d WHEN c <> 0 THEN c END"))
    first = pairs.select("a", "b", F.col("n").alias("f_ab"))
    last = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n").alias("f_xy"))
    found = found.join(first, ["a", "b"]).join(last, ["x", "y"], "left")
    for c in _IDS:
        names = [F.col("id").alias(c), F.col("word").alias(f"w_{c}"), F.col("f").alias(f"f_{c}"), *([F.col("lang")] if c == "a" else [])]
        found = found.join(known.select(*names), c, "inner" if c in "ab" else "left")
    cut = lambda k, when, le, ri: F.when(F.expr(when), F.struct(_score(F.col("n"), F.col(le), F.col(ri)).alias("score"), F.lit(k).alias("k"), F.col(le).alias("l"), F.col(ri).alias("r")))
    cuts = F.array(
        cut(1, "c = 0", "f_a", "f_b"), cut(1, "c <> 0 AND d = 0", "f_a", "f_xy"), cut(1, "d <> 0", "f_a", "f_rest"),
        cut(2, "c <> 0 AND d = 0", "f_ab", "f_c"), cut(2, "d <> 0", "f_ab", "f_xy"), cut(3, "d <> 0", "f_first", "f_d"),
    )
    scored = found.select("lang", F.concat_ws(" ", *(f"w_{c}" for c in _IDS)).alias("phrase"), F.col("n").alias("a"), F.array_min(cuts).alias("s"), (F.pmod(F.xxhash64(*_IDS), F.lit(SALTS))).alias("salt"))
    best = [F.col("s.score").desc(), F.col("a").desc(), F.col("phrase")]
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").alias("score"))
