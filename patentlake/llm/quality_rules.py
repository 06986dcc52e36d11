"""Quality rules: thresholds that adapt to each language and source, from mergeable sketches.

Signals of every text are counted once and written. Each signal's rates go into a sketch
for each (language, source): log-linear buckets, six leading bits of an integer rate, and
how many documents are in each. Such sketches merge by adding counts, exactly and in any
order, so those of a language are the sum of its sources' and that of the corpus is the
sum of the languages'. Quartiles read from a sketch are at most 1/32 too low. From them
come fences, as far from the median as REACH times the distance of the quartile, plus a
slack in which no text is an outlier; they take the place of fixed cutoffs. A join brings
each document the fences of its group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patentlake.llm._io import bounded, written
from patentlake.llm._text import SPACED_WORD, shingle_hashes, text_slices, word_hashes, words

#: fixed by the contract of the query: fewest words, and the share of repeated words in per cent
LEAST_WORDS, MOST_REPEATED = 50, 50
#: distance of a fence from the median, in distances of the quartile
REACH = 4
#: documents that a group needs for fences of its own; smaller ones take their language's, small languages the corpus's
LEAST_DOCUMENTS = 200
#: leading bits that a bucket keeps
BITS = 6
#: (signal, what is counted, by what it is divided, slack, has a lower fence); rates and slacks in millionths
SIGNALS = (
    ("symbols", "n_symbols", "n_words", 100_000, False),
    ("repeats", "n_repeat_words", "n_words", 350_000, False),
    ("lines", "n_dup_lines", "n_lines", 350_000, False),
    ("length", "word_chars", "n_words", 1_000_000, True),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = np.ones(256, dtype=bool)  # bytes that begin a code point
_LEAD[0x80:0xC0] = False


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _again(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, key): whether an equal one came before it, and whether there is any equal one."""
    order = np.lexsort((np.arange(len(key)), key, row))
    r, k = row[order], key[order]
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    before, some = np.empty(len(key), dtype=bool), np.empty(len(key), dtype=bool)
    before[order], some[order] = same[:-1], same[:-1] | same[1:]
    return before, some


def count_signals(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each text in a slice of UTF-8."""
    n = len(offs) - 1
    start, end, at = words(data, offs, SPACED_WORD)
    lead = _sums(_LEAD[data])
    per_word = np.concatenate([[0], np.cumsum(lead[end] - lead[start])])
    symbols = _sums(_SYMBOL[data])
    of_word = np.repeat(np.arange(n), np.diff(at))

    cuts = np.flatnonzero(data == 10)
    # lines that hold a word: they begin at a row's start or behind a \n
    begin = np.unique(np.concatenate([offs[:-1], cuts + 1]))
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    stop = np.where((stop > 0) & (data[stop - 1] == 10), stop - 1, stop) if len(stop) else stop
    full = np.searchsorted(start, stop, side="left") > np.searchsorted(start, begin, side="left")
    begin, stop = begin[full], stop[full]
    of_line = np.searchsorted(offs, begin, side="right") - 1
    before, _ = _again(of_line, word_hashes(data, begin, stop))

    hit = np.zeros(len(start), dtype=bool)
    if len(start) >= 3:
        inside = of_word[:-2] == of_word[2:]
        _, twice = _again(of_word[:-2][inside], shingle_hashes(word_hashes(data, start, end), 3)[inside])
        first = np.flatnonzero(inside)[twice]
        for k in range(3):
            hit[first + k] = True
    return {
        "n_words": np.diff(at),
        "word_chars": per_word[at[1:]] - per_word[at[:-1]],
        "n_symbols": symbols[offs[1:]] - symbols[offs[:-1]],
        "n_dup_lines": np.bincount(of_line[before], minlength=n),
        "n_repeat_words": np.bincount(of_word[hit], minlength=n),
        "n_lines": np.bincount(of_line, minlength=n),
    }


def _signals(source: DataFrame, names: list[str]) -> DataFrame:
    """The columns in names, and COUNTS of the column text."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = {c: np.zeros(batch.num_rows, dtype=np.int64) for c in COUNTS}
            for i, j, data, offs in text_slices(batch.column("text")):
                for c, v in count_signals(data, offs).items():
                    out[c][i:j] = v
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, out.values())], names=[*names, *out])

    kinds = ", ".join([*(f"{c} {source.schema[c].dataType.simpleString()}" for c in names), *(f"{c} long" for c in COUNTS)])
    return source.mapInArrow(run, kinds)


def rate(count: str, by: str) -> Column:
    """In millionths; null where there is nothing to divide by."""
    return F.expr(f"CASE WHEN {by} > 0 THEN {count} * 1000000 DIV {by} END")


def sketches(counts: DataFrame, group: list[str]) -> DataFrame:
    """(group, signal, bucket, n): documents in each bucket of each signal."""
    rates = F.explode(F.array(*(F.struct(F.lit(s).alias("signal"), rate(c, by).alias("rate")) for s, c, by, _, _ in SIGNALS))).alias("r")
    long = counts.select(*group, rates).select(*group, "r.*").where("rate IS NOT NULL")
    shift = f"greatest(length(bin(rate)) - {BITS}, 0)"
    return long.groupBy(*group, "signal", F.expr(f"shiftleft(shiftright(rate, {shift}), {shift})").alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of larger groups: the sum of those they hold."""
    return sketch.groupBy(*group, "signal", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, group: list[str]) -> DataFrame:
    """(group, signal, total, q1, q2, q3): the least bucket at which so many quarters of the documents are reached."""
    of = Window.partitionBy(*group, "signal")
    upto = sketch.withColumn("upto", F.sum("n").over(of.orderBy("bucket"))).withColumn("total", F.sum("n").over(of))
    return upto.groupBy(*group, "signal", "total").agg(*(F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bucket"))).alias(f"q{k}") for k in (1, 2, 3)))


def fences(sketch: DataFrame, group: list[str], least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(group, <signal>_most, length_least) of each group, by its own sketch or that of the smallest larger group with enough documents."""
    steps = [group[:k] for k in range(len(group), -1, -1)]
    known = quartiles(sketch, group)
    out = known.select(*group, "signal", *(F.col(c).alias(f"{c}_0") for c in ("total", "q1", "q2", "q3")))
    for k, larger in enumerate(steps[1:], 1):
        sketch = merged(sketch, larger)
        wide = quartiles(sketch, larger).select(*(F.col(c).alias(f"_{c}") for c in larger), F.col("signal").alias("_signal"), *(F.col(c).alias(f"{c}_{k}") for c in ("total", "q1", "q2", "q3")))
        same = F.col("signal") == F.col("_signal")
        for c in larger:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        out = out.join(wide, same, "left").drop("_signal", *(f"_{c}" for c in larger))
    last = len(steps) - 1
    chosen = F.lit(last)
    for k in range(last - 1, -1, -1):
        chosen = F.when(F.col(f"total_{k}") >= least, k).otherwise(chosen)
    out = out.withColumn("_k", chosen)
    q = {n: F.expr(f"CASE _k {' '.join(f'WHEN {k} THEN {n}_{k}' for k in range(last + 1))} END") for n in ("q1", "q2", "q3")}
    limits = []
    for s, _, _, slack, both in SIGNALS:
        of = F.col("signal") == s
        limits.append(F.max(F.when(of, q["q2"] + REACH * (q["q3"] - q["q2"]) + slack)).alias(f"{s}_most"))
        if both:
            limits.append(F.max(F.when(of, q["q2"] - REACH * (q["q2"] - q["q1"]) - slack)).alias(f"{s}_least"))
    return out.groupBy(*group).agg(*limits)


def apply_rules(docs: DataFrame, text: str = "text", group: tuple[str, str] = ("lang", "source"), least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Every row of docs with COUNTS, base_failed, n_outside (signals beyond a fence) and kept in place of its text.

    A null text is an empty one: no words, and so not kept. Null languages and sources are
    groups of their own. Repeated rows each count and each get a row; an empty table gives
    an empty one. Other columns pass through; those named like results are replaced.
    Everything is counted over all documents that have words. One job counts and writes the
    signals; a source with a third of all documents is summed up before its shuffle, and
    the join with the fences is one of a small table, by broadcast where Spark finds it
    small, else by a shuffle that adaptive execution splits.
    """
    results = [*COUNTS, "base_failed", "n_outside", "kept"]
    keep = [c for c in docs.columns if c != text and (c not in results or c in group)]
    names = [f"k{i}" for i in range(len(keep))]
    by = [f"k{keep.index(c)}" for c in group]
    source = bounded(docs).select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col(f"`{text}`").cast("string").alias("text"))
    counts = written(_signals(source, names), "signals")
    limits = written(fences(sketches(counts, by), by, least), "fences")
    limits = limits.select(*(F.col(c).alias(f"_{c}") for c in by), *limits.columns[len(by) :])
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    outside = F.lit(0)
    for s, c, d, _, both in SIGNALS:
        beyond = rate(c, d) > F.col(f"{s}_most")
        beyond = beyond | (rate(c, d) < F.col(f"{s}_least")) if both else beyond
        outside += F.coalesce(beyond, F.lit(False)).cast("int")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = counts.join(limits, same, "left").withColumn("base_failed", failed).withColumn("n_outside", outside)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("n_outside") == 0)).select(*(F.col(n).alias(c) for c, n in zip(keep, names, strict=True) if c not in results), *results)
