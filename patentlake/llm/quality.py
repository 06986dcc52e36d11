"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled good) and unlabelled web text train a logistic model that
minimises the non-negative unbiased risk

    prior * R_p(+1)  +  max(0, R_u(-1) - prior * R_p(-1))

where the second term falls below zero the step goes against it instead, which keeps the
model from fitting noise. The class prior is estimated from positives and unlabelled texts
alone: among the texts that a first classifier puts on top nearly all are positive, so the
share of unlabelled texts there, over that of positives, is the prior; the best place to
read it is where that ratio with its confidence bound is least (best bin estimation, on
rows that the first classifier hasn't seen). Labels of bad texts teach nothing. The features
describe a text's form (character classes and their transitions, letter case, words,
repetition) and are counted over whole texts. Sampling is bounded by `max_positive` and
`max_unlabelled` rows, taken by a hash of the document id; all documents are scored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentlake.llm._io import bounded
from patentlake.llm._text import LOWER, SPACED_WORD, shingle_hashes, text_slices, word_hashes, words

MAX_POSITIVE = 6000
MAX_UNLABELLED = 12000
STEPS = 400

#: classes of a byte: space, line end, lower, upper, digit, beyond ASCII, sentence marks, quotes and brackets, other marks
N_CLASSES = 9
CLASS = np.full(256, 8, dtype=np.uint8)
CLASS[[9, 32]] = 0
CLASS[[10, 11, 12, 13]] = 1
CLASS[97:123] = 2
CLASS[65:91] = 3
CLASS[48:58] = 4
CLASS[128:] = 5
CLASS[list(b".,;:?")] = 6
CLASS[list(b"'\"()-")] = 7
N_FEATURES = N_CLASSES + N_CLASSES**2 + 9


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _distinct(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many different values each row has."""
    if not len(values):
        return np.zeros(len(bounds) - 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.append(True, (v[1:] != v[:-1]) | (r[1:] != r[:-1]))
    return np.bincount(r[new], minlength=len(bounds) - 1)


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of N_FEATURES numbers for each text of a slice."""
    n = len(offs) - 1
    size = np.diff(offs)
    row = np.repeat(np.arange(n), size)
    kind = CLASS[data].astype(np.int64)
    one = np.bincount(row * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    same = row[1:] == row[:-1] if len(row) else np.zeros(0, dtype=bool)
    pair = (row[1:] * N_CLASSES + kind[1:]) * N_CLASSES + kind[:-1] if len(row) else np.zeros(0, dtype=np.int64)
    two = np.bincount(pair[same], minlength=n * N_CLASSES**2).reshape(n, -1)
    low = LOWER[data]
    start, end, bounds = words(low, offs, SPACED_WORD)
    wh = word_hashes(low, start, end)
    n_words = np.diff(bounds)
    word_row = np.repeat(np.arange(n), n_words)
    again = np.bincount(word_row[1:][(wh[1:] == wh[:-1]) & (word_row[1:] == word_row[:-1])], minlength=n) if len(wh) else np.zeros(n)
    three = shingle_hashes(wh, 3)
    inner = word_row[: len(three)] == word_row[2:][: len(three)] if len(three) else np.zeros(0, dtype=bool)
    edges = np.concatenate([[0], np.cumsum(np.bincount(word_row[: len(three)][inner], minlength=n))])
    first_upper = np.bincount(word_row[CLASS[data[start]] == 3], minlength=n) if len(start) else np.zeros(n)
    last_mark = np.bincount(word_row[CLASS[data[end - 1]] == 8], minlength=n) if len(start) else np.zeros(n)
    lone_mark = np.bincount(word_row[(end - start == 1) & (CLASS[data[start]] == 8)], minlength=n) if len(start) else np.zeros(n)
    some, w = np.maximum(size, 1), np.maximum(n_words, 1)
    letters = np.maximum(one[:, 2] + one[:, 3], 1)
    extra = [
        one[:, 3] / letters,
        again / w,
        _distinct(wh, bounds) / w * np.log1p(n_words),
        np.where(np.diff(edges) > 0, _distinct(three[inner], edges) / np.maximum(np.diff(edges), 1), 1.0),
        first_upper / w,
        last_mark / w,
        lone_mark / w,
        np.log1p(n_words),
        np.bincount(word_row, weights=end - start, minlength=n) / w / 10,
    ]
    return np.column_stack([one / some[:, None], two / some[:, None], *extra]).astype(np.float64)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """prior * R_p(+1) and R_u(-1) - prior * R_p(-1) of logistic loss, and the gradients of both. p, u: rows of positives and unlabelled."""
    zp, zu = p @ w, u @ w
    sp, su = (1 / (1 + np.exp(-np.clip(z, -40, 40))) for z in (zp, zu))
    positive = prior * np.mean(np.logaddexp(0, -zp))
    negative = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
    return positive, negative, -prior * (p.T @ (1 - sp)) / len(p), (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)


def _descend(p: np.ndarray, u: np.ndarray, prior: float, steps: int, rate: float, decay: float) -> np.ndarray:
    w = np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        _, negative, good, rest = risk(w, p, u, prior)
        g = good + rest if negative >= 0 else -rest
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w


def best_bin(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Class prior from scores that rank positives first: the least ratio of the shares above a score, with its confidence bound."""
    cuts = np.unique(positive)
    share_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    share_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    noise = sum(np.sqrt(np.log(4 / delta) / (2 * len(x))) for x in (positive, unlabelled))
    at = int(np.argmin((share_u + (1 + gamma) * noise) / share_p))
    return float(np.clip(share_u[at] / share_p[at], 0.01, 0.99))


def estimated_prior(p: np.ndarray, u: np.ndarray, steps: int = STEPS) -> float:
    """Share of positives among unlabelled rows: two halves of either rank each other's rows."""
    found = []
    for k in (0, 1):
        (a, b), (c, d) = ((x[k::2], x[1 - k :: 2]) for x in (p, u))
        if not all(map(len, (a, b, c, d))):
            return 0.5
        w = _descend(a, c, 0.5, steps, 0.03, 1e-3)
        found.append(best_bin(b @ w, d @ w))
    return float(np.mean(found))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = STEPS, rate: float = 0.03, decay: float = 3e-4) -> Model:
    """Minimise the non-negative risk by Adam over all rows; the prior is estimated where none is given."""
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    p, u = (np.column_stack([np.clip((x - mean) / scale, -6, 6), np.ones(len(x))]) for x in (positive, unlabelled))
    prior = estimated_prior(p, u) if prior is None else prior
    w = _descend(p, u, prior, steps, rate, decay)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def _features_of(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample, on the driver."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for _, _, data, offs in text_slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in features(data, offs)], pa.binary())], names=["f"])

    got = rows.select("id", "text").mapInArrow(run, "f binary").toPandas()["f"]
    return np.frombuffer(b"".join(got), dtype=np.float64).reshape(-1, N_FEATURES)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """Model from docs (doc_id, text) and labels (doc_id, quality); None if there is no trusted positive.

    A document with any label but 1 isn't trusted; null ids and null labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = F.xxhash64("doc_id", F.lit(7))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).where(F.col("id").isNotNull())
    positive = known.where("quality = 1").orderBy(drawn, "doc_id").limit(max_positive).select(F.col("doc_id").alias("id"))
    unlabelled = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct().orderBy(drawn, "doc_id").limit(max_unlabelled).select(F.col("doc_id").alias("id"))
    # the samples are bounded, so either may be broadcast; a repeated id gives one row, that of its text of least hash
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    p, u = (_features_of(texts.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(one)) for ids in (positive, unlabelled))
    return fit(p, u) if len(p) and len(u) else None


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **bounds) -> DataFrame:
    """Every row of docs with held_out, score and predicted; its text is kept.

    Null and empty texts are scored as texts without characters. Without trusted positives
    every row scores 0.5. A null id is not held out. Repeated rows each get a row; empty
    docs give an empty table; columns named like a result are replaced, others pass through.
    """
    ids = bounded(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    model = train(ids, labels.select("doc_id", "quality"), **bounds)
    results = ("held_out", "score", "predicted")
    keep = [c for c in docs.columns if c not in results]
    names = [f"k{i}" for i in range(len(keep))]
    at = names[keep.index(text)]
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)])
    kinds = "".join(f"{n} {source.schema[n].dataType.simpleString()}, " for n in names)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            score = np.full(batch.num_rows, 0.5)
            if model is not None:
                for i, j, data, offs in text_slices(batch.column(at)):
                    score[i:j] = model.score(features(data, offs))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, "score"])

    out = source.mapInArrow(run, f"{kinds}score double").select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "score")
    return out.withColumn("held_out", held_out(F.col(f"`{doc_id}`"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
