"""Vectorised words, word hashes and shingles straight from Arrow string buffers.

Everything works on slices of bounded bytes, so that numpy's temporaries stay
bounded whatever size of record batch Spark sends. One text is never cut: a text
longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes of a word, after lower-casing: digits, a-z and all of UTF-8 beyond ASCII
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True

#: bytes of a word: all but space and \t \n \v \f \r
SPACED_WORD = np.ones(256, dtype=bool)
SPACED_WORD[[0x20, 9, 10, 11, 12, 13]] = False

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """P^i and P^-i modulo 2^64, as far as they were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * SLICE_BYTES)
            ones = np.ones(1, dtype=np.uint64)
            self.up = np.multiply.accumulate(np.concatenate([ones, np.full(size, _P)]))
            self.down = np.multiply.accumulate(np.concatenate([ones, np.full(size, _PINV)]))
        return self.up, self.down


POWERS = _Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of (byte + 1) * P^position over [i, j)."""
    up, _ = POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, the same wherever the span lies."""
    _, down = POWERS.upto(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, row offsets into them) of slices of about `limit` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if big else np.int32, count=n + 1, offset=column.offset * (8 if big else 4)).astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1)
        yield row, end, data[offs[row] : offs[end]], offs[row : end + 1] - offs[row]
        row = end


def words(low: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in lower-cased bytes, and offsets of each row's words. No word crosses a row."""
    inside = is_word[low]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offs[:-1] < offs[1:]
    rows, tails = offs[:-1][full], offs[1:][full] - 1
    first[rows], last[tails] = inside[rows], inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word: its lanes of eight bytes are mixed with their place and summed, so that no structure of the bytes makes two words meet."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE_BYTES, side="right")))
        data = np.concatenate([low[start[i] : end[j - 1]], np.zeros(8, dtype=np.uint8)])
        out[i:j] = _lane_sums(data, start[i:j] - start[i], end[i:j] - start[i])
        i = j
    return mix(out + (end - start).astype(np.uint64) * _P)


def _lane_sums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of the mixed lanes of each word; eight bytes follow the last one. One word alone may be of any size."""
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    if len(start) == 1:
        with np.errstate(over="ignore"):
            blocks = (np.arange(a, min(int(end[0]), a + SLICE_BYTES), 8) for a in range(0, int(end[0]), SLICE_BYTES))
            return np.array([sum((_lanes(eight, at, end[0], at).sum() for at in blocks), np.uint64(0))], dtype=np.uint64)
    count = (end - start + 7) >> 3
    first = np.cumsum(count) - count
    of = np.repeat(np.arange(len(start)), count)
    inner = (np.arange(len(of)) - first[of]) << 3
    return np.add.reduceat(_lanes(eight, start[of] + inner, end[of], inner), first)


def _lanes(eight: np.ndarray, at: np.ndarray, end, inner) -> np.ndarray:
    """Mixed lanes at the given bytes, of words that end at `end`; inner is a lane's first byte within its word."""
    beyond = (np.maximum(8 - (end - at), 0) << 3).astype(np.uint64)
    return mix(((eight[at] << beyond) >> beyond) ^ mix((inner + 1).astype(np.uint64) * _P))


def shingle_hashes(wh: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, at the run's first word; runs may cross rows, so callers mask by row."""
    m = len(wh) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = mix(wh[:m] + np.uint64(n * int(_Q) % (1 << 64)))
    for k in range(1, n):
        out ^= wh[k : k + m]
        out = mix(out)
    return out
