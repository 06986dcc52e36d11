"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts reach the tokenizer in batches balanced by bytes; a text longer than a piece is
split at ASCII white space. That is a safe boundary for this kind of tokenizer: its
pre-tokens never cross white space, no canonical composition joins a space to what
follows, and special strings hold no space. A boundary between a letter and ASCII
punctuation is as safe. Each distinct part between boundaries is encoded once in a batch,
many parts to a call, and the encodings of parts seen before are kept in a table of
bounded size, so that common words cost one look-up.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentlake.llm._io import bounded
from patentlake.llm._text import text_slices

VOCABULARY = "word_bpe_49k.json"
#: batches handed to the encoder hold about so many bytes of text
BATCH_BYTES = 1 << 20
#: longer texts are split at white space
PIECE_BYTES = 1 << 16
#: bytes of words and ids kept between batches
TABLE_BYTES = 160 << 20

_SPACE = re.compile(rb"[ \t\n\v\f\r]")
#: an ASCII or Latin-1 letter that ASCII punctuation follows: a pre-token ends between them
_EDGE = re.compile(rb"([a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])(?=[!-/:-@\[-`{-~])")
#: words that are one pre-token: letters alone, or ASCII punctuation alone
_SINGLE = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[!-/:-@\[-`{-~]+")
#: what opens a special string, within which no text is cut or changed
_SPECIAL = b"<|"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """Cut text after white space into pieces of at least `limit` bytes, if it has any there."""
    at = 0
    while len(text) - at > limit:
        found = _SPACE.search(text, at + limit)
        if found is None:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


class WordEncoder:
    """Ids of white-space separated words, as little-endian unsigned integers of `width` bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table: dict[bytes, bytes] = {}
        self.held = 0

        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.width = 2 if len(self.ends) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _learn(self, found: set[bytes]) -> None:
        if self.held > TABLE_BYTES:
            self.table, self.held = {}, 0
        new = found - self.table.keys()
        if not new:
            return
        # parts of each new word at its safe boundaries; b"\n".join keeps this at a few calls
        words = [w for w in new if _SPECIAL not in w]
        parts = [x.split() for x in _EDGE.sub(rb"\1 ", b"\n".join(words)).split(b"\n")] if words else []
        whole = set().union(*parts).union(w for w in new if _SPECIAL in w) - self.table.keys()
        single = [w for w in whole if _SINGLE.fullmatch(w)]
        other = list(whole.difference(single))
        for i in range(0, len(single), 4096):
            some = single[i : i + 4096]
            ids = np.asarray(self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, dtype=self.kind)
            at = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            if len(at) != len(some) + 1:  # not a vocabulary with one word end for each pre-token
                other += some
                continue
            raw = ids.tobytes()
            self.table.update(zip(some, [raw[self.width * a : self.width * b] for a, b in zip(at, at[1:], strict=False)], strict=True))
        if other:
            out = self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)
            self.table.update(zip(other, [np.asarray(e.ids, dtype=self.kind).tobytes() for e in out], strict=True))
        get = self.table.__getitem__
        self.table.update((w, b"".join(map(get, ps))) for w, ps in zip(words, parts, strict=True) if len(ps) > 1)
        self.held += sum(map(len, new)) + 180 * len(new)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; texts are encoded together."""
        split = [self._words(t) for t in texts]
        self._learn(set().union(*split) if split else set())
        get = self.table.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    @staticmethod
    def _words(text: bytes) -> list[bytes]:
        text = text if _SPECIAL in text else text.lower()  # only A-Z; the tokenizer does so too
        return [w for p in pieces(text, PIECE_BYTES) for w in p.split()] if len(text) > PIECE_BYTES else text.split()


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One for all tasks of a Python worker, so that words met by earlier tasks are known."""
    return WordEncoder(path)


def batches(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Rows of a column in runs balanced by bytes, as UTF-8; null is empty."""
    for i, j, data, offs in text_slices(column, limit):
        raw = data.tobytes()
        yield i, j, [raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None, limit: int = 2048) -> DataFrame:
    """Every row of docs with n_bytes, n_tokens and over_limit (n_tokens > limit) in place of its text.

    Null or empty text: 0 bytes, 0 tokens. Repeated rows each get a row; an empty table
    gives an empty one. Columns of docs named like the three results are replaced by them;
    all others but `text` pass through, nulls included. Narrow: no shuffle.
    """
    path = path or vocabulary_path()
    keep = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    names = [f"k{i}" for i in range(len(keep))]
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").cast("string").alias("text"))

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in it:
            column, n = batch.column("text"), batch.num_rows
            size, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for i, j, texts in batches(column):
                size[i:j] = [len(t) for t in texts]
                count[i:j] = [len(ids) // encoder.width for ids in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(size), pa.array(count), pa.array(count > limit)], names=[*names, "n_bytes", "n_tokens", "over_limit"])

    kinds = "".join(f"{n} {source.schema[n].dataType.simpleString()}, " for n in names)
    out = source.mapInArrow(run, f"{kinds}n_bytes long, n_tokens long, over_limit boolean")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_bytes", "n_tokens", "over_limit")
