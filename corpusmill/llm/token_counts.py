"""Token counts (operator 1): batch encoding in an Arrow function that returns lengths only.

A text is split where tokens can never span: at blanks and line feeds for vocabularies that drop white space. Equal
units of a batch are encoded once, unknown ones in batches of about equal bytes, and a bounded memo of unit lengths
lives as long as the Python worker. Very long texts are many units like any other; no text is cut elsewhere.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

BATCH_BYTES = 1 << 16
MEMO_LIMIT = 2_500_000
UNIT_BYTE = np.ones(256, dtype=bool)
UNIT_BYTE[[10, 32]] = False


class Memo:
    """A bounded map of 64-bit hashes to non-negative numbers, in sorted arrays; emptied when full."""

    def __init__(self, limit: int = MEMO_LIMIT):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.values = np.empty(0, np.uint64), np.empty(0, np.int64)

    def get(self, asked: np.ndarray) -> np.ndarray:
        """Values of ascending keys, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(asked), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.values[at], -1)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        self.keys, self.values = np.insert(self.keys, at, keys), np.insert(self.values, at, values)

    def full(self) -> bool:
        return len(self.keys) > self.limit


def texts_of(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    return [buf[a:b].tobytes().decode("utf-8") for a, b in zip(start.tolist(), end.tolist(), strict=True)]


class UnitLengths:
    """Token counts of the rows of a buffer, by one tokenizers vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.memo = Tokenizer.from_file(path), Memo()
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, texts: list[str]) -> np.ndarray:
        out, batch, size = [], [], 0
        for t in texts:
            batch.append(t)
            size += len(t)
            if size >= BATCH_BYTES:
                out += [len(e) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
                batch, size = [], 0
        out += [len(e) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        return np.array(out, dtype=np.int64)

    def count(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.memo.full():
            self.memo.clear()
        start, end = tk.edges(buf, off, UNIT_BYTE)
        keys, where, inverse = np.unique(tk.span_hash(buf, start, end), return_index=True, return_inverse=True)
        got = self.memo.get(keys)
        new = np.flatnonzero(got < 0)
        if len(new):
            got[new] = self.encode(texts_of(buf, start[where[new]], end[where[new]]))
            self.memo.put(keys[new], got[new])
        return tk.sums(got[inverse], np.searchsorted(start, off))


_COUNTERS: dict[str, UnitLengths] = {}


def token_counts(
    docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, for a tokenizers file whose white space is dropped.

    Null texts count as empty: no bytes, no tokens. Rows with null or repeated ids are rows like others; an empty
    table gives no rows; other columns are ignored. Special strings inside texts count as the library's default has
    them; nothing is added, cut or padded. Equal 64-bit hashes stand for equal units.
    """

    def run(batches):
        counter = _COUNTERS.get(tokenizer) or _COUNTERS.setdefault(tokenizer, UnitLengths(tokenizer))
        for part, buf, off in tk.balanced(batches, "__text", 1 << 21):
            n = counter.count(buf, off)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[ident].dataType.simpleString()
    chosen = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("__text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
