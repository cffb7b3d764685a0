"""Corpus-wide values for the keys of a block of documents, without a row per key.

Documents are dealt to blocks of a few MB by a hash of id and text. Each block asks for the distinct 64-bit keys it
holds, one compressed message per shard of the key space; each shard folds the blocks' own values (sum or minimum) and
answers every block in the order it asked. A key of any frequency arrives at most once per block, so no key is hot;
block and shard sizes are bounded whatever the corpus size. Blocks depend on row contents only, so a lost executor's
part is recomputed alike. The texts are shuffled once: both users of the blocked table share its exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, SHARD = "__block", "__shard"
MESSAGES = f"{BLOCK} long, {SHARD} long, keys binary, vals binary"
_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes under zstd."""
    v = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def pack_all(columns: list[np.ndarray]) -> bytes:
    """Several columns of non-negative integers as one blob: byte planes of all of them under zstd."""
    head, planes = [], []
    for column in columns:
        v = np.ascontiguousarray(column, dtype="<u8")
        width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
        head += [len(v), width]
        planes.append(np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return _PACKER.compress(np.array(head, dtype="<u4").tobytes() + b"".join(planes))


def unpack_all(blob: bytes, n: int) -> list[np.ndarray]:
    raw = _UNPACKER.decompress(blob)
    out, at = [], 8 * n
    for size, width in np.frombuffer(raw, dtype="<u4", count=2 * n).reshape(n, 2).tolist():
        v = np.zeros((size, 8), dtype=np.uint8)
        v[:, :width] = np.frombuffer(raw, dtype=np.uint8, count=size * width, offset=at).reshape(width, size).T
        out.append(v.view("<u8").ravel())
        at += size * width
    return out


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


@dataclass(frozen=True)
class Layout:
    blocks: int
    shards: int
    bits: int

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """The leading ``bits`` of 64-bit hashes."""
        return hashes >> np.uint64(64 - self.bits)

    def cuts(self, keys: np.ndarray) -> np.ndarray:
        """Where sorted keys pass from shard to shard (shards + 1 entries)."""
        edge = [(s << self.bits) // self.shards for s in range(self.shards)]
        return np.append(np.searchsorted(keys, np.array(edge, dtype=np.uint64)), len(keys))


BLOCK_BYTES, LEAST_BLOCK, SHARD_KEYS = 8 << 20, 1 << 18, 1 << 20


def layout_of(docs: DataFrame, text: str, keys_per_byte: float, spare_bits: int, block_bytes: int = BLOCK_BYTES) -> Layout:
    """One scan for the corpus size; blocks of about ``block_bytes`` of text at most and shards of about a million keys.

    Keys keep log2(number of keys) + ``spare_bits`` bits, so a key is shared by chance once in 2**spare_bits; they have
    64 bits, the whole hash, at most.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(math.ceil(size / block_bytes), min(tasks, math.ceil(size / LEAST_BLOCK)), 1)
    keys = max(1, int(size * keys_per_byte))
    shards = max(math.ceil(keys / SHARD_KEYS), min(tasks // 2, math.ceil(keys / 50_000)), 1)
    return Layout(blocks, shards, min(64, max(24, keys.bit_length() + spare_bits)))


def blocked(docs: DataFrame, layout: Layout, ident: str, text: str) -> DataFrame:
    """(__block, id, text): rows dealt by a hash of both."""
    key = F.pmod(F.xxhash64(F.col(ident), F.col(text)), F.lit(layout.blocks))
    return docs.select(key.alias(BLOCK), F.col(ident).alias("__id"), F.col(text).alias("__text"))


KeysOf = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def answers(rows: DataFrame, layout: Layout, keys_of: KeysOf, fold: str) -> DataFrame:
    """Messages (__block, __shard, empty, values): each block's keys, folded over all blocks by ``fold`` (sum, min)."""

    def ask(table: pa.Table) -> pa.Table:
        block = table.column(BLOCK)[0].as_py()
        keys, vals = keys_of(table)
        cut = layout.cuts(keys)
        used = [s for s in range(layout.shards) if cut[s] < cut[s + 1]]
        return pa.table(
            {
                BLOCK: pa.array([block] * len(used), pa.int64()),
                SHARD: pa.array(used, pa.int64()),
                "keys": pa.array([pack_sorted(keys[cut[s] : cut[s + 1]]) for s in used], pa.binary()),
                "vals": pa.array([pack(vals[cut[s] : cut[s + 1]]) for s in used], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(x.as_py()) for x in table.column("keys")]
        vals = [unpack(x.as_py()) for x in table.column("vals")]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        own, n = np.concatenate(vals), int(where.max()) + 1
        if fold == "sum":
            total = np.zeros(n, dtype=np.uint64)
            np.add.at(total, where, own)
        else:
            total = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
            np.minimum.at(total, where, own)
        end = np.cumsum([len(k) for k in keys])
        out = [pack(total[where[b - len(k) : b]]) for k, b in zip(keys, end, strict=True)]
        return pa.table(
            {
                BLOCK: table.column(BLOCK),
                SHARD: table.column(SHARD),
                "keys": pa.array([b""] * len(out), pa.binary()),
                "vals": pa.array(out, pa.binary()),
            }
        )

    asked = rows.groupBy(BLOCK).applyInArrow(ask, MESSAGES)
    return asked.groupBy(SHARD).applyInArrow(answer, MESSAGES)


def with_answers(
    rows: DataFrame, layout: Layout, keys_of: KeysOf, fold: str, use: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table], schema: str
) -> DataFrame:
    """``use(table, keys, values)`` over every block, with the corpus-wide value of each of its distinct keys."""

    def meet(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            raise ValueError("an answer without its block")
        keys, _ = keys_of(docs)
        got = sorted(zip(told.column(SHARD).to_pylist(), told.column("vals").to_pylist(), strict=True))
        values = np.concatenate([unpack(v) for _, v in got]) if got else np.empty(0, np.uint64)
        if len(values) != len(keys):
            raise ValueError("a block's answers do not match its keys")
        return use(docs, keys, values)

    told = answers(rows, layout, keys_of, fold)
    return rows.groupBy(BLOCK).cogroup(told.groupBy(BLOCK)).applyInArrow(meet, schema)
