"""Vectorised text primitives shared by the operators that read whole texts.

A batch of texts is one UTF-8 byte buffer plus row offsets, as Arrow stores it. Words are runs of bytes outside
``[\\x20\\x09-\\x0D]``; since all separators are ASCII this equals the code-point rule. Every array is proportional to
the words of one batch, never to a corpus, and buffers are scanned in pieces of at most ``PIECE`` bytes, so one very
long text costs memory in proportion to its words only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 20
LOW = 1 << 16

#: Fixed odd multipliers of the 64-bit hashes (SplitMix64 finaliser and a polynomial base with its inverse mod 2**64).
MIX1, MIX2, GOLD = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
BASE = 0x2127599BF4325C37 | 1
BASE_INV = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, elementwise."""
    x = x + GOLD
    x ^= x >> U64(30)
    x *= MIX1
    x ^= x >> U64(27)
    x *= MIX2
    x ^= x >> U64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


BYTE_CODE = mix(np.arange(256, dtype=U64) + U64(1))
LOWER_MAP = np.arange(256, dtype=np.uint8)
LOWER_MAP[65:91] += 32
LOWER_CODE = BYTE_CODE[LOWER_MAP]
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
POW = _powers(BASE, PIECE)
#: Powers of the inverse base at any position are products of two small tables.
INV_LOW = _powers(BASE_INV, LOW)
INV_HIGH_BASE = pow(BASE_INV, LOW, 1 << 64)


def power(at: np.ndarray) -> np.ndarray:
    """Powers of the base at any position: products of two small tables."""
    top = int(at.max() >> 16) + 1 if len(at) else 1
    return POW[at & (LOW - 1)] * _powers(pow(BASE, LOW, 1 << 64), max(top, 2))[at >> 16]


def inverse_power(at: np.ndarray) -> np.ndarray:
    at = at.astype(np.int64)
    top = int(at.max() >> 16) + 1 if len(at) else 1
    return INV_LOW[at & (LOW - 1)] * _powers(INV_HIGH_BASE, max(top, 2))[at >> 16]


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at.astype(np.int64) - int(at[0])


def slices_by_bytes(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def balanced(batches, text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of Arrow batches with about ``limit`` bytes of text each, with their buffer and offsets."""
    for batch in batches:
        buf, off = buffer_of(batch.column(batch.schema.get_field_index(text)))
        for i, j in slices_by_bytes(off, limit):
            yield batch.slice(i, j - i), buf[off[i] : off[j]], off[i : j + 1] - off[i]


class Words:
    """Words of a batch: byte ``start`` and ``end``, 64-bit ``hash``, and ``first`` word of each row (n + 1 entries)."""

    __slots__ = ("end", "first", "hash", "start")

    def __init__(self, start, end, hashes, first):
        self.start, self.end, self.hash, self.first = start, end, hashes, first


def edges(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes with ``inside[byte]``, broken at row offsets."""
    starts, ends = [], []
    n = len(buf)
    for a in range(0, n, PIECE):
        b = min(a + PIECE, n)
        here = inside[buf[a:b]]
        before = np.empty_like(here)
        before[1:] = here[:-1]
        before[0] = a > 0 and bool(inside[buf[a - 1]])
        rows = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)]
        after = np.empty_like(here)
        after[:-1] = here[1:]
        after[-1] = b < n and bool(inside[buf[b]])
        before[rows - a] = False
        last = offsets[np.searchsorted(offsets, a + 1) : np.searchsorted(offsets, b, side="right")] - 1
        after[last - a] = False
        starts.append(np.flatnonzero(here & ~before) + a)
        ends.append(np.flatnonzero(here & ~after) + a + 1)
    empty = np.empty(0, np.int64)
    return np.concatenate(starts or [empty]), np.concatenate(ends or [empty])


def prefix_hash(buf: np.ndarray, points: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``buf[:p]`` for each ascending point p."""
    out = np.zeros(len(points), dtype=U64)
    carry, scale, step = U64(0), 1, pow(BASE, PIECE, 1 << 64)
    for a in range(0, len(buf), PIECE):
        b = min(a + PIECE, len(buf))
        run = code[buf[a:b]]
        run *= POW[: b - a]
        if scale != 1:
            run *= U64(scale)
        np.cumsum(run, out=run)
        run += carry
        i, j = np.searchsorted(points, [a + 1, b + 1])
        out[i:j] = run[points[i:j] - a - 1]
        carry, scale = run[-1], scale * step % (1 << 64)
    return out


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """64-bit hashes of byte spans whose starts and ends each ascend; equal bytes give equal hashes."""
    h = prefix_hash(buf, end, code) - prefix_hash(buf, start, code)
    h *= inverse_power(start)
    return mix(h)


def words_of(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    start, end = edges(buf, offsets, NOT_SPACE)
    hashes = span_hash(buf, start, end, LOWER_CODE if lower else BYTE_CODE)
    return Words(start, end, hashes, np.searchsorted(start, offsets).astype(np.int64))


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of each element, from the rows' first elements."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of ``width`` elements that lies inside one row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    h = hashes[:n].copy()
    for k in range(1, width):
        h *= MIX2
        h += hashes[k : k + n]
    ends = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + width <= ends)
    return at, mix(h[at])


class Rolling:
    """Rolling hash over the elements of all rows: a window of any width is a difference of two prefix sums."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        at = np.arange(len(hashes))
        self.prefix = np.zeros(len(hashes) + 1, dtype=U64)
        np.cumsum(hashes * power(at), out=self.prefix[1:])
        self.back = inverse_power(at)
        self.end = np.repeat(first[1:], np.diff(first))

    def windows(self, width: int, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of every run of ``width`` elements inside one row, among those at ``starts`` if given."""
        at = np.arange(len(self.end)) if starts is None else starts
        at = at[at + width <= self.end[at]]
        return at, mix((self.prefix[at + width] - self.prefix[at]) * self.back[at])


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all word shingles; a row with 1 to ``width`` - 1 words gives its whole sequence as one."""
    rows = row_of(words.first)
    at, h = windows(words.hash, words.first, width)
    row, hashes = [rows[at]], [h]
    count = np.diff(words.first)
    for size in range(1, width):
        which = np.flatnonzero(count == size)
        if len(which):
            begin = words.first[which]
            h = words.hash[begin].copy()
            for k in range(1, size):
                h *= MIX2
                h += words.hash[begin + k]
            row.append(which)
            hashes.append(mix(h ^ mix(np.full(len(which), size, dtype=U64))))
    row, hashes = np.concatenate(row), np.concatenate(hashes)
    if len(row) and len(which_order := np.flatnonzero(np.diff(row) < 0)):
        order = np.argsort(row, kind="stable")
        row, hashes = row[order], hashes[order]
    return row, hashes


def distinct_per_row(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes sorted and distinct within each row, and the rows' first entries (n + 1)."""
    order = np.lexsort((hashes, row)) if len(row) else np.empty(0, np.int64)
    r, h = row[order], hashes[order]
    keep = np.ones(len(r), dtype=bool)
    keep[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    r, h = r[keep], h[keep]
    return h, np.searchsorted(r, np.arange(n + 1)).astype(np.int64)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's values (any integer or boolean kind)."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
