"""Benchmark decontamination (operator 2): size-partitioned MinHash containment search.

Items are partitioned by the number of their shingles, each class up to twice the last. For a class of at most u
shingles a document is searched in overlapping windows of 1.5 u, so an item anywhere in a long text stands in a window
of its own size, where its Jaccard similarity is high enough that 64 MinHash functions miss it less than once in a
million (containment 0.8: similarity over 0.2, 0.8 ** 64). A window that shares a minimum with an item makes the pair a
candidate; exact shingle containment decides. No shuffle; the item index is sent in blocks of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textkit as tk

FUNCTIONS, TABLE_BITS = 64, 16
BLOCK_ITEMS, BLOCK_BYTES = 16384, 32 << 20
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    WORD_BYTE[_a:_b] = True
FACTOR = (tk.mix(np.arange(FUNCTIONS, dtype=np.uint64) + np.uint64(77)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
SHIFT = tk.mix(np.arange(FUNCTIONS, dtype=np.uint64) + np.uint64(7777)).astype(np.uint32)


def plain_words(buf: np.ndarray, off: np.ndarray) -> tk.Words:
    """A-Z-lowered runs of ASCII letters, digits and non-ASCII characters: punctuation and spacing do not count."""
    start, end = tk.edges(buf, off, WORD_BYTE)
    return tk.Words(start, end, tk.span_hash(buf, start, end, tk.LOWER_CODE), np.searchsorted(start, off).astype(np.int64))


@dataclass
class SizeClass:
    """Items of up to ``size`` shingles: their minima as sorted keys (function, minimum), and owners."""

    size: int
    table: np.ndarray  # [function, low bits of minimum] -> some item has it
    keys: np.ndarray
    owners: np.ndarray


class ItemIndex:
    def __init__(self, ids: list, texts: list[str], width: int = 5):
        self.ids, self.width = ids, width
        buf, off = tk.buffer_of(pa.array([t or "" for t in texts], pa.large_string()))
        words = plain_words(buf, off)
        row, h = tk.shingles(words, width)
        h, first = tk.distinct_per_row(row, h, len(ids))
        self.sets = [h[first[i] : first[i + 1]] for i in range(len(ids))]
        count = np.diff(words.first)
        #: items of fewer words than a shingle: looked for as they stand
        self.short = {m: [i for i in range(len(ids)) if count[i] == m] for m in range(1, width)}
        self.short_hash = {m: _short_hashes(words.hash, words.first[:-1][which], m) for m, which in self.short.items() if which}
        self.classes = []
        sizes = np.array([len(s) if c >= width else 0 for s, c in zip(self.sets, count, strict=True)])
        top = 4
        while (sizes > (top // 2 if top > 4 else 0)).any():
            which = np.flatnonzero((sizes <= top) & (sizes > (top // 2 if top > 4 else 0)))
            if len(which):
                self.classes.append(self._class(top, which))
            top *= 2

    def _class(self, size: int, which: np.ndarray) -> SizeClass:
        table = np.zeros((FUNCTIONS, 1 << TABLE_BITS), dtype=bool)
        keys, owners = [], []
        for i in which:
            low = self.sets[i].astype(np.uint32)
            for f in range(FUNCTIONS):
                m = int((low * FACTOR[f] + SHIFT[f]).min())
                table[f, m & ((1 << TABLE_BITS) - 1)] = True
                keys.append((f << 32) | m)
                owners.append(i)
        order = np.argsort(keys, kind="stable")
        return SizeClass(size, table, np.array(keys, dtype=np.int64)[order], np.array(owners)[order])

    def candidates(self, h: np.ndarray, at: np.ndarray, word_rows: np.ndarray) -> np.ndarray:
        """Pairs (row, item), sorted and distinct, whose windows share a minimum. ``at``: word of each shingle."""
        pairs = []
        n = len(h)
        if not n or not self.classes:
            return np.empty((0, 2), np.int64)
        rows = word_rows[at]
        low = h.astype(np.uint32)
        largest = self.classes[-1].size // 2
        padded = np.full(-(-n // largest) * largest, 0, dtype=np.uint32)
        padded[:n] = low
        smallest = self.classes[0].size // 2
        by_size = {c.size // 2: c for c in self.classes}
        # the places inside a block become rows of an array: minima over blocks are then minima of whole rows
        spread = np.ascontiguousarray(padded.reshape(-1, smallest).T)
        tail = len(padded) - n
        for f in range(FUNCTIONS):
            x = spread * FACTOR[f] + SHIFT[f]
            if tail:
                flat_at = np.arange(n, len(padded))
                x[flat_at % smallest, flat_at // smallest] = np.uint32(0xFFFFFFFF)
            low_row, step = x.min(axis=0), smallest
            while True:
                if (c := by_size.get(step)) is not None:
                    win = low_row.copy()
                    np.minimum(win[:-1], low_row[1:], out=win[:-1])
                    np.minimum(win[:-2], low_row[2:], out=win[:-2])
                    hit = np.flatnonzero(c.table[f][win & np.uint32((1 << TABLE_BITS) - 1)])
                    if len(hit):
                        key = (f << 32) | win[hit].astype(np.int64)
                        a, b = np.searchsorted(c.keys, key), np.searchsorted(c.keys, key, side="right")
                        some = b > a
                        hit, a, b = hit[some], a[some], b[some]
                        for w, i, j in zip(hit.tolist(), a.tolist(), b.tolist(), strict=True):
                            lo, hi = rows[min(w * step, n - 1)], rows[min((w + 3) * step, n) - 1]
                            pairs += [(r, o) for r in range(lo, hi + 1) for o in c.owners[i:j]]
                if step >= largest:
                    break
                low_row = np.minimum(low_row[0::2], low_row[1::2])
                step *= 2
        return np.unique(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=0)

    def search(self, buf: np.ndarray, off: np.ndarray, percent: int) -> list[tuple[int, int, int, int]]:
        """(row, item, item's shingles, shared shingles) of every exact containment of at least ``percent``."""
        w = plain_words(buf, off)
        at, h = tk.windows(w.hash, w.first, self.width)
        word_rows = tk.row_of(w.first)
        found = []
        begin = np.searchsorted(at, w.first)
        pairs = self.candidates(h, at, word_rows)
        last, own = -1, None
        for row, item in pairs.tolist():
            if row != last:
                last, own = row, np.unique(h[begin[row] : begin[row + 1]])
            mine = self.sets[item]
            if len(own):
                where = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                shared = int((own[where] == mine).sum())
                if 100 * shared >= percent * len(mine):
                    found.append((row, item, len(mine), shared))
        for m, hashes in self.short_hash.items():
            spot, g = tk.windows(w.hash, w.first, m) if m > 1 else (np.arange(len(w.hash)), tk.mix(w.hash))
            for i, x in zip(self.short[m], hashes, strict=True):
                found += [(r, i, 1, 1) for r in np.unique(word_rows[spot[g == x]]).tolist()]
        return sorted(found)


def _short_hashes(hashes: np.ndarray, begin: np.ndarray, m: int) -> np.ndarray:
    h = hashes[begin].copy()
    for k in range(1, m):
        h *= tk.MIX2
        h += hashes[begin + k]
    return tk.mix(h)


def _blocks(items: DataFrame, ident: str, text: str, width: int):
    """Indexes of the items, a bounded number of rows and bytes at a time."""
    chosen = items.select(F.col(ident).alias("i"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    rows, size = chosen.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    parts = max(1, -(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for k in range(parts):
        got = chosen.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k).orderBy("i", "t").collect()
        yield ItemIndex([r["i"] for r in got], [r["t"] for r in got], width)


def contained_items(
    docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 5, percent: int = 80,
) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared) for every item of which a text holds at least ``percent``.

    Shingles are ``width`` words; an item with fewer words is one shingle, looked for as it stands. Null, empty and
    wordless texts and items match nothing. Repeated rows give repeated results, null ids stay null, empty tables give
    no rows, and other columns are ignored.
    """
    kinds = docs.schema[ident].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    chosen = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("__text"))
    item_type = to_arrow_type(items.schema[item_id].dataType)
    out = None
    for index in _blocks(items, item_id, item_text, width):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for part, buf, off in tk.balanced(batches, "__text", 1 << 21):
                got = sent.value.search(buf, off, percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array([g[0] for g in got], pa.int64())),
                        pa.array([sent.value.ids[g[1]] for g in got], item_type),
                        pa.array([g[2] for g in got], pa.int64()),
                        pa.array([g[3] for g in got], pa.int64()),
                    ],
                    ["doc_id", "item_id", "n_item_shingles", "n_shared"],
                )

        hits = chosen.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item_shingles long, n_shared long")
        out = hits if out is None else out.unionByName(hits)
    return out


def decontaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    Null, empty and wordless texts and items match nothing; repeated rows share their fate; empty tables give what is
    there. The texts are read once for each block of items (``BLOCK_ITEMS``, ``BLOCK_BYTES``).
    """
    for index in _blocks(items, item_id, item_text, width):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for part, buf, off in tk.balanced(batches, text, 1 << 21):
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[g[0] for g in sent.value.search(buf, off, percent)]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
