"""Substring dedup (operator 10) by content-defined chunking with a gear rolling hash.

Cuts are where the gear hash of the last 32 bytes is small, so they move with the content and survive insertions. From
every cut a variable chunk runs to the first cut at least ``span`` bytes on; chunks are deduplicated by digest across
the corpus. The chunk's first owner is the smallest id that holds it; runs of chunks that an earlier document owns are
one repeated passage, reported (or removed) if it has enough words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as ex
from . import textkit as tk

GEAR = (tk.mix(np.arange(256, dtype=np.uint64) + np.uint64(1000)) >> np.uint64(32)).astype(np.uint32)
MEAN, LONGEST, SPAN, MIN_WORDS = 12, 256, 96, 30
TOP = np.uint64(np.iinfo(np.uint64).max)


def gear(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: sum of GEAR[byte] << age over the last 32 bytes of the same row."""
    h = GEAR[buf]
    rows = off[:-1][np.diff(off) > 0]
    for k in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[k:] = h[:-k] << np.uint32(k)
        near = (rows[:, None] + np.arange(k)).ravel()
        older[near[near < len(h)]] = 0
        h += older
    return h


def cuts_of(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ascending cut positions of all rows: content cuts, row edges, and one each LONGEST bytes where none fell."""
    at = np.flatnonzero(gear(buf, off) < np.uint32((1 << 32) // MEAN)) + 1
    at = np.union1d(at, off)
    more = (np.diff(at) - 1) // LONGEST
    if more.any():
        i = np.repeat(np.arange(len(more)), more)
        k = np.arange(len(i)) - np.repeat(np.cumsum(more) - more, more) + 1
        at = np.union1d(at, at[i] + k * LONGEST)
    return at


def chunks(buf: np.ndarray, off: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, digest) of every chunk; none passes its row's end."""
    cut = cuts_of(buf, off)
    row = np.searchsorted(off, cut, side="right") - 1
    end = np.searchsorted(cut, cut + span)
    ok = (row < len(off) - 1) & (end < len(cut))
    cut_end = cut[np.minimum(end, len(cut) - 1)]
    ok &= cut_end <= np.append(off[1:], 0)[np.minimum(row, len(off) - 1)]
    start, stop = cut[ok], cut_end[ok]
    return row[ok], start, stop, tk.span_hash(buf, start, stop)


def id_order(ids: pa.ChunkedArray) -> np.ndarray:
    """Integer ids as unsigned numbers of the same order; null ones come last."""
    plain = ids.cast(pa.int64()).fill_null(0).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.where(ids.is_null().to_numpy(), TOP, plain)


def _slices(table: pa.Table, span: int):
    buf, off = tk.buffer_of(table.column("__text"))
    for i, j in tk.slices_by_bytes(off, 1 << 21):
        part, at = buf[off[i] : off[j]], off[i : j + 1] - off[i]
        yield i, part, at, *chunks(part, at, span)


def repeated_passages(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, span: int = SPAN
) -> DataFrame:
    """(doc_id, start, length, n_words, first_doc_id) of every passage that a smaller id holds too, in bytes.

    Also passages that come again later in the same text. Bounds are trimmed to whole words. Null and empty texts, and
    texts shorter than ``span`` bytes, hold no passage. Rows that repeat an id are one document: what they share is no
    repeat. Null ids come after all others. An empty table gives no rows; other columns are ignored. Ids are integers.
    Chunks are equal if their whole 64-bit digests are.
    """
    layout = ex.layout_of(docs, text, 1 / MEAN, 64)
    kind = docs.schema[ident].dataType.simpleString()

    def keys_of(table):
        order = id_order(table.column("__id"))
        digest, owner = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for i, _, _, row, _, _, h in _slices(table, span):
            digest.append(layout.keys(h))
            owner.append(order[i + row])
        digest, owner = np.concatenate(digest), np.concatenate(owner)
        by = np.lexsort((owner, digest))
        digest, owner = digest[by], owner[by]
        first = np.append(True, digest[1:] != digest[:-1]) if len(digest) else np.empty(0, bool)
        return digest[first], owner[first]

    def use(table, keys, firsts):
        ids, order = table.column("__id"), id_order(table.column("__id"))
        out = {k: [] for k in ("row", "start", "length", "n_words", "first")}
        for i, buf, off, row, start, end, h in _slices(table, span):
            if not len(h):
                continue
            key = layout.keys(h)
            first = firsts[np.searchsorted(keys, key)]
            again = first < order[i + row]
            own = np.flatnonzero(~again)  # the owner: only what comes again later in its text
            by = own[np.lexsort((start[own], key[own], row[own]))]
            new = np.append(True, (key[by][1:] != key[by][:-1]) | (row[by][1:] != row[by][:-1])) if len(by) else np.empty(0, bool)
            head = by[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(by) else by
            again[by] = ~new & (start[by] >= end[head])
            hit = np.flatnonzero(again)
            if not len(hit):
                continue
            r, a, b = row[hit], start[hit], end[hit]
            reach = np.maximum.accumulate(b)
            fresh = np.append(True, (r[1:] != r[:-1]) | (a[1:] > reach[:-1]))
            lead = np.flatnonzero(fresh)
            a, b, r = a[lead], reach[np.append(lead[1:], len(reach)) - 1], r[lead]
            ws, we = tk.edges(buf, off, tk.NOT_SPACE)
            lo, hi = np.searchsorted(ws, a), np.searchsorted(we, b, side="right")
            keep = hi - lo >= min_words
            lo, hi = lo[keep], hi[keep]
            out["row"].append(i + r[keep])
            out["start"].append(ws[lo] - off[r[keep]])
            out["length"].append(we[hi - 1] - ws[lo])
            out["n_words"].append(hi - lo)
            out["first"].append(first[hit[lead]][keep])
        got = {k: np.concatenate([np.empty(0, np.int64), *v]) if k != "first" else np.concatenate([np.empty(0, np.uint64), *v]) for k, v in out.items()}
        source = (got["first"] ^ np.uint64(1 << 63)).view(np.int64)
        return pa.table(
            {
                "doc_id": ids.take(pa.array(got["row"])),
                "start": pa.array(got["start"], pa.int64()),
                "length": pa.array(got["length"], pa.int64()),
                "n_words": pa.array(got["n_words"], pa.int64()),
                "first_doc_id": pa.array(source, mask=got["first"] == TOP).cast(ids.type),
            }
        )

    schema = f"doc_id {kind}, start long, length long, n_words long, first_doc_id {kind}"
    return ex.with_answers(ex.blocked(docs, layout, ident, text), layout, keys_of, "min", use, schema)


def without_passages(docs: DataFrame, passages: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of their texts; a text that loses nothing stays as it is."""
    spans = passages.groupBy(F.col("doc_id").alias("__id")).agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("__spans"))
    names = docs.columns
    joined = docs.join(spans, F.col(ident) == F.col("__id"), "left")
    raw = F.encode(F.col(text), "utf-8")
    n = F.size("__spans")
    begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.col("__spans")[k - 1]["start"] + F.col("__spans")[k - 1]["length"])
    stop = lambda k: F.when(k == n, F.octet_length(text)).otherwise(F.col("__spans")[F.least(k, n - 1)]["start"])
    kept = F.transform(F.sequence(F.lit(0), n), lambda k: F.decode(F.substring(raw, (begin(k) + 1).cast("int"), F.greatest(stop(k) - begin(k), F.lit(0)).cast("int")), "utf-8"))
    changed = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.array_join(kept, ""))
    return joined.select(*[changed.alias(c) if c == text else F.col(f"`{c}`") for c in names])
