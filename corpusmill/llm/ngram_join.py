"""N-gram Jaccard join (operator 5): rare-first prefix filtering with length, positional and suffix filters.

1. Each block of documents learns the document frequency of its word n-grams. An n-gram of one document matches
   nothing; it only lengthens the head of the rare-first order.
2. A text of n distinct n-grams emits those of its first n - ceil(t n) + 1 that another text holds, with their places.
3. Texts with equal sets are one node. Nodes that share a prefix n-gram are first paired with one pivot of that n-gram,
   then within random parts of its group, four times larger in each round. Length, positional and suffix filters drop
   pairs; each pair left is verified exactly. Linked nodes merge, and only pairs of different components go on, so a
   group of near copies is joined by a few links for each node. An n-gram is done when one part has held its whole
   group: every pair of different components that it could link has then been looked at, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as ex
from . import textkit as tk
from .components import connected_components
from .storage import materialise

RANGES = 8
FIRST_PART, GROWTH = 8, 4


def _sets(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each row and the rows' first entries; big tables go in slices."""
    buf, off = tk.buffer_of(table.column("__text"))
    parts, counts = [], []
    for i, j in tk.slices_by_bytes(off, 1 << 21):
        w = tk.words_of(buf[off[i] : off[j]], off[i : j + 1] - off[i], lower=True)
        row, h = tk.shingles(w, width)
        h, first = tk.distinct_per_row(row, h, j - i)
        parts.append(h)
        counts.append(np.diff(first))
    h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    return h, first.astype(np.int64)


def set_nodes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row's set, as a signed long."""
    n = np.diff(first)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(tk.mix(h), out=total[1:])
    other = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(tk.mix(h ^ tk.GOLD), out=other[1:])
    a, b = total[first[1:]] - total[first[:-1]], other[first[1:]] - other[first[:-1]]
    return tk.mix(tk.mix(a ^ n.astype(np.uint64)) + b).view(np.int64)


def _prefixes(docs: DataFrame, ident: str, text: str, width: int, percent: int) -> DataFrame:
    """A row per document: id, n, node, prefix n-grams that other documents hold (token, pos), and the shared part."""
    layout = ex.layout_of(docs, text, 1 / 6, 12)
    id_type = docs.schema[ident].dataType.simpleString()

    def keys_of(table):
        h, _ = _sets(table, width)
        return np.unique(layout.keys(h), return_counts=True)

    def use(table, keys, freq):
        h, first = _sets(table, width)
        n = np.diff(first)
        rows = tk.row_of(first)
        df = freq[np.searchsorted(keys, layout.keys(h))]
        alone = tk.sums(df < 2, first)
        room = n - (percent * n + 99) // 100 + 1 - alone  # prefix entries left for shared n-grams
        live = (room > 0) & (n > alone)
        pick = np.flatnonzero((df >= 2) & live[rows])
        r, hh, dd = rows[pick], h[pick], df[pick]
        count = np.bincount(r, minlength=len(n))
        start = np.concatenate([[0], np.cumsum(count)])
        order = np.lexsort((hh, dd, r))
        rank = np.arange(len(order)) - start[r[order]]
        head = rank < room[r[order]]
        tok, tok_row = hh[order][head].view(np.int64), r[order][head]
        pos = (rank[head] + alone[tok_row]).astype(np.int32)
        tok_off = np.concatenate([[0], np.cumsum(np.bincount(tok_row, minlength=len(n)))]).astype(np.int32)
        cells = np.zeros((len(n), RANGES), dtype=np.int64)
        np.add.at(cells, (r, (hh >> np.uint64(61)).astype(np.int64)), 1)
        raw = np.ascontiguousarray(hh, dtype="<u8")  # ascending in each row
        shared = [raw[start[i] : start[i + 1]].tobytes() if live[i] else None for i in range(len(n))]
        return pa.table(
            {
                "doc_id": table.column("__id"),
                "n": pa.array(n, pa.int64()),
                "node": pa.array(set_nodes(h, first)),
                "token": pa.ListArray.from_arrays(pa.array(tok_off), pa.array(tok)),
                "pos": pa.ListArray.from_arrays(pa.array(tok_off), pa.array(pos)),
                "cells": pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * RANGES), pa.array(cells.ravel().astype(np.int32))),
                "shared": pa.array(shared, pa.binary()),
            }
        )

    schema = f"doc_id {id_type}, n long, node long, token array<long>, pos array<int>, cells array<int>, shared binary"
    return ex.with_answers(ex.blocked(docs, layout, ident, text), layout, keys_of, "sum", use, schema)


def _candidate(a: str, b: str, percent: int):
    """Length, positional and suffix filters on two prefix entries of one token."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    length = (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
    need = percent * (na + nb)
    place = (100 + percent) * (1 + F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos")) - 1) >= need
    # the parts of both sets in each range of hashes bound their overlap, as in suffix filtering
    overlap = sum(F.least(F.col(f"{a}.cells")[i], F.col(f"{b}.cells")[i]) for i in range(RANGES))
    return length & place & ((100 + percent) * overlap >= need)


def _verified(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """(a, b): the components of the pairs (x, y) of nodes that link."""
    left = shared.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("shared").alias("sx"))
    right = shared.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("shared").alias("sy"))

    def run(batches):
        for batch in batches:
            keep = []
            for nx, sx, ny, sy in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                a, b = np.frombuffer(sx, dtype="<u8"), np.frombuffer(sy, dtype="<u8")
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                inter = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(100 * inter >= percent * (nx + ny - inter))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(left, "x").join(right, "y").select("a", "b", "nx", "sx", "ny", "sy")
    return full.mapInArrow(run, "a long, b long").distinct()


def _pairs(live: DataFrame, part: int, percent: int) -> DataFrame:
    """(x, y, a, b): node pairs of different components a and b that pass the filters.

    With ``part`` 0 each node meets the smallest set of each of its n-grams; otherwise the n-gram's group is dealt at
    random to parts of about that many nodes, and those of one part meet.
    """
    x, y = F.col("a.node"), F.col("b.node")
    on = (F.col("a.token") == F.col("b.token")) & (F.col("a.component") != F.col("b.component"))
    if part:
        deal = F.pmod(F.xxhash64("node", "token", F.lit(part)), F.ceil(F.col("m") / part))
        live = live.withColumn("part", deal)
        others, on = live, on & (F.col("a.part") == F.col("b.part")) & (x < y)
    else:
        whole = F.struct("node", "n", "pos", "cells", "component")
        others = live.groupBy("token").agg(F.min_by(whole, F.struct("n", "node")).alias("p")).select("token", "p.*")
        on = on & (x != y)
    near = live.alias("a").join(others.alias("b"), on & _candidate("a", "b", percent))
    ends = F.array_sort(F.array(F.struct(x.alias("node"), F.col("a.component").alias("c")), F.struct(y.alias("node"), F.col("b.component").alias("c"))))
    near = near.select(ends.alias("e")).select(*[F.col("e")[i][f].alias(k) for i, f, k in ((0, "node", "x"), (1, "node", "y"), (0, "c", "a"), (1, "c", "b"))])
    return near.distinct()


def _merged(comps: DataFrame | None, new: DataFrame) -> DataFrame:
    """(node, component) after components have become nodes of larger ones."""
    if comps is None:
        return new
    to = new.select(F.col("node").alias("component"), F.col("component").alias("to"))
    moved = comps.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return moved.unionByName(new.join(comps, "node", "left_anti"))


def _linked(entries: DataFrame, payload: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of every linked node, from entries (token, m, node, n, pos, cells); None without links."""
    comps, part = None, 0
    live = entries.withColumn("component", F.col("node"))
    while True:
        pairs = materialise(_pairs(live, part, percent), "pairs")
        needed = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()
        links = materialise(_verified(pairs, payload.join(needed, "node", "left_semi").dropDuplicates(["node"]), percent), "links")
        if not links.isEmpty():
            comps = materialise(_merged(comps, connected_components(links)), "components")
        at = entries.filter(F.col("m") > part)  # smaller groups were one part: they are done
        if comps is None:
            at = at.withColumn("component", F.col("node"))
        else:
            at = at.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
        span = at.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        live = materialise(at.join(span.filter("lo <> hi").select("token"), "token"), "open")
        if live.isEmpty():
            return comps
        part = part * GROWTH or FIRST_PART


def similar_sets(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: near-copy classes under 100 |A n B| >= percent |A u B|.

    Sets are distinct ``width``-word shingles of the A-Z-lowered text (fewer words: the whole sequence). The component
    is the smallest id reachable by links. Null, empty and wordless texts have no shingle and are linked with nothing.
    Rows that repeat an id are rows of their own; a row with a null id takes part, and a component with no other id
    has a null one. An empty table gives no rows; other columns are ignored. Links within a component are neither
    listed nor counted: what is joined already is not compared again.
    """
    rows = materialise(_prefixes(docs, ident, text, width, percent), "sets")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    entries = rows.filter(F.size("token") > 0).select("node", "n", "cells", F.explode(F.arrays_zip("token", "pos")).alias("e"))
    entries = entries.select(F.col("e.token").alias("token"), "node", "n", F.col("e.pos").alias("pos"), "cells")
    entries = entries.groupBy("token", "node").agg(*[F.first(c).alias(c) for c in ("n", "pos", "cells")])
    crowd = entries.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1")
    entries = materialise(entries.join(crowd, "token"), "entries")
    payload = rows.filter(F.col("shared").isNotNull()).select("node", "n", "shared")
    comps = _linked(entries, payload, percent)
    if comps is None:
        comps = nodes.limit(0).select("node", F.col("node").alias("component"))
    label = nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    label = label.join(least, "component").select("node", "component_id")
    full = rows.filter("n > 0").select("doc_id", "n", "node").join(label, "node")
    out = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    bare = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(bare)


def one_per_component(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each class stays.

    Rows linked with nothing stay; rows that repeat an id share its fate. A row with a null id always stays, as it
    cannot be named. Empty tables and other columns pass as they are.
    """
    marked = similar_sets(docs, ident, text, width, percent).filter("component_id = doc_id").select(F.col("doc_id").alias("__keep")).distinct()
    named = docs.join(marked, F.col(ident) == F.col("__keep"), "left_semi")
    return named.unionByName(docs.filter(F.col(ident).isNull()))
