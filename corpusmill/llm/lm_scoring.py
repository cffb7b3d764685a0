"""LM scoring (operator 9): a weighted backoff automaton over smoothed n-grams.

Counts come from all training texts. Smoothing is Dirichlet, order by order, over an additively smoothed unigram
floor: P(w | h) = (c(h w) + m P(w | h')) / (c(h) + m). As an automaton: a seen history of up to two words is a state, an
arc for w carries log P(w | h) and leads to the longest seen history that ends with w, and the failure arc to h'
carries log(m / (c(h) + m)). One left-to-right traversal per text carries the state and adds up the weights.

No task holds the model. Texts are dealt to blocks; a block builds the part of the automaton that its texts can reach.
It first asks for its words' corpus-wide numbers and counts, then for the counts of its word pairs and triples, which it
sends as such numbers: no two n-grams are ever taken for one, and a message costs some two bytes for each of them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as ex
from . import textkit as tk
from .storage import materialise

END = tk.mix(np.array([0x0E17D], dtype=np.uint64))[0]
#: Dirichlet masses of orders 2 and 3, by the log-probability of held-out texts.
MASS = (2000.0, 8.0)
SEGMENT = 128


def held_out(ids: list, folds: int, fold: int) -> np.ndarray:
    return np.array([x is not None and zlib.crc32(str(x).encode()) % folds == fold for x in ids], dtype=bool)


def tokens_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, each row's words and one end, and the rows' first tokens (n + 1)."""
    w = tk.words_of(buf, off, lower=True)
    n = len(off) - 1
    first = w.first + np.arange(n + 1)
    out = np.empty(len(w.hash) + n, dtype=np.uint64)
    out[first[1:] - 1] = END
    out[np.arange(len(w.hash)) + tk.row_of(w.first)] = w.hash
    return out, first


def sorted_distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of each key among them, and a place in ``keys`` for each distinct one."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    where = np.empty(len(keys), dtype=np.int64)
    where[order] = np.cumsum(new) - 1
    return ranked[new], where, order[new]


class Grams:
    """The words, pairs and triples of a block's texts, each numbered within the block.

    ``word[p]`` is the number of the token at p; ``pair[p]`` and ``triple[p]`` those of the n-grams that end at p, or -1
    where a row is too short so far. Pairs are in order of the two words' corpus-wide numbers ``ids``.
    """

    def __init__(self, tokens: np.ndarray, first: np.ndarray, ids: np.ndarray | None = None):
        self.first = first
        self.hashes, self.word, _ = sorted_distinct(tokens)
        if ids is None:
            return
        order = np.argsort(ids)
        self.ids = ids[order]
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.arange(len(ids))
        self.by_id, self.word = order, rank[self.word]
        n, w = len(tokens), max(1, len(ids))
        place = np.arange(n) - np.repeat(first[:-1], np.diff(first))
        at = np.flatnonzero(place >= 1)
        keys, where, _ = sorted_distinct(self.word[at - 1] * w + self.word[at])
        self.pair = np.full(n, -1, dtype=np.int64)
        self.pair[at] = where
        self.left, self.right = keys // w, keys % w
        at = np.flatnonzero(place >= 2)
        keys, where, some = sorted_distinct(self.pair[at - 1] * w + self.word[at])
        self.triple = np.full(n, -1, dtype=np.int64)
        self.triple[at] = where
        self.history, self.last = keys // w, keys % w  # of each triple: its first two words, and the third
        self.suffix = self.pair[at][some]  # its last two words

    def counts(self, which: np.ndarray, n: int, train: np.ndarray) -> np.ndarray:
        """How often each of ``n`` numbers stands in training rows."""
        return np.bincount(which[train & (which >= 0)], minlength=n)


class Route:
    """Pairs by shard, each with its triples: the order in which a block asks and is answered."""

    def __init__(self, g: Grams, shards: int):
        key = tk.mix(g.ids[g.left] * tk.MIX1 + g.ids[g.right])
        shard = (key % np.uint64(shards)).astype(np.int64)
        self.pairs = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
        self.cut = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
        size = np.bincount(g.history, minlength=len(g.left))
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]  # triples are in order of their pairs
        self.size = size[self.pairs]
        stop = np.cumsum(self.size)
        self.triples = np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin[self.pairs] - (stop - self.size), self.size)
        self.triple_cut = np.concatenate([[0], stop])[self.cut]
        self.used = np.flatnonzero(np.diff(self.cut)).tolist()

    def parts(self):
        for s in self.used:
            yield s, slice(self.cut[s], self.cut[s + 1]), slice(self.triple_cut[s], self.triple_cut[s + 1])


class Automaton:
    """States, arcs and failure arcs for the n-grams of one block, with corpus-wide counts.

    State 0 is the root, then come the words' states and the pairs' states. Arcs are the n-grams: those of words leave
    the root, those of pairs their first word's state, those of triples their first pair's state.
    """

    def __init__(self, g: Grams, count: list[np.ndarray], total: int, vocabulary: int, mass: tuple[float, float]):
        self.g = g
        w, (c1, c2, c3) = len(g.ids), (c.astype(np.float64) for c in count)
        p1 = (c1 + 0.5) / (total + 0.5 * (vocabulary + 1))
        p2 = (c2 + mass[0] * p1[g.right]) / (c1[g.left] + mass[0])
        p3 = (c3 + mass[1] * p2[g.suffix]) / (c2[g.history] + mass[1])
        one = np.where(c1 > 0, 1 + np.arange(w), 0)
        two = np.where(c2 > 0, 1 + w + np.arange(len(c2)), one[g.right])
        self.known, self.base = c1 > 0, np.log10(p1)
        self.fail_to = np.concatenate([[0], np.zeros(w, np.int64), one[g.right]])
        self.fail_weight = np.log10(np.concatenate([[1.0], mass[0] / (c1 + mass[0]), mass[1] / (c2 + mass[1])]))
        self.order = np.repeat([0, 1, 2], [1, w, len(c2)])
        self.arc_weight = [self.base, np.log10(p2), np.log10(p3)]
        self.arc_to = [one, two, two[g.suffix]]
        self.arc_is = [np.ones(w, dtype=bool), c2 > 0, c3 > 0]
        # the state that a text's tokens up to p leave: where a later segment of a long text sets out
        self.after = np.where(g.pair >= 0, two[g.pair], one[g.word]) if len(c2) else one[g.word]

    def traverse(self) -> np.ndarray:
        """Log10 probability of each row, token by token; long rows are taken up in segments side by side."""
        g = self.g
        length = np.diff(g.first)
        pieces = -(-length // SEGMENT)
        row = np.repeat(np.arange(len(length)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = g.first[:-1][row] + nth * SEGMENT
        left = np.minimum(length[row] - nth * SEGMENT, SEGMENT)
        state = np.where(nth > 0, self.after[np.maximum(start - 1, 0)], 0)
        order = np.argsort(-left, kind="stable")
        start, left, state, acc = start[order], left[order], state[order], np.zeros(len(order))
        alive = len(left) - np.searchsorted(left[::-1], np.arange(int(left.max()) if len(left) else 0), side="right")
        at = (g.word, g.pair, g.triple)
        for t, n in enumerate(alive.tolist()):
            p, s = start[:n] + t, state[:n]
            weight, to = np.empty(n), np.empty(n, dtype=np.int64)
            order_of = self.order[s]
            for k in (2, 1, 0):  # from each state by its arc for the token, or by failure arcs to a state that has one
                here = np.flatnonzero(order_of == k)
                arc = at[k][p[here]]
                has = (arc >= 0) & self.arc_is[k][arc] if len(self.arc_is[k]) else np.zeros(len(here), dtype=bool)
                go, arc = here[has], arc[has]
                weight[go], to[go] = self.arc_weight[k][arc], self.arc_to[k][arc]
                stay = here[~has]
                acc[stay] += self.fail_weight[s[stay]]
                s[stay] = self.fail_to[s[stay]]
                order_of[stay] = self.order[s[stay]]
                order_of[go] = -1
            acc[:n] += weight
            state[:n] = to
        each = np.empty(len(order))
        each[order] = acc
        out = np.zeros(len(length))
        np.add.at(out, row, each)
        return out


def _vocabulary(docs: DataFrame, ident: str, text: str, folds: int, fold: int, shards: int) -> tuple[int, int]:
    """Training tokens N and distinct ones V; partial distinct sets meet by shard of the hash space."""
    chosen = docs.select(F.col(ident).alias("__id"), F.col(text).alias("__text"))
    cutter = ex.Layout(1, shards, 64)

    def part(batches):
        pool, total = [], 0

        def send():
            keys = np.unique(np.concatenate(pool))
            cut = cutter.cuts(keys)
            used = [s for s in range(shards) if cut[s] < cut[s + 1]]
            blobs = [ex.pack_sorted(keys[cut[s] : cut[s + 1]]) for s in used]
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([0] * len(used), pa.int64()), pa.array(blobs, pa.binary())], ["shard", "n", "keys"])

        for batch, buf, off in tk.balanced(batches, "__text", 1 << 21):
            train = ~held_out(batch.column(0).to_pylist(), folds, fold)
            tokens, first = tokens_of(buf, off)
            tokens = tokens[np.repeat(train, np.diff(first))]
            total += len(tokens)
            pool.append(np.unique(tokens))
            if sum(map(len, pool)) > 1_500_000:
                pool = [np.unique(np.concatenate(pool))]
                if len(pool[0]) > 1_000_000:
                    yield send()
                    pool = []
        if pool:
            yield send()
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([total], pa.int64()), pa.array([b""], pa.binary())], ["shard", "n", "keys"])

    def unite(table: pa.Table) -> pa.Table:
        got = [ex.unpack_sorted(x.as_py()) for x in table.column("keys") if len(x.as_py())]
        n = len(np.unique(np.concatenate(got))) if got else 0
        return pa.table({"v": pa.array([n], pa.int64())})

    sent = chosen.mapInArrow(part, "shard long, n long, keys binary")
    sent = materialise(sent, "vocabulary")
    total = sent.filter("shard < 0").agg(F.sum("n")).first()[0] or 0
    distinct = sent.filter("shard >= 0").groupBy("shard").applyInArrow(unite, "v long").agg(F.sum("v")).first()[0] or 0
    return total, distinct


def answer_words(table: pa.Table, shards: int) -> pa.Table:
    """For each block's words: their numbers, small for frequent words and distinct over all shards, and their counts."""
    keys = [ex.unpack_sorted(x.as_py()) for x in table.column("keys")]
    vals = [ex.unpack(x.as_py()) for x in table.column("vals")]
    distinct, where, _ = sorted_distinct(np.concatenate(keys))
    count = np.zeros(len(distinct), dtype=np.uint64)
    np.add.at(count, where, np.concatenate(vals))
    rank = np.empty(len(distinct), dtype=np.int64)
    rank[np.lexsort((distinct, -count.astype(np.int64)))] = np.arange(len(distinct))
    number = rank * shards + table.column(ex.SHARD)[0].as_py()
    stop = np.cumsum([len(k) for k in keys])
    told = [where[b - len(k) : b] for k, b in zip(keys, stop, strict=True)]
    return _messages(table.column(ex.BLOCK), table.column(ex.SHARD), [ex.pack(number[t]) for t in told], [ex.pack(count[t]) for t in told])


def answer_grams(table: pa.Table) -> pa.Table:
    """For each block's pairs and triples: their counts over all blocks."""
    each = [ex.unpack_all(x.as_py(), 6) for x in table.column("keys")]
    left, right, size, last, c2, c3 = (np.concatenate([e[i] for e in each]) for i in range(6))
    start = np.cumsum([0] + [len(e[0]) for e in each])[:-1]
    left = np.concatenate([np.cumsum(e[0], dtype=np.uint64) for e in each])
    _, pair, _ = sorted_distinct(_two(left, right))
    _, triple, _ = sorted_distinct(_two(np.repeat(pair.astype(np.uint64), size.astype(np.int64)), last))
    totals = []
    for where, count in ((pair, c2), (triple, c3)):
        total = np.zeros(int(where.max()) + 1 if len(where) else 0, dtype=np.uint64)
        np.add.at(total, where, count)
        totals.append(total[where])
    stop3 = np.cumsum([len(e[3]) for e in each])
    vals = [ex.pack_all([totals[0][a : a + len(e[0])], totals[1][b - len(e[3]) : b]]) for e, a, b in zip(each, start, stop3, strict=True)]
    return _messages(table.column(ex.BLOCK), table.column(ex.SHARD), [b""] * len(vals), vals)


def _two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key for each pair of numbers; numbers beyond 32 bits are renumbered first."""
    for x in (a, b):
        if len(x) and int(x.max()) >> 32:
            return sorted_distinct(a)[1].astype(np.uint64) << np.uint64(32) | sorted_distinct(b)[1].astype(np.uint64)
    return a << np.uint64(32) | b


def _messages(block, shard, keys: list[bytes], vals: list[bytes]) -> pa.Table:
    return pa.table({ex.BLOCK: block, ex.SHARD: shard, "keys": pa.array(keys, pa.binary()), "vals": pa.array(vals, pa.binary())})


def score_documents(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    fold: int = 1,
    mass: tuple[float, float] = MASS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, by a trigram model.

    Training texts are those whose crc32(id as text) mod ``folds`` is not ``fold``; a null id trains. Null texts count
    as empty: one end token. Repeated rows count as often as they stand. An empty table gives no rows, and without
    training texts every token has the floor's probability. Other columns are ignored. Words are told apart by 64-bit
    hashes, n-grams by their words.
    """
    layout = ex.layout_of(docs, text, 1 / 2, 64, block_bytes=6 << 20)
    word_shards = max(1, layout.shards // 8)
    words = ex.Layout(layout.blocks, word_shards, 64)
    total, vocabulary = _vocabulary(docs, ident, text, folds, fold, word_shards)
    kind = docs.schema[ident].dataType.simpleString()

    def read(table):
        tokens, first = tokens_of(*tk.buffer_of(table.column("__text")))
        return tokens, first, np.repeat(~held_out(table.column("__id").to_pylist(), folds, fold), np.diff(first))

    def ask_words(table):
        tokens, first, train = read(table)
        g = Grams(tokens, first)
        count = g.counts(g.word, len(g.hashes), train)
        cut = words.cuts(g.hashes)
        used = np.flatnonzero(np.diff(cut)).tolist()
        part = [slice(cut[s], cut[s + 1]) for s in used]
        block = pa.array([table.column(ex.BLOCK)[0].as_py()] * len(used), pa.int64())
        return _messages(block, pa.array(used, pa.int64()), [ex.pack_sorted(g.hashes[x]) for x in part], [ex.pack(count[x]) for x in part])

    def told_words(told):
        """The numbers and counts of the block's words, in order of their hashes."""
        got = sorted(zip(told.column(ex.SHARD).to_pylist(), told.column("keys").to_pylist(), told.column("vals").to_pylist(), strict=True))
        return np.concatenate([ex.unpack(k) for _, k, _ in got]), np.concatenate([ex.unpack(v) for _, _, v in got])

    def ask_grams(table, told):
        tokens, first, train = read(table)
        g = Grams(tokens, first, told_words(told)[0])
        route = Route(g, layout.shards)
        c2 = g.counts(g.pair, len(g.left), train)[route.pairs]
        c3 = g.counts(g.triple, len(g.last), train)[route.triples]
        left, right, last = g.ids[g.left[route.pairs]], g.ids[g.right[route.pairs]], g.ids[g.last[route.triples]]
        keys = [ex.pack_all([np.diff(left[a], prepend=np.uint64(0)), right[a], route.size[a], last[b], c2[a], c3[b]]) for _, a, b in route.parts()]
        block = pa.array([table.column(ex.BLOCK)[0].as_py()] * len(keys), pa.int64())
        return _messages(block, pa.array(route.used, pa.int64()), keys, [b""] * len(keys))

    def use(table, told):
        tokens, first, _ = read(table)
        from_words = np.array([len(k) > 0 for k in told.column("keys").to_pylist()])
        ids, c1 = told_words(told.filter(pa.array(from_words)))
        g = Grams(tokens, first, ids)
        route = Route(g, layout.shards)
        c2, c3 = np.zeros(len(g.left), np.uint64), np.zeros(len(g.last), np.uint64)
        rest = told.filter(pa.array(~from_words))
        got = dict(zip(rest.column(ex.SHARD).to_pylist(), rest.column("vals").to_pylist(), strict=True))
        for s, a, b in route.parts():
            c2[route.pairs[a]], c3[route.triples[b]] = ex.unpack_all(got[s], 2)
        model = Automaton(g, [c1[g.by_id], c2, c3], total, vocabulary, mass)
        n, doc_ids = np.diff(first), table.column("__id")
        return pa.table(
            {
                "doc_id": doc_ids,
                "held_out": pa.array(held_out(doc_ids.to_pylist(), folds, fold)),
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(tk.sums(model.known[g.word], first), pa.int64()),
                "train_tokens": pa.array(np.full(len(n), total), pa.int64()),
                "base_score": pa.array(np.add.reduceat(model.base[g.word], first[:-1])),
                "score": pa.array(model.traverse()),
            }
        )

    rows = ex.blocked(docs, layout, ident, text)
    asked = rows.groupBy(ex.BLOCK).applyInArrow(ask_words, ex.MESSAGES)
    known = asked.groupBy(ex.SHARD).applyInArrow(lambda t: answer_words(t, word_shards), ex.MESSAGES)
    asked = rows.groupBy(ex.BLOCK).cogroup(known.groupBy(ex.BLOCK)).applyInArrow(ask_grams, ex.MESSAGES)
    counted = asked.groupBy(ex.SHARD).applyInArrow(answer_grams, ex.MESSAGES)
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy(ex.BLOCK).cogroup(known.unionByName(counted).groupBy(ex.BLOCK)).applyInArrow(use, schema)
