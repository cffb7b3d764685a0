"""Best-fit packing (operator 3) of token sequences into bins of fixed capacity.

What has to be solved depends only on how many pieces there are of each length, at most ``capacity`` numbers however
large the corpus is, so the driver plans over counts: bin completion by branch and bound with the best-fit solution as
incumbent. A plan is a list of runs, a filling and how often it is used. The pieces get a rank within their length by
salted windows (a hot length is many groups) and look their slot up in the plan.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .storage import materialise
from .token_counts import Memo, texts_of

CAPACITY = 2048
#: Bound on the search, some ten seconds of the driver; best-fit completes a dive at about so many places.
SEARCH_STEPS, COMPLETIONS, OPEN_NODES = 3_000_000, 8, 32
Run = tuple[tuple[int, ...], int]


# ---- token ids -------------------------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies print a byte as itself where visible, else as the next unused letter from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def unit_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where units begin: at row starts, and at a blank or line feed after a character that is surely no white space.

    A token of a byte-level vocabulary holds no white space after another character, so none spans such a place.
    """
    at = np.flatnonzero((buf == 32) | (buf == 10))
    at = at[at > 0]
    b1 = buf[at - 1]
    b2, b3 = buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 3, 0)]
    odd = ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 >= 0xE1) & (b3 <= 0xE3))
    safe = ((b1 > 32) & (b1 < 127)) | ((b1 >= 128) & ~odd)
    rows = off[:-1][np.diff(off) > 0]
    return np.union1d(at[safe], rows)


class UnitIds:
    """Token ids of the rows of a buffer by a byte-level vocabulary of the tokenizers library.

    Merges run in tiktoken over the ranks of the same file, which gives the same ids; units that hold the string of an
    added token go to the library itself. Units are encoded once while the bounded memo lasts.
    """

    POOL_LIMIT = 12_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters = byte_letters()
        self.added = [t["content"] for t in told["added_tokens"]]
        ranks = {bytes(letters[c] for c in w): i for w, i in told["model"]["vocab"].items() if w not in self.added}
        # fixed value: the pattern of byte-level pre-tokenisation
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(path)
        self.memo = Memo(2_000_000)
        self.clear()

    def clear(self) -> None:
        self.memo.clear()
        self.pool, self.used = np.empty(1 << 20, np.uint32), 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, size = [], []
        for t in texts:
            if any(a in t for a in self.added):
                got = self.slow.encode(t, add_special_tokens=False).ids
            else:
                got = self.fast.encode_ordinary(t)
            ids += got
            size.append(len(got))
        return np.array(ids, dtype=np.uint32), np.array(size, dtype=np.int64)

    def ids(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids, and the rows' first ones (n + 1)."""
        if self.memo.full() or self.used > self.POOL_LIMIT:
            self.clear()
        start = unit_starts(buf, off)
        end = np.append(start[1:], len(buf))
        keys, where, inverse = np.unique(tk.span_hash(buf, start, end), return_index=True, return_inverse=True)
        got = self.memo.get(keys)
        at, size = got >> 24, got & 0xFFFFFF
        new = np.flatnonzero(got < 0)
        if len(new):
            ids, n = self.encode(texts_of(buf, start[where[new]], end[where[new]]))
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            self.pool[self.used : self.used + len(ids)] = ids
            at[new], size[new] = self.used + np.cumsum(n) - n, n
            self.used += len(ids)
            short = new[n < 1 << 24]  # a longer unit does not fit the packed form and is not remembered
            self.memo.put(keys[short], (at[short] << 24) | size[short])
        at, size = at[inverse], size[inverse]
        stop = np.cumsum(size)
        take = np.arange(stop[-1] if len(stop) else 0) + np.repeat(at - (stop - size), size)
        first = np.concatenate([[0], stop])[np.searchsorted(start, off)]
        return self.pool[take], first


_IDS: dict[str, UnitIds] = {}
PIECES = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, ident: str, text: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every row's ids and ``end_id``, cut only beyond ``capacity``."""

    def run(batches):
        encoder = _IDS.get(tokenizer) or _IDS.setdefault(tokenizer, UnitIds(tokenizer))
        for part, buf, off in tk.balanced(batches, "__text", 1 << 20):
            ids, first = encoder.ids(buf, off)
            row, piece, begin, length, crc = [], [], [], [], []
            for i in range(part.num_rows):
                whole = np.append(ids[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                a, b, k = 0, len(whole) % capacity or capacity, 0
                while a < len(whole):
                    row.append(i)
                    piece.append(k)
                    begin.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(whole[a:b].tobytes()))
                    a, b, k = b, b + capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32())] + [pa.array(x, pa.int64()) for x in (begin, length, crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[ident].dataType.simpleString()
    chosen = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("__text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, {PIECES}")


# ---- the plan --------------------------------------------------------------------------------------------------


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any solution needs: by volume, and by pieces above half a bin with what cannot join them."""
    best = -(-sum(s * c for s, c in counts.items()) // capacity)
    sizes = sorted(counts)
    for k in (x for x in sizes if 2 * x <= capacity):
        big = sum(c for s, c in counts.items() if s > capacity - k)
        mid = [(s, c) for s, c in counts.items() if capacity - k >= s > capacity // 2]
        low = sum(s * c for s, c in counts.items() if k <= s <= capacity // 2)
        n_mid = sum(c for _, c in mid)
        free = n_mid * capacity - sum(s * c for s, c in mid)
        best = max(best, big + n_mid + max(0, -(-(low - free) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over counts: bins alike are one group."""
    groups: dict[int, list[list]] = {}
    rooms: list[int] = []

    def add(room: int, filling: tuple[int, ...], n: int) -> None:
        if n:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append([filling, n])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            if at < len(rooms):
                filling, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                filling, n = (), left
            each = room // size
            whole = min(n, left // each)
            left -= whole * each
            add(room - each * size, filling + (size,) * each, whole)
            n -= whole
            if n and left and left < each:
                add(room - left * size, filling + (size,) * left, 1)
                n, left = n - 1, 0
            if filling:
                add(room, filling, n)
    return [(f, n) for group in groups.values() for f, n in group]


class Spent(Exception):
    """The search has used up its steps."""


class Steps:
    """What is left of the bound on a search."""

    def __init__(self, n: int):
        self.left = n

    def take(self, n: int = 1) -> None:
        self.left -= n
        if self.left < 0:
            raise Spent


def fillings(counts: dict[int, int], sizes: list[int], room: int, most_waste: int, steps: Steps) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(waste, filling) of every undominated way to fill ``room``, least waste first and larger pieces before smaller.

    Sums that the sizes up to each one reach are bit sets, so the walk never enters a branch without a filling. A
    filling is dominated if one of its pieces, two of them together, or its waste can give way to one larger piece that
    is still to be placed.
    """
    usable = sizes[: bisect.bisect_right(sizes, room)]
    limit = [counts[s] for s in usable]
    spare = dict(zip(usable, limit, strict=True))
    mask = (1 << (room + 1)) - 1
    reach, sums = [], 1
    for s, n in zip(usable, limit, strict=True):
        if sums != mask:
            n, k = min(n, room // s), 1
            while n > 0:
                sums |= sums << (min(k, n) * s)
                n, k = n - k, 2 * k
            sums &= mask
        reach.append(sums)
    steps.take(1 + len(usable) // 8)

    def free_up_to(low: int, high: int, used: Counter) -> bool:
        """Whether a piece of ``low`` to ``high`` is left beside those used."""
        at = bisect.bisect_left(usable, low)
        while at < len(usable) and usable[at] <= high:
            if spare[usable[at]] > used[usable[at]]:
                return True
            at += 1
        return False

    def dominated(used: Counter, waste: int) -> bool:
        each = sorted(used)
        if any(free_up_to(x + 1, x + waste, used) for x in [0, *each]):
            return True
        pairs = {x + y for i, x in enumerate(each) for y in each[i:] if x != y or used[x] > 1}
        return any(free_up_to(p, p + waste, used) for p in pairs)

    def exact(at: int, rest: int) -> Iterator[tuple[int, ...]]:
        at = min(at, bisect.bisect_right(usable, rest) - 1)
        while at >= 0 and reach[at] >> rest & 1:
            s, below = usable[at], reach[at - 1] if at else 1
            for n in range(min(limit[at], rest // s), 0, -1):
                steps.take()
                if below >> (rest - n * s) & 1:
                    if rest == n * s:
                        yield (s,) * n
                    else:
                        for more in exact(at - 1, rest - n * s):
                            yield (s,) * n + more
            at -= 1
            steps.take()

    for waste in range(min(room, most_waste) + 1):
        if waste == room:
            if not usable:
                yield waste, ()
        elif sums >> (room - waste) & 1:
            for pick in exact(len(usable) - 1, room - waste):
                if not dominated(Counter(pick), waste):
                    yield waste, pick


@dataclass
class Plan:
    """``runs`` place every piece in ``bins`` bins; no plan needs fewer than ``bound``, nor than ``bins`` if ``proved``."""

    runs: list[Run]
    bins: int
    bound: int
    proved: bool


@dataclass
class Node:
    """A bin to be completed: its ways not tried yet, the waste before it, and how many ways were tried.

    Only the deepest ``OPEN_NODES`` nodes keep their ways; others find them again, should the search come back.
    """

    ways: Iterator | None
    waste: int
    tried: int = 0


def bin_completion(counts: dict[int, int], capacity: int, steps: int = SEARCH_STEPS) -> Plan:
    """Branch and bound by bin completion: best-fit is the first incumbent.

    A node completes the bin of the largest piece left with each undominated filling in turn, as many times as the
    counts allow and then less often. A branch ends when its waste exceeds what a plan with fewer bins could afford;
    best-fit completes it on the way, and a better plan becomes the incumbent. ``steps`` bounds the search, not the
    input: when they are used up, the incumbent stands and ``Plan.bound`` shows how far it may be from the optimum.
    With enough steps every plan is considered.
    """
    counts = {s: c for s, c in counts.items() if c}
    runs = best_fit(counts, capacity)
    best = Plan(runs, sum(n for _, n in runs), lower_bound(counts, capacity), False)
    volume, budget = sum(s * c for s, c in counts.items()), Steps(steps)
    left, sizes, taken, waste = dict(counts), sorted(counts), [], 0
    options: list[Node] = []
    pause = next_fit = max(1, len(counts) // COMPLETIONS)

    def change(filling: tuple[int, ...], n: int) -> None:
        for x, k in Counter(filling).items():
            before = left[x]
            left[x] = before + n * k
            if left[x] and not before:
                bisect.insort(sizes, x)
            elif before and not left[x]:
                del sizes[bisect.bisect_left(sizes, x)]

    def keep(more: list[Run]) -> None:
        bins = sum(n for _, n in taken) + sum(n for _, n in more)
        if bins < best.bins:
            best.runs, best.bins = [*taken, *more], bins

    def ways() -> Iterator[tuple[tuple[int, ...], int, int]]:
        """(filling, times, waste each) at this node, before anything of it is placed."""
        top, now = sizes[-1], dict(left)
        now[top] -= 1
        own, before = [s for s in sizes if now[s]], waste
        for slack, rest in fillings(now, own, capacity - top, afford() - before, budget):
            if before + slack > afford():  # the incumbent is better by now
                return
            filling = (top, *rest)
            for n in range(min((now[x] + (x == top)) // k for x, k in Counter(filling).items()), 0, -1):
                yield filling, n, slack

    def afford() -> int:
        return (best.bins - 1) * capacity - volume

    try:
        while best.bins > best.bound:
            if not sizes:
                keep([])
            elif len(options) == len(taken) and waste <= afford():
                if len(taken) >= next_fit:
                    next_fit = len(taken) + pause
                    budget.take(4 * len(sizes))
                    keep(best_fit({s: left[s] for s in sizes}, capacity))
                options.append(Node(ways(), waste))
                if len(options) > OPEN_NODES:
                    options[-1 - OPEN_NODES].ways = None
            while options:
                if len(taken) == len(options):
                    filling, n = taken.pop()
                    change(filling, n)
                    waste = options[-1].waste
                node, way = options[-1], None
                if node.ways is None:
                    node.ways = itertools.islice(ways(), node.tried, None)
                for w in node.ways:
                    node.tried += 1
                    if waste + w[1] * w[2] <= afford():
                        way = w
                        break
                if way:
                    filling, n, slack = way
                    taken.append((filling, n))
                    change(filling, -n)
                    waste += n * slack
                    break
                options.pop()
            if not options:
                break
        best.proved = True
    except Spent:
        best.proved = best.bins == best.bound
    return best


def slots(runs: list[Run]) -> dict[str, np.ndarray]:
    """For each use of a length in a run: first rank, first sequence number, offset in the sequence."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for filling, n in runs:
        offset = 0
        for x in filling:
            out.append((x, used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + n
            offset += x
        sequence += n
    table = np.array(sorted(out), dtype=np.int64).reshape(-1, 4)
    return {k: table[:, i] for i, k in enumerate(("length", "rank", "sequence", "offset"))}


def pack_documents(
    docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    Null texts count as empty and hold the end id alone. Rows with null or repeated ids are packed like others; an
    empty table gives no rows; other columns are ignored. Which of several equal lengths takes which slot follows
    their ids, so a repeated run gives the same packing.
    """
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, tokenizer, ident, text, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(slots(bin_completion(counts, capacity).runs))
    salts = max(32, -(-sum(counts.values()) // 100_000))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    each = salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("length", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("__rank", F.row_number().over(within) - 1).join(base, ["length", "__salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("__rank") + F.col("__base")).alias("__rank"))

    def place(batches):
        p = plan.value
        keys = (p["length"] << 44) | p["rank"]
        for batch in batches:
            rank = batch.column(5).to_numpy()
            at = np.searchsorted(keys, (batch.column(3).to_numpy() << 44) | rank, side="right") - 1
            cols = [batch.column(i) for i in range(5)]
            cols += [pa.array(p["sequence"][at] + rank - p["rank"][at]), pa.array(p["offset"][at])]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names[:5], "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, {PIECES}, sequence_id long, offset long")
