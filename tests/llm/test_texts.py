"""Operators that look at one text at a time."""

import itertools
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import decontamination, packing, quality_rules, token_counts, toxicity
from corpusmill.llm import textkit as tk
from tests.llm.helpers import AZ, WORD, frame, later_share, messy_rows, plain, quality_by_hand, simple, words

os.environ["TOKENIZERS_PARALLELISM"] = "false"
NASTY = [" ", "\n", "\t", "a", "B", "é", " ", "　", "1", "'s", ".", "<|endoftext|>", "日", "\x1c", "😀", "́", " ", "  "]


def nasty_texts(n=1500):
    r = random.Random(2)
    return ["".join(r.choice(NASTY) for _ in range(r.randint(0, 30))) for _ in range(n)]


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def test_words_and_spans(monkeypatch):
    monkeypatch.setattr(tk, "PIECE", 64)  # many pieces
    texts = [r[1] or "" for r in messy_rows()[:40]] + ["x" * 300]
    buf, off = tk.buffer_of(pa.array(texts))
    monkeypatch.setattr(tk, "POW", tk.POW[:64])
    w = tk.words_of(buf, off)
    got = [buf[a:b].tobytes().decode() for a, b in zip(w.start, w.end, strict=True)]
    assert got == [x for t in texts for x in WORD.findall(t)]
    by = {}
    for x, h in zip(got, w.hash, strict=True):
        assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)


@pytest.mark.parametrize("cls,name", [(token_counts.UnitLengths, "word_bpe_49k.json"), (packing.UnitIds, "byte_bpe_50k.json")])
def test_units_give_the_librarys_tokens(cls, name):
    texts = nasty_texts() + [r[1] or "" for r in messy_rows()]
    lib = library(name)
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    buf, off = tk.buffer_of(pa.array(texts))
    mine = cls(public_tokenizers.path(name))
    for _ in range(2):  # the second time from the memo
        if cls is packing.UnitIds:
            ids, first = mine.ids(buf, off)
            assert all(ids[first[i] : first[i + 1]].tolist() == w for i, w in enumerate(want))
        else:
            assert mine.count(buf, off).tolist() == list(map(len, want))


def test_a_unit_of_any_length_has_its_ids(monkeypatch):
    """A unit of over 2**24 tokens among others, of which the next call remembers the short ones."""
    units = packing.UnitIds(public_tokenizers.path("byte_bpe_50k.json"))
    asked, size = [], {"short": 2, " long": (1 << 24) + 3, " end": 1}

    def encode(texts):
        asked.append(sorted(texts))
        return np.concatenate([np.arange(size[t], dtype=np.uint32) for t in texts]), np.array([size[t] for t in texts])

    monkeypatch.setattr(units, "encode", encode)
    buf, off = tk.buffer_of(pa.array(["short long end", "", "short"]))
    want = np.concatenate([np.arange(size[t], dtype=np.uint32) for t in ("short", " long", " end", "short")])
    ids, first = units.ids(buf, off)
    n = (1 << 24) + 6
    assert first.tolist() == [0, n, n, n + 2] and np.array_equal(ids, want)
    monkeypatch.setattr(units, "POOL_LIMIT", 1 << 40)
    assert np.array_equal(units.ids(buf, off)[0], want) and asked[1] == [" long"]


def test_rolling_hashes_are_those_of_the_windows(monkeypatch):
    r = np.random.default_rng(3)
    words = r.integers(0, 3, 400).astype(np.uint64)
    first = np.array([0, 7, 7, 150, 400])
    monkeypatch.setattr(tk, "LOW", 1 << 16)
    rolling = tk.Rolling(tk.mix(words), first)
    for width in (1, 3, 8):
        at, h = rolling.windows(width)
        assert at.tolist() == [i for a, b in zip(first, first[1:], strict=False) for i in range(a, b - width + 1)]
        by = {}
        for i, x in zip(at.tolist(), h.tolist(), strict=True):
            assert by.setdefault(tuple(words[i : i + width].tolist()), x) == x
        assert len(set(by.values())) == len(by)
    long = tk.Rolling(tk.mix(np.tile(words[:100], 3000)), np.array([0, 300_000]))
    h = long.windows(8)[1]
    assert (h[:100] == h[100:200]).all() and (h[:100] == h[299_900 - 100 : 299_900]).all()


def test_token_counts(spark):
    t = library("word_bpe_49k.json")
    rows = token_counts.token_counts(frame(spark), public_tokenizers.path("word_bpe_49k.json")).collect()
    want = Counter((r[0], len((r[1] or "").encode()), len(t.encode(r[1] or "", add_special_tokens=False).ids)) for r in messy_rows())
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)
    assert token_counts.token_counts(frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def placed(runs):
    out = Counter()
    for filling, n in runs:
        assert sum(filling) <= 2048 and n > 0
        for x in filling:
            out[x] += n
    return out


def test_plans_place_everything():
    r = random.Random(4)
    for _ in range(40):
        counts = dict(Counter(r.choices(range(1, 2049), k=r.randint(1, 200))))
        fit, plan = packing.best_fit(counts, 2048), packing.bin_completion(counts, 2048, 20_000)
        assert placed(fit) == placed(plan.runs) == counts
        assert plan.bound <= plan.bins == sum(n for _, n in plan.runs) <= sum(n for _, n in fit)
        assert plan.proved or plan.bins > plan.bound
    # best-fit decreasing needs three bins here, the search finds two
    assert packing.bin_completion({4: 2, 3: 4}, 10).bins == 2
    assert packing.bin_completion({}, 2048).runs == []


def fewest(pieces, capacity):
    """The optimum by trying every bin for every piece."""
    best = len(pieces)

    def put(i, rooms):
        nonlocal best
        if len(rooms) < best:
            if i == len(pieces):
                best = len(rooms)
                return
            for room in set(rooms):
                if room >= pieces[i]:
                    rest = list(rooms)
                    rest.remove(room)
                    put(i + 1, [*rest, room - pieces[i]])
            put(i + 1, [*rooms, capacity - pieces[i]])

    put(0, [])
    return best


@pytest.mark.parametrize("open_nodes", [32, 1])
def test_search_finds_the_optimum_of_small_cases(monkeypatch, open_nodes):
    monkeypatch.setattr(packing, "OPEN_NODES", open_nodes)
    r = random.Random(12)
    beaten = 0
    for _ in range(250):
        capacity = r.choice([10, 20, 37, 60])
        pieces = sorted((r.randint(1, capacity * 2 // 3) for _ in range(r.randint(1, 10))), reverse=True)
        plan = packing.bin_completion(dict(Counter(pieces)), capacity)
        assert plan.proved and plan.bins == fewest(pieces, capacity), (pieces, capacity)
        beaten += plan.bins < sum(n for _, n in packing.best_fit(dict(Counter(pieces)), capacity))
    assert beaten


def test_fillings_are_the_undominated_ones():
    """Every maximal filling that no exchange of one or two pieces improves, and no other, in order of waste."""
    r = random.Random(13)
    for _ in range(60):
        counts = {s: r.randint(1, 3) for s in r.sample(range(1, 25), r.randint(1, 6))}
        room, sizes, want = r.randint(1, 40), sorted(counts), set()
        for pick in itertools.product(*(range(counts[s] + 1) for s in sizes)):
            waste = room - sum(s * k for s, k in zip(sizes, pick, strict=True))
            free = [s for s, k in zip(sizes, pick, strict=True) if k < counts[s]]
            own = [s for s, k in zip(sizes, pick, strict=True) for _ in range(k)]
            pairs = [x + y for i, x in enumerate(own) for y in own[i + 1 :]]
            worse = any(0 < f <= waste for f in free) or any(x < f <= x + waste for x in own for f in free) or any(x <= f <= x + waste for x in pairs for f in free)
            if waste >= 0 and not worse:
                want.add((waste, tuple(sorted(own, reverse=True))))
        got = list(packing.fillings(counts, sizes, room, room, packing.Steps(10**9)))
        assert set(got) == want and len(got) == len(want) and [w for w, _ in got] == sorted(w for w, _ in got)


@pytest.mark.parametrize("hot", [0, 20_000])
def test_search_goes_beyond_best_fit_with_many_lengths(hot):
    """Some 2,000 distinct lengths, one of them hot: the search places all of them by default, and meets the lower bound."""
    r = random.Random(0)
    counts = Counter(min(2048, 1 + int(r.lognormvariate(5.8, 1.0))) for _ in range(100_000))
    counts[400] += hot
    plan = packing.bin_completion(dict(counts), 2048)
    assert len(counts) > 2000 and placed(plan.runs) == counts
    assert plan.bins == plan.bound <= sum(n for _, n in packing.best_fit(counts, 2048)) - (not hot)


def test_packing_round_trip(spark):
    t = library("byte_bpe_50k.json")
    got = packing.pack_documents(frame(spark), public_tokenizers.path("byte_bpe_50k.json")).collect()
    want = Counter()
    for r in messy_rows():
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        a, b, k = 0, len(ids) % 2048 or 2048, 0
        while a < len(ids):
            want[r[0], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
            a, b, k = b, b + 2048, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == packing.lower_bound(Counter(k[3] for k in want.elements()), 2048)
    assert packing.pack_documents(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_quality_rules(spark):
    rules = quality_rules.RepetitionRules()
    for r in quality_rules.repetition_measures(frame(spark), keep=("doc_id", "text")).collect():
        hand = quality_by_hand(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == hand
        base = hand[0] < 20 or 100 * hand[4] > 30 * hand[0]
        shares = [later_share(r["text"], n) for n in sorted(rules.ngrams)]
        assert r["dup_ngram_chars"] == pytest.approx(shares)
        failed = r["dup_line_chars"] > rules.line_chars or any(s > rules.ngrams[n] for s, n in zip(shares, sorted(rules.ngrams), strict=True))
        assert r["base_failed"] == base and r["kept"] == (not base and not failed)
    kept = quality_rules.quality_filter(frame(spark))
    assert kept.columns == frame(spark).columns and 0 < kept.count() < frame(spark).count()
    assert quality_rules.repetition_measures(frame(spark, [])).count() == 0


def test_decontamination(spark):
    r = random.Random(8)
    v = ["".join(r.choices("abcdefghij", k=5)) for _ in range(500)]
    say = lambda k: [r.choice(v) for _ in range(k)]
    items = [(i, " ".join(say(k))) for i, k in enumerate([12, 30, 60, 100, 200, 6, 5, 3, 1, 400])] + [(90, None), (91, ""), (92, "!!")]
    docs = []
    for i in range(80):
        body = say(r.randint(0, 900))
        if i % 2:
            w = items[i % 10][1].split()
            if i % 3 == 0 and len(w) > 20:
                w[r.randrange(len(w))] = "changed"
            if i % 5 == 0:
                w = w[: len(w) // 2]
            at = r.randint(0, len(body))
            body = body[:at] + [x.upper() + r.choice([",", ""]) for x in w] + body[at:]
        docs.append((i, " ".join(body)))
    docs += [(100, None), (101, ""), (None, items[1][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in docs:
        w = plain(t)
        for j, x in items:
            g = plain(x)
            n = min(5, len(g))
            if n:
                s = {tuple(g[k : k + n]) for k in range(len(g) - n + 1)}
                have = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
                if 100 * len(s & have) >= 80 * len(s):
                    want.add((i, j, len(s), len(s & have)))
    got = {tuple(x) for x in decontamination.contained_items(d, b).collect()}
    assert got == want and len(want) > 30
    left = decontamination.decontaminated(d, b)
    assert {x["doc_id"] for x in left.collect()} == {i for i, _ in docs} - {w[0] for w in want}
    for kind in ("int", "string"):
        other = decontamination.contained_items(d, b.withColumn("item_id", F.col("item_id").cast(kind)))
        assert {(x[0], int(x[1]), *x[2:]) for x in other.collect()} == want
    twice = decontamination.contained_items(d.union(d).withColumn("item_id", F.lit("x")), b.withColumn("doc_id", F.lit("y")))
    assert Counter(map(tuple, twice.collect())) == Counter([w for w in want for _ in "ab"])
    assert decontamination.contained_items(d.limit(0), b).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contained_items(d, none).count() == 0 and decontamination.decontaminated(d, none).count() == len(docs)


def test_toxicity_learns_pairs(spark):
    """Neither word alone is toxic; together they are. Only an interaction can tell."""
    r = random.Random(3)
    say = lambda: ["".join(r.choices("aeiourst", k=4)) for _ in range(20)]
    docs, labels = [], []
    for i in range(3000):
        a, b = r.random() < 0.5, r.random() < 0.5
        w = say() + ["insultword"] * a + ["groupword"] * b
        r.shuffle(w)
        docs.append((i, " ".join(w)))
        labels.append((i, int(a and b)))
    docs += [(5000, None), (5001, ""), (None, "insultword groupword")]
    labels += [(5000, None), (7, 0), (9999, 1)]
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_toxicity(d, l).collect()
    assert len(got) == len(docs) and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in got)
    assert all(x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in got)
    truth = dict(labels[:3000])
    held = [(x["predicted"], truth[x["doc_id"]]) for x in got if x["held_out"] and x["doc_id"] in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    bare = toxicity.score_toxicity(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert bare.count() == len(docs)


def test_toxicity_learns_pairs_without_leaning_words():
    """The label is exactly one of two words: no single term tells anything, among many that could mislead."""
    r = np.random.default_rng(5)
    rows, label = [], []
    for _ in range(4000):
        a, b = (r.random(2) < 0.5).tolist()
        rows.append(np.unique(np.concatenate([r.integers(10, 3000, 20), [1] * a, [2] * b]).astype(np.int64)))
        label.append(float(a != b))
    first, label = np.cumsum([0] + [len(x) for x in rows]), np.array(label)
    cut = 3000
    machine = toxicity.fit(np.concatenate(rows[:cut]), first[: cut + 1], label[:cut], toxicity.FitOptions())
    score = machine.score(np.concatenate(rows[cut:]), first[cut:] - first[cut])
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label[cut:] > 0
    assert (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum()) > 0.95


def test_toxicity_sample_is_bounded(spark):
    """A repeated id counts once, and the terms on the driver keep to their bound."""
    rows = [(i % 50, f"word{i % 9} bad other{i}" if i % 2 else "good words here") for i in range(400)]
    labels = [(i, i % 2) for i in range(50)]
    d, l = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("x")).withColumn("h", F.lit(1)), spark.createDataFrame(labels, "doc_id long, toxic int")
    seen = []

    def fit(terms, first, label, options, real=toxicity.fit):
        seen.append((len(label), 4 * len(terms)))
        return real(terms, first, label, options)

    kept, toxicity.fit = toxicity.fit, fit
    try:
        assert toxicity.score_toxicity(d, l).count() == 400
        assert toxicity.score_toxicity(d, l, options=toxicity.FitOptions(sample_bytes=200)).count() == 400
        assert toxicity.score_toxicity(d.limit(0), l).count() == 0
    finally:
        toxicity.fit = kept
    assert seen[0][0] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(50)) and 0 < seen[1][1] <= 200 and seen[2][0] == 0


def test_toxicity_heldout_labels_do_not_matter(spark):
    docs = simple(spark, [f"word{i % 7} bad" if i % 3 == 0 else f"word{i % 5} good" for i in range(300)])
    rows = [(i, int(i % 3 == 0)) for i in range(300)]
    flip = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in rows]
    score = lambda l: sorted((x["doc_id"], x["score"]) for x in toxicity.score_toxicity(docs, spark.createDataFrame(l, "doc_id long, toxic int")).collect())
    assert score(rows) == score(flip)


def test_low_case_table():
    assert bytes(tk.LOWER_MAP[65:91]).decode() == "".join(chr(AZ[c]) for c in range(65, 91))
