"""Operators over the whole corpus: joins, counts, components, and the pipeline."""

import glob
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from corpusmill.llm import exchange, line_dedup, lm_scoring, ngram_join, quality_rules, queries, substring_dedup, url_filters
from corpusmill.llm.components import connected_components
from tests.conftest import SMALL
from tests.llm.helpers import components, frame, later_share, line_removals, low, messy_rows, plain, quality_by_hand, simple, words


def test_messages_round_trip():
    r = np.random.default_rng(1)
    for top in (1, 255, 1 << 20, (1 << 64) - 1):
        v = r.integers(0, top, 500, dtype=np.uint64, endpoint=True)
        assert (exchange.unpack(exchange.pack(v)) == v).all()
        s = np.unique(v)
        assert (exchange.unpack_sorted(exchange.pack_sorted(s)) == s).all()
    columns = [r.integers(0, top, n, dtype=np.uint64) for top, n in ((200, 3), (1 << 40, 50), (9, 0))]
    assert all((a == b).all() for a, b in zip(exchange.unpack_all(exchange.pack_all(columns), 3), columns, strict=True))
    lay = exchange.Layout(1, 7, 24)
    cuts = lay.cuts(np.arange(1 << 10, dtype=np.uint64) << np.uint64(14))
    assert cuts[0] == 0 and cuts[-1] == 1 << 10 and len(cuts) == 8


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    rows = spark.createDataFrame([*edges, (None, 3), (7, None), (5, 5)], "a long, b long")
    assert {(x["node"], x["component"]) for x in connected_components(rows).collect()} == {(x, find(x)) for x in parent}
    assert connected_components(rows.limit(0)).count() == 0


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_ngram_join(spark, width, percent):
    rows = messy_rows()
    got = ngram_join.similar_sets(frame(spark), width=width, percent=percent).collect()
    want = components([(r[0], r[1]) for r in rows], width, percent)
    assert Counter(map(tuple, got)) == Counter(want)
    kept = ngram_join.one_per_component(frame(spark), width=width, percent=percent)
    assert kept.columns == frame(spark).columns
    names = {i for i, _, c in want if i == c and i is not None}
    assert {r["doc_id"] for r in kept.collect()} == names | {None}


def test_null_ids_stay(spark):
    """A row without an id stays whether it copies another or not."""
    t = " ".join(f"w{i}" for i in range(40))
    for more in ([], [(None, "other words " + t.replace("w", "v"))]):
        df = spark.createDataFrame([(5, t), (6, t), (None, t), *more], "doc_id long, text string")
        got = ngram_join.one_per_component(df).collect()
        assert Counter(r["doc_id"] for r in got) == Counter({5: 1, None: 1 + len(more)})


def test_ngram_join_parts(spark, monkeypatch):
    """Groups far larger than the first parts: several rounds lose no link."""
    monkeypatch.setattr(ngram_join, "FIRST_PART", 2)
    monkeypatch.setattr(ngram_join, "GROWTH", 2)
    r = random.Random(21)
    base = [[f"{g}w{i}" for i in range(50)] for g in range(3)]
    texts = []
    for k in range(90):
        w = list(base[k % 3])
        for _ in range(r.randint(0, 3)):
            w[r.randrange(50)] = f"x{r.randrange(30)}"
        texts.append(" ".join(w))
    got = ngram_join.similar_sets(simple(spark, texts), width=4, percent=85).collect()
    assert sorted(map(tuple, got)) == sorted(components(list(enumerate(texts)), 4, 85))


def test_ngram_join_near_group(spark):
    """A group of near copies around the threshold, where pairs in it do and do not link."""
    r = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(120):
        w = list(base)
        for _ in range(r.randint(0, 2)):
            w[r.randrange(60)] = f"x{r.randrange(1000)}"
        texts.append(" ".join(w))
    got = ngram_join.similar_sets(simple(spark, texts), width=4, percent=85).collect()
    assert sorted(map(tuple, got)) == sorted(components(list(enumerate(texts)), 4, 85))
    assert ngram_join.similar_sets(simple(spark, texts).limit(0)).count() == 0


@pytest.fixture
def small_table(monkeypatch):
    """A rarity table of 4096 cells: words share cells."""
    monkeypatch.setattr(line_dedup, "CELLS", 12)
    monkeypatch.setattr(line_dedup, "SEGMENT", 6)


def test_line_dedup(spark, small_table):
    r = random.Random(6)
    v = [f"w{i}" for i in range(60)]
    base = [" ".join(r.sample(v, 12)) for _ in range(12)]
    texts = []
    for _ in range(40):
        each = []
        for _ in range(r.randint(0, 6)):
            w = r.choice(base).split()
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(v)
            each.append(r.choice([" ", "  ", "\t"]).join(w))
        texts.append("\n".join(each))
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, " \n\n"), (103, "x"), (104, "x\nx\n\ny"), (3, texts[3]), (None, "null id line of words")]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, row string, kept string")
    want = line_removals(rows)
    got = line_dedup.line_report(df.select("doc_id", "text", "row"), text="text").join(df.limit(0).select("kept"), F.lit(False), "left").collect()
    assert len(got) == len(rows)
    by = {}
    for x in got:
        by[x["doc_id"]] = (x["n_lines"], list(x["removed_lines"]))
        assert x["n_removed"] == len(x["removed_lines"])
    for i, t in rows:
        assert by[i] == (sum(bool(words(x)) for x in (t or "").split("\n")), want.get((i, t), [])), (i, t)
    cleaned = {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(df).collect()}
    for i, t in rows:
        drop = set(want.get((i, t), []))
        assert cleaned[i] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop))
    assert line_dedup.dedup_lines(df).columns == df.columns
    assert line_dedup.line_report(df.limit(0)).count() == 0


def test_line_dedup_rounds(spark, monkeypatch):
    """Groups far larger than the first parts, at the production rarity table: several rounds lose no match."""
    monkeypatch.setattr(line_dedup, "FIRST_PART", 2)
    monkeypatch.setattr(line_dedup, "GROWTH", 2)
    r = random.Random(8)
    base = [[f"{g}w{i}" for i in range(20)] for g in range(4)]
    rows = []
    for k in range(60):
        each = []
        for _ in range(4):
            w = [x for x in r.choice(base) if r.random() < 0.97]
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"x{r.randrange(40)}"
            each.append(r.choice([" ", " \r", "\t"]).join(w))
        rows.append((k, "\n".join(each)))
    want = line_removals(rows)
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["removed_lines"] for x in got} == {i: want.get((i, t), []) for i, t in rows}
    assert any(not x["n_removed"] for x in got) or sum(x["n_removed"] for x in got) < 240


def test_line_dedup_work(spark):
    """Texts are split once, and the first round sends few entries of a node whose words are frequent."""
    df = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(40)) + f" x{k}") for k in range(2000)], "doc_id long, text string")
    rarity = line_dedup.materialise(line_dedup._rarity(df, "doc_id", "text"), "word-levels")
    assert rarity.select(F.size("levels")).first()[0] == 1 << line_dedup.CELLS
    lines = line_dedup._lines(df, "doc_id", "text", rarity, 80)
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("split(text") == 1
    nodes = line_dedup._nodes(line_dedup.materialise(lines, "lines"))
    assert nodes.count() == 2000 and nodes.select(F.size("prefix")).distinct().first()[0] == 9
    assert line_dedup._entries(nodes, line_dedup.FIRST_PART, 10, True).count() <= 2000 * (1 + line_dedup.FEW) + 200


def test_line_dedup_is_native():
    source = open(line_dedup.__file__).read()
    assert not re.search(r"pandas|Arrow|udf|\.rdd|collect\(\)", source)


def lm_by_hand(rows, m2=lm_scoring.MASS[0], m3=lm_scoring.MASS[1]):
    tok = [(i, [*words(low(t)), None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in tok]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for (_, t), h in zip(tok, held, strict=True):
        if not h:
            c1.update(t)
            c2.update(zip(t, t[1:], strict=False))
            c3.update(zip(t, t[1:], t[2:], strict=False))
    n, v = sum(c1.values()), len(c1)
    for (i, t), h in zip(tok, held, strict=True):
        state, score, base = (), 0.0, 0.0
        for w in t:  # the automaton, step by step
            p1 = (c1[w] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p1)
            if len(state) == 2 and not c3[(*state, w)]:
                score += math.log10(m3 / (c2[state] + m3))
                state = state[1:]
            if len(state) == 1 and not c2[(*state, w)]:
                score += math.log10(m2 / (c1[state[0]] + m2))
                state = ()
            p = p1
            if len(state) >= 1:
                p = (c2[state[-1], w] + m2 * p) / (c1[state[-1]] + m2)
            if len(state) == 2:
                p = (c3[(*state, w)] + m3 * p) / (c2[state] + m3)
            score += math.log10(p)
            state = (*state, w)[-2:] if c1[w] else ()
        yield i, h, len(t), sum(c1[w] > 0 for w in t), n, base, score


def test_lm_scores(spark):
    rows = [(r[0], r[1]) for r in messy_rows()]
    got = sorted((tuple(x) for x in lm_scoring.score_documents(frame(spark)).collect()), key=repr)
    want = sorted(lm_by_hand(rows), key=repr)
    assert [g[:5] for g in sorted(got, key=lambda g: (g[0] is None, g[0] or 0, g[2]))] == [w[:5] for w in sorted(want, key=lambda w: (w[0] is None, w[0] or 0, w[2]))]
    by = {(w[0], w[2]): w for w in want}
    for g in got:
        assert g[5:] == pytest.approx(by[g[0], g[2]][5:], abs=1e-6)
    assert lm_scoring.score_documents(frame(spark, [])).count() == 0


def test_lm_counts_are_not_shared(spark):
    """As many n-grams as make short keys meet: every score is that of separate counts."""
    r = random.Random(3)
    rows = [(i, " ".join(f"w{r.randrange(30000)}" for _ in range(2000))) for i in range(40)]
    rows += [(100 + i, t) for i, t in rows[:20]]
    got = {x["doc_id"]: tuple(x) for x in lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for w in lm_by_hand(rows):
        assert got[w[0]][:5] == w[:5] and got[w[0]][5:] == pytest.approx(w[5:], abs=1e-6)


def test_lm_is_a_distribution():
    """After any history, the automaton's probabilities of all words and of one unknown word add up to one."""
    r = random.Random(17)
    train = [[*(r.randrange(6) for _ in range(r.randint(1, 12))), 50] for _ in range(30)]  # 50 ends a text
    c1 = Counter(w for t in train for w in t)
    c2, c3 = Counter(), Counter()
    for t in train:
        c2.update(zip(t, t[1:], strict=False))
        c3.update(zip(t, t[1:], t[2:], strict=False))
    for history in ([0, 1], [1, 9], [9, 2], [9, 9], [3, 3], [5, 0]):
        rows = [[*history, w] for w in [*sorted(c1), 9]] + [history] * (len(c1) + 1)
        tokens = np.array([w for t in rows for w in t], dtype=np.uint64)
        first = np.cumsum([0] + [len(t) for t in rows])
        g = lm_scoring.Grams(tokens, first, np.array([7 * w for w in sorted({*tokens.tolist()})], dtype=np.uint64))
        word = (g.ids // np.uint64(7)).astype(int).tolist()
        pairs = list(zip(*(np.array(word)[x].tolist() for x in (g.left, g.right)), strict=True))
        triples = [(*pairs[h], word[w]) for h, w in zip(g.history, g.last, strict=True)]
        count = [np.array([c[k] for k in keys], dtype=np.uint64) for c, keys in ((c1, word), (c2, pairs), (c3, triples))]
        score = lm_scoring.Automaton(g, count, sum(c1.values()), len(c1), (3.0, 0.7)).traverse()
        k = len(c1) + 1
        assert (10 ** (score[:k] - score[k:])).sum() == pytest.approx(1)


def test_lm_long_texts_in_segments(spark, monkeypatch):
    rows = [(i, " ".join(f"w{random.Random(i).randrange(9)}{k % 5}" for k in range(n))) for i, n in enumerate((1, 5, 700, 128, 127, 129))]
    got = {x["doc_id"]: x["score"] for x in lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {w[0]: pytest.approx(w[6]) for w in lm_by_hand(rows)}


def test_lm_numbers_beyond_32_bits():
    a = np.array([1 << 40, 3, 1 << 40, 1 << 40], dtype=np.uint64)
    b = np.array([5, 5, 1 << 50, 5], dtype=np.uint64)
    k = lm_scoring._two(a, b)
    assert k[0] == k[3] and len(set(k.tolist())) == 3


def test_substring_dedup(spark):
    r = random.Random(9)
    say = lambda k: " ".join("".join(r.choices("abcdefghijklmno", k=r.randint(2, 8))) for _ in range(k))
    passages = [say(55) for _ in range(6)]
    short = [say(14) for _ in range(6)]
    texts, want = [], set()
    for i in range(60):
        parts = [say(r.randint(20, 200))]
        if i % 3 == 0:
            parts.append(passages[i % 6])
            if i >= 6:
                want.add(i)
        parts += [short[i % 6], say(r.randint(20, 100))]
        texts.append("\n".join(parts) if i % 2 else " ".join(parts))
    texts += [None, "", "tiny", "x" * 5000, texts[1], say(60) + " " + passages[0].upper()]
    n = len(texts)
    want |= {n - 2}
    df = simple(spark, texts).union(simple(spark, texts).filter("doc_id = 1")).withColumn("start", F.lit(1)).withColumn("first_doc_id", F.lit("x"))
    got = substring_dedup.repeated_passages(df).collect()
    assert {x["doc_id"] for x in got} - {63} == want
    for x in got:
        raw = texts[x["doc_id"]].encode()
        span = raw[x["start"] : x["start"] + x["length"]]
        if x["doc_id"] != 63:
            assert span in texts[x["first_doc_id"]].encode() and len(span.split()) == x["n_words"] >= substring_dedup.MIN_WORDS
    spans = [x for x in got if x["doc_id"] == 9]
    cut = {x["doc_id"]: x["text"] for x in substring_dedup.without_passages(df, substring_dedup.repeated_passages(df)).collect()}
    raw = texts[9].encode()
    for x in sorted(spans, key=lambda x: -x["start"]):
        raw = raw[: x["start"]] + raw[x["start"] + x["length"] :]
    assert cut[9] == raw.decode() and cut[2] == texts[2] and cut[60] is None
    assert substring_dedup.repeated_passages(df.limit(0)).count() == 0


def test_gear_is_local():
    from corpusmill.llm import textkit as tk
    import pyarrow as pa

    a, b = "the quick brown fox jumps over the lazy dog " * 3, "other words in front "
    buf, off = tk.buffer_of(pa.array([a, b + a]))
    g = substring_dedup.gear(buf, off)
    assert (g[32 : len(a)] == g[len(a) + len(b) + 32 :]).all()
    alone = substring_dedup.gear(*tk.buffer_of(pa.array([b + a])))
    assert (alone == g[len(a) :]).all()


def test_url_filters(spark):
    link = lambda u: f'<head><LINK href="{u}" rel="canonical"></head>'
    refresh = lambda u: f"<meta http-equiv='refresh' content='0; url={u}'>"
    pages = [
        (1, "http://a.example.com/en/1", None), (2, "http://A.Example.com/en/77?x", ""), (3, "http://m.example.net/de/8#f", ""),
        (4, "http://alias.example.edu/p", link("http://z.com/en/1")), (5, "http://alias.example.edu/q", refresh("/p")),
        (6, "http://free.example.edu/", link("http://example.com/en/7")), (7, "http://chain.example.edu/", link("http://free.example.edu/")),
        (8, "http://both.example.edu/", link("http://free.example.edu/") + refresh("http://z.com/en/1")), (9, None, link("http://z.com/en/1")),
        (10, "no scheme", ""), (11, "http://com/en", ""), (12, "http://xcom/en/", ""), (13, "http://plain.edu", ""), (None, "http://com/en/", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("x")).withColumn("host", F.lit("y"))
    got = {x["page_id"]: tuple(x)[1:5] for x in url_filters.judge_urls(df).collect()}
    assert got[1] == ("a.example.com", "/en/1", "com/en/", "block")
    assert got[2] == ("a.example.com", "/en/77", "example.com/en/7", "allow")
    assert got[3] == ("m.example.net", "/de/8", "example.net/de/8", "block")
    # 8 ties the blocked class to one with an allowed member: the allow goes first for all of it
    assert {got[k][3] for k in (4, 5, 6, 7, 8)} == {"allow"}
    assert got[9] == ("", "", None, "allow") and got[10] == ("", "", None, "allow")
    assert got[11][2:] == (None, "allow") and got[12][2:] == (None, "allow") and got[13] == ("plain.edu", "", None, "allow")
    assert got[None][2:] == ("com/en/", "block")
    some = url_filters.judge_urls(df.filter("page_id in (4, 5, 13)"), redirects=spark.createDataFrame([("http://plain.edu", "http://alias.example.edu/q")], "f string, t string"))
    assert {x["verdict"] for x in some.collect()} == {"block"}
    assert url_filters.judge_urls(df.limit(0)).count() == 0
    twice = url_filters.judge_urls(df.union(df).withColumn("html", F.concat(F.repeat(F.lit("<p>text "), 200_000), F.coalesce("html", F.lit("")))))
    assert Counter(tuple(x)[:5] for x in twice.collect()) == Counter((k, *v) for k, v in got.items() for _ in "ab")


def test_url_rules_are_the_contract(spark):
    want = "block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/"
    assert ", ".join(f"{r.verdict} {r.text}" for r in url_filters.RULES) == want
    urls = {"http://a.com/en/": "block", "http://example.com/en/71": "allow", "http://b.net/de/8": "allow", "http://example.net/de/7": "allow", "http://x.example.net/de/8": "block", "http://c.org/es/1": "block"}
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    assert [x["verdict"] for x in url_filters.judge_urls(pages).orderBy("page_id").collect()] == list(urls.values())


def test_pipeline(spark, small_table):
    docs = frame(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert packed and max(Counter((p["sequence_id"], p["offset"]) for p in packed).values()) == 1


def pipeline_by_hand(rows, items):
    """The five stages, each by its rule: (doc_id, piece, start, length, crc32) of what is left, and ids by stage."""
    import public_tokenizers
    from tokenizers import Tokenizer

    rules, left = quality_rules.RepetitionRules(), []
    for i, t in rows:
        n, chars, _, _, repeated = quality_by_hand(t)
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                dup += (line in seen) * sum(map(len, words(line)))
                seen.add(line)
        bad = n < 20 or 100 * repeated > 30 * n or dup > rules.line_chars * max(1, chars)
        if not bad and all(later_share(t, k) <= v for k, v in rules.ngrams.items()):
            left.append((i, t))
    ids = [[i for i, _ in left]]
    gone = line_removals(left)
    left = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), []))) for i, t in left]
    left = [(i, t) for i, t in left if words(t)]
    ids.append([i for i, _ in left])
    least = {i: c for i, _, c in components(left, 5, 80)}
    left = [(i, t) for i, t in left if least[i] == i]
    ids.append([i for i, _ in left])

    def holds(t, x):
        w, g = plain(t), plain(x)
        n = min(5, len(g))
        s = {tuple(g[k : k + n]) for k in range(len(g) - n + 1)} if n else set()
        return bool(s) and 100 * len(s & {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}) >= 80 * len(s)

    left = [(i, t) for i, t in left if not any(holds(t, x) for x in items)]
    ids.append([i for i, _ in left])
    lib, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for i, t in left:
        whole = np.array([*lib.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        a, b, k = 0, len(whole) % 2048 or 2048, 0
        while a < len(whole):
            out.append((i, k, a, b - a, zlib.crc32(whole[a:b].tobytes())))
            a, b, k = b, b + 2048, k + 1
    return out, ids


def test_pipeline_against_brute_force(spark, tmp_path):
    """All five stages as run, at production parameters: the same pieces, and every stage takes some documents."""
    r = random.Random(31)
    v = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(900)]
    say = lambda k: [r.choice(v) for _ in range(k)]
    items, shared, texts = [" ".join(say(k)) for k in (12, 40, 90)], [" ".join(say(12)) for _ in range(8)], []
    for i in range(160):
        kind = r.random()
        if kind < 0.3 and texts:
            w = r.choice(texts).split(" ")
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(v)
            texts.append(" ".join(w))
            continue
        parts = [" ".join(say(r.randint(3, 40))) for _ in range(r.randint(1, 9))]
        if kind < 0.4:
            parts.insert(r.randrange(len(parts) + 1), r.choice(items))
        if kind < 0.6:
            parts.insert(r.randrange(len(parts) + 1), r.choice(shared))
        if 0.6 < kind < 0.7:
            parts += [parts[0]] * r.randint(1, 5)
        texts.append("\n".join(parts))
    texts += [None, "", " \n ", "few words", " ".join(say(5000))]
    rows = list(enumerate(texts))
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want, ids = pipeline_by_hand(rows, items)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got) == Counter(want)
    assert max(Counter((x["sequence_id"], x["offset"]) for x in got).values()) == 1
    assert len(rows) > len(ids[0]) > len(ids[2]) > len(ids[3]) and len(ids[1]) >= len(ids[2])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_their_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert Counter(str(tuple(r)) for r in df.select(*columns).collect()) == Counter(str(r) for r in want.fetchall())


def test_queries_are_registered():
    names = __spark_entry__.queries()
    for k in range(1, 11):
        assert len([n for n in names if n.startswith(f"op{k}_")]) == 1
    assert "pipeline" in names
