"""Fixtures and brute-force forms of the operators' rules."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, doc string, node string, row string, line string, token string, component string"


def low(text):
    return (text or "").translate(AZ)


def words(text):
    return WORD.findall(text or "")


def messy_rows(seed=5, n=60):
    """Random texts with near copies, shared passages, nulls, blanks, one long text, ties and repeated rows."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghijklmnopqrstuvwxyzÉß日", k=r.randint(1, 9))) for _ in range(400)]
    say = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passage = say(70)
    texts = []
    for _ in range(n):
        kind = r.random()
        if kind < 0.25 and texts:
            w = r.choice(texts).split(" ")
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w))
        elif kind < 0.4:
            texts.append(" ".join(say(30) + passage + say(30)))
        else:
            w = say(r.randint(1, 120))
            texts.append(re.sub(r" (\w{3}) ", r"\n\1 ", " ".join(w)))
    texts += ["", None, "   ", "\n\n", "one", "Two Words", "a\tb\x0bc\rd", " ".join(say(9000)), "same text here " * 20, "A a A a", "\u0085  x"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[0], (None, "a row without an id " + " ".join(say(30)), "en", "s", 1)]
    r.shuffle(rows)
    return [(*row, "k", "d", "n", "r", "l", "t", "c") for row in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(messy_rows() if rows is None else rows, SCHEMA).repartition(3)


def simple(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def shingle_set(text, width):
    w = words(low(text))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components(rows, width, percent):
    """[(doc_id, n, component)] by comparing all texts that share a shingle."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(k)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (_, s) in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g] if j > k)
        for j, c in shared.items():
            if 100 * c >= percent * (len(s) + len(sets[j][1]) - c):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        c = find(k)
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [(i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)]


def line_removals(rows, percent=80):
    """{(doc_id, text): removed line numbers}: equal or similar to a line that comes before by (id, number)."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))
    first, occurrences = {}, []
    for i, t in order:
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(words(line))
            if s:
                first.setdefault(s, (i, t, k))
                occurrences.append((i, t, k, s))
    gone, before = set(), []
    for s in first:
        if any(100 * len(s & o) >= percent * len(s | o) for o in before):
            gone.add(s)
        before.append(s)
    out = defaultdict(list)
    for i, t, k, s in occurrences:
        if s in gone or first[s] != (i, t, k):
            out[i, t].append(k)
    return out


def quality_by_hand(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover)


def later_share(text, n):
    w, seen, cover = words(text), set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i : i + n])
        if g in seen:
            cover.update(range(i, i + n))
        seen.add(g)
    return sum(len(w[k]) for k in cover) / max(1, sum(map(len, w)))


def plain(text):
    """Words to decontamination: runs of letters, digits and non-ASCII characters."""
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", low(text))
