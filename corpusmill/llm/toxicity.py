"""Toxicity (operator 4): a factorization machine over hashed terms.

Terms are hashed words of a text and the heads of its longer words, once each. Beside a weight per term the machine learns a vector per term; inner
products of two terms' vectors weigh their meeting in one text, such as an insult and the mention of a group, which no
additive weights can. It is fitted on the driver from a bounded sample of labelled rows, as sparse term lists; all
texts are then scored in one narrow stage with the model, whose size is fixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .decontamination import plain_words
from .storage import materialise

TERM_BITS = 18
HEADS = (4, 6)  # bytes: inflected and compounded forms share a head
SAMPLE_ROWS, SAMPLE_BYTES = 24_000, 40 << 20


@dataclass(frozen=True)
class FitOptions:
    """``sample_rows`` and ``sample_bytes`` bound the labelled rows the fit takes, and what their terms take on the driver.

    The rows are chosen by a hash of their id. Learned are the ``terms`` terms that lean most to one label, and those of
    pairs that lean otherwise than their two terms do: all pairs of the ``paired`` most frequent terms are looked at, and
    those that part from the sum of both terms by ``pair_z`` standard deviations count. More terms only blur the fit.
    """

    sample_rows: int = SAMPLE_ROWS
    sample_bytes: int = SAMPLE_BYTES
    factors: int = 8
    terms: int = 2048
    paired: int = 2048
    pair_z: float = 6.0
    least_rows: int = 5
    epochs: int = 20
    batch: int = 256
    rate: float = 0.08
    decay: float = 1e-4
    seed: int = 7


def terms_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each row, words and the heads of longer words, and the rows' first ones (n + 1)."""
    w = plain_words(buf, off)
    rows = tk.row_of(w.first)
    keys = [(rows << TERM_BITS) | (w.hash >> np.uint64(64 - TERM_BITS)).astype(np.int64)]
    for head in HEADS:
        long = np.flatnonzero(w.end - w.start > head)
        h = tk.span_hash(buf, w.start[long], w.start[long] + head, tk.LOWER_CODE)
        h = tk.mix(h ^ np.uint64(head))
        keys.append((rows[long] << TERM_BITS) | (h >> np.uint64(64 - TERM_BITS)).astype(np.int64))
    key = np.unique(np.concatenate(keys))
    return key & ((1 << TERM_BITS) - 1), np.searchsorted(key >> TERM_BITS, np.arange(len(off)))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


@dataclass
class Machine:
    bias: float
    weight: np.ndarray  # by term
    vector: np.ndarray  # by term

    def margin(self, terms: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.vector[terms].astype(np.float64)
        both = row_sums(np.concatenate([v, v * v, self.weight[terms, None]], axis=1), first)
        k = v.shape[1]
        side = both[:, :k]
        return self.bias + both[:, 2 * k] + 0.5 * ((side * side).sum(1) - both[:, k : 2 * k].sum(1)), side

    def score(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(terms, first)[0], -30, 30)))


def leaning_terms(counts: np.ndarray, positive: np.ndarray, label: np.ndarray, options: FitOptions) -> np.ndarray:
    """The terms that part the labels best by chi-squared, among those of enough rows."""
    rate = label.mean()
    expect = counts * rate
    chi = (positive - expect) ** 2 / np.maximum(expect * (1 - counts / len(label)) * (1 - rate), 1e-9)
    chi[counts < options.least_rows] = -1
    best = np.argsort(-chi, kind="stable")[: options.terms]
    return best[chi[best] >= 0]


def _of(terms: np.ndarray, first: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in ``used``) of each entry whose term is used."""
    place = np.full(1 << TERM_BITS, -1, dtype=np.int32)
    place[used] = np.arange(len(used))
    at = place[terms]
    on = at >= 0
    return np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))[on], at[on]


def paired_terms(terms: np.ndarray, first: np.ndarray, label: np.ndarray, options: FitOptions) -> np.ndarray:
    """The terms of pairs whose rows lean otherwise than the sum of what both terms tell."""
    counts = np.bincount(terms, minlength=1 << TERM_BITS)
    used = np.argsort(-counts, kind="stable")[: options.paired]
    used = used[counts[used] >= options.least_rows]
    row, at = _of(terms, first, used)
    both, positive = np.zeros((2, len(used), len(used)), dtype=np.float32)
    for a in range(0, len(label), 2048):
        i, j = np.searchsorted(row, [a, a + 2048])
        x = np.zeros((min(2048, len(label) - a), len(used)), dtype=np.float32)
        x[row[i:j] - a, at[i:j]] = 1
        both += x.T @ x
        x = x[label[a : a + len(x)] > 0]
        positive += x.T @ x
    rate = label.mean()
    own = np.diag(positive) / np.maximum(np.diag(both), 1)
    expect = np.clip(own[:, None] + own[None, :] - rate, 0.0, 1.0)
    z = np.abs(positive - both * expect) / np.sqrt(np.maximum(both * rate * (1 - rate), 1e-9))
    z[both < options.least_rows] = 0
    np.fill_diagonal(z, 0)
    return used[(z >= options.pair_z).any(axis=1)]


def fit(terms: np.ndarray, first: np.ndarray, label: np.ndarray, options: FitOptions) -> Machine:
    """Adagrad on the logistic loss; a fixed seed gives the same machine."""
    n, k = 1 << TERM_BITS, options.factors
    rng = np.random.default_rng(options.seed)
    rate = min(max(label.mean() if len(label) else 0.0, 1e-4), 1 - 1e-4)
    whole = Machine(float(np.log(rate / (1 - rate))), np.zeros(n), np.zeros((n, k)))
    if not len(label) or label.min() == label.max():
        return whole
    counts, positive = np.bincount(terms, minlength=n), np.bincount(terms[np.repeat(label > 0, np.diff(first))], minlength=n)
    used = np.union1d(leaning_terms(counts, positive, label, options), paired_terms(terms, first, label, options))
    row, terms = _of(terms, first, used)
    first = np.searchsorted(row, np.arange(len(label) + 1))
    m = Machine(whole.bias, np.zeros(len(used)), rng.normal(0, 0.01, (len(used), k)))
    gw, gv, gb = np.full(len(used), 1e-2), np.full((len(used), k), 1e-2), 1e-2
    for _ in range(options.epochs):
        order = rng.permutation(len(label))
        for i in range(0, len(order), options.batch):
            pick = order[i : i + options.batch]
            size = first[pick + 1] - first[pick]
            stop = np.concatenate([[0], np.cumsum(size)])
            t = terms[np.arange(stop[-1]) + np.repeat(first[pick] - stop[:-1], size)]
            margin, side = m.margin(t, stop)
            err = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - label[pick]
            where = np.full(len(used), -1, dtype=np.int64)
            where[t] = 0
            which = np.flatnonzero(where == 0)
            where[which] = np.arange(len(which))
            where = where[t]
            e = np.repeat(err, size)
            total = np.bincount(where, weights=e, minlength=len(which))
            dw = total / len(pick) + options.decay * m.weight[which]
            apart = np.repeat(err[:, None] * side, size, axis=0)
            dv = np.stack([np.bincount(where, weights=apart[:, f], minlength=len(which)) for f in range(k)], axis=1)
            dv = (dv - total[:, None] * m.vector[which]) / len(pick) + options.decay * m.vector[which]
            db = err.mean()
            gw[which] += dw * dw
            gv[which] += dv * dv
            gb += db * db
            m.weight[which] -= options.rate * dw / np.sqrt(gw[which])
            m.vector[which] -= 0.5 * options.rate * dv / np.sqrt(gv[which])
            m.bias -= options.rate * db / np.sqrt(gb)
    whole.bias = m.bias
    whole.weight[used], whole.vector[used] = m.weight, m.vector
    return whole


def held_out(ident: str):
    """Whether crc32(id as text) mod 4 is 2; null ids are not."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, ident: str, text: str, label: str, options: FitOptions) -> Machine:
    marks = labels.select(F.col(ident).alias("__id"), F.col(label).alias("__label")).filter("__id is not null and __label is not null")
    marks = marks.filter(~held_out("__id")).groupBy("__id").agg(F.max("__label").alias("__label"))
    marks = marks.orderBy(F.xxhash64("__id"), "__id").limit(options.sample_rows)
    rows = docs.select(F.col(ident).alias("__id"), F.col(text).alias("__text")).join(marks, "__id").select("__id", "__label", "__text")

    def run(batches):
        for part, buf, off in tk.balanced(batches, "__text", 1 << 21):
            t, first = terms_of(buf, off)
            raw = t.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1).cast(pa.int64()), pa.array([raw[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                ["id", "label", "terms"],
            )

    kind = docs.schema[ident].dataType.simpleString()
    listed = rows.mapInArrow(run, f"id {kind}, label long, terms binary").groupBy("id").agg(F.min(F.struct("terms", "label")).alias("r"))  # one row of an id
    listed = materialise(listed.select("id", F.xxhash64("id").alias("h"), "r.label", "r.terms"), "labelled-terms")
    size = np.array([(r["h"], r["size"]) for r in listed.select("h", F.octet_length("terms").alias("size")).collect()], dtype=np.int64).reshape(-1, 2)
    size = size[np.argsort(size[:, 0], kind="stable")]  # at most `sample_rows` rows of two numbers
    fits = int(np.searchsorted(np.cumsum(size[:, 1]), options.sample_bytes, side="right"))
    if fits < len(size):
        listed = listed.filter(F.col("h") < int(size[fits, 0]))
    got = sorted(listed.select("h", "label", "terms").collect())
    first = np.concatenate([[0], np.cumsum([len(r["terms"]) // 4 for r in got], dtype=np.int64)]).astype(np.int64)
    label, terms = np.array([r["label"] > 0 for r in got], dtype=float), np.frombuffer(b"".join(r["terms"] for r in got), dtype="<i4")
    del got
    return fit(terms, first, label, options)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic",
    threshold: float = 0.3, options: FitOptions | None = None,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Labels are read only for ids that are not held out; of several labels of an id the largest counts, and null ones
    none. Null, empty and wordless texts score as the bias alone. Without labels of both classes every row gets the
    share of label 1. Rows with null or repeated ids are scored like others; an empty table gives no rows; other
    columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, ident, text, label, options or FitOptions()))

    def run(batches):
        for part, buf, off in tk.balanced(batches, "__text", 1 << 21):
            score = sent.value.score(*terms_of(buf, off))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema[ident].dataType.simpleString()
    chosen = docs.select(F.col(ident).alias("doc_id"), held_out(ident).alias("held_out"), F.col(text).alias("__text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
