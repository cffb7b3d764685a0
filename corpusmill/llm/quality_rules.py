"""Quality rules by repetition coverage (operator 7).

Rolling hashes of several n-gram lengths mark the words that lie inside n-grams seen earlier in the same text; the
share of characters they cover, and the share inside repeated lines, reject a text. All per text: one narrow Arrow
stage, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
NOT_NEWLINE = np.ones(256, dtype=bool)
NOT_NEWLINE[10] = False
WINDOW = 8

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, dup_line_chars double, dup_ngram_chars array<double>"
)


@dataclass(frozen=True)
class RepetitionRules:
    """Largest shares of characters inside repeated n-grams (by n) and repeated lines."""

    ngrams: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    line_chars: float = 0.20
    min_words: int = 20
    repeat_percent: int = 30


def later_copies(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over (row, hash) entries: equal to another one of the row; equal to an earlier one."""
    both, later = np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=bool)
    key = h ^ tk.mix(row.astype(np.uint64))
    srt = np.sort(key)
    dup = srt[1:][srt[1:] == srt[:-1]]
    if not len(dup):
        return both, later
    dup = np.unique(dup)
    at = np.searchsorted(dup, key)
    at[at == len(dup)] = 0
    cand = np.flatnonzero(dup[at] == key)
    order = cand[np.lexsort((cand, h[cand], row[cand]))]
    same = (row[order][1:] == row[order][:-1]) & (h[order][1:] == h[order][:-1])
    later[order[1:][same]] = True
    both[order[1:][same]] = True
    both[order[:-1][same]] = True
    return both, later


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Mask over n words: inside a window of ``width`` words at one of the starts."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def code_points(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points in each span (spans ascend)."""
    lead = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=lead[1:])
    return lead[end] - lead[start]


def measure(buf: np.ndarray, off: np.ndarray, rules: RepetitionRules) -> dict[str, np.ndarray]:
    w = tk.words_of(buf, off)
    n = len(off) - 1
    rows = tk.row_of(w.first)
    chars = code_points(buf, w.start, w.end)
    n_words, word_chars = np.diff(w.first), tk.sums(chars, w.first)
    sym = np.flatnonzero(SYMBOLS[buf])
    n_symbols = np.diff(np.searchsorted(sym, off))

    ls, le = tk.edges(buf, off, NOT_NEWLINE)  # empty lines have no word and never count
    at = np.searchsorted(w.start, ls)
    has = (at < len(w.start)) & (np.append(w.start, 0)[np.minimum(at, len(w.start))] < le)
    ls, le = ls[has], le[has]
    line_row = np.searchsorted(off, ls, side="right") - 1
    _, later = later_copies(line_row, tk.span_hash(buf, ls, le))
    n_dup_lines = np.bincount(line_row[later], minlength=n)
    a, b = np.searchsorted(w.start, ls[later]), np.searchsorted(w.start, le[later])
    sums = np.concatenate([[0], np.cumsum(chars)])
    line_chars = np.bincount(line_row[later], weights=sums[b] - sums[a], minlength=n)

    rolling = tk.Rolling(w.hash, w.first)
    p, h = rolling.windows(WINDOW)
    both, _ = later_copies(rows[p], h)
    n_repeat = tk.sums(covered(len(rows), p[both], WINDOW), w.first)

    shares, alive = [], None
    total = np.maximum(word_chars, 1)
    failed = line_chars > rules.line_chars * total
    for width in sorted(rules.ngrams):
        # a longer n-gram repeats only where its first shorter n-gram does
        p, h = rolling.windows(width, None if alive is None else np.flatnonzero(alive))
        both, later = later_copies(rows[p], h)
        alive = np.zeros(len(rows), dtype=bool)
        alive[p[both]] = True
        share = tk.sums(np.where(covered(len(rows), p[later], width), chars, 0), w.first) / total
        shares.append(share)
        failed |= share > rules.ngrams[width]
    base = (n_words < rules.min_words) | (100 * n_repeat > rules.repeat_percent * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "base_failed": base, "kept": ~base & ~failed, "dup_line_chars": line_chars / total,
        "dup_ngram_chars": np.stack(shares, axis=1) if shares else np.zeros((n, 0)),
    }


def repetition_measures(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: RepetitionRules | None = None
) -> DataFrame:
    """The ``keep`` columns of every row, then its measures and verdict (``SCHEMA``).

    Null and empty texts have no words and fail the base rule. Repeated rows are judged each for itself; an empty
    table gives no rows; other columns are ignored. Texts of any length are measured whole.
    """
    rules = rules or RepetitionRules()
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])

    def run(batches):
        for part, buf, off in tk.balanced(batches, "__text", 1 << 21):
            m = measure(buf, off, rules)
            shares = m.pop("dup_ngram_chars")
            lists = pa.ListArray.from_arrays(
                np.arange(len(off), dtype=np.int32) * shares.shape[1], pa.array(shares.ravel())
            )
            cols = [part.column(i) for i in range(len(keep))]
            cols += [pa.array(v) for v in m.values()] + [lists]
            yield pa.RecordBatch.from_arrays(cols, [*keep, *m, "dup_ngram_chars"])

    return chosen.mapInArrow(run, f"{fields}, {SCHEMA}" if keep else SCHEMA)


def quality_filter(docs: DataFrame, text: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns as they are."""
    rules = rules or RepetitionRules()

    def run(batches):
        for part, buf, off in tk.balanced(batches, text, 1 << 21):
            yield part.filter(pa.array(measure(buf, off, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
