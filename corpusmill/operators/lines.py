"""Line-level operators: exploding, scoring, filtering, token windows and their stitching, images, labels."""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

LineScorer = Callable[[Column], Column]


def explode_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text", compat: bool = False) -> DataFrame:
    lines = tx.split_lines(F.col(text), compat)
    return docs.select(ident, F.posexplode(lines).alias("line_no", "line"))


def default_line_score(line: Column) -> Column:
    """Logit of keeping a line, from its shape: words, letters, link marks. A model can take its place."""
    n = F.length(line)
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]", ""))
    words = F.size(F.filter(F.split(line, " "), lambda w: w != ""))
    share = F.when(n == 0, F.lit(0.0)).otherwise(letters / n)
    return F.least(words, F.lit(30)) * 0.2 + share * 4.0 - F.when(line.rlike(r"\||https?:"), 3.0).otherwise(0.0) - 3.0


def line_shape(line: Column) -> dict[str, Column]:
    """What a line's shape tells, as numbers from 0 to about 1."""
    n = F.length(line)
    part = lambda kind: F.when(n == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(line, kind, "")) / n)
    words = F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    return {
        "words": F.least(words, F.lit(30)) / 30.0, "length": F.least(n, F.lit(200)) / 200.0,
        "letters": part(r"[^\p{L}]"), "digits": part(r"[^\p{N}]"), "marks": part(r"[^\p{P}\p{S}]"),
        "link": F.when(line.rlike(r"\||https?:"), 1.0).otherwise(0.0), "ends": F.when(line.rlike(r"[.!?:]\s*$"), 1.0).otherwise(0.0),
    }


def fit_line_scorer(rows: DataFrame, line: str = "line", label: str = "label", regularisation: float = 0.01, rounds: int = 100) -> LineScorer:
    """Logistic regression on the lines' shapes, fitted on all labelled rows; the scorer is a native Column of logits.

    Rows without line or label are left out; with one kind of label only, the scorer is a constant.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    shape = line_shape(F.col(line))
    known = rows.filter(F.col(line).isNotNull() & F.col(label).isNotNull())
    numbers = known.select(*[c.cast("double").alias(k) for k, c in shape.items()], F.col(label).cast("double").alias("label"))
    seen = numbers.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return lambda x: F.when(x.isNotNull(), F.lit(0.0 if seen[0] is None else 20.0 if seen[0] > 0 else -20.0))
    vectors = VectorAssembler(inputCols=list(shape), outputCol="features").transform(numbers).select("features", "label")
    model = LogisticRegression(regParam=regularisation, maxIter=rounds).fit(vectors)
    weights, bias = [float(w) for w in model.coefficients], float(model.intercept)

    def scorer(x: Column) -> Column:
        logit = F.lit(bias)
        for w, value in zip(weights, line_shape(x).values(), strict=True):
            logit = logit + value * w
        return logit

    return scorer


def line_scores(text: Column, scorer: LineScorer = default_line_score, compat: bool = False) -> Column:
    """A probability for each line."""
    return F.transform(tx.split_lines(text, compat), lambda x: tx.sigmoid(scorer(x)))


def filter_lines(text: Column, scores: Column, threshold: float = 0.5, strict: bool = False, compat: bool = False) -> Column:
    """Lines whose score reaches the threshold (passes it, if strict), with their line ends."""
    pairs = F.arrays_zip(tx.split_lines(text, compat).alias("line"), scores.alias("score"))
    keep = (lambda x: x["score"] > threshold) if strict else (lambda x: x["score"] >= threshold)
    return F.array_join(F.transform(F.filter(pairs, keep), lambda x: x["line"]), "")


def every_nth_separator(lines: DataFrame, n: int, ident: str = "doc_id", order: str = "line_no") -> DataFrame:
    """``is_global`` for the lines whose running number modulo n is 1; with n 0 or 1 there are none."""
    number = F.row_number().over(Window.partitionBy(ident).orderBy(order))
    return lines.withColumn("is_global", (number % n == 1) if n > 1 else F.lit(False))


# ---- token windows ---------------------------------------------------------------------------------------------


def window_starts(n_tokens: Column, max_length: int, overlap: int = 512) -> Column:
    """Starts of the windows over a text: they overlap only if the text is longer than one."""
    stride = F.when(n_tokens > max_length, F.lit(max_length - overlap)).otherwise(F.lit(max_length))
    return F.when(n_tokens > 0, F.sequence(F.lit(0).cast("long"), (n_tokens - 1).cast("long"), stride.cast("long"))).otherwise(F.array().cast("array<bigint>"))


def token_windows(docs: DataFrame, n_tokens: Column, max_length: int, overlap: int = 512, ident: str = "doc_id") -> DataFrame:
    each = docs.select(ident, n_tokens.alias("__n"), F.explode(window_starts(n_tokens, max_length, overlap)).alias("token_start"))
    length = F.least(F.lit(max_length).cast("long"), F.col("__n") - F.col("token_start"))
    return each.select(ident, "token_start", length.alias("window_length"))


def stitch(windows: list[tuple[list[int], int, list[float]]], context: int = 256) -> list[float]:
    """Scores of a text from (separators' places in the text, window start, scores) of its windows in order.

    The first scored window counts whole. A later one counts from its first separator at least ``context`` tokens in:
    what was scored from that separator on gives way; if it was not scored yet, the rest is appended.
    """
    places: list[int] = []
    scores: list[float] = []
    for at, start, new in windows:
        if not at:
            continue
        if not places:
            places, scores = list(at), list(new)
            continue
        cut = next((k for k, p in enumerate(at) if p - start >= context), None)
        if cut is None:
            continue
        keep = places.index(at[cut]) if at[cut] in places else len(places)
        places[keep:], scores[keep:] = at[cut:], new[cut:]
    return scores


def stitched_scores(text: Column, max_length: int, overlap: int = 512, context: int = 256, score: Callable[[str], float] | None = None) -> Column:
    """Line scores of texts read window by window, white-space tokens with a separator after each line."""
    score = score or (lambda line: len(line) / (1.0 + len(line)))

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[float]:
            place, n, each = [], 0, []
            lines = t.split("\n")
            for line in lines[:-1] if lines[-1] == "" else lines:
                n += len(line.split())
                place.append(n)
                each.append(float(score(line)))
                n += 1
            stride = max_length - overlap if n > max_length else max_length
            told = []
            for s in range(0, n, stride):
                inside = [k for k, p in enumerate(place) if s <= p < s + max_length]
                told.append(([place[k] for k in inside], s, [each[k] for k in inside]))
            return stitch(told, context)

        return texts.map(one, na_action="ignore")

    return run(text)


# ---- images ----------------------------------------------------------------------------------------------------

IMAGE = re.compile(tx.IMAGE)


def split_images(markdown: str) -> tuple[str, list[tuple[int, str]]]:
    """Text without image references, and (place in that text, URL) of each."""
    out, last, removed, text = [], 0, 0, []
    for m in IMAGE.finditer(markdown):
        out.append((m.start() - removed, m[2]))
        text.append(markdown[last : m.start()])
        last, removed = m.end(), removed + len(m[0])
    return "".join([*text, markdown[last:]]), out


def insert_images(text: str, images) -> str:
    """The inverse, without alternative texts: a list of pairs, an OrderedDict with int keys, or a dict."""
    if isinstance(images, OrderedDict):
        if any(not isinstance(k, int) for k in images):
            raise ValueError("places must be whole numbers")
        pairs = list(images.items())
    elif isinstance(images, dict):
        pairs = sorted((int(k), v) for k, v in images.items())
    elif isinstance(images, (list, tuple)):
        pairs = list(images)
    else:
        raise ValueError("images must be a mapping or a list of pairs")
    out, last = [], 0
    for place, url in pairs:
        out += [text[last:place], f"![]({url})"]
        last = place
    return "".join([*out, text[last:]])


def image_places(text: Column) -> Column:
    """array<struct<pos, url>> of a Markdown text's images."""

    @F.pandas_udf("array<struct<pos:int,url:string>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"pos": p, "url": u} for p, u in split_images(t)[1]], na_action="ignore")

    return run(text)


def image_map(places: Column) -> Column:
    """The map form: of images at one place the last stays."""
    lone = F.filter(places, lambda x, i: F.size(F.filter(F.slice(places, i + 2, F.greatest(F.size(places) - i - 1, F.lit(0))), lambda y: y["pos"] == x["pos"])) == 0)
    return F.map_from_entries(lone)


def with_images(text: Column, places: Column) -> Column:
    """Images put back at their places; native."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("last"))
    step = lambda a, x: F.struct(
        F.concat(a["out"], F.substring(text, a["last"] + 1, x["pos"] - a["last"]), F.lit("![]("), x["url"], F.lit(")")).alias("out"),
        x["pos"].alias("last"),
    )
    return F.aggregate(places, start, step, lambda a: F.concat(a["out"], F.substring(text, a["last"] + 1, F.length(text))))


# ---- labels and metrics ----------------------------------------------------------------------------------------


def line_labels(selected: Column, n_lines: Column, compat: bool = False) -> Column:
    """0/1 per line. ``compat`` drops the label when the only selected line is the first."""
    ones = F.aggregate(F.coalesce(selected, F.array().cast("array<int>")), F.lit(0), lambda a, x: a + x)
    label = lambda i: F.when(F.array_contains(selected, i) & (ones > 0 if compat else F.lit(True)), 1).otherwise(0)
    every = F.when(n_lines > 0, F.sequence(F.lit(0), (n_lines - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(every, label)


def truncate_labels(selected: Column, n_lines: Column) -> Column:
    return F.filter(selected, lambda x: x < n_lines)


def bce_with_logits(logit: Column, label: Column) -> Column:
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def mean_bce(lines: DataFrame, ident: str, logit: str, label: str) -> DataFrame:
    """Mean over texts of the mean over their lines."""
    per = lines.groupBy(ident).agg(F.avg(bce_with_logits(F.col(logit), F.col(label).cast("double"))).alias("l"))
    return per.agg(F.avg("l").alias("loss"))


def binary_metrics(rows: DataFrame, score: Column, label: Column, threshold: float = 0.5) -> DataFrame:
    """accuracy, precision, recall and f1 of ``score > threshold``; 0 where undefined."""
    got, want = score > threshold, label > 0
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    c = rows.agg(count(got & want).alias("tp"), count(got & ~want).alias("fp"), count(~got & want).alias("fn"), count(~got & ~want).alias("tn"))
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
