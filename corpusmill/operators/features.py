"""Quality features: an extension point, the default set, and the filter over them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FilterConfig, MinHashConfig
from ..functions import minhash as mh
from ..functions import text as tx


@dataclass(frozen=True)
class Feature:
    """Named columns computed from a row's ``url`` and ``text``; any Column will do, a pandas UDF included."""

    name: str
    columns: Callable[[Column, Column], dict[str, Column]]


def executor_model(load: Callable[[], object], score: Callable[[object, str], object], kind: str) -> Callable[[Column], Column]:
    """A model as a Column function: loaded once by each task at its first batch, then applied to every text.

    Nulls stay null. ``load`` and ``score`` are shipped to the executors; the model itself is not.
    """

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for texts in batches:
            model = load() if model is None else model
            yield texts.map(partial(score, model), na_action="ignore")

    return lambda text: run(text)


def default_features(filters: FilterConfig = FilterConfig(), language: Callable[[Column], Column] = tx.language) -> list[Feature]:
    domains, strategy = filters.blacklisted_domains, filters.parse_error_strategy
    return [
        Feature("length", lambda url, text: {"content_length": tx.content_length(text)}),
        Feature("domain", lambda url, text: {"is_domain_blacklisted": tx.is_domain_blacklisted(url, domains, strategy)}),
        Feature("alphanumeric", lambda url, text: {"ratio_alphanumeric_chars": tx.ratio_alphanumeric(text)}),
        Feature("headings", lambda url, text: {"ratio_headings_per_non_heading_word": tx.heading_ratio(text)}),
        Feature("entropy", lambda url, text: {"unigram_entropy": tx.unigram_entropy(text)}),
        Feature("language", lambda url, text: {"language": language(text)}),
    ]


def with_features(docs: DataFrame, features: list[Feature], url: str = "url", text: str = "text", once: bool = False) -> DataFrame:
    """One projection adds all features' columns.

    ``once``: behind a generator, which keeps Catalyst from writing a feature out again wherever a filter reads it. All of
    ``features`` are computed then, read or not.
    """
    added: dict[str, Column] = {}
    for f in features:
        added |= f.columns(F.col(url), F.col(text))
    if once:
        return docs.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in added.items()]))))
    return docs.withColumns(added)


def with_minhash(docs: DataFrame, cfg: MinHashConfig = MinHashConfig(), text: str = "text") -> DataFrame:
    """``minhash_bucket_0`` ... of every text; null for null texts. The signature is computed once per row."""
    each = docs.withColumn("__buckets", mh.bucket_column(mh.normalize_for_minhash(F.col(text)), cfg))
    named = {f"minhash_bucket_{i}": F.col("__buckets")[i] for i in range(cfg.buckets)}
    return each.withColumns(named).drop("__buckets")


def passes(cfg: FilterConfig = FilterConfig()) -> Column:
    """All rules hold; a null feature fails."""
    rule = F.col("content_length").between(*cfg.content_length) & ~F.col("is_domain_blacklisted")
    rule &= F.col("ratio_alphanumeric_chars").between(*cfg.alphanumeric)
    rule &= F.col("ratio_headings_per_non_heading_word").between(*cfg.headings)
    if cfg.apply_entropy:
        rule &= F.col("unigram_entropy").between(*cfg.entropy)
    return F.coalesce(rule, F.lit(False))


def with_verdict(features: DataFrame, cfg: FilterConfig = FilterConfig()) -> DataFrame:
    return features.withColumn("passes_all_quality_filters", passes(cfg))


def word_counts(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    each = docs.select(ident, F.explode(tx.words(F.col(text))).alias("word"))
    return each.groupBy(ident, "word").agg(F.count("*").alias("n"))


def discrete_quantiles(rows: DataFrame, value: str, shares: tuple[float, ...], bins: int = 1024) -> list[float | None]:
    """The values that the shares of the rows, in order, end at: exact, without a sort. ``rows`` is read some times.

    Each pass counts the bins of the range that holds the wanted rank, until one value is left. Nulls are not counted.
    """
    x = F.col(value).cast("double")
    n, least, most = rows.select(F.count(x), F.min(x), F.max(x)).first()
    out = []
    for share in shares:
        rank, low, high = max(1, n - math.floor(n - n * share)), least, most
        while n and low < high:
            width = (high - low) / bins
            at = F.least(F.floor((x - low) / width), F.lit(bins)) if width > 0 else (x > low).cast("long")
            counts = rows.filter(x.between(low, high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
            for c in sorted(counts.collect(), key=lambda c: c["bin"]):
                if rank <= c["n"]:
                    low, high = c["low"], c["high"]
                    break
                rank -= c["n"]
        out.append(low)
    return out
