"""The curation stages in order, each a function of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import markup
from ..functions import text as tx
from ..operators import dedup, features, lines
from ..operators.release import release


def converted(records: DataFrame) -> DataFrame:
    """(id, url, warc_file, warc_date, warc_block_digest, content); no content where a page fails or takes too long."""
    content = markup.html_to_markdown(markup.decode_html("payload"))
    return records.select("id", "url", tx.warc_suffix(F.col("warc_file")).alias("warc_file"), "warc_date", "warc_block_digest", content.alias("content"))


def to_markdown(records: DataFrame) -> DataFrame:
    """The converted pages; those that cannot be converted are left out."""
    return converted(records).filter(F.col("content").isNotNull())


def failed(pages: DataFrame) -> DataFrame:
    """The side output: which of the ``converted`` pages (written and reread, so as not to convert twice) failed."""
    return pages.filter(F.col("content").isNull()).drop("content")


def to_text(pages: DataFrame, cfg: PipelineConfig = PipelineConfig(), scorer: lines.LineScorer = lines.default_line_score) -> DataFrame:
    """(id, text): lines kept by score, repaired, without images."""
    c, content = cfg.lines, F.col("content")
    kept = lines.filter_lines(content, lines.line_scores(content, scorer, c.compat_boundaries), c.threshold, c.strict, c.compat_boundaries)
    return pages.select("id", tx.strip_images(markup.fix_text(kept)).alias("text"))


def to_quality(docs: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(id, features, MinHash buckets, verdict) of (id, url, text)."""
    done = features.with_features(docs, features.default_features(cfg.filters))
    return features.with_verdict(features.with_minhash(done, cfg.minhash), cfg.filters).drop("url", "text")


def to_dedup(quality: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    rows = quality.filter("passes_all_quality_filters") if cfg.restrict_dedup_to_passing else quality
    scope = None if cfg.dedup_scope == "global" else cfg.dedup_scope
    return dedup.with_dedup_keep(rows.select("id"), rows, "id", scope)


def curate(records: DataFrame, cfg: PipelineConfig = PipelineConfig(), cut=lambda df: df) -> DataFrame:
    """WARC records to release rows. ``cut`` may write and reread a stage, so that its UDFs run once."""
    pages = cut(to_markdown(records))
    texts = cut(to_text(pages, cfg))
    quality = cut(to_quality(pages.select("id", "url").join(texts, "id"), cfg))
    flags = to_dedup(quality, cfg)
    source = pages.select("id", "url", "warc_file", "warc_date")
    return release(source, texts, quality.select("id", "language", "passes_all_quality_filters"), flags)
