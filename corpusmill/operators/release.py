"""Release: the stages' columns aligned by id, filtered and masked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def release(sources: DataFrame, texts: DataFrame, quality: DataFrame, dedup: DataFrame, ident: str = "id", mask: bool = True) -> DataFrame:
    """Rows that pass the quality filter and stay in dedup. The two filters run below the joins."""
    good = quality.filter("passes_all_quality_filters").drop("passes_all_quality_filters")
    stay = dedup.filter("dedup_keep").select(ident)
    out = sources.join(good, ident).join(stay, ident, "left_semi").join(texts, ident)
    return out.withColumn("text", tx.mask_pii(F.col("text"))) if mask else out
