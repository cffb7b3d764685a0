"""The corpus pipeline: five stages over ``documents``, each a call of one operator of ``corpusmill.llm``.

Every stage takes all rows that its predecessor kept. The first four return the columns of their input; the last one
returns the packed pieces. Null texts count as empty throughout. Rows that repeat an id are rows of their own to the
quality rules and to packing, and share their fate where a stage decides by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontamination, line_dedup, ngram_join, packing, quality_rules
from corpusmill.llm.storage import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition and length rules keep."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stood earlier in the corpus; ``n_chars`` follows the text.

    A document that loses all its words was a copy of earlier lines as a whole and goes; others keep what is theirs.
    """
    left = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.filter(F.col("text").isNull() | F.col("text").rlike(line_dedup.WORD)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.one_per_component(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (at least 0.8 of its five-word shingles)."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token sequences in bins of 2048."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: No SQL: token ids, and the plan of the packing, are beyond it. tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written, and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
