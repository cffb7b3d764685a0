"""Tables that cut lineage, in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset (a local session, as in tests) a folder of our own."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{key} must name a folder that the driver and all executors share")
    if not (own := getattr(shared_dir, "own", None)):
        own = shared_dir.own = tempfile.mkdtemp(prefix="corpusmill-")
    return own


def materialise(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back: later steps survive lost executors and never repeat its work."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
