"""Intermediate tables that several steps read, in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame

_OWN: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back, so that what follows neither repeats its work nor loses it.

    Only a local session without that setting gets a folder of its own.
    """
    spark, key = df.sparkSession, "spark.checkpoint.dir"
    top = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{key} must name a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="corpusmill-"))
        top = _OWN[0]
    path = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
