"""Distributed connected components by alternating large-star and small-star steps.

Every step is a minimum per node (combined before its shuffle) and a join that Spark may split at a hub, so neither a
component nor a hub's neighbours are ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u > v) after one large-star or small-star step."""
    if large:
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = ways.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        down = edges.join(low, "u")
        out = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component) of every node on an edge of (a, b), two columns of one orderable type.

    The component is its smallest node. Null ends, loops and repeated edges are ignored; no edges give no rows.
    """
    a, b = edges.columns
    e = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = materialise(e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name)
    before = _state(e)
    for _ in range(rounds):
        e = materialise(_star(_star(e, True), False), name)
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
