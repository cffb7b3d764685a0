"""Groups, batches and shards over an ordered table.

Row numbers over a whole table come without a single-task window: rows are counted per range partition, and each row's
number is its place in its partition plus the counts before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALL_DUMPS


#: Lists of ids up to this length are sent to all executors.
BROADCAST_ROWS = 100_000


def group_bounds(n: int, group_size: float | None = None, num_groups: int | None = None) -> list[tuple[int, int]]:
    """Start and end of each group: ends are rounded half to even after adding up the (float) group size.

    With more groups than rows some groups are empty, and fewer than asked for may come.
    """
    if (group_size is None) == (num_groups is None):
        raise ValueError("give either group_size or num_groups")
    step = group_size if num_groups is None else n / num_groups
    bounds, at = [], 0
    while round(at) < n:
        bounds.append((round(at), min(round(at + step), n)))
        at += step
    return bounds


def numbered(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with the rows' numbers from 0 in the order of ``order``, which has to be unique.

    The number of partitions is given, so that adaptive execution leaves them as they are in both uses of the exchange.
    """
    many = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(many, *order).withColumn("__part", F.spark_partition_id())
    within = Window.partitionBy("__part").orderBy(*order)
    placed = parts.withColumn("__in", F.row_number().over(within) - 1)
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition only
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__in") + F.col("__start")).drop("__part", "__in", "__n", "__start")


def grouped(df: DataFrame, order: list[str], group_size: float | None = None, num_groups: int | None = None) -> DataFrame:
    """``df`` with ``row_no`` and ``group_no``. Only the number of rows is fetched to compute the bounds."""
    bounds = group_bounds(df.count(), group_size, num_groups)
    ends = F.array(*[F.lit(e).cast("long") for _, e in bounds]) if bounds else F.array().cast("array<bigint>")
    number = F.size(F.filter(ends, lambda e: e <= F.col("row_no")))
    if num_groups is None and float(group_size).is_integer():
        number = F.floor(F.col("row_no") / int(group_size)).cast("int")
    return numbered(df, order).withColumn("group_no", number)


def fixed_batches(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return numbered(df, order).withColumn("batch_no", F.floor(F.col("row_no") / n))


def train_val_split(df: DataFrame, order: list[str], n_val: int = 100) -> DataFrame:
    """The first ``n_val`` rows are for validation; ``order`` has to be unique. Only these rows are sent around."""
    first = df.select(*[F.col(c).alias(f"__{c}") for c in order]).orderBy(*[f"__{c}" for c in order]).limit(n_val).withColumn("__val", F.lit(True))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order]
    told = df.join(F.broadcast(first) if n_val <= BROADCAST_ROWS else first, same, "left")
    return told.select(*df.columns, F.when(F.col("__val"), "val").otherwise("train").alias("split"))


def length_batches(df: DataFrame, ident: str, length: str, size: int = 16) -> DataFrame:
    """``batch_no`` of rows in the order of their length, and ``pad_to``, the greatest length of the batch."""
    batched = fixed_batches(df, [length, ident], size)
    return batched.withColumn("pad_to", F.max(length).over(Window.partitionBy("batch_no"))).drop("row_no")


def padded(tokens: Column, pad_to: Column, pad: Column) -> Column:
    """A row's tokens, filled up to its batch's length."""
    return F.concat(tokens, F.array_repeat(pad, (pad_to - F.size(tokens)).cast("int")))


def by_token_length(df: DataFrame, ident: str, length: Column) -> DataFrame:
    return df.withColumn("token_length", length).orderBy("token_length", ident)


# ---- shards ----------------------------------------------------------------------------------------------------


def shard_of_path(path: Column) -> tuple[Column, Column]:
    """Dump and shard named by a path ``.../<dump>/<shard>.parquet``; empty where it names none."""
    pattern = r"([0-9]{4}-[0-9]{2})/([^/]+)\.parquet"
    return F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumn("shard", F.col("_metadata.file_path"))


def planned_shards(spark, num_shards: int, dumps: tuple[str, ...] = ALL_DUMPS) -> DataFrame:
    names = spark.createDataFrame([(d,) for d in dumps], "dump string")
    return names.select("dump", F.explode(F.sequence(F.lit(0), F.lit(num_shards - 1))).alias("n")).select("dump", F.lpad(F.col("n").cast("string"), 4, "0").alias("shard"))


def missing_shards(planned: DataFrame, existing: DataFrame) -> DataFrame:
    return planned.join(existing, planned.columns, "left_anti")


def zipped_shards(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Shards of two stages side by side, by name."""
    return left.join(right, keys)


def aligned(left: DataFrame, right: DataFrame, ident: str) -> DataFrame:
    """Two stages' columns side by side. An id that only one of them has fails the run; see ``assert_aligned`` for repeats."""
    a, b = left.withColumn("__l", F.lit(True)), right.withColumn("__r", F.lit(True))
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    odd = F.raise_error(F.concat(F.lit("only one of the stages has id "), F.coalesce(F.col(ident).cast("string"), F.lit("null"))))
    return a.join(b, ident, "full_outer").filter(F.when(both, True).otherwise(odd.cast("boolean"))).drop("__l", "__r")


def assert_aligned(left: DataFrame, right: DataFrame, ident: str) -> None:
    """Raises unless both hold the same ids, each once."""
    a = left.groupBy(ident).agg(F.count("*").alias("a"))
    b = right.groupBy(ident).agg(F.count("*").alias("b"))
    odd = a.join(b, ident, "full_outer").filter("a is null or b is null or a <> 1 or b <> 1")
    if not odd.isEmpty():
        raise ValueError("the stages do not hold the same ids once each")
