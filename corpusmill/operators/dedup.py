"""Near-duplicate removal by MinHash buckets, and paragraph dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def bucket_names(df: DataFrame) -> list[str]:
    names = [c for c in df.columns if c.startswith("minhash_bucket_")]
    return sorted(names, key=lambda c: int(c.rsplit("_", 1)[1]))


def survivors_by_pass(buckets: DataFrame, ident: str = "id", scope: str | None = None) -> list[DataFrame]:
    """Survivors after each bucket column in turn: of those still there, the smallest id per bucket value stays.

    Each pass is one aggregation of the smallest (id, later buckets) struct, combined before its shuffle: a value that
    a third of all rows share is reduced to one row per task, and no window ever holds it. Rows with null buckets (null
    texts) collide with nothing and are left out.
    """
    names = bucket_names(buckets)
    keys = [scope] if scope else []
    alive = buckets.filter(F.col(names[0]).isNotNull()).select(ident, *keys, *names)
    out = []
    for i, name in enumerate(names):
        rest = names[i + 1 :]
        alive = alive.groupBy(*keys, name).agg(F.min(F.struct(ident, *rest)).alias("s")).select(*keys, f"s.{ident}", *[f"s.{c}" for c in rest])
        out.append(alive.select(*keys, ident))
    return out


def colliding(buckets: DataFrame, ident: str = "id", scope: str | None = None) -> DataFrame:
    """The rows that share the value of some bucket column with another row. Only they can lose, or make others lose."""
    names, keys = bucket_names(buckets), [scope] if scope else []
    each = buckets.select(ident, *keys, F.posexplode(F.array(*names)).alias("__n", "__v")).filter(F.col("__v").isNotNull())
    shared = each.groupBy(*keys, "__n", "__v").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    on = F.lit(True)
    left, right = each.alias("l"), shared.alias("r")
    for c in [*keys, "__n", "__v"]:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    ids = left.join(right, on, "left_semi").select(ident).distinct()
    return buckets.join(ids, ident, "left_semi")


def with_dedup_keep(docs: DataFrame, buckets: DataFrame, ident: str = "id", scope: str | None = None) -> DataFrame:
    """``docs`` with ``dedup_keep``: whether its id survived. Null texts, which collide with nothing, stay.

    The buckets are written once; the passes then run over the rows that share a value with another one.
    """
    buckets = staged(buckets.select(ident, *([scope] if scope else []), *bucket_names(buckets)), "buckets")
    some = staged(colliding(buckets, ident, scope), "colliding")
    lost = staged(some.select(ident).join(survivors_by_pass(some, ident, scope)[-1].select(ident), ident, "left_anti").distinct(), "lost")
    kept = buckets.select(ident).distinct().join(lost, ident, "left_anti").withColumn("__kept", F.lit(True))
    return docs.join(kept, ident, "left").withColumn("dedup_keep", F.coalesce("__kept", F.lit(False))).drop("__kept")


def paragraph_dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text) with every later copy of a paragraph (line) removed, by the digest of its trimmed lowered form.

    The first place of a digest is a minimum combined before its shuffle; texts are put together again per row.
    """
    each = docs.select(ident, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    each = each.withColumn("digest", F.sha1(F.lower(F.trim("line"))))
    first = each.groupBy("digest").agg(F.min(F.struct(ident, "line_no")).alias("f"))
    kept = first.select(f"f.{ident}", "f.line_no")
    lines = kept.groupBy(ident).agg(F.collect_list("line_no").alias("kept"))
    joined = docs.select(ident, text).join(lines, ident, "left")
    stay = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.when(F.array_contains("kept", i), x)), lambda x: x.isNotNull())
    return joined.select(ident, F.array_join(F.coalesce(stay, F.array().cast("array<string>")), "\n").alias(text))
