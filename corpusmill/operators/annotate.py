"""Annotation data: defaults, views, selections, losses, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "url string, content string, selected_lines array<int>, is_ignored boolean, line_predictions array<double>"


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, plain or zipped by their suffix; a malformed line fails the read."""
    return spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path)


def looked_up(rows: DataFrame, value: str, key: str = "url") -> DataFrame:
    """The rows of one key."""
    return rows.filter(F.col(key) == value)


def with_defaults(rows: DataFrame) -> DataFrame:
    """Missing selections are empty, missing marks false."""
    return rows.withColumns(
        {
            "selected_lines": F.coalesce("selected_lines", F.array().cast("array<int>")),
            "is_ignored": F.coalesce("is_ignored", F.lit(False)),
        }
    )


def kept(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.coalesce("is_ignored", F.lit(False)))


def upserted(rows: DataFrame, changed: DataFrame, key: str = "url") -> DataFrame:
    """``rows`` with those of ``changed`` put in the place of theirs, or added."""
    return rows.join(changed.select(key), key, "left_anti").select(*rows.columns).unionByName(changed.select(*rows.columns))


def view(rows: DataFrame, ident: str, mode: str = "annotations", threshold: float = 0.5) -> DataFrame:
    """(id, line_no, line, selected, score, shown) of the lines that end in a newline.

    Mode ``predictions`` shows scores over the threshold, ``output`` those that reach it, others the selection.
    """
    lines = F.split("content", "\n")
    body = F.slice(lines, 1, F.size(lines) - 1)
    each = rows.select(ident, "selected_lines", "line_predictions", F.posexplode(body).alias("line_no", "line"))
    score = F.get("line_predictions", F.col("line_no"))
    chosen = F.array_contains("selected_lines", F.col("line_no"))
    shown = {"predictions": score > threshold, "output": score >= threshold}.get(mode, chosen)
    return each.select(ident, "line_no", "line", chosen.alias("selected"), score.alias("score"), F.coalesce(shown, F.lit(False)).alias("shown"))


def drag_selected(selected: Column, start: Column, end: Column, selecting: bool) -> Column:
    """A dragged range of line numbers added to, or taken from, a selection; sorted."""
    dragged = F.sequence(F.least(start, end), F.greatest(start, end))
    return F.sort_array(F.array_union(selected, dragged) if selecting else F.array_except(selected, dragged))


def line_loss(score: Column, label: Column) -> Column:
    return -(label * F.ln(score + 1e-5) + (1 - label) * F.ln(1 - score + 1e-5))


def loss_intensity(loss: Column) -> Column:
    return 1 - F.least(F.greatest(loss, F.lit(0.0)), F.lit(2.0)) / 2
