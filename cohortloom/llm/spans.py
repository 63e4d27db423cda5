"""Positions of pattern matches as rows, with DataFrame functions alone.

Splitting a text at a pattern gives the gaps between its matches, so a running sum
of gap and match lengths gives code-point positions in one pass over the text. The
sums run in a window over one document's matches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW = "_row"
CONTEXT = 40


def with_row(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW, F.monotonically_increasing_id())


def found(df: DataFrame, text: Column, patterns: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """(other columns, kind, start, end, value, left, right), dealt by document.

    `patterns` maps a kind to its pattern and to a cheap test that every text with a
    match passes. Patterns never match the empty string. `df` has the column _row; a
    row without any match is kept once with a null kind. `left` and `right` are up to
    40 characters of context.
    """
    none = F.array().cast("array<string>")
    keep = [F.col(f"`{c}`") for c in df.columns]
    arrays, kinds = [], []
    for number, (kind, (pattern, test)) in enumerate(patterns.items()):
        hits = F.when(test, F.expr(f"regexp_extract_all(_text, {_literal(pattern)}, 0)")).otherwise(none)
        gaps = F.when(test, F.split("_text", pattern, -1)).otherwise(none)
        arrays += [hits.alias(f"_hits{number}"), gaps.alias(f"_gaps{number}")]
        entry = F.struct(F.lit(kind).alias("kind"), F.col(f"_hits{number}").alias("hits"), F.col(f"_gaps{number}").alias("gaps"))
        kinds.append(F.when(F.size(f"_hits{number}") > 0, entry))
    split = df.select(*keep, text.alias("_text")).select(*keep, *arrays)
    by_kind = split.select(*keep, F.explode_outer(F.array_compact(F.array(*kinds))).alias("_found"))
    pairs = F.arrays_zip(
        F.col("_found.hits").alias("hit"),
        F.col("_found.gaps").alias("gap"),
        F.expr("slice(_found.gaps, 2, size(_found.gaps))").alias("after"),
    )
    rows = by_kind.select(*keep, F.col("_found.kind").alias("kind"), F.posexplode_outer(pairs).alias("_at", "_pair"))
    rows = rows.filter(F.col("kind").isNull() | F.col("_pair.hit").isNotNull())
    narrow = rows.select(
        *keep,
        "kind",
        "_at",
        F.col("_pair.hit").alias("value"),
        F.char_length("_pair.gap").alias("_gap"),
        F.right("_pair.gap", F.lit(CONTEXT)).alias("left"),
        F.left("_pair.after", F.lit(CONTEXT)).alias("right"),
    ).repartition(F.col(ROW))
    size = F.char_length("value")
    order = Window.partitionBy(ROW, "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = narrow.withColumn("end", F.sum((F.col("_gap") + size).cast("long")).over(order))
    return placed.select(*keep, "kind", (F.col("end") - size).alias("start"), "end", "value", "left", "right")


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def running(value: Column, partition: str | list[str], *order: Column) -> Column:
    """The largest value among the rows so far, this one included."""
    return F.max(value).over(
        Window.partitionBy(partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )


def joined(entries: Column) -> Column:
    """kind:start:end, comma-joined, of an array of structs in order."""
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))),
        ",",
    )


def uncovered(base: Column) -> Column:
    """Whether a span is no base span and overlaps none of its document; needs rows dealt by _row.

    Two sweeps: the furthest base end among spans that begin no later, and the nearest
    base start among those that begin no earlier.
    """
    first = F.coalesce(base, F.lit(False)).desc()
    reach = running(F.when(base, F.col("end")), ROW, F.col("start"), first)
    ahead = -running(F.when(base, -F.col("start")), ROW, F.col("start").desc(), first)
    covered = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    return ~base & ~covered
