"""Counts: one-way, two-way, value frequencies, zero-filled and wide forms.

Every count combines on the map side, so what crosses the network is bounded by
the number of distinct keys per task and a hot key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import age_band, decode, is_text, match_label, strip, with_numbers
from cohortloom.schema import CohortSchema


def label_of(schema: CohortSchema) -> Column:
    """Declared label or null."""
    return match_label(F.col(schema.label), schema.labels)


def dimensions(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(label, category, band) of every row that has a declared label."""
    labelled = df.where(label_of(schema).isNotNull())
    return with_numbers(labelled, [schema.number]).select(
        label_of(schema).alias(schema.label),
        strip(F.col(schema.category)).alias(schema.category),
        age_band(F.col(schema.number), schema).alias(schema.band_name),
    )


def counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _raw_text(df: DataFrame, name: str) -> Column:
    """The value as written, without padding; blanks stay and are dropped later."""
    return strip(F.col(name)) if is_text(df, name) else F.col(name).cast("string")


def value_counts(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(indicator, value, n) over the values as written; blanks are skipped.

    The unpivot multiplies rows only inside the task: the partial aggregate sits
    right behind it and the shuffle carries distinct values.
    """
    long = (
        df.where(label_of(schema).isNotNull())
        .select(*[_raw_text(df, name).alias(name) for name in schema.ordinals])
        .unpivot([], list(schema.ordinals), "indicator", "value")
        .where(F.col("value") != "")
    )
    return counts(long, ["indicator", "value"])


def distribution_table(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """All counts as one long (key, n) table, keys joined by '|'.

    One scan and one shuffle of the input: label, category and band go through
    the aggregate together, next to the unpivoted indicators, and the five
    one- and two-way counts are rolled up from that small result.
    """
    dims = [schema.label, schema.category, schema.band_name]
    labelled = df.where(label_of(schema).isNotNull())
    rows = with_numbers(labelled, [schema.number]).select(
        label_of(schema).alias(schema.label),
        F.coalesce(strip(F.col(schema.category)), F.lit("")).alias(schema.category),
        age_band(F.col(schema.number), schema).alias(schema.band_name),
        *[_raw_text(df, name).alias(f"value_{name}") for name in schema.ordinals],
    )
    entries = [
        F.struct(
            F.lit(None).cast("string").alias("indicator"),
            *[F.col(name).alias(f"part{position}") for position, name in enumerate(dims)],
        )
    ]
    nothing = F.lit(None).cast("string")
    for name in schema.ordinals:
        entries.append(
            F.struct(
                F.lit(name).alias("indicator"),
                F.col(f"value_{name}").alias("part0"),
                nothing.alias("part1"),
                nothing.alias("part2"),
            )
        )
    grouped = (
        rows.select(F.inline(F.array(*entries)))
        .where(F.col("part0") != "")
        .groupBy("indicator", "part0", "part1", "part2")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    label, category, band = (F.col(f"part{position}") for position in range(3))

    def key(*parts) -> Column:
        return F.concat_ws("|", *[F.lit(part) if isinstance(part, str) else part for part in parts])

    keys = F.when(
        F.col("indicator").isNull(),
        F.array(
            key(schema.label, label),
            key(schema.category, category),
            key(schema.band_name, band),
            key("cross", f"{schema.label}_{schema.number}", label, band),
            key("cross", f"{schema.label}_{schema.category}", label, category),
        ),
    ).otherwise(F.array(key("indicator", F.col("indicator"), label)))
    return grouped.select(F.explode(keys).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))


def counts_filled(
    df: DataFrame, value: Column, domain: Sequence[str], name: str, always: Sequence[str] | None = None
) -> DataFrame:
    """(name, n) with a zero for declared values nothing falls into.

    Values of `domain` outside `always` appear only if something falls into
    them. The domain is declared, so each value is one counter of a single
    global aggregate and no join is needed.
    """
    always = domain if always is None else always
    totals = df.select(value.alias("value")).agg(
        *[F.count_if(F.col("value") == entry).alias(f"n{at}") for at, entry in enumerate(domain)]
    )
    rows = [
        F.struct(F.lit(entry).alias(name), F.col(f"n{at}").alias("n"), F.lit(entry in always).alias("always"))
        for at, entry in enumerate(domain)
    ]
    return (
        totals.select(F.inline(F.array(*rows)))
        .where(F.col("always") | (F.col("n") > 0))
        .select(name, "n")
    )


def label_counts_filled(df: DataFrame, schema: CohortSchema) -> DataFrame:
    return counts_filled(df, label_of(schema), schema.labels, schema.label)


def category_counts_filled(df: DataFrame, schema: CohortSchema) -> DataFrame:
    shown = list(schema.codes.values())
    value = decode(F.col(schema.category), schema)
    return counts_filled(with_numbers(df, [schema.category]), value, [*shown, schema.other], schema.category, always=shown)


def band_counts_filled(df: DataFrame, schema: CohortSchema) -> DataFrame:
    value = age_band(F.col(schema.number), schema)
    return counts_filled(
        with_numbers(df, [schema.number]), value, [*schema.band_names, "N/A"], schema.band_name, always=schema.band_names
    )


def share(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """(value, n, ratio) of one column; the total is a scalar over the counts."""
    counted = counts(df, [column])
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(column, "n", F.round(F.col("n") / total, digits).alias("ratio"))


def crosstab(df: DataFrame, rows: str, columns: str, domain: Sequence[str]) -> DataFrame:
    """Wide counts with one column per declared value of `columns`.

    Rows without a row value are left out. The domain is given, so no extra job
    looks for the distinct values.
    """
    counted = df.groupBy(rows).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(columns) == value).alias(value) for value in domain]
    )
    # One condition on key and count: a test of the key alone would be pushed
    # below the projection and compute the key again for every row.
    return counted.where(F.when(F.col(rows).isNotNull(), F.col("_n")) > 0).drop("_n")
