"""Class means, bucket counts and the ranking of indicators built on them.

One wide aggregate keyed by label does all the work: per indicator a sum and one
counter per bucket. It combines on the map side to one row per label and task,
so neither row count nor class skew reaches the shuffle. Everything after it
works on labels x indicators rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import bucket_tests, with_numbers, with_whole
from cohortloom.operators.distribution import counts, label_of
from cohortloom.schema import CohortSchema

DIGITS = 2


def _values(df: DataFrame, schema: CohortSchema, truncate: bool, *others: Column) -> DataFrame:
    """The given columns and every indicator as `v<position>`."""
    read = with_whole if truncate else with_numbers
    named = [F.col(f"_{name}").alias(f"v{at}") for at, name in enumerate(schema.ordinals)]
    return read(df, schema.ordinals, "_").select(*others, *named)


def _labelled(df: DataFrame, schema: CohortSchema, truncate: bool) -> DataFrame:
    labelled = df.where(label_of(schema).isNotNull())
    return _values(labelled, schema, truncate, label_of(schema).alias("level"))


def _stack(wide: DataFrame, schema: CohortSchema, keep: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Columns `<measure><position>` to one row per indicator."""
    entries = [
        F.struct(
            F.lit(at).alias("position"),
            F.lit(name).alias("indicator"),
            *[F.col(f"{measure}{at}").alias(measure) for measure in measures],
        )
        for at, name in enumerate(schema.ordinals)
    ]
    return wide.select(*keep, F.inline(F.array(*entries)))


def indicator_table(df: DataFrame, schema: CohortSchema, truncate: bool = False) -> DataFrame:
    """(level, position, indicator, total, n, <bucket>...) per label and indicator.

    Missing values are skipped. `n` is the sum of the buckets, because every
    number has a bucket.
    """
    rows = _labelled(df, schema, truncate)
    measures = []
    for at in range(len(schema.ordinals)):
        value = F.col(f"v{at}")
        measures.append(F.sum(value).alias(f"total{at}"))
        measures += [F.count_if(test).alias(f"{name}{at}") for name, test in bucket_tests(value, schema).items()]
    stacked = _stack(
        rows.groupBy("level").agg(*measures), schema, ["level"], ["total", *schema.bucket_names]
    )
    n = sum((F.col(name) for name in schema.bucket_names[1:]), F.col(schema.bucket_names[0]))
    return stacked.withColumn("n", n)


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, F.round(total / n, DIGITS)).otherwise(0.0)


def means_by_label(
    df: DataFrame, schema: CohortSchema, missing: str = "skip", truncate: bool = False
) -> DataFrame:
    """(indicator, level, mean, n) of every indicator.

    `missing="skip"` divides by the values present and leaves out indicators
    without any; `missing="zero"` counts a missing value as 0, divides by all
    rows of the label and lists every declared label.
    """
    if missing == "skip":
        rows = _labelled(df, schema, truncate)
        measures = []
        for at in range(len(schema.ordinals)):
            measures += [F.sum(f"v{at}").alias(f"total{at}"), F.count(f"v{at}").alias(f"n{at}")]
        long = _stack(rows.groupBy("level").agg(*measures), schema, ["level"], ["total", "n"])
        return long.where("n > 0").select(
            "indicator", "level", _mean(F.col("total"), F.col("n")).alias("mean"), "n"
        )
    if missing != "zero":
        raise ValueError(f"unknown rule for missing values: {missing}")
    rows = _labelled(df, schema, truncate)
    sums = [F.coalesce(F.sum(f"v{at}"), F.lit(0)).alias(f"total{at}") for at in range(len(schema.ordinals))]
    per_label = rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"), *sums)
    found = _stack(per_label, schema, ["level", "n"], ["total"]).select("indicator", "level", "total", "n")
    zeros = [
        F.struct(F.lit(name).alias("indicator"), F.lit(label).alias("level"))
        for name in schema.ordinals
        for label in schema.labels
    ]
    declared = df.sparkSession.range(1, numPartitions=1).select(
        F.inline(F.array(*zeros)), F.lit(0).alias("total"), F.lit(0).alias("n")
    )
    return (
        found.unionByName(declared)
        .groupBy("indicator", "level")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select("indicator", "level", _mean(F.col("total"), F.col("n")).alias("mean"), "n")
    )


def means_overall(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(indicator, mean, n) over all rows, undeclared labels included; missing is 0."""
    sums = [F.coalesce(F.sum(f"v{at}"), F.lit(0)).alias(f"total{at}") for at in range(len(schema.ordinals))]
    totals = _values(df, schema, False).agg(F.count(F.lit(1)).alias("n"), *sums)
    return _stack(totals, schema, ["n"], ["total"]).select(
        "indicator", _mean(F.col("total"), F.col("n")).alias("mean"), "n"
    )


def chart_means(df: DataFrame, schema: CohortSchema) -> DataFrame:
    return means_by_label(df, schema, missing="zero").where(F.col("indicator").isin(*schema.chart))


def _buckets(table: DataFrame, schema: CohortSchema) -> DataFrame:
    return table.select(
        "indicator",
        "level",
        F.inline(
            F.array(*[F.struct(F.lit(name).alias("bucket"), F.col(name).alias("n")) for name in schema.bucket_names])
        ),
    )


def bucket_crosstab(
    df: DataFrame, schema: CohortSchema, truncate: bool = False, keep_zero: bool = False
) -> DataFrame:
    """(indicator, bucket, level, n). Empty cells are absent unless asked for."""
    cells = _buckets(indicator_table(df, schema, truncate), schema)
    return cells.select("indicator", "bucket", "level", "n").where(F.lit(keep_zero) | (F.col("n") > 0))


def rows_by_label(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(level, n) over rows with a declared label."""
    return counts(df.select(label_of(schema).alias("level")).where(F.col("level").isNotNull()), ["level"])


def correlation_table(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(kind, indicator, bucket, level, mean, n) with kinds MEAN, XTAB and N.

    One scan: the row count per label rides along the indicator aggregate. The
    values are whole numbers, fractions cut off.
    """
    rows = _labelled(df, schema, truncate=True)
    measures = [F.count(F.lit(1)).alias("rows")]
    for at in range(len(schema.ordinals)):
        value = F.col(f"v{at}")
        measures.append(F.sum(value).alias(f"total{at}"))
        measures += [F.count_if(test).alias(f"{name}{at}") for name, test in bucket_tests(value, schema).items()]
    wide = rows.groupBy("level").agg(*measures)
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def entry(kind: str, indicator: Column, name: Column, mean: Column, n: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            indicator.alias("indicator"),
            name.alias("bucket"),
            mean.alias("mean"),
            n.alias("n"),
        )

    entries = [entry("N", text, text, number, F.col("rows"))]
    for at, indicator in enumerate(schema.ordinals):
        cells = {name: F.col(f"{name}{at}") for name in schema.bucket_names}
        n = sum(list(cells.values())[1:], cells[schema.bucket_names[0]])
        mean = F.round(F.col(f"total{at}") / F.nullif(n, F.lit(0)), DIGITS)
        entries.append(entry("MEAN", F.lit(indicator), text, mean, n))
        entries += [entry("XTAB", F.lit(indicator), F.lit(name), number, cell) for name, cell in cells.items()]
    return (
        wide.select("level", F.inline(F.array(*entries)))
        .where("n > 0")
        .select("kind", "indicator", "bucket", "level", "mean", "n")
    )


def risk_factors(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """One row per indicator: class means, impact, share of the worst class in
    the top bucket, bucket counts per class, and the rank by impact.

    Impact is the difference of the rounded means of the last and the first
    declared label. Ties keep the declared order of the indicators.
    """
    table = indicator_table(df, schema)
    top = schema.bucket_names[-1]

    def of(label: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("level") == label, F.col(column))), F.lit(0))

    measures = []
    for label in schema.labels:
        measures.append(_mean(of(label, "total"), of(label, "n")).alias(f"mean_{label.lower()}"))
        measures += [of(label, name).alias(f"{name}_{label.lower()}") for name in schema.bucket_names]
    per_indicator = table.groupBy("position", "indicator").agg(*measures)
    high, low = schema.highest.lower(), schema.lowest.lower()
    in_top = sum(
        (F.col(f"{top}_{label.lower()}") for label in schema.labels[1:]),
        F.col(f"{top}_{low}"),
    )
    impact = F.round(F.col(f"mean_{high}") - F.col(f"mean_{low}"), DIGITS)
    pct = F.when(in_top > 0, F.round(F.col(f"{top}_{high}") / in_top * 100, 1)).otherwise(0.0)
    # At most one row per declared indicator reaches this window.
    order = Window.orderBy(F.desc("impact"), "position")
    return (
        per_indicator.withColumns({"impact": impact, "pct_high": pct})
        .withColumn("rank", F.row_number().over(order))
        .select(
            "rank",
            "indicator",
            *[f"mean_{label.lower()}" for label in schema.labels],
            "impact",
            "pct_high",
            *[f"{name}_{label.lower()}" for name in schema.bucket_names for label in schema.labels],
        )
    )


def impact(df: DataFrame, schema: CohortSchema) -> DataFrame:
    return risk_factors(df, schema).select("indicator", "impact")


def pct_in_bucket(df: DataFrame, schema: CohortSchema) -> DataFrame:
    return risk_factors(df, schema).select("indicator", "pct_high")


def rank_factors(df: DataFrame, schema: CohortSchema) -> DataFrame:
    return risk_factors(df, schema).select("rank", "indicator", "impact")


def top_factors(df: DataFrame, schema: CohortSchema, k: int = 5) -> DataFrame:
    return rank_factors(df, schema).orderBy("rank").limit(k)


def risk_export(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """The ranking as exported: rank, indicator, class means, impact, share."""
    return risk_factors(df, schema).select(
        "rank",
        "indicator",
        *[f"mean_{label.lower()}" for label in schema.labels],
        "impact",
        F.col("pct_high").alias("pct_high_when_high_value"),
    )


def factor_documents(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """The ranking in nested form: one row per indicator with maps inside."""
    flat = risk_factors(df, schema)

    def by_label(prefix: str) -> Column:
        return F.create_map(
            *[part for label in schema.labels for part in (F.lit(label), F.col(f"{prefix}_{label.lower()}"))]
        )

    crosstab = F.create_map(
        *[part for name in schema.bucket_names for part in (F.lit(name), by_label(name))]
    )
    return flat.select(
        "rank",
        "indicator",
        by_label("mean").alias("mean_by_level"),
        "impact",
        F.col("pct_high").alias("pct_high_when_high_value"),
        crosstab.alias("crosstab"),
    )
