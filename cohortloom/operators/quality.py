"""Audits: per cell, per row, duplicates, label conflicts, verification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import missing, row_key, strip, title, with_numbers, with_signature
from cohortloom.operators.cleaning import rule_violations
from cohortloom.schema import CohortSchema


class QualityError(ValueError):
    """The gate found invalid values."""


def _count_true(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left + right, [c.cast("int") for c in conditions])


def _single_row(frames: Sequence[DataFrame]) -> DataFrame:
    """Put one-row frames side by side: stack them, then keep the filled cells."""
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(F.col(f"`{name}`")).alias(name) for name in stacked.columns])


def stated_label(schema: CohortSchema) -> Column:
    """The label as compared for conflicts: a missing one counts as 'None'."""
    return F.coalesce(title(strip(F.col(schema.label))), F.lit("None"))


def _distinct_ids(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """One row: distinct ids and whether a null is among them.

    On its own, because next to other counters every distinct id would carry all
    of them through the shuffle. It reads the id column only.
    """
    return df.select(F.col(schema.id).alias("id")).agg(
        F.count_distinct("id").alias("distinct_ids"),
        F.coalesce(F.max(F.col("id").isNull().cast("int")), F.lit(0)).alias("null_id"),
    )


def quality_summary(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """The whole audit as one row, from three aggregates.

    Cell and row counters need no shuffle. Ids are counted from their column
    alone. Repeated rows, signatures and label conflicts come from one pass over
    digests, which combines on the map side at both of its steps: a signature
    that fills a third of the table reaches its reducer as one row per task.
    """
    groups = summarize_digests(digests(df, schema))
    return summary_of(schema, counters(df, schema), _distinct_ids(df, schema), groups)


def counters(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """One row of sums over rows and cells; rows of several tables may be added up."""
    checked, broken = rule_violations(df, schema)
    cells = [broken[name] for name in schema.ordinals]
    measured = checked.select(
        broken[schema.number].cast("int").alias("bad_number"),
        broken[schema.category].cast("int").alias("bad_category"),
        broken[schema.label].cast("int").alias("bad_label"),
        _count_true(cells).alias("bad_cells"),
        _count_true([missing(df, name) for name in schema.checked]).alias("blank_cells"),
    )
    clean = F.col("bad_number") + F.col("bad_category") + F.col("bad_label") + F.col("bad_cells") == 0
    return measured.agg(
        F.count(F.lit(1)).alias("row_count_raw"),
        F.count_if(clean).alias("row_count_valid"),
        F.coalesce(F.sum("bad_number"), F.lit(0)).alias(f"invalid_{schema.number}"),
        F.coalesce(F.sum("bad_category"), F.lit(0)).alias(f"invalid_{schema.category}"),
        F.coalesce(F.sum("bad_cells"), F.lit(0)).alias("invalid_risk_scale"),
        F.coalesce(F.sum("bad_label"), F.lit(0)).alias(f"invalid_{schema.label}"),
        F.coalesce(F.sum("blank_cells"), F.lit(0)).alias("missing_cells"),
    )


def digests(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(signature, stated, row_key, n): distinct rows as digests and how often each stands."""
    return (
        with_signature(df, schema.features)
        .select(
            F.unhex("feature_signature").alias("signature"),
            F.xxhash64(stated_label(schema)).alias("stated"),
            row_key(schema.checked).alias("row_key"),
        )
        .groupBy("signature", "stated", "row_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def summarize_digests(rows: DataFrame) -> DataFrame:
    """One row: signatures, distinct rows, conflicts, rows without a signature."""
    signed = F.col("signature").isNotNull()
    return (
        rows.groupBy("signature")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("n_distinct"),
            (F.min("stated") != F.max("stated")).alias("conflicting"),
        )
        .agg(
            F.count("signature").alias("unique_feature_signature"),
            F.coalesce(F.sum("n_distinct"), F.lit(0)).alias("distinct_rows"),
            F.count_if(signed & F.col("conflicting")).alias("signature_label_conflicts"),
            F.coalesce(F.sum(F.when(~signed, F.col("n"))), F.lit(0)).alias("rows_without_signature"),
        )
    )


def summary_of(schema: CohortSchema, rows: DataFrame, ids: DataFrame, groups: DataFrame) -> DataFrame:
    """The audit from its three one-row parts."""
    total = F.col("row_count_raw")
    width = len(schema.checked)
    return _single_row([rows, ids, groups]).select(
        "row_count_raw",
        "row_count_valid",
        (total - F.col("row_count_valid")).alias("row_count_invalid"),
        _percent(F.col("row_count_valid"), total).alias("valid_row_pct"),
        _percent(total * width - F.col("missing_cells"), total * width).alias("field_completeness_pct"),
        F.lit(width).alias("column_count"),
        "missing_cells",
        (total - F.col("distinct_ids") - F.col("null_id")).alias("duplicate_id"),
        (total - F.col("distinct_rows")).alias("duplicate_full_row"),
        "unique_feature_signature",
        (total - F.col("unique_feature_signature")).alias("duplicated_feature_rows"),
        "rows_without_signature",
        "signature_label_conflicts",
        f"invalid_{schema.number}",
        f"invalid_{schema.category}",
        "invalid_risk_scale",
        f"invalid_{schema.label}",
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(0.0)


def signature_groups(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(signature as 32 bytes, n, conflicting), the null signature included.

    Smallest against largest label hash decides a conflict in constant state, so
    one exchange of hash-aggregated rows is enough.
    """
    return (
        with_signature(df, schema.features)
        .select(
            F.unhex("feature_signature").alias("signature"),
            F.xxhash64(stated_label(schema)).alias("stated"),
        )
        .groupBy("signature")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.min("stated") != F.max("stated")).alias("conflicting"),
        )
    )


def label_conflicts(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(feature_signature, n_labels) of signatures that carry more than one label.

    Shuffles 32-byte digests and 64-bit label hashes instead of texts.
    """
    return (
        with_signature(df, schema.features)
        .select(F.unhex("feature_signature").alias("signature"), F.xxhash64(stated_label(schema)).alias("stated"))
        .groupBy("signature")
        .agg(F.count_distinct("stated").alias("n_labels"))
        # One condition on both columns: a test of the signature alone would be
        # pushed below the hash and compute it twice.
        .where(F.when(F.col("signature").isNotNull(), F.col("n_labels")) > 1)
        .select(F.lower(F.hex("signature")).alias("feature_signature"), "n_labels")
    )


def checks_table(summary: DataFrame, schema: CohortSchema) -> DataFrame:
    """(name, count, passed): the seven checks of a quality summary."""
    named = {
        f"invalid_{schema.number}": f"invalid_{schema.number}",
        f"invalid_{schema.category}": f"invalid_{schema.category}",
        "invalid_risk_scale": "invalid_risk_scale",
        f"invalid_{schema.label}": f"invalid_{schema.label}",
        "duplicate_id": f"duplicate_{schema.id}",
        "duplicate_full_row": "duplicate_full_row",
        "signature_label_conflicts": "signature_label_conflicts",
    }
    entries = [
        F.struct(F.lit(shown).alias("name"), F.col(column).alias("count"), (F.col(column) == 0).alias("passed"))
        for column, shown in named.items()
    ]
    return summary.select(F.inline(F.array(*entries)))


def quality_report(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(check_name, value, meaning) after cleaning, eight rows.

    Scale violations are counted per cell.
    """
    df = with_numbers(df, schema.features)
    empty = [F.col(name).isNull() for name in schema.features]
    empty += [F.col(schema.id).isNull(), F.col(schema.label).isNull()]
    checked, broken = rule_violations(df, schema)
    totals = checked.select(
        *[broken[name].cast("int").alias(f"bad_{name}") for name in (schema.category, schema.number, schema.label)],
        _count_true([broken[name] for name in schema.ordinals]).alias("bad_cells"),
        _count_true(empty).alias("missing"),
    ).agg(
        F.sum(f"bad_{schema.category}").alias("category"),
        F.sum(f"bad_{schema.number}").alias("number"),
        F.sum("bad_cells").alias("cells"),
        F.sum(f"bad_{schema.label}").alias("label"),
        F.count(F.lit(1)).alias("total"),
        F.sum("missing").alias("missing"),
    )
    totals = _single_row([totals, _distinct_ids(df, schema)])
    low, high = schema.ordinal_range
    floor, ceiling = schema.number_range
    checks = [
        (f"invalid_{schema.category}", F.col("category"), f"Rows whose {schema.category} is not one of {list(schema.codes)}."),
        (f"invalid_{schema.number}", F.col("number"), f"Rows whose {schema.number} is outside [{floor}, {ceiling}]."),
        ("invalid_risk_scale", F.col("cells"), f"Cells of {len(schema.ordinals)} indicators outside [{low}, {high}]."),
        (f"invalid_{schema.label}", F.col("label"), f"Rows whose {schema.label} is not one of {list(schema.labels)}."),
        ("row_count", F.col("total"), "Rows kept by cleaning."),
        ("column_count_clean", F.lit(len(df.columns)), "Columns after renaming."),
        ("missing_total", F.col("missing"), "Empty cells after coercion."),
        (f"duplicated_{schema.id}", F.col("total") - F.col("distinct_ids") - F.col("null_id"), f"Rows repeating an earlier {schema.id}."),
    ]
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(value.cast("bigint"), F.lit(0)).alias("value"),
            F.lit(meaning).alias("meaning"),
        )
        for name, value, meaning in checks
    ]
    return totals.select(F.inline(F.array(*entries)))


def invalid_checks(report: DataFrame) -> DataFrame:
    """The failed `invalid_*` checks of a quality report."""
    return report.where(F.col("check_name").startswith("invalid_") & (F.col("value") > 0))


def gate(report: DataFrame) -> DataFrame:
    """Return the report, or raise if any `invalid_*` check counted something.

    Collects at most the eight rows of the report.
    """
    failed = invalid_checks(report).collect()
    if failed:
        raise QualityError(", ".join(f"{row.check_name}={row.value}" for row in failed))
    return report


def violation_counts(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """(check_name, n) per row: a row with several bad indicators counts once.

    Checks nothing violates are absent; `rows_total` is there for any input row.
    """
    checked, broken = rule_violations(df, schema)
    any_cell = reduce(lambda left, right: left | right, [broken[name] for name in schema.ordinals])
    checks = {
        "rows_total": F.lit(True),
        f"invalid_{schema.category}": broken[schema.category],
        f"invalid_{schema.number}": broken[schema.number],
        f"invalid_{schema.label}": broken[schema.label],
        "invalid_risk_scale": any_cell,
    }
    totals = checked.agg(*[F.count_if(broken_).alias(name) for name, broken_ in checks.items()])
    entries = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias("n")) for name in checks]
    return totals.select(F.inline(F.array(*entries))).where(F.col("n") > 0)


def profile(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """One row: rows, distinct signatures, duplicated rows, conflicts.

    Counted over all rows: the group without a signature is not distinct.
    """
    return (
        signature_groups(df, schema)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count("signature").alias("unique_signatures"),
            F.count_if(F.col("signature").isNotNull() & F.col("conflicting")).alias(
                "signature_label_conflicts"
            ),
        )
        .select(
            "row_count",
            "unique_signatures",
            (F.col("row_count") - F.col("unique_signatures")).alias("duplicated_feature_rows"),
            "signature_label_conflicts",
        )
    )


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: total rows, distinct keys (null is one of them), unique or not."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("distinct_keys"),
    ).select("total", "distinct_keys", (F.col("total") == F.col("distinct_keys")).alias("is_unique"))


def duplicate_excess(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier one. Shuffles 32-byte digests."""
    return (
        df.select(row_key(columns).alias("row_key"))
        .agg((F.count(F.lit(1)) - F.count_distinct("row_key")).alias("duplicate_rows"))
    )


def verify(
    df: DataFrame,
    schema: CohortSchema,
    expected: DataFrame,
    snapshots: DataFrame | None = None,
    raw_names: Sequence[str] = (),
) -> DataFrame:
    """(check_name, ok, measured, expected) of a stored cohort table.

    `expected` holds (check_name, expected BIGINT) for `total`,
    `<label>:<value>` and `<category>:<code>`. What is measured on the table takes
    one aggregate and the distinct ids; the rest reads its column names only. A check
    whose column is missing, and an expectation that nothing measures, fail.
    """
    present = set(df.columns)
    counters = {"total": F.count(F.lit(1))}
    if schema.label in present:
        for label in schema.labels:
            counters[f"{schema.label}:{label}"] = F.count_if(F.col(schema.label) == label)
    if schema.category in present:
        for code in schema.codes:
            counters[f"{schema.category}:{code}"] = F.count_if(F.col(schema.category) == code)
    counters["signature"] = (
        F.count_if(F.length("feature_signature") == 64)
        if "feature_signature" in present
        else F.lit(0).cast("bigint")
    )
    parts = [df.agg(*[value.alias(name) for name, value in counters.items()])]
    if schema.id in present:
        parts.append(_distinct_ids(df, schema).select((F.col("distinct_ids") + F.col("null_id")).alias("unique_id")))
    measured = _single_row(parts) if len(parts) > 1 else parts[0]
    # Without its own expectation, a counter has to reach the number of rows.
    whole = {"unique_id", "signature"}
    absent = [name for name in (schema.id, *schema.features, schema.label) if name not in present]
    raw = [name for name in raw_names if name in present]

    def entry(name: str, value: Column, target: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            value.cast("bigint").alias("measured"),
            target.cast("bigint").alias("target"),
        )

    none = F.lit(None)
    entries = [
        entry(name, F.col(f"`{name}`"), F.col("total") if name in whole else none) for name in measured.columns
    ]
    entries.append(entry("missing_columns", F.lit(len(absent)), F.lit(0)))
    entries.append(entry("raw_case_columns", F.lit(len(raw)), F.lit(0)))
    checks = measured.select(F.inline(F.array(*entries)))
    # Both sides hold one row per check; an expectation that nothing measures fails.
    result = checks.join(expected, "check_name", "full_outer").select(
        "check_name",
        "measured",
        F.coalesce("target", F.col("expected").cast("bigint")).alias("expected"),
    )
    result = result.select(
        "check_name", F.coalesce(F.col("measured") == F.col("expected"), F.lit(False)).alias("ok"), "measured", "expected"
    )
    if snapshots is None:
        return result
    at_least_one = snapshots.agg(F.count(F.lit(1)).alias("measured")).select(
        F.lit("snapshots").alias("check_name"),
        (F.col("measured") >= 1).alias("ok"),
        "measured",
        F.lit(1).cast("bigint").alias("expected"),
    )
    return result.unionByName(at_least_one)
