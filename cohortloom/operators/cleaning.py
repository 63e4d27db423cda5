"""Source contract, cleaning, derived columns and row validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import (
    age_band,
    clean_label,
    encode_label,
    inside,
    is_blank,
    match_label,
    missing,
    parsed_once,
    strip,
    with_numbers,
    with_signature,
    with_whole,
)
from cohortloom.schema import CohortSchema


class ContractError(ValueError):
    """The source does not have exactly the expected columns."""


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Fail on missing or unexpected columns, else put them in expected order."""
    absent = [name for name in expected if name not in df.columns]
    unexpected = [name for name in df.columns if name not in expected]
    if absent or unexpected:
        raise ContractError(f"missing columns: {absent}; unexpected columns: {unexpected}")
    return df.select(*expected)


def contract_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(kind, column, n_values) over expected and actual columns.

    Kind is matched, missing or unexpected; n_values counts non-null values.
    One aggregate over the table, however many columns there are.
    """
    filled = df.agg(*[F.count(F.col(name)).alias(name) for name in df.columns])
    entries = [
        F.struct(
            F.lit("matched" if name in df.columns else "missing").alias("kind"),
            F.lit(name).alias("column"),
            (F.col(name) if name in df.columns else F.lit(0).cast("bigint")).alias("n_values"),
        )
        for name in expected
    ]
    entries += [
        F.struct(F.lit("unexpected").alias("kind"), F.lit(name).alias("column"), F.col(name).alias("n_values"))
        for name in df.columns
        if name not in expected
    ]
    return filled.select(F.inline(F.array(*entries)))


def canonicalize(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def clean_text(df: DataFrame, schema: CohortSchema) -> DataFrame:
    """Strip the id; bring the label to its declared spelling. Keeps every row."""
    return df.withColumns(
        {
            schema.id: strip(F.col(schema.id)),
            schema.label: clean_label(F.col(schema.label), schema.labels),
        }
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return with_numbers(df, columns)


def coerce_integer(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return with_whole(df, columns).withColumns({name: F.col(name).try_cast("int") for name in columns})


def timestamp(moment: datetime | Column) -> Column:
    """Zone-free time given by the caller: the clock is always injected."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def enrich(df: DataFrame, schema: CohortSchema, version: str, now: datetime) -> DataFrame:
    """Typed row plus band, label code, signature, version and update time."""
    typed = coerce_integer(clean_text(df, schema), schema.features)
    return with_signature(typed, schema.features).select(
        schema.id,
        *schema.features,
        schema.label,
        age_band(F.col(schema.number), schema).alias(schema.band_name),
        encode_label(F.col(schema.label), schema).alias(f"{schema.label}_encoded"),
        "feature_signature",
        F.lit(version).alias("dataset_version"),
        timestamp(now).alias("updated_at"),
    )


def published_frames(df: DataFrame, schema: CohortSchema) -> tuple[DataFrame, DataFrame]:
    """(counting frame with the band, model frame with the label code)."""
    cleaned = coerce_numeric(clean_text(df, schema), schema.features)
    common = [schema.id, *schema.features]
    counting = cleaned.select(
        *common,
        age_band(F.col(schema.number), schema, "right_closed").alias(schema.band_name),
        schema.label,
    )
    model = cleaned.select(
        *common,
        encode_label(F.col(schema.label), schema, unknown=None).alias(f"{schema.label}_encoded"),
        schema.label,
    )
    return counting, model


def rule_violations(df: DataFrame, schema: CohortSchema) -> tuple[DataFrame, dict[str, Column]]:
    """(frame, column name -> true where that cell breaks its rule). Missing breaks it.

    The rules hold on the returned frame, which has the features' numbers beside them:
    they can be filtered and counted on in any number without parsing a cell again.
    """
    rows, numbers = parsed_once(df, schema.features)
    return rows, _rules(rows, schema, numbers)


def _rules(df: DataFrame, schema: CohortSchema, numbers: Mapping[str, Column]) -> dict[str, Column]:
    rules = {
        schema.number: ~inside(numbers[schema.number], *schema.number_range),
        schema.category: ~F.coalesce(numbers[schema.category].isin(*schema.codes), F.lit(False)),
    }
    for name in schema.ordinals:
        rules[name] = ~inside(numbers[name], *schema.ordinal_range)
    if schema.label in df.columns:
        rules[schema.label] = match_label(F.col(schema.label), schema.labels).isNull()
    return rules


def validate(
    df: DataFrame, schema: CohortSchema, scoring: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with an `errors` array). Together all rows.

    `scoring` checks a prediction request instead of a stored row: features must
    be whole numbers, the id may be missing and columns outside the request
    (the label among them) are refused.
    """
    if scoring:
        extra = [name for name in df.columns if name not in (schema.id, *schema.features)]
        if extra:
            raise ContractError(f"unexpected columns: {extra}")
    required = schema.features if scoring else (schema.id, *schema.features, schema.label)
    absent = [name for name in required if name not in df.columns]
    if absent:
        raise ContractError(f"missing columns: {absent}")
    if not scoring and not isinstance(df.schema[schema.id].dataType, T.StringType):
        raise ContractError(f"{schema.id} must be text")
    rows, numbers = parsed_once(df, schema.features)
    rules = _rules(rows, schema, numbers)
    if scoring:
        # A scored feature has to be whole, not only inside its range.
        rules = {name: broken | (numbers[name] % 1 != 0) for name, broken in rules.items()}
    else:
        rules = {schema.id: is_blank(F.col(schema.id)), **rules}
    sound = ~reduce(or_, rules.values())
    errors = F.array_compact(
        F.array(
            *[
                F.when(missing(df, name), f"missing:{name}").when(broken, f"invalid:{name}")
                for name, broken in rules.items()
            ]
        )
    )
    return rows.where(sound).select(*df.columns), rows.where(~sound).select(*df.columns, errors.alias("errors"))
