"""Allow-listed filters, sorting, paging and lookup.

Filters are `Column` expressions on bare columns, so they reach the Parquet
scan. Callers never pass SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.schema import CohortSchema

# The filter operators of the contract.
OPERATORS = ("eq", "gte", "lte", "between")


def _whole(name: str, value) -> int:
    if value is None:
        raise ValueError(f"{name} is required by this operator")
    return int(value)


def _condition(column: str, operator: str, value, min_value, max_value) -> Column:
    col = F.col(column)
    if operator == "eq":
        return col == _whole("value", value)
    if operator == "gte":
        return col >= _whole("value", value)
    if operator == "lte":
        return col <= _whole("value", value)
    bounds = sorted((_whole("min_value", min_value), _whole("max_value", max_value)))
    return col.between(*bounds)


def where(
    df: DataFrame,
    schema: CohortSchema,
    *,
    id: str | None = None,
    label: str | None = None,
    category: int | None = None,
    number_min: int | None = None,
    number_max: int | None = None,
    feature: str | None = None,
    operator: str | None = None,
    value: int | None = None,
    min_value: int | None = None,
    max_value: int | None = None,
) -> DataFrame:
    """Rows matching all given filters. Anything off the allow-list raises.

    A reversed `between` is put in order.
    """
    if id:
        df = df.where(F.col(schema.id) == str(id))
    if label:
        declared = {name.lower(): name for name in schema.labels}
        if str(label).lower() not in declared:
            raise ValueError(f"unknown {schema.label}: {label}")
        df = df.where(F.col(schema.label) == declared[str(label).lower()])
    if category is not None:
        if int(category) not in schema.codes:
            raise ValueError(f"{schema.category} must be one of {list(schema.codes)}")
        df = df.where(F.col(schema.category) == int(category))
    if number_min is not None:
        df = df.where(F.col(schema.number) >= int(number_min))
    if number_max is not None:
        df = df.where(F.col(schema.number) <= int(number_max))
    if feature:
        if feature not in schema.ordinals:
            raise ValueError(f"not a filterable column: {feature}")
        if operator not in OPERATORS:
            raise ValueError(f"unknown operator: {operator}")
        df = df.where(_condition(feature, operator, value, min_value, max_value))
    return df


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(F.col(key) == str(value))


def sort_keys(schema: CohortSchema, by: str | None = None, direction: str = "asc") -> list[tuple[str, bool]]:
    """Allow-listed sort as (column, descending), with the id as tie-break."""
    descending = bool(by) and str(direction).lower() == "desc"
    if not by or by == schema.id:
        return [(schema.id, descending)]
    if by not in (schema.number, schema.label, schema.category, *schema.ordinals):
        raise ValueError(f"not a sortable column: {by}")
    return [(by, descending), (schema.id, False)]


def ordered_by(keys: Sequence[tuple[str, bool]]) -> list[Column]:
    """Nulls come first when ascending and last when descending."""
    return [F.desc_nulls_last(name) if descending else F.asc_nulls_first(name) for name, descending in keys]


def sort_columns(schema: CohortSchema, by: str | None = None, direction: str = "asc") -> list[Column]:
    return ordered_by(sort_keys(schema, by, direction))


def sort(df: DataFrame, schema: CohortSchema, by: str | None = None, direction: str = "asc") -> DataFrame:
    return df.orderBy(*sort_columns(schema, by, direction))


def page_bounds(page: int, size: int) -> tuple[int, int]:
    return max(1, int(page)), max(1, int(size))


def page_rows(df: DataFrame, order: list[Column], page: int = 1, size: int = 20) -> DataFrame:
    """One page by its number: a top-k of all pages up to it. To walk on, use `page_after`."""
    page, size = page_bounds(page, size)
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def _behind(name: str, descending: bool, value) -> Column:
    """Rows that come after a value in the order of one column."""
    col = F.col(name)
    if value is None:
        return F.lit(False) if descending else col.isNotNull()
    return ((col < F.lit(value)) | col.isNull()) if descending else col > F.lit(value)


def page_after(
    df: DataFrame, keys: Sequence[tuple[str, bool]], last: Mapping | None, size: int = 20
) -> DataFrame:
    """The page that follows the row `last`, at the cost of a first page.

    `keys` is a sort as from `sort_keys`, whose last column identifies a row; `last`
    holds that row's values, nulls included. The bound is a filter on bare columns,
    so it reaches the scan. A repeated last row is refused, because rows equal to it
    in all keys cannot be told apart.
    """
    _, size = page_bounds(1, size)
    if last is None:
        return df.orderBy(*ordered_by(keys)).limit(size)
    same = F.lit(True)
    after = F.lit(False)
    for name, descending in keys:
        after = after | (same & _behind(name, descending, last[name]))
        same = same & F.col(name).eqNullSafe(F.lit(last[name]))
    if df.where(same).limit(2).count() > 1:
        raise ValueError(f"rows repeat in {[name for name, _ in keys]}: {[last[name] for name, _ in keys]}")
    return df.where(after).orderBy(*ordered_by(keys)).limit(size)


def page_meta(df: DataFrame, page: int = 1, size: int = 20) -> DataFrame:
    """One row: page, page_size, total, total_pages (at least 1)."""
    page, size = page_bounds(page, size)
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        F.lit(page).alias("page"),
        F.lit(size).alias("page_size"),
        "total",
        F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint").alias("total_pages"),
    )


def export_rows(df: DataFrame, schema: CohortSchema, limit: int | None = None, **filters) -> DataFrame:
    """Every row that matches the filters; with a `limit`, that many in id order."""
    columns = [name for name in (schema.id, *schema.features, schema.label) if name in df.columns]
    matched = where(df, schema, **filters).select(*columns)
    if limit is None:
        return matched
    return matched.orderBy(F.asc_nulls_first(schema.id), *columns[1:]).limit(int(limit))


def history(
    log: DataFrame,
    *,
    subject: str | None = None,
    predicted: str | None = None,
    labels: Sequence[str] = (),
) -> DataFrame:
    """Prediction log rows of one subject and/or one predicted label.

    With the declared `labels`, the label is found whatever its case.
    """
    if subject:
        log = log.where(F.col("subject_id") == str(subject))
    if predicted:
        declared = {name.lower(): name for name in labels}
        log = log.where(F.col("predicted_label") == declared.get(str(predicted).lower(), str(predicted)))
    return log


def newest_first() -> list[Column]:
    return [F.desc_nulls_last("created_at"), F.asc("prediction_id")]


def latest(df: DataFrame, time_column: str) -> DataFrame:
    """All rows of the newest time: one snapshot, or one log entry.

    Without any time, all rows. The newest time is a combinable maximum and one row
    wide; nothing is sorted.
    """
    newest = df.agg(F.max(time_column).alias("_newest"))
    return df.join(newest, F.col(time_column).eqNullSafe(F.col("_newest"))).select(*df.columns)
