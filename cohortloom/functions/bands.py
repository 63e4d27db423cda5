"""Bands, buckets, codes: small chains of `when` generated from the schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.schema import CohortSchema


def age_band(value: Column, schema: CohortSchema, mode: str = "closed_bins") -> Column:
    """Name of the band a number falls into.

    `closed_bins`: whole-number bands with both ends included. What lies between
    or outside them takes the last band; a missing number is 'N/A'.
    `right_closed`: bands meet at their upper ends; outside the declared range
    and for a missing number the result is null.
    """
    if mode == "closed_bins":
        band = F.when(value.isNull(), "N/A")
        for low, high, name in schema.bands:
            band = band.when(value.between(low, high), name)
        return band.otherwise(schema.bands[-1][2])
    if mode == "right_closed":
        floor, ceiling = schema.number_range
        band = F.when((value < floor) | (value > ceiling), F.lit(None).cast("string"))
        for _, high, name in schema.bands[:-1]:
            band = band.when(value <= high, name)
        return band.when(value.isNotNull(), schema.bands[-1][2])
    raise ValueError(f"unknown band mode: {mode}")


def bucket(value: Column, schema: CohortSchema) -> Column:
    """Ordinal bucket. Out-of-scale numbers still fall into the outer buckets."""
    named = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in schema.buckets[:-1]:
        named = named.when(value <= upper, name)
    return named.otherwise(schema.buckets[-1][1])


def bucket_tests(value: Column, schema: CohortSchema) -> dict[str, Column]:
    """Bucket name -> test for that bucket, as plain comparisons to count over."""
    tests, below = {}, None
    for upper, name in schema.buckets:
        parts = [part for part in (below, None if upper is None else value <= upper) if part is not None]
        tests[name] = parts[0] if len(parts) == 1 else parts[0] & parts[1]
        below = None if upper is None else value > upper
    return tests


def decode(value: Column, schema: CohortSchema) -> Column:
    """Category code to the name it is shown under."""
    named = None
    for code, name in schema.codes.items():
        named = F.when(value == code, name) if named is None else named.when(value == code, name)
    return named.otherwise(schema.other)


def encode_label(label: Column, schema: CohortSchema, unknown: int | None = -1) -> Column:
    """Position of the label in the declared order."""
    code = None
    for position, name in enumerate(schema.labels):
        code = F.when(label == name, position) if code is None else code.when(label == name, position)
    return code.otherwise(F.lit(unknown).cast("int"))
