"""Content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numbers import with_whole


def signature(columns: Sequence[str]) -> Column:
    """SHA-256 of the ordered whole-number columns joined by '|'.

    `concat` (not `concat_ws`) makes the result null as soon as one feature is
    missing, so two rows that miss different features can never collide.
    """
    parts = []
    for name in columns:
        parts += [F.lit("|"), F.col(name).cast("string")]
    return F.sha2(F.concat(*parts[1:]), 256)


def with_signature(df: DataFrame, features: Sequence[str], name: str = "feature_signature") -> DataFrame:
    """Add the signature of the features, whatever type they are stored in."""
    whole = [f"_whole_{feature}" for feature in features]
    return with_whole(df, features, "_whole_").withColumn(name, signature(whole)).drop(*whole)


def length_prefixed(columns: Sequence[str]) -> Column:
    """The stored values as one text, nulls told apart from every text.

    Each value carries its length, so no two different rows join to one text.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def row_key(columns: Sequence[str]) -> Column:
    """32-byte digest of the stored values."""
    return F.unhex(F.sha2(length_prefixed(columns), 256))


def order_hash(key: Column, seed: int) -> Column:
    """Position of a group in the seeded order, as a 64-digit hex text."""
    return F.sha2(F.concat(key, F.lit(str(seed))), 256)
