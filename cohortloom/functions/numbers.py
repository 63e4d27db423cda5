"""Lenient numbers: whatever does not parse is null, and nothing raises.

These work on frames, not on columns: each step is a projection of its own, so a
cell is parsed once however often its number is used above. A column that is
already integral passes through untouched, so sums over it stay exact and no
parsing is paid for. NaN and the infinities count as missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.text import WHITESPACE, is_blank

# Spark's cast also takes '7d', '7f' and hexadecimal; a letter it does not know
# in their place makes it refuse them.
_REFUSED = "dDfFxX"
# The cast trims plain spaces and control characters by itself; the other white
# space is turned into spaces in the same pass.
_MATCHING = _REFUSED + WHITESPACE
_REPLACEMENT = "?" * len(_REFUSED) + " " * len(WHITESPACE)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


def missing(df: DataFrame, name: str) -> Column:
    """Null, or blank where the column is text."""
    return is_blank(F.col(name)) if is_text(df, name) else F.col(name).isNull()


def parse(df: DataFrame, name: str) -> Column:
    """The cell as a number, NaN and the infinities still in; names the cell once."""
    if is_text(df, name):
        return F.translate(F.col(name), _MATCHING, _REPLACEMENT).try_cast("double")
    return F.col(name) if is_whole(df, name) else F.col(name).cast("double")


def parsed_once(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """(frame with the numbers beside its columns, column name -> its number).

    For columns on which several rules build, or a filter and a projection. A plain
    projection would be merged into everything above it and parse a cell as often as
    its number is named. These numbers come out of a generator over one struct a row,
    into which the optimizer moves nothing and which it repeats nowhere.
    """
    doubtful = [name for name in columns if not is_whole(df, name)]
    numbers = {name: F.col(name) for name in columns}
    if not doubtful:
        return df, numbers
    aliases = {name: f"_number_{name}" for name in doubtful}
    cells = F.struct(*[parse(df, name).alias(alias) for name, alias in aliases.items()])
    return df.select("*", F.inline(F.array(cells))), numbers | {name: F.col(alias) for name, alias in aliases.items()}


def inside(value: Column, low: float, high: float) -> Column:
    """Whether a number is within the closed range; null, NaN and infinity are not."""
    return F.coalesce(value.between(low, high), F.lit(False))


def with_numbers(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Add `<prefix><column>` as a number; without a prefix, in place."""

    parsed = df.withColumns({f"{prefix}{name}": parse(df, name) for name in columns})
    # NaN orders above infinity in Spark, so one comparison drops both.
    doubtful = [f"{prefix}{name}" for name in columns if not is_whole(df, name)]
    if not doubtful:
        return parsed
    return parsed.withColumns({name: F.when(F.abs(F.col(name)) < float("inf"), F.col(name)) for name in doubtful})


def with_whole(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Add `<prefix><column>` as a whole number, truncated toward zero."""
    numbers = with_numbers(df, columns, prefix)
    doubtful = [f"{prefix}{name}" for name in columns if not is_whole(df, name)]
    return numbers.withColumns({name: F.col(name).try_cast("bigint") for name in doubtful}) if doubtful else numbers
