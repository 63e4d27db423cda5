"""Text normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip removes. Spark's one-argument trim removes
# the plain space only.
WHITESPACE = "".join(filter(str.isspace, map(chr, range(0x3001))))


def strip(col: Column) -> Column:
    return F.btrim(col.cast("string"), F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for null and for text that is empty once stripped."""
    return F.coalesce(strip(col) == "", F.lit(True))


def title(col: Column) -> Column:
    """Capitalise every run of letters, so also after '-' and an apostrophe."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def match_label(col: Column, labels: Sequence[str]) -> Column:
    """The declared label this text spells, whatever its case and padding, or null."""
    spellings = F.create_map(*[F.lit(part) for label in labels for part in (label.lower(), label)])
    # A lookup reads the text once, where a chain of `when` would repeat it.
    return F.try_element_at(spellings, F.lower(strip(col)))


def clean_label(col: Column, labels: Sequence[str]) -> Column:
    """Declared labels in their declared spelling, anything else in title case."""
    return F.coalesce(match_label(col, labels), title(strip(col)))
