"""The one descriptor that drives every operator.

A cohort is any table with an id, a class label, one banded number, one coded
category and a run of small-scale ordinal indicators. Operators never name a
column themselves: they read it from a `CohortSchema`.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CohortSchema:
    id: str
    label: str
    labels: tuple[str, ...]
    """Declared labels, weakest first. The position is the label code."""
    number: str
    """The banded number, e.g. an age."""
    category: str
    """The coded category, e.g. a gender code."""
    codes: dict[int, str]
    """Valid category codes and the name each is shown under."""
    ordinals: tuple[str, ...]
    """Indicator columns. Their order is part of the signature."""
    other: str = "other"
    number_range: tuple[int, int] = (0, 120)
    ordinal_range: tuple[int, int] = (1, 9)
    # The bands, ranges and bucket bounds results are compared under.
    bands: tuple[tuple[int, int, str], ...] = (
        (0, 19, "<20"),
        (20, 29, "20-29"),
        (30, 39, "30-39"),
        (40, 49, "40-49"),
        (50, 59, "50-59"),
        (60, 200, ">=60"),
    )
    band_name: str = "age_group"
    buckets: tuple[tuple[int | None, str], ...] = ((3, "low"), (6, "mid"), (None, "high"))
    """Inclusive upper bound and name of each ordinal bucket; the last is open."""
    chart: tuple[str, ...] = field(default=())
    """Indicators shown on the summary chart."""

    def __post_init__(self):
        if len({label.lower() for label in self.labels}) != len(self.labels):
            raise ValueError("labels must differ by more than case")
        if self.buckets[-1][0] is not None:
            raise ValueError("the last bucket must be open")
        unknown = set(self.chart) - set(self.ordinals)
        if unknown:
            raise ValueError(f"chart names no indicator: {sorted(unknown)}")

    @property
    def features(self) -> tuple[str, ...]:
        """Model inputs in signature order."""
        return (self.number, self.category, *self.ordinals)

    @property
    def checked(self) -> tuple[str, ...]:
        """Columns that count towards completeness and full-row equality."""
        return (*self.features, self.label)

    @property
    def band_names(self) -> tuple[str, ...]:
        return tuple(name for _, _, name in self.bands)

    @property
    def bucket_names(self) -> tuple[str, ...]:
        return tuple(name for _, name in self.buckets)

    @property
    def lowest(self) -> str:
        return self.labels[0]

    @property
    def highest(self) -> str:
        return self.labels[-1]
