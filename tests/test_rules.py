"""What the package must not contain."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

PACKAGE = Path(__file__).resolve().parents[1] / "cohortloom"
SOURCES = {
    path.relative_to(PACKAGE).as_posix(): path.read_text()
    for path in PACKAGE.rglob("*.py")
    if "llm" not in path.relative_to(PACKAGE).parts
}
BANNED = (
    r"tempfile",
    r"cohortloom\.llm",
    r"\budf\b",
    r"pandas",
    r"\.rdd\b",
    r"toPandas",
    r"toLocalIterator",
    r"crossJoin",
    r"localCheckpoint",
    r"inferSchema",
    r"createOrReplaceTempView",
)


@pytest.mark.parametrize("pattern", BANNED)
def test_not_used(pattern):
    assert [name for name, text in SOURCES.items() if re.search(pattern, text)] == []


def test_the_only_collects_are_bounded():
    found = {name: len(re.findall(r"\.collect\(\)|\.take\(", text)) for name, text in SOURCES.items()}
    # The gate reads the eight rows of its report, the split five offenders for its message,
    # a merge the numbers of the buckets it touches, an ingest its four failed checks at most.
    assert {name: n for name, n in found.items() if n} == {
        "operators/quality.py": 1, "operators/split.py": 1, "sources/ingest.py": 1, "sources/keyed.py": 1
    }


def test_broadcasts_have_a_bound():
    """One row a label for the cuts of a split (2); one row a hot key, of which a sketch names few (2)."""
    found = {name: len(re.findall(r"F\.broadcast\(", text)) for name, text in SOURCES.items()}
    assert {name: n for name, n in found.items() if n} == {"operators/split.py": 4}
