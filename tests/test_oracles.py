"""Every query with SQL against DuckDB; every other one has to return rows."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from cohortloom.plans.oracle import ORACLES
from cohortloom.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck.sql(ORACLES[name])) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 7


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert (len(QUERIES), len(ORACLES)) == (100, 100)
