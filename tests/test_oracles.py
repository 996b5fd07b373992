"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from reviewmill.plans.oracles import statements
from reviewmill.plans.registry import QUERIES
from compare import connect, oracle_rows, spark_rows
from conftest import MEDIUM

ORACLES = statements()


@pytest.fixture(scope="module")
def duck():
    with connect(MEDIUM) as db:
        yield db


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    names, rows = spark_rows(QUERIES[name](spark, MEDIUM))
    expected_names, expected = oracle_rows(duck, ORACLES[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert [r for r, e in zip(rows, expected) if r != e][:3] == []


def test_entry(spark):
    assert entry_points.entry(spark).count() == 12
