"""Every registered query against its SQL twin, on whole tables."""

from __future__ import annotations

import pytest
from compare import duck_rows, spark_rows

import __spark_entry__ as entry_points
from berth.plans import catalogue

QUERIES = catalogue.QUERIES
SQL = catalogue.SQL


def test_registry_is_consistent():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"profile_approx"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, con, sf_dir):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() == 11
