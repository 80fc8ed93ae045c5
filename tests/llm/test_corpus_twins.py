"""Queries that SQL can say, and the entry point's registration."""

from __future__ import annotations

import pytest
from compare import duck_rows, spark_rows

import __spark_entry__ as entry_points
from berth.llm.queries import QUERIES, SQL


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, con, sf_dir):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, SQL[name])
    assert columns == expected_columns
    assert rows == expected
