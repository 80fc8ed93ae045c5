"""Keys of several columns and references, planted and found."""

from __future__ import annotations

import itertools

import pytest

from berth.operators import relations as rel


def keys(df, **options):
    return {tuple(r["columns"]) for r in rel.unique_sets(df, **options).collect()}


def test_planted_keys_of_two_and_three_columns(spark):
    df = spark.range(2000).selectExpr(
        "id % 40 AS a",
        "id DIV 40 AS b",
        "CAST(id % 10 AS string) AS c",
        "id DIV 200 AS d",
        "id % 200 DIV 10 AS `odd name`",
        "IF(id = 7, NULL, id) AS nearly",
        "id % 2 AS e",
        "map('k', id) AS m",
    )
    found = keys(df)
    assert ("a", "b") in found and ("c", "d", "odd name") in found
    rows = [r.asDict() for r in df.drop("m").collect()]
    whole = ["a", "b", "c", "d", "odd name", "e"]
    expected = []
    for size in (1, 2, 3):
        for names in itertools.combinations(whole, size):
            unique = len({tuple(r[n] for n in names) for r in rows}) == len(rows)
            if unique and not any({*k} <= {*names} for k in expected):
                expected.append(names)
    assert found == {*expected}
    assert keys(df, columns=["a", "c", "e"]) == set()
    assert keys(df.limit(0)) == set() and keys(df.select("m")) == set()


def test_a_set_that_one_repeated_row_spoils_is_no_key(spark):
    df = spark.range(3000).selectExpr("id % 60 AS a", "id DIV 60 AS b")
    assert keys(df) == {("a", "b")}
    assert keys(df.union(df.limit(1))) == set()


@pytest.fixture
def star(spark):
    parents = spark.range(500).selectExpr("id * 7 AS p_key", "concat('n', id) AS p_name", "CAST(id % 5 AS int) AS p_kind")
    children = spark.range(9000).selectExpr(
        "id AS c_id",
        "IF(id % 11 = 0, NULL, CAST(id % 500 * 7 AS int)) AS c_key",
        "id % 500 * 7 + IF(id = 8999, 1, 0) AS c_almost",
        "IF(id % 3 > 0, 7, id % 500 * 7) AS c_hot",
        "concat('n', id % 100) AS c_label",
        "CAST(NULL AS bigint) AS c_none",
    )
    return {"parents": parents, "children": children}


def test_references_are_found_without_being_named(star):
    found = {(r["child_column"], r["parent_column"]): r for r in rel.references(star).collect()}
    assert {("c_key", "p_key"), ("c_hot", "p_key"), ("c_label", "p_name")} <= set(found)
    assert not [k for k in found if k[0] in ("c_almost", "c_none") and k[1] == "p_key"]
    assert found["c_key", "p_key"]["same_name"] and not found["c_hot", "p_key"]["same_name"]
    assert (found["c_label", "p_name"]["child_values"], found["c_label", "p_name"]["parent_values"]) == (100, 500)
    # What lies in a key's range by chance is an inclusion all the same.
    assert ("p_kind", "c_id") in found and ("c_id", "p_key") not in found


def test_only_pairs_that_sketches_leave_are_compared(star, monkeypatch):
    asked = []
    unique = rel._unique
    monkeypatch.setattr(rel, "_unique", lambda df, names: asked.append(names) or unique(df, names))
    rel.references(star)
    assert sorted(map(tuple, asked)) == [("c_id",), ("p_key",), ("p_name",)]
