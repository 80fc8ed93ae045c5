"""Exact percentiles against sorting."""

from __future__ import annotations

import math
import random

import pytest

from berth.operators import selection as sel

SHARES = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)


def plain(values, share):
    given = sorted(v for v in values if v is not None and not math.isnan(v))
    if not given:
        return None
    return given[max(1, math.ceil(round(share * len(given), 9))) - 1]


def columns(seed):
    draw = random.Random(seed)
    n = 500
    return {
        "even": [float(i) for i in range(n)],
        "hot": [7.0 if i % 3 else draw.random() for i in range(n)],
        "one": [3.5] * n,
        "wide": [draw.choice([-1, 1]) * 10 ** draw.uniform(-300, 300) for _ in range(n)],
        "ends": [draw.choice([-1.7e308, 1.7e308, 0.0, 5e-324, -0.0, 1.0]) for _ in range(n)],
        "holes": [None if i % 2 else math.nan if i % 6 == 0 else float(i) for i in range(n)],
        "none": [None] * n,
        "odd name": [math.inf if i % 50 == 0 else -math.inf if i % 51 == 0 else float(i % 9) for i in range(n)],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_sorting(spark, seed):
    given = columns(seed)
    names = list(given)
    layout = ", ".join(f"`{n}` double" for n in given)
    df = spark.createDataFrame(list(zip(*given.values(), strict=True)), layout).repartition(3)
    found = {(r["column_name"], r["share"]): r["value"] for r in sel.exact_percentiles(df, names, SHARES).collect()}
    assert len(found) == len(names) * len(SHARES)
    for (name, share), value in found.items():
        assert value == plain(given[name], share), (name, share)


def test_few_passes_for_plain_numbers(spark, monkeypatch):
    passes = []
    narrowed = sel._narrowed
    monkeypatch.setattr(sel, "_narrowed", lambda *a: passes.append(1) or narrowed(*a))
    df = spark.range(100_000).selectExpr("id * 3 AS k", "CAST(id % 977 AS double) / 100 AS price")
    rows = sel.exact_percentiles(df, ["k", "price"]).collect()
    assert [r["value"] for r in rows][:3] == [74997.0, 149997.0, 224997.0]
    assert len(passes) <= 3


def test_no_rows_and_wrong_shares(spark):
    df = spark.createDataFrame([], "v int")
    assert [tuple(r) for r in sel.exact_percentiles(df, ["v"], [0.5]).collect()] == [("v", 0.5, None)]
    with pytest.raises(ValueError):
        sel.exact_percentiles(df, ["v"], [1.5])
