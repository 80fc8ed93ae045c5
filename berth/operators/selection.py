"""Exact percentiles of many columns, by narrowing ranges of values until one value is left.

Each wanted percentile of a column is the value at a rank. A pass over the table counts, for every
wanted rank at once, the values in each of BINS parts of the range that the rank is known to lie
in, with the smallest and largest value of each part; the part that holds the rank is the next
range. What is shuffled are counts per part, so no column's values meet anywhere, and a value
that fills a third of the table is a number. Bins are cut between values that exist, so a pass
leaves at most a thousandth of the range; whole numbers and prices take two or three passes.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from berth.operators.layout import literal, local_rows
from berth.operators.profile import tick

BINS = 1000
#: More passes than any range of doubles needs.
MOST_PASSES = 400
_LARGEST = sys.float_info.max


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """(column_name, share, value): the smallest value of a numeric column that at least the share
    of its values does not exceed; a share of 0 is the smallest value.

    Values are taken as doubles. NULL and NaN are no values; a column without values has NULL.
    """
    if not all(0 <= s <= 1 for s in shares):
        raise ValueError("shares lie between 0 and 1")
    spark = df.sparkSession
    cells = ", ".join(f"struct({i} AS slot, CAST({tick(c)} AS double) AS v)" for i, c in enumerate(columns))
    values = df.selectExpr(f"inline(array({cells}))").filter("v IS NOT NULL AND NOT isnan(v)")
    # One row per column here, and one per wanted percentile below: what the caller has named.
    ends = {r["slot"]: r for r in values.groupBy("slot").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    ).collect()}
    wanted = [(slot, share) for slot in range(len(columns)) for share in shares]
    found: dict[int, float] = {}
    open_ranges = []
    for target, (slot, share) in enumerate(wanted):
        if slot in ends:
            n, low, high = ends[slot]["n"], ends[slot]["low"], ends[slot]["high"]
            rank = max(1, math.ceil(_rounded(share * n)))
            open_ranges.append((target, slot, rank, low, high))
    for _ in range(MOST_PASSES):
        found |= {t: low for t, _, _, low, high in open_ranges if low == high}
        open_ranges = [r for r in open_ranges if r[0] not in found]
        if not open_ranges:
            break
        open_ranges = _narrowed(values, open_ranges)
    rows = [
        (columns[slot], float(share), found.get(target)) for target, (slot, share) in enumerate(wanted)
    ]
    told = ", ".join(
        f"({literal(c)}, {s!r}D, {'NULL' if v is None else f'CAST({str(v)!r} AS double)'})" for c, s, v in rows
    )
    return spark.sql(
        f"SELECT col1 AS column_name, col2 AS share, CAST(col3 AS double) AS value FROM VALUES {told}"
    )


def _rounded(product: float) -> float:
    """A whole number where the product of share and count is one but for its last bits."""
    near = round(product)
    return near if math.isclose(product, near, rel_tol=1e-12) else product


def _narrowed(values: DataFrame, ranges: list[tuple]) -> list[tuple]:
    """For each (target, slot, rank within the range, low, high) a narrower range."""
    given = local_rows(
        values.sparkSession,
        [(t, s, r, repr(low), repr(high)) for t, s, r, low, high in ranges],
        "target int, own bigint, rank bigint, low string, high string",
    ).selectExpr("target", "own", "rank", "CAST(low AS double) AS low", "CAST(high AS double) AS high")
    # The ends have bins of their own, so every pass gets on, and infinite ones are not divided.
    # Halves, as the width of the widest range is no double.
    low, high = f"greatest(low, -{_LARGEST!r}D) / 2", f"least(high, {_LARGEST!r}D) / 2"
    inner = f"least(floor((v / 2 - {low}) / ({high} - {low}) * {BINS}), {BINS - 1})"
    number = f"CAST(CASE WHEN v = low THEN 0 WHEN v = high THEN {BINS + 1} ELSE 1 + {inner} END AS int)"
    bins = (
        values.join(F.broadcast(given), (F.col("slot") == F.col("own")) & F.col("v").between(F.col("low"), F.col("high")))
        .withColumn("bin", F.expr(number))
        .groupBy("target", "own", "rank", "bin")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    before = F.sum("n").over(Window.partitionBy("target").orderBy("bin")) - F.col("n")
    chosen = (
        bins.withColumn("before", before)
        .filter("before < rank AND rank <= before + n")
        .selectExpr("target", "own", "rank - before AS rank", "low", "high")
    )
    return [tuple(r) for r in chosen.collect()]
