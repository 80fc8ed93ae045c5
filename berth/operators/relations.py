"""Keys and references found in the data: minimal unique sets of columns, and columns whose values
all occur in another table's key.

Both look at sketches first. One scan sketches every column; whatever the sketches rule out is
never compared in full, and what is left is decided exactly: a key by grouping, a reference by an
anti-join of the distinct values.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.operators.layout import literal, local_rows
from berth.operators.load import write_snapshot
from berth.operators.profile import comparable, quoted, tick

#: Sketches with so many times less than the rows are taken for sets that are not unique; the
#: standard error of a sketch is 1.6 percent.
NEAR = 0.9
#: Sets of columns that one scan sketches.
SETS_AT_ONCE = 200

KEYS = "table_name string, columns array<string>, row_count bigint"


def _hashed(names: Sequence[str]) -> str:
    return f"xxhash64({', '.join(tick(n) for n in names)})"


def _about(df: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """About how many different values each set of columns has."""
    found = {}
    for start in range(0, len(sets), SETS_AT_ONCE):
        part = sets[start : start + SETS_AT_ONCE]
        measures = [
            F.expr(f"hll_sketch_estimate(hll_sketch_agg({_hashed(s)}))").alias(f"_{i}") for i, s in enumerate(part)
        ]
        found |= dict(zip(part, df.agg(*measures).first(), strict=True))
    return found


def _unique(df: DataFrame, names: Sequence[str]) -> bool:
    repeated = df.groupBy(*(quoted(n) for n in names)).count().filter("count > 1")
    return repeated.limit(1).count() == 0


def unique_sets(df: DataFrame, table: str = "", columns: Sequence[str] | None = None, most: int = 3) -> DataFrame:
    """(table_name, columns, row_count): the smallest sets of at most ``most`` columns whose values
    tell every row apart; none for a table without rows.

    Only columns without NULLs take part, as in a key. Sets are tried level by level: a set that
    holds a unique one is not minimal and is left out, and one whose columns have too few values
    between them cannot be unique. A table without repeated rows has such a set, though it may be
    larger than ``most``.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    named = [f.name for f in fields if comparable(f.dataType)]
    counts = df.agg(
        F.count("*").alias("_rows"),
        *(F.count(quoted(c)).alias(f"_{i}") for i, c in enumerate(named)),
    ).first()
    rows = counts["_rows"]
    whole = [c for i, c in enumerate(named) if rows and counts[f"_{i}"] == rows]
    single = _about(df, [(c,) for c in whole])
    found: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        sets = []
        for names in itertools.combinations(whole, size):
            if any({*key} <= {*names} for key in found):
                continue
            room = 1.0
            for c in names:
                room *= single[(c,)] / NEAR
            if room >= rows:
                sets.append(names)
        about = single if size == 1 else _about(df, sets)
        found += [s for s in sets if about[s] >= NEAR * rows and _unique(df, s)]
    given = [(table, ",".join(str(whole.index(c)) for c in names), rows) for names in found]
    listed = local_rows(df.sparkSession, given, "table_name string, places string, row_count bigint")
    names = F.array(*(F.lit(c) for c in whole)) if whole else F.array().cast("array<string>")
    places = F.transform(F.split("places", ","), lambda p: F.element_at(names, p.cast("int") + 1))
    return listed.select("table_name", places.alias("columns"), "row_count")


def _kind(dtype: T.DataType) -> str | None:
    """Types whose values can refer to each other; fractions and truth values are no keys."""
    if isinstance(dtype, T.IntegralType):
        return "bigint"
    if isinstance(dtype, (T.StringType, T.DateType)):
        return dtype.simpleString()
    return None


def _column_sketches(tables: dict[str, DataFrame]) -> list[tuple]:
    """(table, column, kind, values, different, sketch) of every column that can be a key or refer
    to one; one row per column of the schemas, its sketch of a fixed size."""
    out = []
    for table, df in tables.items():
        fields = [(f.name, _kind(f.dataType)) for f in df.schema.fields if _kind(f.dataType)]
        if not fields:
            continue
        measures = [F.count("*").alias("_rows")]
        for i, (name, kind) in enumerate(fields):
            value = f"CAST({tick(name)} AS {kind})" if kind != "date" else f"unix_date({tick(name)})"
            measures += [
                F.count(quoted(name)).alias(f"_n{i}"),
                F.expr(f"theta_sketch_agg({value})").alias(f"_s{i}"),
            ]
        cells = ", ".join(
            f"struct({literal(table)} AS table_name, {literal(name)} AS column_name, {literal(kind)} AS kind, "
            f"_rows AS records, _n{i} AS given, _s{i} AS sketch)"
            for i, (name, kind) in enumerate(fields)
        )
        out.append(df.agg(*measures).selectExpr(f"inline(array({cells}))"))
    return out


def references(tables: dict[str, DataFrame]) -> DataFrame:
    """(child_table, child_column, parent_table, parent_column, child_values, parent_values,
    same_name): columns all of whose values occur in a key column of another table, or of the
    same table under another name.

    A key column is one without NULLs or repeated values. Sketches of the columns tell how many
    values of one are not in another: more than none, and the pair is out. Numbers that happen
    to lie in a key's range are found too; ``same_name`` marks pairs whose names agree behind
    the first underscore, and ``child_values`` of ``parent_values`` says how much is used.
    """
    parts = _column_sketches(tables)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # One row per column of the schemas, as are the pairs made of them below.
    measured = write_snapshot(every, label="sketches").withColumn("different", F.theta_sketch_estimate("sketch"))
    parents = measured.filter("given = records AND records > 0").filter(F.col("different") >= NEAR * F.col("records"))
    pairs = (
        measured.filter("given > 0")
        .alias("c")
        .join(parents.alias("p"), F.col("c.kind") == F.col("p.kind"))
        .filter("c.table_name <> p.table_name OR c.column_name <> p.column_name")
        .filter(F.theta_sketch_estimate(F.theta_difference("c.sketch", "p.sketch")) == 0)
        .selectExpr("c.table_name AS ct", "c.column_name AS cc", "p.table_name AS pt", "p.column_name AS pc", "c.kind")
        .orderBy("ct", "cc", "pt", "pc")
        .collect()
    )
    keys = {}
    found = []
    for ct, cc, pt, pc, kind in pairs:
        if (pt, pc) not in keys:
            keys[pt, pc] = _unique(tables[pt], [pc])
        if not keys[pt, pc]:
            continue
        child = tables[ct].select(quoted(cc).cast(kind).alias("v")).filter("v IS NOT NULL").distinct()
        parent = tables[pt].select(quoted(pc).cast(kind).alias("k"))
        told = child.join(parent, F.col("v") == F.col("k"), "left").agg(
            F.count("*").alias("n"), F.count("k").alias("there")
        )
        counted = told.first()
        if counted["n"] == counted["there"]:
            found.append((ct, cc, pt, pc, counted["n"], tables[pt].count(), _after(cc) == _after(pc)))
    return local_rows(
        next(iter(tables.values())).sparkSession,
        found,
        "child_table string, child_column string, parent_table string, parent_column string, "
        "child_values bigint, parent_values bigint, same_name boolean",
    )


def _after(name: str) -> str:
    """A column's name without a prefix."""
    return name.partition("_")[2].lower() or name.lower()
