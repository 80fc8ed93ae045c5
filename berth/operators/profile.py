"""Column profiles of one or many tables: one row per column.

Every column of every table gets a slot number. Columns of a fixed-width type become
(slot, value) rows, grouped first by slot and value and then by slot. The first step
combines on the map side, so a value that fills a third of a table is one row per task,
and it yields the exact distinct count, the counts and the extremes from a single scan.
All tables share one such pair of shuffles per type. Nothing is expanded to the width of
a table, as one ``count_distinct`` per column would be.

Text columns keep their extremes in an aggregate without grouping keys (no rows are
shuffled, nothing is sorted) and only send short values or digests to the distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from berth.functions import quality
from berth.operators.layout import literal, local_rows

# Strings of this many bytes or more take part in the distinct count as a SHA-256
# digest of 64 characters. Shorter ones stay as they are, so the two cannot meet.
DIGEST_FROM_BYTES = 64


def quoted(name: str) -> Column:
    """The column of that very name, dots and blanks included."""
    return F.col(tick(name))


def tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def comparable(dtype: T.DataType) -> bool:
    """Whether values of the type can be grouped."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return comparable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(comparable(f.dataType) for f in dtype.fields)
    return True


def _shown(dtype: T.DataType) -> bool:
    """Whether min and max of the type are reported as text."""
    return not isinstance(dtype, (T.ArrayType, T.StructType, T.BinaryType))


@dataclass(frozen=True)
class Slot:
    """One column of one table within a profile."""

    number: int
    table: str
    ordinal: int
    name: str
    dtype: T.DataType

    @property
    def is_text(self) -> bool:
        return isinstance(self.dtype, T.StringType)

    @property
    def group_type(self) -> str:
        """Type under which the values are grouped; whole numbers of all widths meet."""
        whole = (T.ByteType, T.ShortType, T.IntegerType)
        return "bigint" if isinstance(self.dtype, whole) else self.dtype.simpleString()

    @property
    def error(self) -> str | None:
        if comparable(self.dtype):
            return None
        return f"unsupported type {self.dtype.simpleString()}"


def slots_of(tables: dict[str, DataFrame], by: Sequence[str]) -> list[Slot]:
    slots = []
    for table, df in tables.items():
        for i, field in enumerate(df.schema.fields):
            if field.name not in by:
                slots.append(Slot(len(slots), table, i, field.name, field.dataType))
    return slots


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _value_rows(df: DataFrame, by: Sequence[str], cells: list[tuple[int, str]]) -> DataFrame:
    """(by.., slot, value) rows from (slot, expression) cells of the same type."""
    structs = ", ".join(f"struct({slot} AS slot, {value} AS value)" for slot, value in cells)
    return df.selectExpr(*[tick(b) for b in by], f"inline(array({structs}))")


_MEASURES = (
    "slot int, row_count bigint, non_null_count bigint, distinct_count bigint, "
    "min_value string, max_value string, max_length bigint"
)


def _fixed_stats(
    tables: dict[str, DataFrame], slots: list[Slot], by: Sequence[str]
) -> list[DataFrame]:
    """Counts, exact distinct counts and extremes of fixed-width columns, per type."""
    per_type: dict[str, list[Slot]] = {}
    for slot in slots:
        if not slot.is_text and slot.error is None:
            per_type.setdefault(slot.group_type, []).append(slot)
    frames = []
    for members in per_type.values():
        parts = []
        for table, df in tables.items():
            cells = [
                (s.number, f"CAST({tick(s.name)} AS {s.group_type})")
                for s in members
                if s.table == table
            ]
            if cells:
                parts.append(_value_rows(df, by, cells))
        grouped = _union(parts).groupBy(*by, "slot", "value").agg(F.expr("count(1) AS n"))
        shown = _shown(members[0].dtype)
        low, high = ("min(value)", "max(value)") if shown else ("NULL", "NULL")
        frames.append(
            grouped.groupBy(*by, "slot").agg(
                F.expr("sum(n) AS row_count"),
                F.expr("coalesce(sum(n) FILTER (WHERE value IS NOT NULL), 0) AS non_null_count"),
                F.expr("count(value) AS distinct_count"),
                F.expr(f"CAST({low} AS string) AS min_value"),
                F.expr(f"CAST({high} AS string) AS max_value"),
                F.expr("CAST(NULL AS bigint) AS max_length"),
            )
        )
    return frames


def _digest(name: str, dtype: T.StringType) -> str:
    """What stands for a text in its distinct count. Only texts that are equal byte by byte may
    be digested; under another collation the value itself is grouped."""
    if dtype != T.StringType():
        return name
    return (
        f"CASE WHEN octet_length({name}) >= {DIGEST_FROM_BYTES} THEN sha2({name}, 256) ELSE {name} END"
    )


def _text_distinct(tables: dict[str, DataFrame], slots: list[Slot], by: Sequence[str]) -> DataFrame:
    """(by.., slot, distinct_count) of the text columns, one grouping for each collation."""
    counts = []
    for dtype in {s.dtype.simpleString(): s.dtype for s in slots}.values():
        parts = []
        for table, df in tables.items():
            cells = [
                (s.number, _digest(tick(s.name), dtype))
                for s in slots
                if s.table == table and s.dtype == dtype
            ]
            if cells:
                parts.append(_value_rows(df, by, cells).filter("value IS NOT NULL"))
        grouped = _union(parts).groupBy(*by, "slot", "value").agg(F.expr("count(1) AS n"))
        counts.append(grouped.groupBy(*by, "slot").agg(F.expr("count(1) AS distinct_count")))
    return _union(counts)


def _scan_stats(
    tables: dict[str, DataFrame],
    slots: list[Slot],
    by: Sequence[str],
    approx_rsd: float | None,
) -> list[DataFrame]:
    """One aggregate per table; without ``by`` it shuffles no rows."""
    frames = []
    for table, df in tables.items():
        mine = [s for s in slots if s.table == table]
        if mine:
            frames.append(_scan_table(df, mine, by, approx_rsd))
    return frames


def _scan_table(
    df: DataFrame, slots: list[Slot], by: Sequence[str], approx_rsd: float | None
) -> DataFrame:
    measures = ["count(1) AS _rows"]
    structs = []
    for slot in slots:
        i, name = slot.number, tick(slot.name)
        measures.append(f"count({name}) AS _n{i}")
        low = high = longest = distinct = "NULL"
        if slot.error is None and _shown(slot.dtype):
            measures += [f"min({name}) AS _lo{i}", f"max({name}) AS _hi{i}"]
            low, high = f"_lo{i}", f"_hi{i}"
        if slot.is_text:
            measures.append(f"max(length({name})) AS _len{i}")
            longest = f"_len{i}"
        if approx_rsd is not None and slot.error is None:
            value = name if _shown(slot.dtype) else f"if({name} IS NULL, NULL, xxhash64({name}))"
            measures.append(f"approx_count_distinct({value}, {approx_rsd}) AS _d{i}")
            distinct = f"_d{i}"
        structs.append(
            f"struct({i} AS slot, _rows AS row_count, _n{i} AS non_null_count, "
            f"CAST({distinct} AS bigint) AS distinct_count, CAST({low} AS string) AS min_value, "
            f"CAST({high} AS string) AS max_value, CAST({longest} AS bigint) AS max_length)"
        )
    columns = [F.expr(m) for m in measures]
    wide = df.groupBy(*[quoted(b) for b in by]).agg(*columns) if by else df.agg(*columns)
    return wide.selectExpr(*[tick(b) for b in by], f"inline(array({', '.join(structs)}))")


def profile_tables(
    tables: dict[str, DataFrame],
    by: Sequence[str] = (),
    distinct: str = "exact",
    rsd: float = 0.05,
) -> DataFrame:
    """Profile every column of several tables, or every column per group of ``by``.

    ``distinct="approx"`` keeps to one scan and shuffles no values; its relative error
    is ``rsd``. ``distinct="none"`` leaves the distinct counts out. A column whose type
    has no equality gets its counts and an ``error`` text instead of failing the others.
    """
    slots = slots_of(tables, by)
    spark = next(iter(tables.values())).sparkSession
    # One row per column of the schemas, known before any data is read.
    layout = local_rows(
        spark,
        [(s.number, s.table, s.name, s.ordinal, s.dtype.simpleString(), s.error) for s in slots],
        "slot int, table_name string, column_name string, ordinal int, data_type string, "
        "error string",
    )
    keys = [*by, "slot"]
    if distinct == "exact":
        text = [s for s in slots if s.is_text]
        unsupported = [s for s in slots if s.error is not None]
        frames = _fixed_stats(tables, slots, by)
        if text:
            scanned = _union(_scan_stats(tables, text, by, None)).drop("distinct_count")
            counted = _text_distinct(tables, text, by)
            if not by:
                counted = F.broadcast(counted)  # at most one row per column
            # Groups may be named by NULL, which equals nothing but itself.
            own = {k: f"_own_{i}" for i, k in enumerate(keys)}
            counted = counted.select(*[quoted(k).alias(v) for k, v in own.items()], "distinct_count")
            same = reduce(
                Column.__and__, [quoted(k).eqNullSafe(F.col(v)) for k, v in own.items()]
            )
            frames.append(
                scanned.join(counted, same, "left")
                .drop(*own.values())
                .withColumn("distinct_count", F.expr("coalesce(distinct_count, 0)"))
            )
        if unsupported:
            frames += _scan_stats(tables, unsupported, by, None)
    else:
        frames = _scan_stats(tables, slots, by, rsd if distinct == "approx" else None)
    stats = _union(frames)
    if by:
        rows = stats.join(F.broadcast(layout), "slot")
    else:
        # Tables without rows leave no groups; the layout keeps their columns.
        rows = layout.join(F.broadcast(stats), "slot", "left")
    rows = rows.withColumns(
        {
            "row_count": F.expr("coalesce(row_count, 0)"),
            "non_null_count": F.expr("coalesce(non_null_count, 0)"),
        }
    )
    if distinct != "none":
        rows = rows.withColumn(
            "distinct_count", F.expr("if(error IS NULL, coalesce(distinct_count, 0), NULL)")
        )
    nulls = F.col("row_count") - F.col("non_null_count")
    return rows.select(
        *[quoted(b) for b in by],
        "table_name",
        "column_name",
        "ordinal",
        "data_type",
        "row_count",
        nulls.alias("null_count"),
        "non_null_count",
        "distinct_count",
        (F.col("distinct_count") + (nulls > 0).cast("bigint")).alias("distinct_incl_null"),
        quality.null_percentage(nulls, F.col("row_count")).alias("null_percentage"),
        F.when(
            F.col("distinct_count").isNotNull(),
            quality.cardinality_class(F.col("distinct_count"), F.col("row_count")),
        ).alias("cardinality"),
        "min_value",
        "max_value",
        "max_length",
        "error",
    )


def profile(
    df: DataFrame, by: Sequence[str] = (), distinct: str = "exact", rsd: float = 0.05
) -> DataFrame:
    """Profile of one table, without the table name."""
    return profile_tables({"": df}, by, distinct, rsd).drop("table_name")


def column_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and non-null counts of every column of several tables: one aggregate per table."""
    parts = []
    for table, df in tables.items():
        measures = ["count(1) AS _rows"]
        measures += [f"count({tick(c)}) AS _n{i}" for i, c in enumerate(df.columns)]
        structs = ", ".join(
            f"struct({literal(table)} AS table_name, {literal(c)} AS column_name, "
            f"{i} AS ordinal, _rows AS row_count, _n{i} AS non_null_count)"
            for i, c in enumerate(df.columns)
        )
        wide = df.agg(*[F.expr(m) for m in measures])
        parts.append(wide.selectExpr(f"inline(array({structs}))"))
    return _union(parts)


def quality_issues(profile_rows: DataFrame) -> DataFrame:
    """One row per issue found in profile rows."""
    found = quality.issue_list(
        F.col("null_percentage"),
        F.col("cardinality"),
        F.col("distinct_count"),
        F.col("null_count"),
        F.col("row_count"),
    )
    keys = [c for c in ("table_name",) if c in profile_rows.columns]
    return profile_rows.select(*keys, "column_name", F.inline(found))


def quality_score(profile_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the column points, two decimals; 0 where there are no columns."""
    points = quality.quality_points(F.col("null_percentage"), F.col("cardinality"))
    score = F.coalesce(F.round(F.avg(points), 2), F.lit(0.0)).alias("data_quality_score")
    measures = [F.count(F.lit(1)).alias("column_count"), score]
    return profile_rows.groupBy(*by).agg(*measures) if by else profile_rows.agg(*measures)


def history_rows(profile_rows: DataFrame, named: DataFrame, issues: DataFrame) -> DataFrame:
    """One nested row per table, typed, as it is kept in the profiling history.

    Lists hold one entry per column or issue of a table, as many as its schema allows.
    """
    columns = profile_rows.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).cast("int").alias("column_count"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    "ordinal",
                    "column_name",
                    "data_type",
                    "null_count",
                    "distinct_count",
                    "null_percentage",
                    "cardinality",
                    "min_value",
                    "max_value",
                )
            )
        ).alias("columns"),
    )
    flagged = named.groupBy("table_name").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("pii_type").isNotNull(), F.col("column_name")))
        ).alias("pii_detected"),
        F.array_sort(
            F.collect_list(F.when(F.col("phi_type").isNotNull(), F.col("column_name")))
        ).alias("phi_detected"),
    )
    listed = issues.groupBy("table_name").agg(
        F.array_sort(
            F.collect_list(F.struct("column_name", "issue_type", "severity", "description"))
        ).alias("data_quality_issues")
    )
    return (
        columns.join(flagged, "table_name", "left")
        .join(listed, "table_name", "left")
        .select(
            "table_name",
            F.struct("column_count", F.col("columns.column_name").alias("columns")).alias(
                "inferred_schema"
            ),
            F.struct("row_count", "columns").alias("statistics"),
            "pii_detected",
            "phi_detected",
            "data_quality_issues",
        )
    )


def column_report(profile_rows: DataFrame) -> DataFrame:
    """Profile, points and issue names of every column in one row each."""
    found = quality.issue_list(
        F.col("null_percentage"),
        F.col("cardinality"),
        F.col("distinct_count"),
        F.col("null_count"),
        F.col("row_count"),
    )
    return profile_rows.select(
        "column_name",
        "data_type",
        "row_count",
        "null_count",
        "distinct_count",
        "cardinality",
        "min_value",
        "max_value",
        quality.quality_points(F.col("null_percentage"), F.col("cardinality")).alias("points"),
        F.array_join(F.transform(found, lambda i: i["issue_type"]), ",").alias("issues"),
    )


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and spread of numeric columns: one aggregate, one row per column."""
    measures, structs = [], []
    for i, name in enumerate(columns):
        value = quoted(name).cast("double")
        measures += [
            F.count(value).alias(f"_n{i}"),
            F.avg(value).alias(f"_m{i}"),
            F.stddev_samp(value).alias(f"_s{i}"),
            F.min(value).alias(f"_lo{i}"),
            F.max(value).alias(f"_hi{i}"),
        ]
        structs.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"_n{i}").alias("non_null_count"),
                F.col(f"_m{i}").alias("mean"),
                F.col(f"_s{i}").alias("stddev"),
                F.col(f"_lo{i}").alias("min_number"),
                F.col(f"_hi{i}").alias("max_number"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*structs)))


def percentiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = 10000,
) -> DataFrame:
    """Percentiles of numeric columns from mergeable sketches: one scan, no value shuffle."""
    wanted = [float(s) for s in shares]
    sketches = [
        F.percentile_approx(quoted(c).cast("double"), wanted, accuracy).alias(f"_p{i}")
        for i, c in enumerate(columns)
    ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(share).alias("share"),
            F.col(f"_p{i}")[j].alias("value"),
        )
        for i, c in enumerate(columns)
        for j, share in enumerate(wanted)
    ]
    return df.agg(*sketches).select(F.inline(F.array(*rows)))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k most frequent values per column, as text; ties in order of the text.

    Values are counted with a map-side combine first. The rank filter reaches the
    counted rows before their shuffle, so one column's values never meet in one task.
    """
    text = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    counted = (
        text.unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    rank = F.row_number().over(
        Window.partitionBy("column_name").orderBy(F.desc("frequency"), "value")
    )
    return counted.withColumn("rank", rank).filter(F.col("rank") <= k)


# Shapes of text values, and the types a value of each shape may fit. Numbers with
# a plus sign or leading zeros have no such shape: as numbers they would not read as they were.
TEXT_SHAPES = {
    "whole number": r"^(0|-?[1-9][0-9]*)\z",
    "plain number": r"^-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)\z",
    "number": r"^-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?\z",
    "truth value": r"^(?i:true|false)\z",
}
# Narrowest first; the bit of a type is set for a value that fits it.
TEXT_TYPES = {
    "boolean": 1,
    "int": 2,
    "bigint": 4,
    "decimal(38,0)": 64,
    "double": 8,
    "decimal(38,18)": 128,
    "date": 16,
    "timestamp_ntz": 32,
}
# A double keeps every number of so many digits; the exact type has room for these many.
DOUBLE_DIGITS = 15
WHOLE_DIGITS, FRACTION_DIGITS = 20, 18


def _fitting_types(value: str) -> str:
    """Bits of the types that keep a text value as it is; NULL for no value."""

    def shape(name: str) -> str:
        return f"{value} RLIKE r'{TEXT_SHAPES[name]}'"

    def casts(dtype: str) -> str:
        return f"try_cast({value} AS {dtype}) IS NOT NULL"

    def bit(dtype: str, test: str) -> str:
        return f"CASE WHEN {test} THEN {TEXT_TYPES[dtype]} ELSE 0 END"

    def digits(number: str) -> str:
        return f"length(replace(trim(LEADING '-0.' FROM {number}), '.', ''))"

    def held(number: str) -> str:
        size = f"abs(try_cast({value} AS double))"
        few, none = f"{digits(number)} <= {DOUBLE_DIGITS}", f"{digits(number)} = 0"
        return f"{few} AND ({none} OR {size} BETWEEN 1e-300 AND 1e300)"

    # The parts of a number by its signs, which the shape has shown to stand where they may.
    mantissa = f"substring_index(substring_index({value}, 'e', 1), 'E', 1)"
    whole = f"length(replace(substring_index({value}, '.', 1), '-', ''))"
    fraction = f"CASE WHEN contains({value}, '.') THEN length({value}) - instr({value}, '.') ELSE 0 END"
    exact = f"{whole} <= {WHOLE_DIGITS} AND {fraction} <= {FRACTION_DIGITS}"
    numbers = " + ".join(
        [
            bit("int", casts("int")),
            bit("bigint", casts("bigint")),
            bit("decimal(38,0)", f"{whole} <= 38"),
            bit("double", f"{digits(value)} <= {DOUBLE_DIGITS}"),
            bit("decimal(38,18)", f"{whole} <= {WHOLE_DIGITS}"),
        ]
    )
    first = ", ".join(str(ord(c)) for c in "-.0123456789tTfF")
    return (
        f"CASE WHEN {value} IS NULL THEN NULL "
        f"WHEN ascii({value}) NOT IN ({first}) THEN 0 "
        f"WHEN {shape('whole number')} THEN {numbers} "
        f"WHEN {shape('plain number')} THEN {bit('double', held(value))} + {bit('decimal(38,18)', exact)} "
        f"WHEN {shape('number')} THEN {bit('double', held(mantissa))} "
        f"WHEN {shape('date')} THEN {bit('date', casts('date'))} "
        f"WHEN {shape('timestamp')} THEN {bit('timestamp_ntz', casts('timestamp_ntz'))} "
        f"WHEN {shape('truth value')} THEN {TEXT_TYPES['boolean']} ELSE 0 END"
    )


def infer_text_schema(df: DataFrame) -> DataFrame:
    """Schema rows for a table of strings: the narrowest type that keeps every value.

    One scan at any width: values become rows first, so that one copy of the test serves all
    columns; each becomes the bits of the types it fits, which are combined per column before the
    shuffle. Whole numbers beyond
    ``bigint`` and long fractions get an exact decimal, and what no type would give back
    as it was (leading zeros, plus signs) stays text, as does a column without values.
    """
    names = df.columns
    cells = ", ".join(f"struct({i} AS slot, {tick(n)} AS value)" for i, n in enumerate(names))
    found = (
        df.selectExpr(f"inline(array({cells}))")
        .selectExpr("slot", f"{_fitting_types('value')} AS fit")
        .groupBy("slot")
        .agg(
            F.expr("count(1) AS _rows"), F.expr("count(fit) AS _given"), F.expr("bit_and(fit) AS _fit")
        )
    )
    layout = local_rows(
        df.sparkSession, list(enumerate(names)), "order_id int, column_name string"
    )
    ladder = " ".join(f"WHEN _fit & {bit} <> 0 THEN '{t}'" for t, bit in TEXT_TYPES.items())
    # At most one row per column; a table without rows has none.
    rows = layout.join(F.broadcast(found), F.col("order_id") == F.col("slot"), "left")
    return rows.selectExpr(
        "column_name",
        f"CASE {ladder} ELSE 'string' END AS data_type",
        "coalesce(_given < _rows, false) AS nullable",
        "order_id",
    ).withColumn("expression", F.format_string("CAST(%s AS %s)", "column_name", "data_type"))


def declared_schema(df: DataFrame) -> DataFrame:
    """Schema rows of a typed source (Parquet, JSON), in the same layout."""
    rows = [
        (f.name, f.dataType.simpleString(), f.nullable, f.name, i)
        for i, f in enumerate(df.schema.fields)
    ]
    layout = (
        "column_name string, data_type string, nullable boolean, expression string, order_id int"
    )
    return local_rows(df.sparkSession, rows, layout)
