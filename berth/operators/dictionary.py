"""Data dictionary: upsert, type proposals, DDL texts, key candidates, constraint tests.

Everything here works on catalogue rows (one per column of any number of tables) or
on the tables themselves; nothing loops over columns with a query each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.operators.layout import literal, local_rows
from berth.operators.profile import quoted, tick
from berth.operators.runlog import latest

# Texts that consumers of proposals look for.
PII_COMMENT = "PII - Apply masking policy"
UNKNOWN_TABLE = "UNKNOWN_TABLE"
# Words that may stand between CREATE and TABLE, and a part of a table's name, quoted or bare.
KINDS_OF_TABLE = ["OR REPLACE", "LOCAL", "GLOBAL", "TEMP", "TEMPORARY", "TRANSIENT", "EXTERNAL"]
NAME_PART = r'"(?:[^"]|"")+"|`(?:[^`]|``)+`|\w+'
DECISIONS = ["APPROVED", "REJECTED"]
PENDING = "PENDING"

DICTIONARY_KEY = ["source_system", "table_name", "column_name"]
UPDATED_FIELDS = ["data_type", "is_pii", "pii_type"]


def catalog_rows(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Catalogue rows of tables given as (schema, table) -> frame; read from the schemas."""
    rows = [
        (schema, table, f.name, i, f.dataType.simpleString(), f.nullable)
        for (schema, table), df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    layout = (
        "table_schema string, table_name string, column_name string, ordinal int, "
        "data_type string, is_nullable boolean"
    )
    return local_rows(spark, rows, layout)


def dictionary_rows(columns: DataFrame, findings: DataFrame, source_system: str) -> DataFrame:
    """Dictionary entries for column rows, with the finding of each column looked up."""
    keys = ["table_name", "column_name"]
    found = findings.select(*keys, F.col("label").alias("pii_type"))
    return (
        columns.join(found, keys, "left")
        .withColumn("source_system", F.lit(source_system))
        .withColumn("is_pii", F.col("pii_type").isNotNull())
    )


def upsert_dictionary(existing: DataFrame, incoming: DataFrame, at: Column) -> DataFrame:
    """New snapshot of the dictionary after one batch of entries.

    Known columns get type, finding and ``updated_at`` from the batch and keep the rest;
    unknown ones are added. A key that comes twice counts once, always in the same way. Both
    sides then hold one row per key, so no key is hot.
    """
    carried = [c for c in existing.columns if c not in {*DICTIONARY_KEY, *UPDATED_FIELDS}]
    new = latest(incoming, DICTIONARY_KEY, UPDATED_FIELDS)
    old, new = existing.alias("old"), new.alias("new")
    condition = reduce(
        lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in DICTIONARY_KEY]
    )
    arrived = F.col("new.column_name").isNotNull()
    known = F.col("old.column_name").isNotNull()

    def carry(name: str) -> Column:
        if name == "created_at":
            return F.when(known, F.col("old.created_at")).otherwise(at)
        if name == "updated_at":
            return F.when(arrived, at).otherwise(F.col("old.updated_at"))
        if name in incoming.columns:
            return F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}"))
        return F.col(f"old.{name}")

    return old.join(new, condition, "full_outer").select(
        *[F.coalesce(f"old.{k}", f"new.{k}").alias(k) for k in DICTIONARY_KEY],
        *[
            F.when(arrived, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in UPDATED_FIELDS
        ],
        *[carry(c).alias(c) for c in carried],
    )


def listing(dictionary: DataFrame, n: int = 100) -> DataFrame:
    """First n entries by table and column."""
    return dictionary.orderBy("table_name", "column_name").limit(n)


def _narrow_cell(slot: int, name: str, dtype: T.DataType) -> str:
    """What a value says about the narrowest type of its column, as a struct."""
    source = tick(name)
    said = {"whole": "bigint", "cents": "boolean", "top": "double", "size": "int", "day": "boolean"}
    found = {}
    if _is_whole(dtype):
        found["whole"] = source
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        found["cents"], found["top"] = f"{source} = round({source}, 2)", f"abs({source})"
    elif isinstance(dtype, T.StringType):
        found["size"] = f"length({source})"
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        found["day"] = f"{source} = date_trunc('DAY', {source})"
    cells = ", ".join(f"CAST({found.get(n, 'NULL')} AS {t}) AS {n}" for n, t in said.items())
    return f"struct({slot} AS slot, {source} IS NOT NULL AS given, {cells})"


def _is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _narrow_kind(dtype: T.DataType) -> str:
    if _is_whole(dtype):
        return "whole"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "fraction"
    if isinstance(dtype, T.StringType):
        return "text"
    return "moment" if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else "other"


_INSIDE = " ".join(
    f"WHEN low >= {-(2 ** (bits - 1))} AND high <= {2 ** (bits - 1) - 1} THEN '{t}'"
    for t, bits in (("tinyint", 8), ("smallint", 16), ("int", 32))
)
_PROPOSED = (
    "CASE kind "
    f"WHEN 'whole' THEN CASE WHEN low IS NULL THEN data_type {_INSIDE} ELSE 'bigint' END "
    "WHEN 'fraction' THEN CASE WHEN cents AND top < 1e12 THEN "
    "concat('decimal(', length(CAST(CAST(floor(top) AS bigint) AS string)) + 2, ',2)') "
    "ELSE data_type END "
    "WHEN 'text' THEN concat('varchar(', greatest(coalesce(size, 1), 1), ')') "
    "WHEN 'moment' THEN CASE WHEN day THEN 'date' ELSE data_type END ELSE data_type END"
)


def narrow_types(tables: dict[str, DataFrame]) -> DataFrame:
    """Proposed type and observed nulls of every column.

    One scan per table at any width; what is shuffled is a row per column and task."""
    columns, parts = [], []
    for table, df in tables.items():
        cells = []
        for i, field in enumerate(df.schema.fields):
            slot = len(columns)
            shown = field.dataType.simpleString()
            columns.append((slot, table, field.name, i, shown, _narrow_kind(field.dataType)))
            cells.append(_narrow_cell(slot, field.name, field.dataType))
        if cells:
            parts.append(df.selectExpr(f"inline(array({', '.join(cells)}))"))
    spark = next(iter(tables.values())).sparkSession
    layout = local_rows(
        spark,
        columns,
        "number int, table_name string, column_name string, ordinal int, data_type string, "
        "kind string",
    )
    found = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("slot")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("given").alias("given"),
            F.min("whole").alias("low"),
            F.max("whole").alias("high"),
            F.bool_and("cents").alias("cents"),
            F.max("top").alias("top"),
            F.max("size").alias("size"),
            F.bool_and("day").alias("day"),
        )
    )
    # At most one row per column; tables without rows have none.
    rows = layout.join(F.broadcast(found), F.col("number") == F.col("slot"), "left")
    return rows.selectExpr(
        "table_name",
        "column_name",
        "ordinal",
        "data_type",
        f"{_PROPOSED} AS proposed_type",
        "n IS NULL OR given < n AS nullable",
    )


def ddl_texts(
    columns: DataFrame, database: str, schema: str, type_column: str = "data_type"
) -> DataFrame:
    """CREATE TABLE text per table from column rows (``label`` marks a finding).

    The columns of one table are brought together, as many as its schema has.
    """
    line = F.concat(
        F.lit("    "),
        "column_name",
        F.lit(" "),
        type_column,
        F.when(~F.col("nullable"), " NOT NULL").otherwise(""),
        F.when(F.col("label").isNotNull(), f" COMMENT '{PII_COMMENT}'").otherwise(""),
    )
    lines = F.array_sort(F.collect_list(F.struct(F.col("ordinal"), line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), ",\n")
    head = F.concat(
        F.lit(f"CREATE OR REPLACE TABLE {database}.{schema}."), "table_name", F.lit(" (\n")
    )
    return (
        columns.groupBy("table_name")
        .agg(body.alias("_body"), F.count(F.lit(1)).alias("column_count"))
        .select(
            "table_name", "column_count", F.concat(head, "_body", F.lit("\n\n);")).alias("ddl")
        )
    )


def ddl_table_name(ddl: Column) -> Column:
    """Table name within a CREATE TABLE text: the last part of the name, without its quotes."""
    kinds = "|".join(k.replace(" ", r"\s+") for k in KINDS_OF_TABLE)
    statement = (
        rf"(?i)\bCREATE(?:\s+(?:{kinds}))*\s+TABLE(?:\s+IF\s+NOT\s+EXISTS)?\s+"
        rf"(?:(?:{NAME_PART})\s*\.\s*)*({NAME_PART})"
    )
    part = F.regexp_extract(ddl, statement, 1)
    inner = F.substr(part, F.lit(2), F.length(part) - 2)
    name = (
        F.when(part.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"')))
        .when(part.startswith("`"), F.replace(inner, F.lit("``"), F.lit("`")))
        .otherwise(part)
    )
    return F.when(part != "", name).otherwise(F.lit(UNKNOWN_TABLE))


def key_candidates(profile_rows: DataFrame) -> DataFrame:
    """Columns fit for a primary key or for clustering."""
    key = (
        (F.col("cardinality") == "UNIQUE")
        & (F.col("null_count") == 0)
        & (F.col("row_count") > 0)
    )
    grouped = F.col("cardinality").isin("LOW", "MEDIUM") & (F.col("distinct_count") > 1)
    timed = F.col("data_type").isin("date", "timestamp", "timestamp_ntz")
    role = F.when(key, "PRIMARY_KEY").when(grouped | timed, "CLUSTERING")
    return profile_rows.withColumn("role", role).filter(F.col("role").isNotNull())


def conformity(df: DataFrame, ddl: str) -> DataFrame:
    """Cells of every row that the proposed types cannot hold, counted per column."""
    proposed = T.StructType.fromDDL(ddl)
    measures, structs = ["count(1) AS _rows"], []
    for i, field in enumerate(proposed.fields):
        name, target = tick(field.name), field.dataType.simpleString()
        measures.append(
            f"count_if({name} IS NOT NULL AND try_cast({name} AS {target}) IS NULL) AS _bad{i}"
        )
        structs.append(
            f"struct({literal(field.name)} AS column_name, '{target}' AS proposed_type, "
            f"_rows AS row_count, _bad{i} AS failures, _bad{i} = 0 AS passed)"
        )
    return df.agg(*[F.expr(m) for m in measures]).selectExpr(
        f"inline(array({', '.join(structs)}))"
    )


def proposal_state(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Proposals with their newest decision; PENDING until there is one."""
    state = latest(decisions, ["proposal_id"], ["decided_at", "seq"])
    joined = proposals.join(
        state.select("proposal_id", "decision", "decided_by", "decided_at"), "proposal_id", "left"
    )
    status = F.coalesce("decision", F.lit(PENDING))
    approved = status == "APPROVED"
    return joined.select(
        *proposals.columns,
        status.alias("approval_status"),
        F.when(approved, F.col("decided_by")).alias("approved_by"),
        F.when(approved, F.col("decided_at")).alias("approved_at"),
    )


def executable(states: DataFrame) -> DataFrame:
    """Only approved proposals may create tables."""
    return states.filter(F.col("approval_status") == "APPROVED")


def not_null_test(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null cells per column, all columns in one aggregate."""
    counts = df.agg(
        *[F.count_if(quoted(c).isNull()).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit("not_null").alias("test"),
            F.col(f"_c{i}").alias("failures"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def unique_test(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    keys = [quoted(c) for c in columns]
    present = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    repeated = df.filter(present).groupBy(*keys).count().filter(F.col("count") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(columns)).alias("column_name"),
        F.lit("unique").alias("test"),
        "failures",
    )


def reference_test(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose reference has no parent. References are counted before the join,
    so a reference that a third of the rows share is one row in it."""
    counted = child.filter(quoted(column).isNotNull()).groupBy(quoted(column).alias("_ref")).count()
    parents = parent.select(quoted(parent_column).alias("_ref")).distinct()
    orphans = counted.join(parents, "_ref", "left_anti")
    return orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("references").alias("test"),
        "failures",
    )
