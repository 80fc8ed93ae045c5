"""Builders for the SQL twins of profile-shaped queries."""

from __future__ import annotations

# Columns of the input tables: name and Spark type.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def columns(table: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ", 1)) for part in COLUMNS[table].split(",")]


def null_percentage(nulls: str, rows: str) -> str:
    return (
        f"CASE WHEN {rows} > 0 THEN CAST({nulls} AS DOUBLE) / {rows} * CAST(100.0 AS DOUBLE) "
        f"ELSE CAST(0 AS DOUBLE) END"
    )


def cardinality(distinct: str, rows: str) -> str:
    return (
        f"CASE WHEN {distinct} = {rows} THEN 'UNIQUE' WHEN {distinct} < 10 THEN 'LOW' "
        f"WHEN {distinct} < {rows} * CAST(0.1 AS DOUBLE) THEN 'MEDIUM' ELSE 'HIGH' END"
    )


def column_rows(relation: str, cols: list[tuple[str, str]], table_name: str) -> str:
    """UNION ALL of one row per column with the raw counts."""
    parts = []
    for i, (name, dtype) in enumerate(cols):
        nested = dtype.startswith("array")
        low = "CAST(NULL AS VARCHAR)" if nested else f"CAST(min({name}) AS VARCHAR)"
        high = "CAST(NULL AS VARCHAR)" if nested else f"CAST(max({name}) AS VARCHAR)"
        longest = f"max(length({name}))" if dtype == "string" else "NULL"
        parts.append(
            f"SELECT '{table_name}' AS table_name, '{name}' AS column_name, {i} AS ordinal, "
            f"'{dtype}' AS data_type, count(*) AS row_count, count(*) - count({name}) AS null_count, "
            f"count({name}) AS non_null_count, count(DISTINCT {name}) AS distinct_count, "
            f"{low} AS min_value, {high} AS max_value, CAST({longest} AS BIGINT) AS max_length "
            f"FROM {relation}"
        )
    return " UNION ALL ".join(parts)


def raw_rows(*tables: str) -> str:
    return " UNION ALL ".join(column_rows(t, columns(t), t) for t in tables)


def profile(raw: str) -> str:
    """Full profile rows over the raw counts."""
    return (
        "SELECT table_name, column_name, ordinal, data_type, row_count, null_count, "
        "non_null_count, distinct_count, "
        "distinct_count + CASE WHEN null_count > 0 THEN 1 ELSE 0 END AS distinct_incl_null, "
        f"{null_percentage('null_count', 'row_count')} AS null_percentage, "
        f"{cardinality('distinct_count', 'row_count')} AS cardinality, "
        "min_value, max_value, max_length, CAST(NULL AS VARCHAR) AS error "
        f"FROM ({raw}) AS raw"
    )
