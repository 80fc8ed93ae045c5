"""Whole onboarding runs as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.operators import mapping as mp
from berth.operators.parts import PartTable
from berth.plans import onboarding as onb
from berth.plans import platform, sqltext
from berth.plans.registry import query, table
from berth.session import scratch_dir
from berth.sources.readers import PARQUET_FORMAT

_TARGET = (
    "O_ORDERKEY string, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2), "
    "o_orderdate date"
)


@query(
    "onboarding_run",
    "SELECT agent_name, 'COMPLETED' AS status, CASE agent_name WHEN 'DICTIONARY' THEN 6 "
    "ELSE count(*) END AS rows FROM orders, "
    "(SELECT unnest(['PROFILING', 'DICTIONARY', 'MAPPING']) AS agent_name) GROUP BY agent_name",
)
def onboarding_run(spark, sf_dir):
    store = onb.Store(spark, scratch_dir(spark, "store"))
    target = mp.columns_from_ddl(table(spark, sf_dir, "orders"), _TARGET)
    done = onb.onboard(spark, store, f"{sf_dir}/orders.parquet", PARQUET_FORMAT, target)
    counts = {
        "PROFILING": done.frames["profile"].agg(F.max("row_count").alias("rows")),
        "DICTIONARY": onb.dictionary_state(store).agg(F.count("data_type").alias("rows")),
        "MAPPING": done.frames["loaded"].agg(F.count(F.lit(1)).alias("rows")),
    }
    rows = reduce(
        DataFrame.unionByName,
        [c.select(F.lit(agent).alias("agent_name"), "rows") for agent, c in counts.items()],
    )
    return onb.step_states(store).select("agent_name", "status").join(rows, "agent_name")


@query(
    "onboarding_loaded",
    'SELECT CAST(o_orderkey AS VARCHAR) AS "O_ORDERKEY", o_custkey, o_orderstatus, '
    "CAST(o_totalprice AS DOUBLE) AS o_totalprice, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders",
)
def onboarding_loaded(spark, sf_dir):
    store = onb.Store(spark, scratch_dir(spark, "store"))
    target = mp.columns_from_ddl(table(spark, sf_dir, "orders"), _TARGET)
    done = onb.onboard(
        spark,
        store,
        f"{sf_dir}/orders.parquet",
        PARQUET_FORMAT,
        target,
        workflow_type=onb.MAPPING_ONLY,
    )
    return done.frames["loaded"].select(
        "O_ORDERKEY",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderpriority",
    )


_STORES: dict[tuple[str, str], onb.Store] = {}


def _recorded(spark, sf_dir) -> onb.Store:
    """The store after a run over orders with a curated load; one run serves all queries of a
    session, which read what it has left in the platform tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        store = onb.Store(spark, scratch_dir(spark, "store"))
        target = mp.columns_from_ddl(table(spark, sf_dir, "orders"), _TARGET)
        done = onb.onboard(
            spark, store, f"{sf_dir}/orders.parquet", PARQUET_FORMAT, target, keys=["O_ORDERKEY"]
        )
        if done.status != "COMPLETED":
            raise RuntimeError(done.summary)
        _STORES[key] = store
    return _STORES[key]


def _platform(name: str, sql: str):
    """Register a query that reads one platform table after the run."""

    def keep(fn):
        @query(f"platform_{name}", sql)
        def read(spark, sf_dir):
            return fn(platform.read_table(_recorded(spark, sf_dir), name))

        return read

    return keep


_LOW = " + ".join(
    f"CAST(count(DISTINCT {c}) BETWEEN 1 AND 9 AND count(DISTINCT {c}) < count(*) AS INT)"
    for c, _ in sqltext.columns("orders")
)


@_platform(
    "workflow_executions",
    "SELECT 'ONBOARDING' AS workflow_type, 'orders.parquet' AS source_file_name, 'CURATED' AS target_schema, "
    "'COMPLETED' AS status, 'PROFILING,DICTIONARY,MAPPING' AS agents, true AS lasted, count(*) > 0 AS given "
    "FROM orders",
)
def platform_workflow_executions(rows):
    return rows.select(
        "workflow_type",
        "source_file_name",
        "target_schema",
        "status",
        F.array_join("agent_sequence", ",").alias("agents"),
        (F.col("end_time") >= F.col("start_time")).alias("lasted"),
        (F.col("duration_seconds") >= 0).alias("given"),
    )


@_platform(
    "agent_execution_log",
    "SELECT agent_name, 'COMPLETED' AS status, 'PARQUET_FORMAT' AS file_format, CAST(6 AS BIGINT) AS columns "
    "FROM (SELECT unnest(['PROFILING', 'DICTIONARY', 'MAPPING']) AS agent_name)",
)
def platform_agent_execution_log(rows):
    return rows.select(
        "agent_name",
        "status",
        F.try_variant_get(F.parse_json("input_params"), "$.format", "string").alias("file_format"),
        F.try_variant_get(F.parse_json("output_result"), "$.columns", "bigint").alias("columns"),
    )


@_platform(
    "agent_profiling_history",
    "SELECT 'orders.parquet' AS source_file_name, count(*) AS sample_size, count(*) AS row_count, "
    f"CAST(6 AS BIGINT) AS column_count, 0 AS pii, {_LOW} AS issues FROM orders",
)
def platform_agent_profiling_history(rows):
    return rows.select(
        "source_file_name",
        "sample_size",
        F.get_json_object("statistics", "$.row_count").cast("bigint").alias("row_count"),
        F.get_json_object("inferred_schema", "$.column_count").cast("bigint").alias("column_count"),
        F.size("pii_detected").alias("pii"),
        F.size("data_quality_issues").alias("issues"),
    )


@_platform(
    "profiling_results",
    f"SELECT 'orders.parquet' AS source_file_name, count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, "
    f"CAST(round(100 - 10.0 * ({_LOW}) / 6, 2) AS DOUBLE) AS score, 'NONE' AS pii_risk_level, {_LOW} AS advice "
    "FROM orders",
)
def platform_profiling_results(rows):
    return rows.select(
        "source_file_name",
        "row_count",
        "column_count",
        F.col("data_quality_score").cast("double").alias("score"),
        "pii_risk_level",
        F.size("recommendations").alias("advice"),
    )


@_platform(
    "ddl_proposals",
    "SELECT 'orders.parquet' AS source_name, 'orders' AS proposed_table_name, 'PENDING' AS approval_status, "
    "count(*) > 0 AS creates FROM orders",
)
def platform_ddl_proposals(rows):
    return rows.select(
        "source_name",
        "proposed_table_name",
        "approval_status",
        F.col("landing_ddl").startswith("CREATE OR REPLACE TABLE LAKE.STAGING.orders (").alias("creates"),
    )


@_platform(
    "enterprise_data_dictionary",
    "SELECT 'lake' AS source_system, 'orders' AS table_name, column_name, data_type, false AS is_pii FROM "
    "(VALUES " + ", ".join(f"('{c}', '{t}')" for c, t in sqltext.columns("orders")) + ") AS t(column_name, data_type)",
)
def platform_enterprise_data_dictionary(rows):
    return rows.select("source_system", "table_name", "column_name", "data_type", "is_pii")


@_platform(
    "agent_dictionary_history",
    "SELECT 'lake' AS source_system, 1 AS table_count, CAST(6 AS BIGINT) AS column_count, "
    "count(*) > 0 AS ddl_generated, false AS external_api_called FROM orders",
)
def platform_agent_dictionary_history(rows):
    return rows.select("source_system", "table_count", "column_count", "ddl_generated", "external_api_called")


_MAPPED = (
    "(VALUES ('o_orderkey', 'O_ORDERKEY', 'bigint', 'string', 'TYPE_CAST', 0.95), ('o_custkey', 'o_custkey', "
    "'bigint', 'bigint', 'DIRECT', 0.95), ('o_orderstatus', 'o_orderstatus', 'string', 'string', 'DIRECT', "
    "0.95), ('o_totalprice', 'o_totalprice', 'double', 'decimal(18,2)', 'TYPE_CAST', 0.95), ('o_orderdate', "
    "'o_orderdate', 'timestamp_ntz', 'date', 'TYPE_CAST', 0.95), ('o_orderpriority', 'o_orderpriority', "
    "'string', 'string', 'DIRECT', 0.7)) AS m(source_column, target_column, source_data_type, "
    "target_data_type, transformation_type, score)"
)


@_platform(
    "field_mappings",
    "SELECT source_column, target_column, source_data_type, target_data_type, transformation_type, "
    f"CAST(score AS DOUBLE) AS score, false AS ai_generated, false AS validated FROM {_MAPPED}",
)
def platform_field_mappings(rows):
    return rows.select(
        "source_column",
        "target_column",
        "source_data_type",
        "target_data_type",
        "transformation_type",
        F.col("confidence_score").alias("score"),
        "ai_generated",
        "validated",
    )


@_platform(
    "agent_mapping_history",
    "SELECT 'orders' AS source_schema, 'CURATED' AS target_schema, count(*) FILTER (WHERE transformation_type "
    "<> 'DIRECT') AS transformation_count, 4 AS dbt_models_generated, CAST(round(avg(score), 2) AS DOUBLE) "
    f"AS score, CAST(count(*) AS INT) AS fields FROM {_MAPPED}",
)
def platform_agent_mapping_history(rows):
    return rows.select(
        "source_schema",
        "target_schema",
        "transformation_count",
        "dbt_models_generated",
        F.col("mapping_confidence_score").alias("score"),
        F.json_array_length("field_mappings").alias("fields"),
    )


@_platform(
    "agent_metrics",
    "SELECT agent_name, metric_type, metric_unit, true AS given FROM (SELECT unnest(['PROFILING', "
    "'DICTIONARY', 'MAPPING']) AS agent_name), (VALUES ('EXECUTION_TIME', 'SECONDS'), ('SUCCESS_RATE', "
    "'BOOLEAN')) AS t(metric_type, metric_unit)",
)
def platform_agent_metrics(rows):
    succeeded = F.when(F.col("metric_type") == "SUCCESS_RATE", F.col("metric_value") == 1)
    return rows.select(
        "agent_name",
        "metric_type",
        "metric_unit",
        F.coalesce(succeeded, F.col("metric_value") >= 0).alias("given"),
    )


@query(
    "onboarding_curated",
    'SELECT CAST(o_orderkey AS VARCHAR) AS "O_ORDERKEY", o_custkey, o_orderstatus, '
    "CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority FROM orders",
)
def onboarding_curated(spark, sf_dir):
    store = _recorded(spark, sf_dir)
    curated = PartTable(spark, store.path("curated/orders")).read()
    return curated.select(
        "O_ORDERKEY",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderpriority",
    )
