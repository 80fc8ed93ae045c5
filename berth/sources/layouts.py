"""Layouts of the platform tables, and creating them as Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables and columns that dashboards and checks read by name.
LAYOUTS = {
    "enterprise_data_dictionary": (
        "dict_id string, source_system string, table_name string, column_name string, "
        "data_type string, description string, business_name string, is_pii boolean, "
        "is_phi boolean, pii_type string, data_classification string, "
        "sample_values array<string>, validation_rules array<string>, constraints string, "
        "synonyms array<string>, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "created_by string, tags map<string,string>, metadata string"
    ),
    "ddl_proposals": (
        "proposal_id string, workflow_id string, source_name string, "
        "proposed_table_name string, source_ddl string, landing_ddl string, schema_json string, "
        "ai_confidence_score double, approval_status string, approved_by string, "
        "approved_at timestamp_ntz, created_at timestamp_ntz, metadata string"
    ),
    "workflow_executions": (
        "workflow_id string, workflow_type string, source_stage_path string, "
        "source_file_name string, target_schema string, status string, "
        "start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds decimal(10,2), "
        "initiated_by string, error_message string, agent_sequence array<string>, "
        "metadata string"
    ),
    "agent_execution_log": (
        "execution_id string, workflow_id string, agent_name string, agent_version string, "
        "status string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "duration_seconds decimal(10,2), input_params string, output_result string, "
        "error_message string, error_stack string, tokens_used bigint, "
        "credits_used decimal(10,4), metadata string"
    ),
    "agent_profiling_history": (
        "profile_id string, workflow_id string, execution_id string, "
        "source_stage_path string, source_file_name string, sample_size bigint, "
        "inferred_schema string, statistics string, pii_detected array<string>, "
        "phi_detected array<string>, data_quality_issues array<string>, "
        "synonym_suggestions string, profiling_summary string, created_at timestamp_ntz, "
        "metadata string"
    ),
    "agent_dictionary_history": (
        "dictionary_id string, workflow_id string, execution_id string, profile_id string, "
        "proposal_id string, source_system string, table_count int, column_count bigint, "
        "ddl_generated boolean, dictionary_enriched boolean, external_api_called boolean, "
        "created_at timestamp_ntz, metadata string"
    ),
    "agent_mapping_history": (
        "mapping_id string, workflow_id string, execution_id string, dictionary_id string, "
        "source_schema string, target_schema string, field_mappings string, "
        "transformation_count bigint, dbt_models_generated int, dbt_project_path string, "
        "mapping_confidence_score double, created_at timestamp_ntz, metadata string"
    ),
    "field_mappings": (
        "mapping_detail_id string, mapping_id string, source_column string, "
        "target_column string, source_data_type string, target_data_type string, "
        "transformation_logic string, transformation_type string, business_rule string, "
        "ai_generated boolean, confidence_score double, validated boolean, "
        "validated_by string, created_at timestamp_ntz"
    ),
    "agent_metrics": (
        "metric_id string, metric_timestamp timestamp_ntz, agent_name string, "
        "execution_id string, metric_type string, metric_value decimal(18,4), "
        "metric_unit string, aggregation_period string, metadata string"
    ),
    "profiling_results": (
        "result_id string, profile_id string, workflow_id string, source_file_name string, "
        "file_size_bytes bigint, file_format string, row_count bigint, column_count bigint, "
        "schema_proposal string, column_statistics string, data_quality_score decimal(5,2), "
        "pii_risk_level string, recommendations array<string>, created_at timestamp_ntz"
    ),
}

# Columns that must be given, and what an omitted column becomes.
REQUIRED = {
    "enterprise_data_dictionary": ["source_system", "table_name", "column_name", "data_type"],
    "ddl_proposals": [
        "workflow_id",
        "source_name",
        "proposed_table_name",
        "source_ddl",
        "landing_ddl",
    ],
    "workflow_executions": ["workflow_type", "source_stage_path"],
    "agent_execution_log": ["workflow_id", "agent_name"],
    "agent_profiling_history": ["workflow_id", "execution_id", "source_stage_path"],
    "agent_dictionary_history": ["workflow_id", "execution_id", "profile_id"],
    "agent_mapping_history": [
        "workflow_id",
        "execution_id",
        "dictionary_id",
        "source_schema",
        "target_schema",
    ],
    "field_mappings": [
        "mapping_id",
        "source_column",
        "target_column",
        "source_data_type",
        "target_data_type",
    ],
    "agent_metrics": ["agent_name", "metric_type"],
    "profiling_results": ["profile_id", "workflow_id"],
}
DEFAULTS = {
    "is_pii": False,
    "is_phi": False,
    "approval_status": "PENDING",
    "agent_version": "v1.0",
    "ddl_generated": False,
    "dictionary_enriched": False,
    "external_api_called": False,
    "validated": False,
}
DEFAULT_STATUS = {"workflow_executions": "INITIATED", "agent_execution_log": "RUNNING"}
MADE_AT = ["created_at", "updated_at", "start_time", "metric_timestamp"]
MADE_BY = ["created_by", "initiated_by"]


def _default(table: str, position: int, column: T.StructField) -> Column:
    if position == 0:
        return F.uuid()
    if column.name == "status":
        return F.lit(DEFAULT_STATUS[table])
    if column.name in MADE_AT:
        return F.localtimestamp()
    if column.name in MADE_BY:
        return F.current_user()
    return F.lit(DEFAULTS.get(column.name))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Bring rows to the layout of a platform table.

    Omitted columns take their defaults; a missing required column is an error, and so is a
    NULL in one when the row is written.
    """
    fields = T.StructType.fromDDL(LAYOUTS[table]).fields
    missing = [c for c in REQUIRED[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{table} needs {', '.join(missing)}")
    columns = []
    for i, f in enumerate(fields):
        value = F.col(f.name) if f.name in df.columns else _default(table, i, f)
        value = value.cast(f.dataType)
        if f.name in REQUIRED[table]:
            message = F.lit(f"{table}.{f.name} must not be NULL")
            value = F.when(value.isNull(), F.raise_error(message)).otherwise(value)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def create_tables(spark: SparkSession, base: str, database: str) -> None:
    """Create the platform tables of a database below a base path."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
    for name, layout in LAYOUTS.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({layout}) USING parquet "
            f"LOCATION '{base.rstrip('/')}/{name}'"
        )


def insert_rows(df: DataFrame, database: str, table: str) -> None:
    """Append rows to a platform table, with defaults filled in."""
    conform(df, table).write.insertInto(f"{database}.{table}")
