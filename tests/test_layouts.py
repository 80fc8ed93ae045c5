"""The platform tables take rows, and the usual checks run on them as Spark SQL."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from berth.operators import mapping as mp
from berth.operators import runlog as log
from berth.plans import runlog
from berth.session import scratch_dir
from berth.sources import layouts


@pytest.fixture(scope="module")
def database(spark):
    name = f"platform_{uuid.uuid4().hex[:8]}"
    layouts.create_tables(spark, scratch_dir(spark, "platform"), name)
    return name


def test_every_table_exists_and_is_empty(spark, database):
    assert len(layouts.LAYOUTS) == 10
    for name in layouts.LAYOUTS:
        assert spark.table(f"{database}.{name}").count() == 0


def test_defaults_and_required_columns(spark, database):
    rows = spark.createDataFrame([("ONBOARDING", "stage/a.csv")], "workflow_type string, source_stage_path string")
    layouts.insert_rows(rows, database, "workflow_executions")
    row = spark.table(f"{database}.workflow_executions").collect()[0]
    assert row["status"] == "INITIATED" and len(row["workflow_id"]) == 36
    assert row["start_time"] is not None and row["end_time"] is None
    with pytest.raises(ValueError):
        layouts.conform(rows.drop("workflow_type"), "workflow_executions")
    empty = spark.createDataFrame([(None, "x")], "workflow_type string, source_stage_path string")
    with pytest.raises(PySparkException):
        layouts.conform(empty, "workflow_executions").collect()


def test_log_queries_as_sql(spark, database, sf_dir):
    steps = runlog.steps(spark, sf_dir).withColumn("execution_id", F.col("execution_id").cast("string"))
    layouts.insert_rows(steps.drop("user_id", "props"), database, "agent_execution_log")
    by_sql = spark.sql(
        f"SELECT agent_name, count(*) AS execution_count, sum(tokens_used) AS total_tokens "
        f"FROM {database}.agent_execution_log WHERE start_time >= TIMESTAMP_NTZ '2024-01-24' "
        "GROUP BY agent_name"
    )
    ours = log.performance_by_agent(spark.table(f"{database}.agent_execution_log"), runlog.AS_OF, hours=168)
    assert {tuple(r) for r in by_sql.collect()} == {
        (r["agent_name"], r["execution_count"], r["total_tokens"]) for r in ours.collect()
    }


def test_mappings_are_stored(spark, database, sf_dir):
    source = mp.source_columns(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    rows = mp.with_defaults(mp.match_columns(source, source), F.lit("m1"))
    layouts.insert_rows(rows, database, "field_mappings")
    stored = spark.table(f"{database}.field_mappings")
    assert stored.count() == 5
    assert {r["validated"] for r in stored.collect()} == {False}
