"""Filling the platform tables: what a run leaves for dashboards and checks that read by name.

The rows of a run are made from what its steps have written to the store; only the run's own facts
(ids, times, states, counts of its summaries) come from the driver. Each table is a folder of
its layout, with one part per run, so a run that is recorded again replaces nothing of others.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.operators import mapping as mp
from berth.operators import runlog as log
from berth.operators.layout import local_rows
from berth.sources import layouts

#: Fixed value: what is said of a profile with issues.
RECOMMENDATION = "%s: %s"


@dataclass
class Step:
    """One step of a run, as its log rows tell it."""

    agent: str
    execution_id: str
    started: dt.datetime
    ended: dt.datetime | None = None
    status: str = "RUNNING"
    error: str | None = None
    given: dict = field(default_factory=dict)
    result: dict = field(default_factory=dict)


@dataclass
class Run:
    """The facts of a run."""

    workflow_id: str
    workflow_type: str
    path: str
    file_format: str
    table: str
    source_system: str
    target_schema: str
    started: dt.datetime
    ended: dt.datetime | None = None
    status: str = "INITIATED"
    error: str | None = None
    steps: list[Step] = field(default_factory=list)

    def step(self, agent: str) -> Step | None:
        return next((s for s in self.steps if s.agent == agent), None)

    @property
    def file_name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]

    def id_of(self, kind: str) -> str:
        """Id of what the run has one of, such as its profile."""
        return f"{kind}-{self.workflow_id}"


def platform_path(store, table: str) -> str:
    return store.path(f"platform/{table}")


def read_table(store, table: str) -> DataFrame:
    """A platform table over all runs."""
    layout = layouts.LAYOUTS[table]
    return store.spark.read.schema(layout).parquet(platform_path(store, table)).select(
        *(c.split(" ")[0] for c in _columns(layout))
    )


def _columns(layout: str) -> list[str]:
    # Types such as decimal(10,2) have commas too, but no blank behind them.
    return layout.split(", ")


def _span(start: dt.datetime, end: dt.datetime | None) -> float | None:
    return None if end is None else (end - start).total_seconds()


def _when(moment: dt.datetime | None) -> str | None:
    return None if moment is None else f"{moment:%Y-%m-%d %H:%M:%S.%f}"


def _run_rows(store, run: Run) -> DataFrame:
    row = (
        run.workflow_id, run.workflow_type, run.path, run.file_name, run.target_schema, run.status,
        _when(run.started), _when(run.ended), _span(run.started, run.ended), run.error,
        ",".join(s.agent for s in run.steps),
    )
    rows = local_rows(
        store.spark,
        [row],
        "workflow_id string, workflow_type string, source_stage_path string, source_file_name string, "
        "target_schema string, status string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "duration_seconds decimal(10,2), error_message string, agents string",
    )
    return rows.withColumn("agent_sequence", F.split("agents", ","))


def _step_rows(store, run: Run) -> DataFrame:
    rows = [
        (
            s.execution_id, run.workflow_id, s.agent, s.status, _when(s.started), _when(s.ended),
            _span(s.started, s.ended), json.dumps(s.given), json.dumps(s.result), s.error,
        )
        for s in run.steps
    ]
    return local_rows(
        store.spark,
        rows,
        "execution_id string, workflow_id string, agent_name string, status string, "
        "start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds decimal(10,2), "
        "input_params string, output_result string, error_message string",
    )


def _with_run(df: DataFrame, run: Run, **more) -> DataFrame:
    values = {"workflow_id": run.workflow_id} | more
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def _profile_rows(run: Run, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    step = run.step("PROFILING")
    at = log.instant(step.ended or step.started)
    history = frames["history"]
    issues = (
        F.transform("data_quality_issues", lambda x: F.to_json(x))
        if "data_quality_issues" in history.columns
        else F.lit(None).cast("array<string>")
    )
    kept = _with_run(
        history,
        run,
        profile_id=run.id_of("profile"),
        execution_id=step.execution_id,
        source_stage_path=run.path,
        source_file_name=run.file_name,
        sample_size=F.col("statistics.row_count"),
        profiling_summary=step.result.get("summary"),
        created_at=at,
    ).withColumns(
        {
            "data_quality_issues": F.coalesce(issues, F.array().cast("array<string>")),
            "inferred_schema": F.to_json("inferred_schema"),
            "statistics": F.to_json("statistics"),
        }
    )
    listed = frames["issues"].groupBy("table_name").agg(
        F.array_sort(
            F.collect_set(F.format_string(RECOMMENDATION, "column_name", "issue_type"))
        ).alias("recommendations")
    )
    sizes = frames["history"].select(
        "table_name",
        F.col("statistics.row_count").alias("row_count"),
        F.to_json("inferred_schema").alias("schema_proposal"),
        F.to_json("statistics.columns").alias("column_statistics"),
    )
    shown = frames["result"].select("table_name", "data_quality_score", "pii_risk_level")
    shown = shown.join(sizes, "table_name", "left").join(listed, "table_name", "left")
    columns = F.get_json_object("schema_proposal", "$.column_count").cast("bigint")
    results = _with_run(
        shown,
        run,
        profile_id=run.id_of("profile"),
        source_file_name=run.file_name,
        file_format=run.file_format,
        column_count=columns,
        created_at=at,
    )
    return {"agent_profiling_history": kept, "profiling_results": results}


def _dictionary_rows(run: Run, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    step = run.step("DICTIONARY")
    at = log.instant(step.ended or step.started)
    proposals = _with_run(
        frames["ddl"],
        run,
        proposal_id=run.id_of("proposal"),
        source_name=run.file_name,
        proposed_table_name=F.col("table_name"),
        source_ddl=F.col("ddl"),
        landing_ddl=F.col("ddl"),
        approval_status="PENDING",
        created_at=at,
    )
    entries = frames["dictionary"].withColumn("created_by", F.current_user())
    history = _with_run(
        frames["ddl"].groupBy().agg(
            F.count("*").cast("int").alias("table_count"), F.sum("column_count").alias("column_count")
        ),
        run,
        dictionary_id=run.id_of("dictionary"),
        execution_id=step.execution_id,
        profile_id=run.id_of("profile"),
        proposal_id=run.id_of("proposal"),
        source_system=run.source_system,
        ddl_generated=True,
        dictionary_enriched=True,
        created_at=at,
    )
    return {
        "ddl_proposals": proposals,
        "enterprise_data_dictionary": entries,
        "agent_dictionary_history": history,
    }


def _mapping_rows(run: Run, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    step = run.step("MAPPING")
    at = log.instant(step.ended or step.started)
    mapping_id = run.id_of("mapping")
    fields = mp.with_defaults(frames["mappings"], F.lit(mapping_id)).withColumn("created_at", at)
    changed = F.count_if(F.col("transformation_type") != "DIRECT").alias("transformation_count")
    pairs = F.to_json(
        F.array_sort(F.collect_list(F.struct("ordinal", "source_column", "target_column", "transformation_type")))
    )
    history = _with_run(
        mp.confidence(frames["mappings"], changed, pairs.alias("field_mappings")),
        run,
        mapping_id=mapping_id,
        execution_id=step.execution_id,
        dictionary_id=run.id_of("dictionary"),
        source_schema=run.table,
        target_schema=run.target_schema,
        dbt_models_generated=step.result.get("models"),
        mapping_confidence_score=F.col("confidence"),
        created_at=at,
    )
    return {"field_mappings": fields, "agent_mapping_history": history}


def record(store, run: Run, frames: dict[str, DataFrame]) -> None:
    """Write the rows of a run that has ended to the platform tables. Of a failed run there are
    its header, its steps and what its completed steps found."""
    rows = {"workflow_executions": _run_rows(store, run)}
    if run.steps:
        rows["agent_execution_log"] = _step_rows(store, run)
    kinds = {"PROFILING": _profile_rows, "DICTIONARY": _dictionary_rows, "MAPPING": _mapping_rows}
    for agent, make in kinds.items():
        step = run.step(agent)
        if step is not None and step.status == "COMPLETED":
            rows |= make(run, frames)
    if "metrics" in frames:
        rows["agent_metrics"] = frames["metrics"]
    for table, df in rows.items():
        layouts.conform(df, table).write.mode("overwrite").parquet(
            f"{platform_path(store, table)}/run={run.workflow_id}"
        )
