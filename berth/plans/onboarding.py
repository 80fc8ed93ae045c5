"""Onboarding of one input: profile, dictionary, mapping and load, with a run log.

The driver only calls the Spark steps in order. What a step finds is written to the store
and read from there by the next one, so nothing is computed twice and nothing but schemas,
plans of columns and log rows passes through the driver.
"""

from __future__ import annotations

import datetime as dt
import decimal
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.functions import summary as texts
from berth.operators import dictionary as dic
from berth.operators import load
from berth.operators import mapping as mp
from berth.operators import profile as prof
from berth.operators import runlog as log
from berth.operators import sensitive as sens
from berth.operators.layout import local_rows
from berth.operators.parts import PartTable
from berth.operators.profile import quoted, tick
from berth.plans import platform
from berth.sources import readers, sinks

# Kinds of runs with their steps, and the layers of a load.
ONBOARDING = "ONBOARDING"
PROFILING_ONLY = "PROFILING_ONLY"
MAPPING_ONLY = "MAPPING_ONLY"
RUN_STEPS = {
    ONBOARDING: ["PROFILING", "DICTIONARY", "MAPPING"],
    PROFILING_ONLY: ["PROFILING"],
    MAPPING_ONLY: ["MAPPING"],
}
LAYERS = ["staging", "intermediate", "curated"]
LOADED_AT = "loaded_at"
#: Parts of a curated table that a run creates.
CURATED_PARTS = 64

LOG_LAYOUT = (
    "workflow_id string, execution_id string, workflow_type string, agent_name string, "
    "status string, start_time timestamp_ntz, duration_seconds decimal(10,2), "
    "tokens_used bigint, credits_used decimal(10,4), error_message string, summary string, "
    "source_path string, target_schema string"
)


@dataclass
class Outcome:
    """What a run produced; the frames are read from the store."""

    workflow_id: str
    status: str
    summary: str
    frames: dict[str, DataFrame] = field(default_factory=dict)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Store:
    """Folders of the platform tables below one base path."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def append(self, name: str, df: DataFrame, workflow_id: str) -> DataFrame:
        """Append the rows of a run in its own partition and read them back."""
        path = f"{self.path(name)}/run={workflow_id}"
        sinks.append_rows(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def holds(self, name: str) -> bool:
        """Whether anything has been written under the name."""
        try:
            return bool(self.read(name).columns)
        except AnalysisException:
            return False

    def log(self, **values) -> None:
        row = {part.split(" ")[0]: None for part in LOG_LAYOUT.split(", ")}
        row.update({name: None if v is None else str(v) for name, v in values.items()})
        df = local_rows(self.spark, [tuple(row.values())], LOG_LAYOUT)
        sinks.append_rows(df, self.path("log"))

    def log_rows(self) -> DataFrame:
        return self.spark.read.schema(LOG_LAYOUT).parquet(self.path("log"))


def onboard(
    spark: SparkSession,
    store: Store,
    path: str,
    file_format: str = readers.CSV_FORMAT,
    target: DataFrame | None = None,
    target_schema: str = "CURATED",
    workflow_type: str = ONBOARDING,
    source_system: str = "lake",
    table_name: str | None = None,
    keys: Sequence[str] = (),
    load_column: str | None = None,
) -> Outcome:
    """Run the steps of one kind of onboarding over a whole input, and fill the platform tables.

    ``target`` holds the column rows of the target table; without it new names are suggested.
    With ``keys`` (target columns) the mapping step also merges what it loaded into the curated
    table of that name, by parts: rows beyond the mark of ``load_column``, or all without one; and
    it tests its keys. A step that fails ends the run; both are logged as FAILED.
    """
    if workflow_type not in RUN_STEPS:
        raise ValueError(f"unknown workflow type {workflow_type}")
    workflow_id = uuid.uuid4().hex
    table = table_name or path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
    common = {
        "workflow_id": workflow_id,
        "workflow_type": workflow_type,
        "source_path": path,
        "target_schema": target_schema,
    }
    frames: dict[str, DataFrame] = {}

    def profiling(df: DataFrame) -> str:
        tables = {table: df}
        frames["profile"] = store.append("profiles", prof.profile_tables(tables), workflow_id)
        frames["findings"] = store.append("findings", sens.value_findings(tables), workflow_id)
        frames["issues"] = store.append(
            "issues", prof.quality_issues(frames["profile"]), workflow_id
        )
        named = sens.name_findings(frames["profile"])
        frames["history"] = store.append(
            "profiling_history",
            prof.history_rows(frames["profile"], named, frames["issues"]),
            workflow_id,
        )
        result = prof.quality_score(frames["profile"], by=["table_name"]).join(
            sens.table_risk(named).drop("column_count"), "table_name"
        )
        frames["result"] = store.append("results", result, workflow_id)
        return texts.PROFILE_TEXT % len(df.columns)

    def dictionary(df: DataFrame) -> str:
        found = frames["findings"].select("table_name", "column_name", "label")
        types = dic.narrow_types({table: df}).join(
            F.broadcast(found), ["table_name", "column_name"], "left"
        )
        columns = store.append("types", types, workflow_id)
        frames["ddl"] = store.append(
            "proposals",
            dic.ddl_texts(columns, "LAKE", "STAGING", "proposed_type"),
            workflow_id,
        )
        entries = dic.dictionary_rows(
            columns.select("table_name", "column_name", "data_type"),
            frames["findings"],
            source_system,
        ).select(*dic.DICTIONARY_KEY, *dic.UPDATED_FIELDS)
        now = log.instant(_now())
        rows = entries.withColumns({"created_at": now, "updated_at": now})
        if store.holds("dictionary"):
            # Known columns keep the day they were first seen.
            merged = dic.upsert_dictionary(dictionary_state(store), entries, now)
            rows = merged.join(entries.select(*dic.DICTIONARY_KEY), dic.DICTIONARY_KEY, "left_semi")
        frames["dictionary"] = store.append("dictionary", rows, workflow_id)
        return texts.PROPOSAL_TEXT % (table, len(df.columns))

    def mapping(df: DataFrame) -> str:
        source = mp.source_columns(df)
        known = target if target is not None else source.limit(0)
        matched = mp.match_columns(source, known)
        frames["mappings"] = store.append("mappings", matched, workflow_id)
        mapped = mp.apply_mapping(df, mp.cast_plan(frames["mappings"]))
        rules = {"casts succeed": F.size("cast_errors") == 0}
        rules |= {f"{k} is given": quoted(k).isNotNull() for k in keys}
        flagged = store.append(
            "intermediate", load.flag_validity(mapped, rules), workflow_id
        )
        frames["loaded"] = load.clean_rows(flagged).drop("cast_errors")
        frames["rejected"] = load.reject_rows(flagged)
        if keys:
            frames["curated"] = _curated(store, table, frames["loaded"], keys, load_column).read()
            tests = dic.not_null_test(frames["loaded"], table, mp.target_names(frames["mappings"]))
            tests = tests.unionByName(dic.unique_test(frames["curated"], table, list(keys)))
            frames["tests"] = store.append("tests", tests, workflow_id)
        return texts.MAPPING_TEXT % (len(df.columns), len(LAYERS) + 1)

    steps: dict[str, Callable[[DataFrame], str]] = {
        "PROFILING": profiling,
        "DICTIONARY": dictionary,
        "MAPPING": mapping,
    }
    started = _now()
    run = platform.Run(
        workflow_id, workflow_type, path, file_format, table, source_system, target_schema, started
    )
    store.log(**common, status="INITIATED", start_time=started)
    done: list[str] = []
    df: DataFrame | None = None
    for agent in RUN_STEPS[workflow_type]:
        step = {**common, "agent_name": agent, "execution_id": uuid.uuid4().hex}
        begun = _now()
        told = platform.Step(agent, step["execution_id"], begun, given={"path": path, "format": file_format})
        run.steps.append(told)
        store.log(**step, status="RUNNING", start_time=begun)
        try:
            if df is None:
                df = readers.read_staged(spark, path, file_format)
                if file_format != readers.PARQUET_FORMAT:
                    # Text is parsed once; all steps read typed columns.
                    df = store.append("landing", df, workflow_id)
            summary = steps[agent](df)
        except Exception as error:
            reason = sinks.ERROR_SUMMARY % sinks.error_condition(error)
            store.log(
                **step,
                status="FAILED",
                start_time=_now(),
                duration_seconds=_seconds(begun),
                error_message=reason,
                summary=reason,
            )
            store.log(
                **common,
                status="FAILED",
                start_time=_now(),
                duration_seconds=_seconds(started),
                error_message=reason,
                summary=reason,
            )
            told.ended = run.ended = _now()
            told.status = run.status = "FAILED"
            told.error = run.error = reason
            platform.record(store, run, frames)
            return Outcome(workflow_id, "FAILED", reason, frames)
        store.log(
            **step,
            status="COMPLETED",
            start_time=_now(),
            duration_seconds=_seconds(begun),
            summary=summary,
        )
        told.ended, told.status = _now(), "COMPLETED"
        told.result = {"summary": summary, "columns": len(df.columns)}
        if agent == "MAPPING":
            told.result["models"] = len(LAYERS) + 1
        done.append(agent)
    steps_done = step_states(store).filter(F.col("workflow_id") == workflow_id)
    frames["metrics"] = store.append("metrics", log.step_metrics(steps_done), workflow_id)
    summary = texts.RUN_TEXT % len(done)
    store.log(
        **common,
        status="COMPLETED",
        start_time=_now(),
        duration_seconds=_seconds(started),
        summary=summary,
    )
    run.ended, run.status = _now(), "COMPLETED"
    platform.record(store, run, frames)
    return Outcome(workflow_id, "COMPLETED", summary, frames)


def _curated(
    store: Store, table: str, rows: DataFrame, keys: Sequence[str], load_column: str | None
) -> PartTable:
    """The curated table after merging what a run has loaded."""
    base = store.path(f"curated/{table}")
    curated = PartTable(store.spark, base)
    if not curated.states.numbers():
        curated = PartTable.create(store.spark, base, rows.schema, keys, CURATED_PARTS, load_column)
    curated.widen(rows.schema)
    if load_column:
        curated.load(rows, inclusive=True)
    else:
        # The run is the version: all its rows take over.
        curated.merge(rows, [LOADED_AT])
    return curated


def decide(store: Store, proposal_id: str, decision: str, by: str) -> None:
    """Add a decision on a DDL proposal."""
    if decision not in dic.DECISIONS:
        raise ValueError(f"unknown decision {decision}")
    now = _now()
    row = local_rows(
        store.spark,
        [(proposal_id, decision, by, f"{now:%Y-%m-%d %H:%M:%S.%f}", int(now.timestamp() * 1e6))],
        "proposal_id string, decision string, decided_by string, decided_at timestamp_ntz, seq bigint",
    )
    sinks.append_rows(row, store.path("decisions"))


def proposals(store: Store) -> DataFrame:
    """All DDL proposals with their newest decision."""
    given = platform.read_table(store, "ddl_proposals").drop("approval_status", "approved_by", "approved_at")
    if not store.holds("decisions"):
        layout = "proposal_id string, decision string, decided_by string, decided_at timestamp_ntz, seq bigint"
        return dic.proposal_state(given, store.spark.createDataFrame([], layout))
    return dic.proposal_state(given, store.read("decisions"))


def execute_proposal(store: Store, proposal_id: str, df: DataFrame) -> DataFrame:
    """Create the landing table of an approved proposal from its input, if every cell fits the
    proposed types; a proposal that is not approved, or an input that does not fit, is an error."""
    states = dic.executable(proposals(store)).filter(F.col("proposal_id") == proposal_id)
    found = states.select("workflow_id", "proposed_table_name").collect()
    if not found:
        raise ValueError(f"proposal {proposal_id} is not approved")
    workflow_id, name = found[0]
    # One row per column of the table.
    types = store.spark.read.parquet(f"{store.path('types')}/run={workflow_id}").orderBy("ordinal")
    proposed = [(r["column_name"], r["proposed_type"]) for r in types.collect()]
    ddl = ", ".join(f"{tick(c)} {t}" for c, t in proposed)
    bad = dic.conformity(df, ddl).filter("NOT passed").select("column_name").collect()
    if bad:
        raise ValueError(f"{name} does not fit its proposal: {', '.join(r[0] for r in bad)}")
    typed = df.select(*(quoted(c).cast(t).alias(c) for c, t in proposed))
    return load.write_snapshot(typed, store.path(f"landing_tables/{name}/{proposal_id}"))


def _seconds(since: dt.datetime) -> decimal.Decimal:
    return decimal.Decimal(f"{(_now() - since).total_seconds():.2f}")


def workflow_states(store: Store) -> DataFrame:
    """Current state of every run in the store."""
    headers = store.log_rows().filter(F.col("agent_name").isNull())
    return log.latest(headers, ["workflow_id"], ["start_time"])


def workflow_status(store: Store, workflow_id: str) -> DataFrame:
    """State of one run; no rows for an unknown id."""
    return log.status_of(workflow_states(store), workflow_id)


def list_workflows(store: Store, n: int = 10, status: str | None = None) -> DataFrame:
    return log.newest(workflow_states(store), n, ["start_time", "workflow_id"], status)


def step_states(store: Store) -> DataFrame:
    """Current state of every step in the store."""
    steps = store.log_rows().filter(F.col("agent_name").isNotNull())
    return log.latest(steps, ["execution_id"], ["start_time"])


def dictionary_state(store: Store) -> DataFrame:
    """Newest entry per column over all runs."""
    return log.latest(store.read("dictionary"), dic.DICTIONARY_KEY, ["updated_at"]).drop("run")
