"""Run-log analytics: status, duration, cost and metrics of onboarding runs.

The log is append-only. A *step* row is one execution of one step of a run; a *run* row
is the state of a run after all its events. All time windows take ``as_of`` so that
a report can be repeated; the bound is a literal, so it reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from berth.functions import quality

# States of a run and of a step, metric types and units, budget levels.
FINAL_STATES = ["COMPLETED", "FAILED", "CANCELLED"]
EXECUTION_TIME = ("EXECUTION_TIME", "SECONDS")
SUCCESS_RATE = ("SUCCESS_RATE", "BOOLEAN")
BUDGET_LEVELS = {"SUSPEND_IMMEDIATE": 100, "SUSPEND": 90, "NOTIFY": 75}


def instant(moment: dt.datetime) -> Column:
    """Timestamp literal without time zone."""
    return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'")


def since(as_of: dt.datetime, days: float = 0, hours: float = 0) -> Column:
    """Rows that started in the given span before ``as_of``."""
    return F.col("start_time") >= instant(as_of - dt.timedelta(days=days, hours=hours))


def _mean(column: str) -> Column:
    """Mean of an exact decimal, as a double; NULL over no values."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Newest row per key.

    The filter on the rank is applied in each task before the shuffle, so a key with
    a third of all rows sends one row per task.
    """
    order = [F.desc(c) for c in newest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def run_headers(steps: DataFrame) -> DataFrame:
    """One row per run: state after its last step, start, end, duration, error."""
    newest = F.struct("start_time", "execution_id")
    return (
        steps.groupBy("workflow_id")
        .agg(
            F.max_by("status", newest).alias("status"),
            F.min("start_time").alias("start_time"),
            F.max("start_time").alias("end_time"),
            F.sum("duration_seconds").alias("duration_seconds"),
            F.max_by("error_message", newest).alias("error_message"),
            F.count(F.lit(1)).alias("step_count"),
        )
        .withColumn("end_time", F.when(F.col("status").isin(FINAL_STATES), F.col("end_time")))
    )


def headers_since(
    steps: DataFrame, as_of: dt.datetime, days: float = 0, hours: float = 0
) -> DataFrame:
    """Headers of the runs that started in the span before ``as_of``.

    All steps of such a run lie in the span, so only these are aggregated, and the span reaches
    the scan. Of what is older just run and time are read, to leave out runs that had begun.
    """
    begun = F.col("start_time") < instant(as_of - dt.timedelta(days=days, hours=hours))
    recent = steps.filter(since(as_of, days, hours) | F.col("start_time").isNull())
    older = steps.filter(begun).select(F.col("workflow_id").alias("_begun")).distinct()
    started = recent.join(older, F.col("workflow_id").eqNullSafe(F.col("_begun")), "left_anti")
    return run_headers(started)


def lifecycle(events: DataFrame) -> DataFrame:
    """Current state of runs from status events (workflow_id, status, at, seq).

    The duration is the span of the events, and only final runs have an end.
    """
    newest = F.struct("at", "seq")
    state = events.groupBy("workflow_id").agg(
        F.max_by("status", newest).alias("status"),
        F.min("at").alias("started_at"),
        F.max("at").alias("last_event_at"),
        F.count(F.lit(1)).alias("events"),
    )
    span = F.timestamp_diff("SECOND", F.col("started_at"), F.col("last_event_at"))
    final = F.col("status").isin(FINAL_STATES)
    return state.withColumns(
        {
            "ended_at": F.when(final, F.col("last_event_at")),
            "duration_seconds": F.when(final, span),
        }
    ).drop("last_event_at")


def totals(runs: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Runs of the last days by state, in one row."""
    status = F.col("status")
    return runs.filter(since(as_of, days=days)).agg(
        F.count(F.lit(1)).alias("total_workflows"),
        F.count_if(status == "COMPLETED").alias("completed"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(status == "IN_PROGRESS").alias("in_progress"),
    )


def recent_summary(runs: DataFrame, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    """Distinct runs, mean duration and success rate of the last hours."""
    return runs.filter(since(as_of, hours=hours)).agg(
        F.count_distinct("workflow_id").alias("workflows_today"),
        _mean("duration_seconds").alias("avg_duration"),
        quality.success_rate(F.col("status")).alias("success_rate"),
    )


def active_agents(steps: DataFrame) -> DataFrame:
    return steps.agg(F.count_distinct("agent_name").alias("agent_count"))


def newest(df: DataFrame, n: int, by: Sequence[str], status: str | None = None) -> DataFrame:
    """The n newest rows, ties by the columns after the first in ``by``."""
    if status is not None:
        df = df.filter(F.col("status") == status)
    return df.orderBy(F.desc(by[0]), *[F.asc(c) for c in by[1:]]).limit(n)


def per_day(runs: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Runs per day and state."""
    return (
        runs.filter(since(as_of, days=days))
        .groupBy(F.date_trunc("day", "start_time").cast("timestamp_ntz").alias("day"), "status")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def monitor(
    runs: DataFrame,
    as_of: dt.datetime,
    statuses: Sequence[str],
    days: int,
    n: int = 50,
) -> DataFrame:
    """The n newest runs in some states within some days."""
    kept = runs.filter(F.col("status").isin(list(statuses)) & since(as_of, days=days))
    return newest(kept, n, ["start_time", "workflow_id"])


def with_steps(listed: DataFrame, steps: DataFrame) -> DataFrame:
    """Steps of the listed runs, in one join; the list is limited and so broadcast."""
    return steps.join(F.broadcast(listed.select("workflow_id")), "workflow_id")


def steps_of(steps: DataFrame, workflow_id: str) -> DataFrame:
    return steps.filter(F.col("workflow_id") == workflow_id).orderBy("start_time", "execution_id")


def status_of(runs: DataFrame, workflow_id: str) -> DataFrame:
    """Header of one run; no rows for an unknown id."""
    return runs.filter(F.col("workflow_id") == workflow_id)


def performance(runs: DataFrame, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    """Durations and outcomes of all runs of the last hours."""
    seconds = F.col("duration_seconds").cast("double")
    return runs.filter(since(as_of, hours=hours)).agg(
        F.count(F.lit(1)).alias("total_workflows"),
        _mean("duration_seconds").alias("avg_duration"),
        F.min(seconds).alias("min_duration"),
        F.max(seconds).alias("max_duration"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_count"),
    )


def performance_by_agent(
    steps: DataFrame, as_of: dt.datetime, hours: int = 1, with_total: bool = False
) -> DataFrame:
    """Executions, mean duration, tokens and success rate per agent, with a total row if asked."""
    kept = steps.filter(since(as_of, hours=hours))
    grouped = kept.rollup("agent_name") if with_total else kept.groupBy("agent_name")
    rows = grouped.agg(
        F.count(F.lit(1)).alias("execution_count"),
        _mean("duration_seconds").alias("avg_duration"),
        F.sum("tokens_used").alias("total_tokens"),
        quality.success_rate(F.col("status")).alias("success_rate"),
    )
    if with_total:
        rows = rows.withColumn("agent_name", F.coalesce("agent_name", F.lit("ALL")))
    return rows


def step_metrics(steps: DataFrame) -> DataFrame:
    """Two long rows per step: its duration and whether it succeeded."""

    def metric(kind: tuple[str, str], value: Column) -> Column:
        return F.struct(
            F.lit(kind[0]).alias("metric_type"),
            value.cast("decimal(18,4)").alias("metric_value"),
            F.lit(kind[1]).alias("metric_unit"),
        )

    return steps.select(
        "execution_id",
        "agent_name",
        F.col("start_time").alias("metric_timestamp"),
        F.lit("EXECUTION").alias("aggregation_period"),
        F.inline(
            F.array(
                metric(EXECUTION_TIME, F.col("duration_seconds")),
                metric(SUCCESS_RATE, (F.col("status") == "COMPLETED").cast("int")),
            )
        ),
    )


def metrics_of_runs(metrics: DataFrame, steps: DataFrame, runs: DataFrame) -> DataFrame:
    """Metric totals per agent over the steps of the given runs (semi joins, no copies)."""
    wanted = steps.join(runs.select("workflow_id"), "workflow_id", "left_semi")
    return (
        metrics.join(wanted.select("execution_id"), "execution_id", "left_semi")
        .groupBy("agent_name", "metric_type", "metric_unit")
        .agg(F.sum("metric_value").cast("double").alias("total_value"))
    )


def cost_by_agent(steps: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    return (
        steps.filter(since(as_of, days=days))
        .groupBy("agent_name")
        .agg(
            F.sum("tokens_used").alias("total_tokens"),
            _mean("tokens_used").alias("avg_tokens_per_execution"),
            F.sum("credits_used").cast("double").alias("total_credits"),
        )
    )


def calls_by_user(
    queries: DataFrame, pattern: str, as_of: dt.datetime, days: int = 7
) -> DataFrame:
    """Calls, successes and mean seconds per user from a query log, by LIKE pattern."""
    return (
        queries.filter(F.col("query_text").like(pattern) & since(as_of, days=days))
        .groupBy("user_name")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.count_if(F.col("execution_status") == "SUCCESS").alias("successful_calls"),
            (_mean("execution_ms") / 1000).alias("avg_duration_seconds"),
        )
    )


def latest_profiles(history: DataFrame, results: DataFrame, n: int = 20) -> DataFrame:
    """Newest profiles with the scores that belong to them.

    The left side is cut to n rows first; only results of those n ids are joined, so
    the results table is scanned once and never shuffled.
    """
    top = newest(history, n, ["created_at", "profile_id"])
    matching = results.join(F.broadcast(top.select("profile_id")), "profile_id", "left_semi")
    return newest(top.join(matching, "profile_id", "left"), n, ["created_at", "profile_id"])


def profile_checks(history: DataFrame, runs: DataFrame) -> DataFrame:
    """Payload fields of the profiles of some runs; the payloads are JSON texts."""
    kept = history.join(runs.select("workflow_id"), "workflow_id", "left_semi")
    return kept.select(
        "profile_id",
        "workflow_id",
        F.try_variant_get(
            F.try_parse_json("inferred_schema"), "$.column_count", "bigint"
        ).alias("column_count"),
        F.try_variant_get(F.try_parse_json("statistics"), "$.row_count", "bigint").alias(
            "row_count"
        ),
        F.size("pii_detected").alias("pii_columns_detected"),
    )


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one labelled row each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("records")).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def budget_levels(steps: DataFrame, quota: float) -> DataFrame:
    """Credits per day, their sum since the start of the month, and the level reached.

    Days are added up first, so a window holds the days of one month at most.
    """
    days = steps.groupBy(
        F.date_trunc("day", "start_time").cast("timestamp_ntz").alias("day")
    ).agg(F.sum("credits_used").alias("credits"))
    month = Window.partitionBy(F.date_trunc("month", "day")).orderBy("day")
    share = F.col("used") * F.lit(100.0) / F.lit(float(quota))
    level = reduce(
        lambda chain, item: chain.when(F.col("used_percentage") >= item[1], item[0]),
        BUDGET_LEVELS.items(),
        F.when(F.col("used_percentage").isNull(), F.lit(None)),
    ).otherwise("NONE")
    return (
        days.withColumn("used", F.sum("credits").over(month).cast("double"))
        .withColumn("used_percentage", share)
        .withColumn("credits", F.col("credits").cast("double"))
        .withColumn("level", level)
    )


def remove_runs(df: DataFrame, removed: DataFrame) -> DataFrame:
    """All rows except those of the removed runs."""
    return df.join(removed.select("workflow_id").distinct(), "workflow_id", "left_anti")


def step_sequence(steps: DataFrame) -> DataFrame:
    """Agents of each run in the order in which they first ran.

    Steps shrink to one row per run and agent on the map side; a list holds each agent
    of a run once.
    """
    first = steps.groupBy("workflow_id", "agent_name").agg(
        F.min(F.struct("start_time", "execution_id")).alias("first")
    )
    ordered = F.array_sort(F.collect_list(F.struct("first", "agent_name")))
    return first.groupBy("workflow_id").agg(
        F.transform(ordered, lambda s: s["agent_name"]).alias("agent_sequence")
    )


def step_positions(steps: DataFrame, parts: int = 64) -> DataFrame:
    """Position of every step within its run, by start time and then execution; NULLs first.

    Steps are counted per run and second; the seconds of a run are cut into up to ``parts``
    pieces of similar size, so a run with a third of all steps, in an hour or in a year, is
    spread over as many groups. Within a piece steps are numbered, and the steps before the
    piece are added. Rows without a run or a time take part.
    """
    second = F.date_trunc("second", "start_time")
    marked = steps.withColumns({"_run": F.col("workflow_id"), "_second": second})
    counts = marked.groupBy("_run", "_second").agg(F.count(F.lit(1)).alias("_size"))
    within = Window.partitionBy("_run").orderBy("_second")
    total = F.sum("_size").over(Window.partitionBy("_run"))
    seconds = counts.select(
        F.col("_run").alias("_own_run"),
        F.col("_second").alias("_own_second"),
        (F.sum("_size").over(within) - F.col("_size")).alias("_before"),
        total.alias("_total"),
    ).withColumn("_piece", F.floor(F.col("_before") * parts / F.col("_total")))
    first = F.min("_before").over(Window.partitionBy("_own_run", "_piece"))
    seconds = seconds.withColumn("_offset", first).drop("_before", "_total")
    same = F.col("_run").eqNullSafe(F.col("_own_run")) & F.col("_second").eqNullSafe(
        F.col("_own_second")
    )
    inside = Window.partitionBy("_run", "_piece").orderBy("start_time", "execution_id")
    return (
        marked.join(seconds, same)
        .withColumn("position", F.col("_offset") + F.row_number().over(inside))
        .drop("_run", "_second", "_own_run", "_own_second", "_piece", "_offset")
    )


def rows_of_runs(history: DataFrame, runs: DataFrame, key: str = "workflow_id") -> DataFrame:
    """History rows that belong to the given runs, several per run if there are."""
    return history.join(runs.select(key).distinct(), key, "left_semi")
