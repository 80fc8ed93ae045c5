"""Run-log queries. The events table stands in for the log; a run is one user's day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from berth.operators import runlog as log
from berth.plans.registry import TABLE_NAMES, query, table, tables

AS_OF = dt.datetime(2024, 1, 31)
QUOTA = 1000.0


def steps(spark, sf_dir):
    """Step rows of the log."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS execution_id",
        "concat(CAST(user_id AS STRING), '-', date_format(ts, 'yyyyMMdd')) AS workflow_id",
        "CASE event_id % 3 WHEN 0 THEN 'PROFILING' WHEN 1 THEN 'DICTIONARY' ELSE 'MAPPING' END "
        "AS agent_name",
        "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'IN_PROGRESS' "
        "ELSE 'COMPLETED' END AS status",
        "ts AS start_time",
        "CAST(value AS DECIMAL(10,2)) AS duration_seconds",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS tokens_used",
        "CAST(CAST(get_json_object(props, '$.k') AS BIGINT) * 0.001 AS DECIMAL(10,4)) "
        "AS credits_used",
        "CASE WHEN event_type = 'error' THEN concat('step ', CAST(event_id AS STRING)) END "
        "AS error_message",
        "user_id",
        "props",
    )


def runs(spark, sf_dir):
    return log.run_headers(steps(spark, sf_dir))


def started(spark, sf_dir, days=0, hours=0):
    """Runs that started in the span before AS_OF."""
    return log.headers_since(steps(spark, sf_dir), AS_OF, days, hours)


_STEPS = (
    "steps AS (SELECT event_id AS execution_id, concat(CAST(user_id AS VARCHAR), '-', "
    "strftime(ts, '%Y%m%d')) AS workflow_id, CASE event_id % 3 WHEN 0 THEN 'PROFILING' WHEN 1 "
    "THEN 'DICTIONARY' ELSE 'MAPPING' END AS agent_name, CASE event_type WHEN 'error' THEN "
    "'FAILED' WHEN 'signup' THEN 'IN_PROGRESS' ELSE 'COMPLETED' END AS status, ts AS start_time, "
    "CAST(value AS DECIMAL(10,2)) AS duration_seconds, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens_used, "
    "CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 0.001 AS DECIMAL(10,4)) "
    "AS credits_used, CASE WHEN event_type = 'error' THEN concat('step ', "
    "CAST(event_id AS VARCHAR)) END AS error_message, user_id, props FROM events)"
)
_RUNS = (
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY workflow_id ORDER BY start_time DESC, "
    "execution_id DESC) AS rn FROM steps), runs AS (SELECT workflow_id, "
    "max(CASE WHEN rn = 1 THEN status END) AS status, min(start_time) AS start_time, "
    "CASE WHEN max(CASE WHEN rn = 1 THEN status END) <> 'IN_PROGRESS' THEN max(start_time) END "
    "AS end_time, sum(duration_seconds) AS duration_seconds, "
    "max(CASE WHEN rn = 1 THEN error_message END) AS error_message, count(*) AS step_count "
    "FROM ranked GROUP BY workflow_id)"
)
_WITH = f"WITH {_STEPS}, {_RUNS} "
_MEAN = "CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds)"
_RATE = "CAST(count(*) FILTER (WHERE status = 'COMPLETED') AS DOUBLE) * 100.0::DOUBLE / count(*)"


def _from(span: str) -> str:
    return f"start_time >= TIMESTAMP '2024-01-31' - INTERVAL {span}"


_RUN_COLUMNS = [
    "workflow_id",
    "status",
    "start_time",
    "end_time",
    "duration_seconds",
    "error_message",
    "step_count",
]
_RUN_SELECT = (
    "workflow_id, status, start_time, end_time, CAST(duration_seconds AS DOUBLE) "
    "AS duration_seconds, error_message, step_count"
)


def shown(df):
    """Run rows with the duration as a double."""
    return df.select(_RUN_COLUMNS).withColumn(
        "duration_seconds", F.col("duration_seconds").cast("double")
    )


@query("run_headers", f"{_WITH} SELECT {_RUN_SELECT} FROM runs")
def run_headers(spark, sf_dir):
    return shown(runs(spark, sf_dir))


@query(
    "run_current",
    f"{_WITH} SELECT workflow_id, execution_id, agent_name, status, start_time FROM ranked "
    "WHERE rn = 1",
)
def run_current(spark, sf_dir):
    state = log.latest(steps(spark, sf_dir), ["workflow_id"], ["start_time", "execution_id"])
    return state.select("workflow_id", "execution_id", "agent_name", "status", "start_time")


@query(
    "run_lifecycle",
    f"{_WITH} SELECT workflow_id, status, start_time AS started_at, end_time AS ended_at, "
    "CASE WHEN end_time IS NOT NULL THEN "
    "CAST((epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS BIGINT) END AS duration_seconds, "
    "step_count AS events FROM runs",
)
def run_lifecycle(spark, sf_dir):
    events = steps(spark, sf_dir).selectExpr(
        "workflow_id", "status", "start_time AS at", "execution_id AS seq"
    )
    return log.lifecycle(events)


@query(
    "latest_turns",
    "SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS chars FROM (SELECT *, row_number() OVER "
    "(PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn = 1",
)
def latest_turns(spark, sf_dir):
    newest = log.latest(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])
    return newest.select("conv_id", "turn", "role", F.length("text").alias("chars"))


@query(
    "runs_7d",
    f"{_WITH} SELECT count(*) AS total_workflows, "
    "count(*) FILTER (WHERE status = 'COMPLETED') AS completed, "
    "count(*) FILTER (WHERE status = 'FAILED') AS failed, "
    f"count(*) FILTER (WHERE status = 'IN_PROGRESS') AS in_progress FROM runs WHERE {_from('7 DAY')}",
)
def runs_7d(spark, sf_dir):
    return log.totals(started(spark, sf_dir, days=7), AS_OF)


@query(
    "runs_24h",
    f"{_WITH} SELECT count(DISTINCT workflow_id) AS workflows_today, {_MEAN} AS avg_duration, "
    f"{_RATE} AS success_rate FROM runs WHERE {_from('48 HOUR')}",
)
def runs_24h(spark, sf_dir):
    # The tables end a day before as_of, so the span of 24 hours is doubled.
    return log.recent_summary(started(spark, sf_dir, hours=48), AS_OF, hours=48)


@query("agents_active", f"{_WITH} SELECT count(DISTINCT agent_name) AS agent_count FROM steps")
def agents_active(spark, sf_dir):
    return log.active_agents(steps(spark, sf_dir))


@query(
    "runs_recent",
    f"{_WITH} SELECT {_RUN_SELECT} FROM runs ORDER BY runs.start_time DESC, workflow_id LIMIT 10",
)
def runs_recent(spark, sf_dir):
    return shown(log.newest(runs(spark, sf_dir), 10, ["start_time", "workflow_id"]))


@query(
    "runs_failed_recent",
    f"{_WITH} SELECT {_RUN_SELECT} FROM runs WHERE status = 'FAILED' "
    "ORDER BY runs.start_time DESC, workflow_id LIMIT 20",
)
def runs_failed_recent(spark, sf_dir):
    top = log.newest(runs(spark, sf_dir), 20, ["start_time", "workflow_id"], status="FAILED")
    return shown(top)


@query(
    "runs_daily",
    f"{_WITH} SELECT date_trunc('day', start_time)::TIMESTAMP AS day, status, count(*) AS count "
    f"FROM runs WHERE {_from('7 DAY')} GROUP BY ALL",
)
def runs_daily(spark, sf_dir):
    return log.per_day(started(spark, sf_dir, days=7), AS_OF)


_MONITOR = (
    f"monitor AS (SELECT * FROM runs WHERE status IN ('FAILED', 'IN_PROGRESS') "
    f"AND {_from('14 DAY')} ORDER BY start_time DESC, workflow_id LIMIT 50)"
)


def _monitor(spark, sf_dir):
    return log.monitor(
        started(spark, sf_dir, days=14), AS_OF, ["FAILED", "IN_PROGRESS"], days=14
    )


@query("runs_monitor", f"{_WITH}, {_MONITOR} SELECT {_RUN_SELECT} FROM monitor")
def runs_monitor(spark, sf_dir):
    return shown(_monitor(spark, sf_dir))


@query(
    "runs_monitor_steps",
    f"{_WITH}, {_MONITOR} SELECT s.workflow_id, s.agent_name, s.status, s.start_time, "
    "CAST(s.duration_seconds AS DOUBLE) AS duration_seconds, s.tokens_used "
    "FROM steps s JOIN monitor m USING (workflow_id)",
)
def runs_monitor_steps(spark, sf_dir):
    found = log.with_steps(_monitor(spark, sf_dir), steps(spark, sf_dir))
    return found.select(
        "workflow_id",
        "agent_name",
        "status",
        "start_time",
        F.col("duration_seconds").cast("double").alias("duration_seconds"),
        "tokens_used",
    )


# The newest run, found by a scalar subquery in SQL and by a one-row join here.
_NEWEST = "(SELECT workflow_id FROM runs ORDER BY start_time DESC, workflow_id LIMIT 1)"


@query(
    "run_steps",
    f"{_WITH} SELECT agent_name, status, start_time, CAST(duration_seconds AS DOUBLE) AS "
    "duration_seconds, tokens_used, error_message, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS payload_k FROM steps "
    f"WHERE workflow_id = {_NEWEST}",
)
def run_steps(spark, sf_dir):
    every = steps(spark, sf_dir)
    last = log.newest(log.run_headers(every), 1, ["start_time", "workflow_id"])
    payload = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return (
        log.with_steps(last, every)
        .orderBy("start_time", "execution_id")
        .select(
            "agent_name",
            "status",
            "start_time",
            F.col("duration_seconds").cast("double").alias("duration_seconds"),
            "tokens_used",
            "error_message",
            payload.alias("payload_k"),
        )
    )


@query("run_status", f"{_WITH} SELECT {_RUN_SELECT} FROM runs WHERE workflow_id = '8-20240101'")
def run_status(spark, sf_dir):
    return shown(log.status_of(runs(spark, sf_dir), "8-20240101"))


@query(
    "perf_overall",
    f"{_WITH} SELECT count(*) AS total_workflows, {_MEAN} AS avg_duration, "
    "CAST(min(duration_seconds) AS DOUBLE) AS min_duration, "
    "CAST(max(duration_seconds) AS DOUBLE) AS max_duration, "
    "count(*) FILTER (WHERE status = 'COMPLETED') AS completed_count, "
    f"count(*) FILTER (WHERE status = 'FAILED') AS failed_count FROM runs WHERE {_from('26 HOUR')}",
)
def perf_overall(spark, sf_dir):
    return log.performance(started(spark, sf_dir, hours=26), AS_OF, hours=26)


_AGENT = (
    f"count(*) AS execution_count, {_MEAN} AS avg_duration, "
    f"CAST(sum(tokens_used) AS BIGINT) AS total_tokens, {_RATE} AS success_rate FROM steps "
)


@query(
    "perf_agent",
    f"{_WITH} SELECT agent_name, {_AGENT} WHERE {_from('168 HOUR')} GROUP BY agent_name",
)
def perf_agent(spark, sf_dir):
    return log.performance_by_agent(steps(spark, sf_dir), AS_OF, hours=168)


@query(
    "perf_agent_total",
    f"{_WITH} SELECT coalesce(agent_name, 'ALL') AS agent_name, {_AGENT} "
    f"WHERE {_from('168 HOUR')} GROUP BY ROLLUP (agent_name)",
)
def perf_agent_total(spark, sf_dir):
    return log.performance_by_agent(steps(spark, sf_dir), AS_OF, hours=168, with_total=True)


_METRICS = (
    "metrics AS (SELECT execution_id, agent_name, start_time AS metric_timestamp, "
    "'EXECUTION' AS aggregation_period, 'EXECUTION_TIME' AS metric_type, "
    "CAST(duration_seconds AS DECIMAL(18,4)) AS metric_value, 'SECONDS' AS metric_unit FROM steps "
    "UNION ALL SELECT execution_id, agent_name, start_time, 'EXECUTION', 'SUCCESS_RATE', "
    "CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END, 'BOOLEAN' FROM steps)"
)


@query(
    "step_metrics",
    f"{_WITH}, {_METRICS} SELECT execution_id, agent_name, metric_timestamp, aggregation_period, "
    "metric_type, CAST(metric_value AS DOUBLE) AS metric_value, metric_unit FROM metrics",
)
def step_metrics(spark, sf_dir):
    rows = log.step_metrics(steps(spark, sf_dir))
    return rows.withColumn("metric_value", F.col("metric_value").cast("double"))


@query(
    "run_metrics",
    f"{_WITH}, {_METRICS} SELECT agent_name, metric_type, metric_unit, "
    "CAST(sum(metric_value) AS DOUBLE) AS total_value FROM metrics WHERE execution_id IN ("
    "SELECT execution_id FROM steps WHERE workflow_id IN (SELECT workflow_id FROM runs "
    "WHERE status = 'FAILED')) GROUP BY ALL",
)
def run_metrics(spark, sf_dir):
    every = steps(spark, sf_dir)
    failed = log.run_headers(every).filter(F.col("status") == "FAILED")
    return log.metrics_of_runs(log.step_metrics(every), every, failed)


@query(
    "cost_agent",
    f"{_WITH} SELECT agent_name, CAST(sum(tokens_used) AS BIGINT) AS total_tokens, "
    "CAST(sum(tokens_used) AS DOUBLE) / count(tokens_used) AS avg_tokens_per_execution, "
    "CAST(sum(credits_used) AS DOUBLE) AS total_credits FROM steps "
    f"WHERE {_from('7 DAY')} GROUP BY agent_name",
)
def cost_agent(spark, sf_dir):
    return log.cost_by_agent(steps(spark, sf_dir), AS_OF)


def query_log(spark, sf_dir):
    """Log of calls with text, user, outcome and milliseconds."""
    return steps(spark, sf_dir).select(
        F.concat(F.lit("CALL ONBOARD_"), "agent_name", F.lit("()")).alias("query_text"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_name"),
        "start_time",
        F.when(F.col("status") == "COMPLETED", "SUCCESS").otherwise("FAIL").alias(
            "execution_status"
        ),
        (F.col("duration_seconds") * 1000).alias("execution_ms"),
    )


@query(
    "calls_user",
    f"{_WITH} SELECT concat('user', CAST(user_id AS VARCHAR)) AS user_name, count(*) AS calls, "
    "count(*) FILTER (WHERE status = 'COMPLETED') AS successful_calls, "
    "CAST(sum(duration_seconds * 1000) AS DOUBLE) / count(*) / 1000 AS avg_duration_seconds "
    f"FROM steps WHERE concat('CALL ONBOARD_', agent_name, '()') LIKE '%ONBOARD_M%' "
    f"AND {_from('7 DAY')} GROUP BY user_id",
)
def calls_user(spark, sf_dir):
    return log.calls_by_user(query_log(spark, sf_dir), "%ONBOARD_M%", AS_OF)


@query(
    "calls_listing",
    f"{_WITH} SELECT concat('CALL ONBOARD_', agent_name, '()') AS query_text, "
    "concat('user', CAST(user_id AS VARCHAR)) AS user_name, start_time FROM steps WHERE "
    f"concat('CALL ONBOARD_', agent_name, '()') LIKE '%ONBOARD_P%' AND {_from('7 DAY')}",
)
def calls_listing(spark, sf_dir):
    calls = query_log(spark, sf_dir).filter(F.col("query_text").like("%ONBOARD_P%"))
    return calls.filter(log.since(AS_OF, days=7)).select("query_text", "user_name", "start_time")


# Profile history: one profile per PROFILING step; results exist for two of three.
_HISTORY = (
    "history AS (SELECT concat('p', CAST(execution_id AS VARCHAR)) AS profile_id, workflow_id, "
    "start_time AS created_at, tokens_used, duration_seconds, props FROM steps "
    "WHERE agent_name = 'PROFILING'), results AS (SELECT profile_id, tokens_used * 100 AS "
    "row_count, tokens_used % 20 AS column_count, CAST(duration_seconds AS DOUBLE) AS "
    "data_quality_score FROM history WHERE tokens_used % 3 <> 0)"
)


def history(spark, sf_dir):
    return (
        steps(spark, sf_dir)
        .filter(F.col("agent_name") == "PROFILING")
        .select(
            F.concat(F.lit("p"), F.col("execution_id").cast("string")).alias("profile_id"),
            "workflow_id",
            F.col("start_time").alias("created_at"),
            "tokens_used",
            "duration_seconds",
            "props",
        )
    )


def results(spark, sf_dir):
    kept = history(spark, sf_dir).filter(F.col("tokens_used") % 3 != 0)
    return kept.select(
        "profile_id",
        (F.col("tokens_used") * 100).alias("row_count"),
        (F.col("tokens_used") % 20).alias("column_count"),
        F.col("duration_seconds").cast("double").alias("data_quality_score"),
    )


@query(
    "profiles_latest",
    f"{_WITH}, {_HISTORY} SELECT h.profile_id, h.workflow_id, h.created_at, r.row_count, "
    "r.column_count, r.data_quality_score FROM history h LEFT JOIN results r "
    "ON h.profile_id = r.profile_id ORDER BY h.created_at DESC, h.profile_id LIMIT 20",
)
def profiles_latest(spark, sf_dir):
    top = log.latest_profiles(history(spark, sf_dir), results(spark, sf_dir))
    return top.drop("tokens_used", "duration_seconds", "props")


@query(
    "profile_checks",
    f"{_WITH}, {_HISTORY} SELECT profile_id, workflow_id, tokens_used AS column_count, "
    "tokens_used AS row_count, CAST(tokens_used % 3 AS INTEGER) AS pii_columns_detected "
    "FROM history WHERE workflow_id IN (SELECT workflow_id FROM runs WHERE status = 'COMPLETED')",
)
def profile_checks(spark, sf_dir):
    payload = history(spark, sf_dir).select(
        "profile_id",
        "workflow_id",
        F.regexp_replace("props", "k", "column_count").alias("inferred_schema"),
        F.regexp_replace("props", "k", "row_count").alias("statistics"),
        F.array_repeat(F.lit("column"), (F.col("tokens_used") % 3).cast("int")).alias(
            "pii_detected"
        ),
    )
    done = runs(spark, sf_dir).filter(F.col("status") == "COMPLETED")
    return log.profile_checks(payload, done)


@query(
    "record_counts",
    " UNION ALL ".join(f"SELECT count(*) AS records, '{t}' AS table_name FROM {t}" for t in TABLE_NAMES),
)
def record_counts(spark, sf_dir):
    return log.record_counts(tables(spark, sf_dir))


_LEVEL = (
    "CASE WHEN used_percentage >= 100 THEN 'SUSPEND_IMMEDIATE' WHEN used_percentage >= 90 THEN "
    "'SUSPEND' WHEN used_percentage >= 75 THEN 'NOTIFY' ELSE 'NONE' END AS level"
)


@query(
    "quota_level",
    f"{_WITH}, days AS (SELECT date_trunc('day', start_time)::TIMESTAMP AS day, "
    "sum(credits_used) AS credits FROM steps GROUP BY ALL), sums AS (SELECT day, "
    "CAST(credits AS DOUBLE) AS credits, CAST(sum(credits) OVER (PARTITION BY "
    "date_trunc('month', day) ORDER BY day) AS DOUBLE) AS used FROM days), "
    f"shares AS (SELECT *, used * 100.0::DOUBLE / {QUOTA}::DOUBLE AS used_percentage FROM sums) "
    f"SELECT *, {_LEVEL} FROM shares",
)
def quota_level(spark, sf_dir):
    return log.budget_levels(steps(spark, sf_dir), QUOTA)


@query(
    "remove_run",
    f"{_WITH} SELECT execution_id, workflow_id, status FROM steps WHERE workflow_id NOT IN ("
    "SELECT workflow_id FROM runs WHERE status = 'FAILED')",
)
def remove_run(spark, sf_dir):
    every = steps(spark, sf_dir)
    failed = log.run_headers(every).filter(F.col("status") == "FAILED")
    return log.remove_runs(every, failed).select("execution_id", "workflow_id", "status")


@query(
    "step_sequence",
    f"{_WITH}, firsts AS (SELECT workflow_id, agent_name, min((start_time, execution_id)) AS f "
    "FROM steps GROUP BY ALL) SELECT workflow_id, string_agg(agent_name, ' → ' ORDER BY f) "
    "AS sequence FROM firsts GROUP BY workflow_id",
)
def step_sequence(spark, sf_dir):
    rows = log.step_sequence(steps(spark, sf_dir))
    return rows.select("workflow_id", F.array_join("agent_sequence", " → ").alias("sequence"))


@query(
    "step_positions",
    f"{_WITH} SELECT workflow_id, execution_id, agent_name, row_number() OVER (PARTITION BY "
    "workflow_id ORDER BY start_time, execution_id) AS position FROM steps",
)
def step_positions(spark, sf_dir):
    rows = log.step_positions(steps(spark, sf_dir))
    return rows.select("workflow_id", "execution_id", "agent_name", "position")
