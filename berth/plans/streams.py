"""Streaming queries: each runs its stream over a whole table and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.operators import load
from berth.plans.registry import query
from berth.plans.sqltext import COLUMNS
from berth.streaming import lifecycle as lc
from berth.streaming import streams as st


def stream_of(spark, sf_dir, name) -> DataFrame:
    # A pattern, because a stream takes a folder but not a single file by its name.
    return st.read_folder(spark, f"{sf_dir}/{name}*.parquet", COLUMNS[name])


def _steps(stream: DataFrame) -> DataFrame:
    return stream.selectExpr(
        "event_id AS execution_id",
        "CASE event_id % 3 WHEN 0 THEN 'PROFILING' WHEN 1 THEN 'DICTIONARY' ELSE 'MAPPING' END "
        "AS agent_name",
        "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'IN_PROGRESS' "
        "ELSE 'COMPLETED' END AS status",
        "CAST(ts AS TIMESTAMP) AS start_time",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS tokens_used",
    )


_AGENT = (
    "CASE event_id % 3 WHEN 0 THEN 'PROFILING' WHEN 1 THEN 'DICTIONARY' ELSE 'MAPPING' END "
    "AS agent_name"
)
_COUNTED = (
    "count(*) AS executions, count(*) FILTER (WHERE event_type = 'error') AS failures, "
    "CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens"
)
_CLOSED = "<= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def _windows(spark, sf_dir, label, **options) -> DataFrame:
    path, progress = st.stream_folders(spark, label)
    st.to_folder(st.windowed_metrics(_steps(stream_of(spark, sf_dir, "events")), **options), path, progress)
    return spark.read.parquet(path).withColumns(
        {
            "window_start": F.col("window_start").cast("timestamp_ntz"),
            "window_end": F.col("window_end").cast("timestamp_ntz"),
        }
    )


@query(
    "stream_windows",
    f"SELECT * FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, "
    f"date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, {_AGENT}, {_COUNTED} "
    f"FROM events GROUP BY ALL) WHERE window_end {_CLOSED}",
)
def stream_windows(spark, sf_dir):
    return _windows(spark, sf_dir, "stream-windows")


@query(
    "stream_windows_sliding",
    "SELECT * FROM (SELECT w AS window_start, w + INTERVAL 2 HOUR AS window_end, "
    f"{_AGENT}, {_COUNTED} FROM (SELECT *, unnest([date_trunc('hour', ts)::TIMESTAMP, "
    "date_trunc('hour', ts)::TIMESTAMP - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY ALL) "
    f"WHERE window_end {_CLOSED}",
)
def stream_windows_sliding(spark, sf_dir):
    return _windows(spark, sf_dir, "stream-sliding", width="2 hours", slide="1 hour")


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    path, progress = st.stream_folders(spark, "stream-dedup")
    twice = stream_of(spark, sf_dir, "events").union(stream_of(spark, sf_dir, "events"))
    timed = twice.withColumn("at", F.col("ts").cast("timestamp"))
    once = st.without_repeats(timed, ["event_id"], "at")
    st.to_folder(once.select("event_id", "user_id", "event_type"), path, progress)
    return spark.read.parquet(path)


@query(
    "stream_load",
    "SELECT o_orderkey, upper(o_orderstatus) AS o_orderstatus, o_totalprice, "
    "o_orderdate AS loaded_at FROM orders",
)
def stream_load(spark, sf_dir):
    path, progress = st.stream_folders(spark, "stream-load")
    orders = stream_of(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.explode(F.array(F.lower("o_orderstatus"), F.upper("o_orderstatus"))).alias(
            "o_orderstatus"
        ),
        "o_totalprice",
        F.col("o_orderdate").alias("loaded_at"),
    )
    # Every order comes in two versions; the second is a day newer and takes over.
    newer = F.col("loaded_at") + F.expr("INTERVAL 1 DAY")
    versions = orders.withColumn(
        "version_at",
        F.when(F.col("o_orderstatus") == F.upper("o_orderstatus"), newer).otherwise(
            F.col("loaded_at")
        ),
    )
    st.load_changes(versions, path, progress)
    schema = (
        "o_orderkey bigint, o_orderstatus string, o_totalprice double, "
        "loaded_at timestamp_ntz, version_at timestamp_ntz"
    )
    return st.current_rows(spark, path, schema, ["o_orderkey"], ["version_at"]).drop("version_at")


_VALID = "o_totalprice >= 50000 AND o_orderstatus IN ('F', 'O')"
_BRANCH_SCHEMA = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


def _quarantined(spark, sf_dir, label) -> str:
    path, progress = st.stream_folders(spark, label)
    orders = stream_of(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    rules = {
        "price": F.col("o_totalprice") >= 50000,
        "status": F.col("o_orderstatus").isin("F", "O"),
    }
    st.quarantine(load.flag_validity(orders, rules).drop("violations"), path, progress)
    return path


@query(
    "stream_quarantine",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT ({_VALID})",
)
def stream_quarantine(spark, sf_dir):
    path = _quarantined(spark, sf_dir, "stream-rejects")
    return st.branch(spark, path, _BRANCH_SCHEMA, valid=False)


@query(
    "stream_accepted",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE {_VALID}",
)
def stream_accepted(spark, sf_dir):
    path = _quarantined(spark, sf_dir, "stream-accepts")
    return st.branch(spark, path, _BRANCH_SCHEMA, valid=True)


_RUN_EVENTS = (
    "concat('r', CAST(event_id DIV 7 AS STRING)) AS workflow_id",
    "CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END "
    "AS status",
    "CAST(ts AS TIMESTAMP) AS at",
    "event_id AS seq",
    "CASE WHEN event_type = 'error' THEN concat('step ', CAST(event_id AS STRING)) END AS error_message",
    "props AS payload",
)


@query(
    "stream_lifecycle",
    "WITH e AS (SELECT concat('r', event_id // 7) AS workflow_id, ts, event_id, CASE event_type WHEN "
    "'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status, "
    "CASE WHEN event_type = 'error' THEN concat('step ', event_id) END AS error_message, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), "
    "r AS (SELECT workflow_id, arg_max(status, event_id) AS last_status, min(ts) AS started_at, "
    "max(ts) AS ended_at, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000 AS duration_seconds, "
    "count(*) AS events, max(event_id) AS last_id, arg_max(k, event_id) AS k FROM e GROUP BY workflow_id) "
    "SELECT workflow_id, CASE last_status WHEN 'RUNNING' THEN 'FAILED' ELSE last_status END AS status, "
    "started_at, ended_at, duration_seconds, events, CASE last_status WHEN 'RUNNING' THEN "
    "'no end within 3600 seconds' WHEN 'FAILED' THEN concat('step ', last_id) END AS error_message, k, "
    "last_status = 'RUNNING' AS timed_out FROM r WHERE ended_at + CASE last_status WHEN 'RUNNING' THEN "
    "INTERVAL 1 HOUR ELSE INTERVAL 10 MINUTE END < (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
)
def stream_lifecycle(spark, sf_dir):
    path, progress = st.stream_folders(spark, "stream-lifecycle")
    events = stream_of(spark, sf_dir, "events").selectExpr(*_RUN_EVENTS)
    lc.follow(lc.with_variant(lc.ended_runs(events)), path, progress)
    runs = spark.read.parquet(path)
    return runs.select(
        "workflow_id",
        "status",
        F.col("started_at").cast("timestamp_ntz").alias("started_at"),
        F.col("ended_at").cast("timestamp_ntz").alias("ended_at"),
        "duration_seconds",
        "events",
        "error_message",
        F.try_variant_get("payload", "$.k", "bigint").alias("k"),
        "timed_out",
    )
