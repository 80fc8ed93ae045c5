"""Queries over stored results: nested profiles, checks by run, listings, sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.functions import quality
from berth.functions import sensitive as sens
from berth.functions import summary as texts
from berth.operators import load
from berth.operators import mapping as mp
from berth.operators import profile as prof
from berth.operators import runlog as log
from berth.operators import sensitive as sop
from berth.plans import runlog, sqltext
from berth.plans.registry import query, table, tables
from berth.plans.sensitive import _name_test

_KEPT = ["customer", "orders", "part", "supplier", "nation"]
_PROFILE = sqltext.profile(sqltext.raw_rows(*_KEPT))
_PII = _name_test(sens.PII_NAME_PARTS)
_PHI = _name_test(sens.PHI_NAME_PARTS)


@query(
    "profile_history",
    "SELECT table_name, CAST(count(*) AS INTEGER) AS column_count, max(row_count) AS row_count, "
    f"CAST(count(*) FILTER (WHERE {_PII}) AS INTEGER) AS pii_columns, "
    f"CAST(count(*) FILTER (WHERE {_PHI}) AS INTEGER) AS phi_columns, "
    "CAST(count(*) FILTER (WHERE cardinality = 'LOW' AND distinct_count > 0) AS INTEGER) "
    "AS issues, string_agg(cardinality, ',' ORDER BY ordinal) AS classes "
    f"FROM ({_PROFILE}) AS p GROUP BY table_name",
)
def profile_history(spark, sf_dir):
    # Written as nested rows, read back by path into the nested fields.
    rows = load.write_snapshot(prof.profile_tables(tables(spark, sf_dir, *_KEPT)), label="profile")
    nested = prof.history_rows(rows, sop.name_findings(rows), prof.quality_issues(rows))
    stored = load.write_snapshot(nested, label="profiling-history")
    return stored.select(
        "table_name",
        "inferred_schema.column_count",
        "statistics.row_count",
        F.size("pii_detected").alias("pii_columns"),
        F.size("phi_detected").alias("phi_columns"),
        F.coalesce(F.size("data_quality_issues"), F.lit(0)).alias("issues"),
        F.array_join("statistics.columns.cardinality", ",").alias("classes"),
    )


@query(
    "profile_results",
    "SELECT table_name, row_count, column_count, data_quality_score, pii_count, phi_count, CASE "
    "WHEN phi_count > 0 OR pii_count > 3 THEN 'HIGH' WHEN pii_count > 1 THEN 'MEDIUM' "
    "WHEN pii_count > 0 THEN 'LOW' ELSE 'NONE' END AS pii_risk_level FROM (SELECT table_name, "
    "max(row_count) AS row_count, count(*) AS column_count, round(avg(100 - CASE WHEN "
    "null_percentage > 50 THEN 30 WHEN null_percentage > 20 THEN 15 ELSE 0 END - "
    "CASE WHEN cardinality = 'LOW' THEN 10 ELSE 0 END), 2) AS data_quality_score, "
    f"count(*) FILTER (WHERE {_PII}) AS pii_count, count(*) FILTER (WHERE {_PHI}) AS phi_count "
    f"FROM ({_PROFILE}) AS p GROUP BY table_name) AS t",
)
def profile_results(spark, sf_dir):
    named = sop.name_findings(prof.profile_tables(tables(spark, sf_dir, *_KEPT)))
    points = quality.quality_points(F.col("null_percentage"), F.col("cardinality"))
    scored = named.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("column_count"),
        F.round(F.avg(points), 2).alias("data_quality_score"),
        F.count("pii_type").alias("pii_count"),
        F.count("phi_type").alias("phi_count"),
    )
    risk = quality.risk_level(F.col("pii_count"), F.col("phi_count"))
    return scored.withColumn("pii_risk_level", risk)


def _counted_names(spark, sf_dir) -> DataFrame:
    named = sop.name_findings(prof.column_counts(tables(spark, sf_dir)))
    return named.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("columns"),
        F.max("row_count").alias("rows"),
        F.count("pii_type").alias("pii"),
        F.count("phi_type").alias("phi"),
    )


def _sentence_rows() -> str:
    parts = []
    for t in sqltext.COLUMNS:
        names = [c for c, _ in sqltext.columns(t)]
        pii = sum(any(p in c for p in sens.PII_NAME_PARTS) for c in names)
        phi = sum(any(p in c for p in sens.PHI_NAME_PARTS) for c in names)
        parts.append(
            f"SELECT '{t}' AS table_name, {len(names)} AS columns, count(*) AS rows, "
            f"{pii} AS pii, {phi} AS phi FROM {t}"
        )
    return " UNION ALL ".join(parts)


@query(
    "summary_texts",
    "SELECT table_name, concat('Profiling completed. ', columns, ' columns analyzed.') AS profile, "
    "concat('Data profiling completed successfully: Analyzed ', columns, ' columns, Processed ', "
    "rows, ' rows, Detected ', pii, ' PII columns, Detected ', phi, ' PHI columns, File: ', "
    "table_name, '.parquet') AS detail, concat('Profiling Results: File=', table_name, "
    "'.parquet, Columns=', columns, ', Rows=', rows, ', PII=', pii, ', PHI=', phi, ', Sample=', "
    "rows) AS stored, concat('DDL generated for ', table_name, ' with ', columns, ' columns.') "
    "AS proposal, concat('Generated ', columns, ' field mappings with 4 DBT models.') AS mapping "
    f"FROM ({_sentence_rows()}) AS t",
)
def summary_texts(spark, sf_dir):
    t, c, n = F.col("table_name"), F.col("columns"), F.col("rows")
    pii, phi, file = F.col("pii"), F.col("phi"), F.concat("table_name", F.lit(".parquet"))
    return _counted_names(spark, sf_dir).select(
        t,
        texts.profile_text(c).alias("profile"),
        texts.profile_detail_text(c, n, pii, phi, file).alias("detail"),
        texts.profile_stored_text(file, c, n, pii, phi, n).alias("stored"),
        texts.proposal_text(t, c).alias("proposal"),
        texts.mapping_text(c, F.lit(4)).alias("mapping"),
    )


@query(
    "run_texts",
    f"{runlog._WITH} SELECT workflow_id, concat('Workflow completed with ', "
    "count(DISTINCT agent_name), ' agents executed.') AS summary FROM steps GROUP BY workflow_id",
)
def run_texts(spark, sf_dir):
    sequence = log.step_sequence(runlog.steps(spark, sf_dir))
    return sequence.select(
        "workflow_id", texts.run_text(F.size("agent_sequence")).alias("summary")
    )


# Histories of the other steps, one row per step of that kind.
def _history(spark, sf_dir, agent: str) -> DataFrame:
    kept = runlog.steps(spark, sf_dir).filter(F.col("agent_name") == agent)
    return kept.select(
        F.concat(F.lower(F.substring("agent_name", 1, 1)), F.col("execution_id").cast("string")).alias(
            "id"
        ),
        "workflow_id",
        "start_time",
        (F.col("tokens_used") % 20).alias("columns"),
        (F.col("status") == "COMPLETED").alias("done"),
        F.when(F.col("tokens_used") % 5 > 0, (F.col("tokens_used") % 100) / 100).alias("score"),
    )


def _history_sql(agent: str) -> str:
    return (
        "SELECT concat(lower(substr(agent_name, 1, 1)), CAST(execution_id AS VARCHAR)) AS id, "
        "workflow_id, start_time, tokens_used % 20 AS columns, status = 'COMPLETED' AS done, "
        "CASE WHEN tokens_used % 5 > 0 THEN CAST(tokens_used % 100 AS DOUBLE) / 100 END AS score "
        f"FROM steps WHERE agent_name = '{agent}'"
    )


_FAILED = "(SELECT workflow_id FROM runs WHERE status = 'FAILED')"


def _failed(spark, sf_dir) -> DataFrame:
    return runlog.runs(spark, sf_dir).filter(F.col("status") == "FAILED")


@query(
    "dictionary_checks",
    f"{runlog._WITH} SELECT id AS dictionary_id, workflow_id, columns AS column_count, "
    f"done AS ddl_generated FROM ({_history_sql('DICTIONARY')}) AS h WHERE workflow_id IN {_FAILED}",
)
def dictionary_checks(spark, sf_dir):
    kept = log.rows_of_runs(_history(spark, sf_dir, "DICTIONARY"), _failed(spark, sf_dir))
    return kept.select(
        F.col("id").alias("dictionary_id"),
        "workflow_id",
        F.col("columns").alias("column_count"),
        F.col("done").alias("ddl_generated"),
    )


@query(
    "mapping_checks",
    f"{runlog._WITH} SELECT id AS mapping_id, workflow_id, columns AS transformation_count, "
    "score AS mapping_confidence_score "
    f"FROM ({_history_sql('MAPPING')}) AS h WHERE workflow_id IN {_FAILED}",
)
def mapping_checks(spark, sf_dir):
    kept = log.rows_of_runs(_history(spark, sf_dir, "MAPPING"), _failed(spark, sf_dir))
    return kept.select(
        F.col("id").alias("mapping_id"),
        "workflow_id",
        F.col("columns").alias("transformation_count"),
        F.col("score").alias("mapping_confidence_score"),
    )


@query(
    "mapping_list",
    f"{runlog._WITH} SELECT id AS mapping_id, workflow_id, start_time AS created_at FROM "
    f"({_history_sql('MAPPING')}) AS h ORDER BY h.start_time DESC, id LIMIT 20",
)
def mapping_list(spark, sf_dir):
    top = log.newest(_history(spark, sf_dir, "MAPPING"), 20, ["start_time", "id"])
    return top.select(
        F.col("id").alias("mapping_id"), "workflow_id", F.col("start_time").alias("created_at")
    )


@query(
    "mapping_fields",
    f"{runlog._WITH}, h AS ({_history_sql('MAPPING')}), f AS (SELECT id AS mapping_id, "
    "concat('c', CAST(i AS VARCHAR)) AS source_column, score FROM "
    "(SELECT *, unnest(range(columns)) AS i FROM h)) SELECT * FROM f WHERE mapping_id IN "
    f"(SELECT id FROM h WHERE workflow_id IN {_FAILED})",
)
def mapping_fields(spark, sf_dir):
    # Field rows of all mappings of some runs; a run may have several mappings.
    history = _history(spark, sf_dir, "MAPPING")
    fields = history.filter("columns > 0").select(
        F.col("id").alias("mapping_id"),
        F.explode(F.sequence(F.lit(0), (F.col("columns") - 1).cast("int"))).alias("i"),
        "score",
    )
    wanted = log.rows_of_runs(history, _failed(spark, sf_dir)).select(
        F.col("id").alias("mapping_id")
    )
    kept = log.rows_of_runs(fields, wanted, "mapping_id")
    return kept.select(
        "mapping_id", F.concat(F.lit("c"), F.col("i").cast("string")).alias("source_column"), "score"
    )


@query(
    "confidence_by_run",
    f"{runlog._WITH} SELECT round(avg(coalesce(score, 0.5::DOUBLE)), 2) AS confidence, "
    f"count(*) AS mappings FROM ({_history_sql('MAPPING')}) AS h",
)
def confidence_by_run(spark, sf_dir):
    scores = _history(spark, sf_dir, "MAPPING").withColumnRenamed("score", "confidence_score")
    return mp.confidence(scores)


# Plain selections of the kind that listings and previews use.
@query(
    "distinct_projection",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem "
    "ORDER BY l_returnflag, l_linestatus, l_linenumber LIMIT 100",
)
def distinct_projection(spark, sf_dir):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return table(spark, sf_dir, "lineitem").select(columns).distinct().orderBy(columns).limit(100)


@query(
    "null_filter",
    "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS shipped FROM lineitem "
    "WHERE CASE WHEN l_orderkey % 3 = 0 THEN l_returnflag END IS NULL AND l_returnflag IN ('A', 'R')",
)
def null_filter(spark, sf_dir):
    sparse = F.when(F.col("l_orderkey") % 3 == 0, F.col("l_returnflag"))
    kept = table(spark, sf_dir, "lineitem").filter(
        sparse.isNull() & F.col("l_returnflag").isin("A", "R")
    )
    return kept.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("shipped")
    )


@query(
    "status_select",
    "SELECT 'lineitem is loaded' AS status, count(*) AS records FROM lineitem",
)
def status_select(spark, sf_dir):
    counted = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("records"))
    return counted.select(F.lit("lineitem is loaded").alias("status"), "records")
