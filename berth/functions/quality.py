"""Column rules for profile rows: null share, cardinality class, points, issues, risk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, classes and texts that reports and dashboards rely on.
LOW_CARDINALITY_BELOW = 10
MEDIUM_CARDINALITY_SHARE = 0.1
HIGH_NULL_PERCENTAGE = 50
RAISED_NULL_PERCENTAGE = 20
FULL_SCORE = 100
HIGH_NULL_PENALTY = 30
RAISED_NULL_PENALTY = 15
LOW_CARDINALITY_PENALTY = 10
HIGH_NULL_TEXT = "Column has %.1f%% null values"
LOW_CARDINALITY_TEXT = "Column has only %d distinct values"
ALL_NULLS_TEXT = "Column contains only null values"


def null_percentage(nulls: Column, rows: Column) -> Column:
    """Share of nulls in percent, 0 for an empty table."""
    return F.when(rows > 0, nulls / rows * F.lit(100.0)).otherwise(F.lit(0.0))


def cardinality_class(distinct: Column, rows: Column) -> Column:
    """UNIQUE, LOW, MEDIUM or HIGH; the first that applies."""
    return (
        F.when(distinct == rows, "UNIQUE")
        .when(distinct < LOW_CARDINALITY_BELOW, "LOW")
        .when(distinct < rows * F.lit(MEDIUM_CARDINALITY_SHARE), "MEDIUM")
        .otherwise("HIGH")
    )


def quality_points(null_pct: Column, cardinality: Column) -> Column:
    """Points of one column, 0 to 100."""
    null_penalty = (
        F.when(null_pct > HIGH_NULL_PERCENTAGE, HIGH_NULL_PENALTY)
        .when(null_pct > RAISED_NULL_PERCENTAGE, RAISED_NULL_PENALTY)
        .otherwise(0)
    )
    class_penalty = F.when(cardinality == "LOW", LOW_CARDINALITY_PENALTY).otherwise(0)
    return F.greatest(F.lit(FULL_SCORE) - null_penalty - class_penalty, F.lit(0))


def issue_list(
    null_pct: Column, cardinality: Column, distinct: Column, nulls: Column, rows: Column
) -> Column:
    """Array of (issue_type, severity, description); a column may have several."""

    def issue(kind: str, severity: str, text: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("issue_type"),
            F.lit(severity).alias("severity"),
            text.alias("description"),
        )

    return F.array_compact(
        F.array(
            F.when(
                null_pct > HIGH_NULL_PERCENTAGE,
                issue("HIGH_NULL_PERCENTAGE", "WARNING", F.format_string(HIGH_NULL_TEXT, null_pct)),
            ),
            F.when(
                (cardinality == "LOW") & (distinct > 0),
                issue("LOW_CARDINALITY", "INFO", F.format_string(LOW_CARDINALITY_TEXT, distinct)),
            ),
            F.when(nulls == rows, issue("ALL_NULLS", "ERROR", F.lit(ALL_NULLS_TEXT))),
        )
    )


def risk_level(pii: Column, phi: Column) -> Column:
    """Risk of a table from its numbers of personal and health columns."""
    return (
        F.when((phi > 0) | (pii > 3), "HIGH")
        .when(pii > 1, "MEDIUM")
        .when(pii > 0, "LOW")
        .otherwise("NONE")
    )


def success_rate(status: Column, good: str = "COMPLETED") -> Column:
    """Percentage of rows with the wanted status; NULL over no rows."""
    return F.try_divide(F.count_if(status == good) * F.lit(100.0), F.count(F.lit(1)))
