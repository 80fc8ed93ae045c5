"""Profiles by file as queries: the table comes in files, some of which change and go."""

from __future__ import annotations

from pyspark.sql import functions as F

from berth.operators import profile as prof
from berth.operators.file_profile import FileProfile
from berth.plans import sqltext
from berth.plans.registry import query, table
from berth.session import scratch_dir


def _in_files(spark, sf_dir, name: str, key: str):
    """A table written as files by the remainder of its key, profiled as they come; each task of
    the scan writes its own, so none reads more of a large table than its share."""
    base = scratch_dir(spark, f"{name}-files")
    rows = table(spark, sf_dir, name)
    files = FileProfile.create(spark, f"{base}/known", rows.schema)
    for n in range(3):
        rows.filter(F.col(key) % 3 == n).write.parquet(f"{base}/rows/{n}")
        files.update([f"{base}/rows"])
    return rows, files


_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null_count, "
    + (
        f"min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value, "
        if t in ("bigint", "string")
        else "CAST(NULL AS VARCHAR) AS min_value, CAST(NULL AS VARCHAR) AS max_value, "
    )
    + (f"max(length({c}))" if t == "string" else "CAST(NULL AS BIGINT)")
    + " AS max_length, true AS within FROM lineitem"
    for c, t in sqltext.columns("lineitem")
)


@query("profile_by_file", _COUNTS)
def profile_by_file(spark, sf_dir):
    """Counts, extremes of whole numbers and text, and whether distinct counts are within five
    standard errors of the exact ones."""
    rows, files = _in_files(spark, sf_dir, "lineitem", "l_orderkey")
    exact = prof.profile(rows).select("column_name", F.col("distinct_count").alias("true_count"))
    error = F.abs(F.col("distinct_count") - F.col("true_count"))
    plain = F.col("data_type").isin("bigint", "string")
    return (
        files.profile()
        .join(F.broadcast(exact), "column_name")
        .select(
            "column_name",
            "row_count",
            "non_null_count",
            F.when(plain, F.col("min_value")).alias("min_value"),
            F.when(plain, F.col("max_value")).alias("max_value"),
            "max_length",
            (error <= F.col("true_count") * 0.08 + 1).alias("within"),
        )
    )
