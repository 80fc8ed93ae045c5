"""Time the headline queries over whole tables and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from berth.plans import catalogue
from berth.session import build_session

HEADLINES = [
    "column_report",
    "profile_columns",
    "profile_all_tables",
    "profile_approx",
    "profile_distribution",
    "profile_top_values",
    "quality_score",
    "infer_schema_text",
    "pii_by_name",
    "pii_by_value",
    "pii_in_text",
    "mask_text",
    "masked_table",
    "text_classify",
    "sentiment",
    "extract",
    "text_digest",
    "tokens",
    "hashed_terms",
    "dictionary_upsert",
    "narrow_types",
    "ddl_narrowed",
    "key_candidates",
    "constraint_tests",
    "synonyms",
    "map_columns_cast",
    "apply_mapping",
    "clean_rows",
    "incremental_load",
    "upsert_repeated_keys",
    "model_type",
    "run_headers",
    "runs_monitor_steps",
    "perf_agent",
    "run_metrics",
    "quota_level",
    "step_positions",
    "stream_load",
    "stream_windows",
    "onboarding_run",
]


def warm_up(spark, sf_dir: str) -> None:
    """Start the executors and load Spark's own classes; none of the measured queries runs."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    regions = spark.read.parquet(f"{sf_dir}/region.parquet")
    joined = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"])
    for _ in range(3):
        joined.groupBy("r_name").count().orderBy("r_name").collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault(
        "PYSPARK_SUBMIT_ARGS", "--conf spark.ui.showConsoleProgress=false pyspark-shell"
    )
    spark = build_session("bench", f"local[{cpus}]", int(cpus), driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    warm_up(spark, sf_dir)
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    rows = catalogue.QUERIES["record_counts"](spark, sf_dir).filter("table_name = 'lineitem'")
    lineitem = rows.collect()[0]["records"]
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "lineitem_rows": lineitem,
                "profiled_rows_per_sec": round(lineitem / seconds["column_report"]),
            }
        )
    )


if __name__ == "__main__":
    main()
