"""Profile queries: statistics, issues, scores and inferred schemas of whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from berth.operators import profile as prof
from berth.operators import selection as sel
from berth.plans import sqltext
from berth.plans.registry import query, table, tables

PROFILED = ("lineitem", "orders", "customer")


@query("profile_columns", sqltext.profile(sqltext.raw_rows(*PROFILED)))
def profile_columns(spark, sf_dir):
    return prof.profile_tables(tables(spark, sf_dir, *PROFILED))


@query(
    "profile_all_tables",
    sqltext.profile(sqltext.raw_rows(*sqltext.COLUMNS)),
)
def profile_all_tables(spark, sf_dir):
    return prof.profile_tables(tables(spark, sf_dir))


@query("profile_approx")
def profile_approx(spark, sf_dir):
    return prof.profile(table(spark, sf_dir, "lineitem"), distinct="approx")


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "profile_distribution",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, "
        f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number "
        "FROM lineitem"
        for c in _NUMERIC
    ),
)
def profile_distribution(spark, sf_dir):
    rows = prof.distribution(table(spark, sf_dir, "lineitem"), _NUMERIC)
    return rows.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    "profile_percentiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({s} AS DOUBLE) AS share, "
        f"CAST(quantile_disc({c}, {s}) AS DOUBLE) AS value FROM lineitem"
        for c in _NUMERIC
        for s in (0.25, 0.5, 0.75)
    ),
)
def profile_percentiles(spark, sf_dir):
    return sel.exact_percentiles(table(spark, sf_dir, "lineitem"), _NUMERIC)


@query(
    "profile_approx_bounds",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null_count, "
        "true AS within FROM lineitem"
        for c, _ in sqltext.columns("lineitem")
    ) + ") AS t",
)
def profile_approx_bounds(spark, sf_dir):
    """Whether each approximate distinct count is within four standard errors of the exact one."""
    lineitem = table(spark, sf_dir, "lineitem")
    exact = prof.profile(lineitem).select("column_name", F.col("distinct_count").alias("true_count"))
    error = F.abs(F.col("distinct_count") - F.col("true_count"))
    return (
        prof.profile(lineitem, distinct="approx", rsd=0.05)
        .join(F.broadcast(exact), "column_name")
        .select(
            "column_name", "row_count", "non_null_count",
            (error <= F.col("true_count") * 0.2 + 1).alias("within"),
        )
    )


@query(
    "profile_percentile_bounds",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({s} AS DOUBLE) AS share, true AS within, "
        f"count({c}) AS given FROM lineitem"
        for c in _NUMERIC
        for s in (0.25, 0.5, 0.75)
    ),
)
def profile_percentile_bounds(spark, sf_dir):
    """Whether the share of values below and up to each percentile encloses the share asked for,
    give or take the sketch's error."""
    lineitem = table(spark, sf_dir, "lineitem")
    found = prof.percentiles(lineitem, _NUMERIC)
    values = lineitem.select(*[F.col(c).cast("double").alias(c) for c in _NUMERIC]).unpivot(
        [], _NUMERIC, "column_name", "v"
    )
    # A few rows per column.
    ranks = values.join(F.broadcast(found), "column_name").groupBy("column_name", "share").agg(
        F.count("v").alias("given"),
        F.count_if(F.col("v") < F.col("value")).alias("below"),
        F.count_if(F.col("v") <= F.col("value")).alias("upto"),
    )
    wanted, slack = F.col("share") * F.col("given"), F.col("given") * 0.001 + 1
    within = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return ranks.select("column_name", "share", within.alias("within"), "given")


_COUNTED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_partkey"]


@query(
    "profile_top_values",
    "SELECT column_name, value, frequency, rank FROM ("
    "SELECT column_name, value, frequency, "
    "CAST(row_number() OVER (PARTITION BY column_name ORDER BY frequency DESC, value) AS INTEGER) "
    "AS rank FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS frequency "
        f"FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in _COUNTED
    )
    + ")) WHERE rank <= 5",
)
def profile_top_values(spark, sf_dir):
    return prof.top_values(table(spark, sf_dir, "lineitem"), _COUNTED)


# The tables hold few nulls, so the null rules run over lineitem with three more columns.
_SPARSE_SQL = (
    "(SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN l_returnflag END AS mostly_null, "
    "CASE WHEN l_orderkey % 3 <> 0 THEN l_partkey END AS partly_null, "
    "CAST(NULL AS VARCHAR) AS always_null FROM lineitem) AS sparse"
)
_SPARSE_COLUMNS = [
    *sqltext.columns("lineitem"),
    ("mostly_null", "string"),
    ("partly_null", "bigint"),
    ("always_null", "string"),
]
_SPARSE_PROFILE = sqltext.profile(sqltext.column_rows(_SPARSE_SQL, _SPARSE_COLUMNS, "sparse"))


def sparse_lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumns(
        {
            "mostly_null": F.when(F.col("l_orderkey") % 3 == 0, F.col("l_returnflag")),
            "partly_null": F.when(F.col("l_orderkey") % 3 != 0, F.col("l_partkey")),
            "always_null": F.lit(None).cast("string"),
        }
    )


@query("profile_sparse", _SPARSE_PROFILE)
def profile_sparse(spark, sf_dir):
    return prof.profile_tables({"sparse": sparse_lineitem(spark, sf_dir)})


@query(
    "quality_issues",
    f"WITH p AS ({_SPARSE_PROFILE}) "
    "SELECT column_name, 'HIGH_NULL_PERCENTAGE' AS issue_type, 'WARNING' AS severity "
    "FROM p WHERE null_percentage > 50 UNION ALL "
    "SELECT column_name, 'LOW_CARDINALITY', 'INFO' FROM p "
    "WHERE cardinality = 'LOW' AND distinct_count > 0 UNION ALL "
    "SELECT column_name, 'ALL_NULLS', 'ERROR' FROM p WHERE null_count = row_count",
)
def quality_issues(spark, sf_dir):
    rows = prof.profile(sparse_lineitem(spark, sf_dir))
    return prof.quality_issues(rows).drop("description")


def score_sql(profile_sql: str) -> str:
    points = (
        "100 - CASE WHEN null_percentage > 50 THEN 30 WHEN null_percentage > 20 THEN 15 ELSE 0 END "
        "- CASE WHEN cardinality = 'LOW' THEN 10 ELSE 0 END"
    )
    return (
        "SELECT table_name, count(*) AS column_count, "
        f"round(avg(greatest({points}, 0)), 2) AS data_quality_score "
        f"FROM ({profile_sql}) AS p GROUP BY table_name"
    )


@query("quality_score", score_sql(_SPARSE_PROFILE))
def quality_score(spark, sf_dir):
    rows = prof.profile_tables({"sparse": sparse_lineitem(spark, sf_dir)})
    return prof.quality_score(rows, by=["table_name"])


@query("quality_score_tables", score_sql(sqltext.profile(sqltext.raw_rows(*sqltext.COLUMNS))))
def quality_score_tables(spark, sf_dir):
    return prof.quality_score(profile_all_tables(spark, sf_dir), by=["table_name"])


_TEXT_COLUMNS = [*[c for c, _ in sqltext.columns("lineitem")], "shipped", "ship_day"]


def ladder_sql(source: str, names: list[str]) -> str:
    """Schema rows of a relation of texts, type by type with one pass each."""
    shapes = prof.TEXT_SHAPES
    mantissa = "regexp_replace({c}, '[eE].*', '')"
    digits = f"length(regexp_replace({mantissa}, '^[-0.]+|[^0-9]', '', 'g'))"
    whole = "length(regexp_replace({c}, '-|[.].*', '', 'g'))"
    fraction = "length(regexp_replace({c}, '^[^.]*[.]?', ''))"
    held = (
        f"{digits} <= 15 AND ({digits} = 0 OR "
        "abs(TRY_CAST({c} AS DOUBLE)) BETWEEN 1e-300 AND 1e300)"
    )
    fits = {
        "boolean": "regexp_matches({c}, '%s')" % shapes["truth value"],
        "int": "regexp_matches({c}, '%s') AND TRY_CAST({c} AS INTEGER) IS NOT NULL"
        % shapes["whole number"],
        "bigint": "regexp_matches({c}, '%s') AND TRY_CAST({c} AS BIGINT) IS NOT NULL"
        % shapes["whole number"],
        "decimal(38,0)": f"regexp_matches({{c}}, '{shapes['whole number']}') AND {whole} <= 38",
        "double": "regexp_matches({c}, '%s')" % shapes["number"] + f" AND {held}",
        "decimal(38,18)": "regexp_matches({c}, '%s')" % shapes["plain number"]
        + f" AND {whole} <= 20 AND {fraction} <= 18",
        "date": "regexp_matches({c}, '%s') AND TRY_CAST({c} AS DATE) IS NOT NULL" % shapes["date"],
        "timestamp_ntz": "regexp_matches({c}, '%s') AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL"
        % shapes["timestamp"],
    }
    parts = []
    for i, name in enumerate(names):
        ladder = " ".join(
            f"WHEN bool_and({name} IS NULL OR ({test.replace('{c}', name)})) THEN '{dtype}'"
            for dtype, test in fits.items()
        )
        parts.append(
            f"SELECT '{name}' AS column_name, CASE WHEN count({name}) = 0 THEN 'string' {ladder} "
            f"ELSE 'string' END AS data_type, count({name}) < count(*) AS nullable, "
            f"{i} AS order_id FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _infer_sql() -> str:
    text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c, _ in sqltext.columns("lineitem"))
    source = (
        f"(SELECT {text}, CAST(l_linestatus = 'F' AS VARCHAR) AS shipped, "
        "CASE WHEN l_orderkey % 5 <> 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END "
        "AS ship_day FROM lineitem) AS t"
    )
    return ladder_sql(source, _TEXT_COLUMNS)


@query("infer_schema_text", _infer_sql())
def infer_schema_text(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    text = lineitem.select(
        *[F.col(c).cast("string").alias(c) for c in lineitem.columns],
        (F.col("l_linestatus") == "F").cast("string").alias("shipped"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_shipdate").cast("date").cast("string")).alias(
            "ship_day"
        ),
    )
    return prof.infer_text_schema(text).drop("expression")


# Texts that a narrower type would not give back as they are, and many plain columns.
WIDE_TEXT = {
    "key20": "concat('1234567890', lpad(CAST(c_custkey AS STRING), 10, '0'))",
    "postcode": "lpad(CAST(c_custkey % 99999 AS STRING), 5, '0')",
    "signed": "concat('+', CAST(c_custkey AS STRING))",
    "fraction": "concat(CAST(c_custkey AS STRING), '.', lpad(CAST(c_custkey AS STRING), 16, '0'))",
    "short_fraction": "concat(CAST(c_custkey AS STRING), '.25')",
    "power": "concat(CAST(c_custkey % 9 + 1 AS STRING), 'e', CAST(c_custkey % 30 AS STRING))",
    **{f"plain{k}": f"CAST(c_custkey % {k + 2} AS STRING)" for k in range(28)},
}


def wide_text_sql() -> str:
    cells = ", ".join(f"{e} AS {n}" for n, e in WIDE_TEXT.items()).replace("AS STRING", "AS VARCHAR")
    return f"(SELECT {cells} FROM customer) AS w"


@query("infer_schema_wide", ladder_sql(wide_text_sql(), list(WIDE_TEXT)))
def infer_schema_wide(spark, sf_dir):
    text = table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in WIDE_TEXT.items()])
    return prof.infer_text_schema(text).drop("expression")


@query(
    "column_report",
    "WITH p AS (" + sqltext.profile(sqltext.raw_rows("lineitem")) + ") "
    "SELECT column_name, data_type, row_count, null_count, distinct_count, cardinality, "
    "min_value, max_value, "
    "100 - CASE WHEN null_percentage > 50 THEN 30 WHEN null_percentage > 20 THEN 15 ELSE 0 END "
    "- CASE WHEN cardinality = 'LOW' THEN 10 ELSE 0 END AS points, "
    "concat_ws(',', CASE WHEN null_percentage > 50 THEN 'HIGH_NULL_PERCENTAGE' END, "
    "CASE WHEN cardinality = 'LOW' AND distinct_count > 0 THEN 'LOW_CARDINALITY' END, "
    "CASE WHEN null_count = row_count THEN 'ALL_NULLS' END) AS issues FROM p",
)
def column_report(spark, sf_dir):
    return prof.column_report(prof.profile(table(spark, sf_dir, "lineitem")))
