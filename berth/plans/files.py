"""Source and sink queries. Their files are written from the input tables by Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from berth.operators import profile as prof
from berth.plans import sqltext
from berth.plans.registry import query, table, tables
from berth.session import scratch_dir
from berth.sources import readers, sinks

# A customer file as CSV with null tokens, padding, and delimiters within quotes.
_LOOSE = {
    "c_custkey": "CAST(c_custkey AS STRING)",
    "c_name": "concat(c_name, ', c/o \"Dock ', CAST(c_custkey % 9 AS STRING), '\"')",
    "c_mktsegment": (
        "CASE c_custkey % 6 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN '' "
        "WHEN 3 THEN concat('  ', c_mktsegment, '   ') ELSE c_mktsegment END"
    ),
    "c_acctbal": "CASE WHEN c_custkey % 5 = 0 THEN 'NULL' ELSE CAST(c_acctbal AS STRING) END",
}


def loose_csv(spark, sf_dir) -> str:
    path = scratch_dir(spark, "loose-csv")
    cells = [f"{e} AS {n}" for n, e in _LOOSE.items()]
    table(spark, sf_dir, "customer").selectExpr(*cells).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)
    return path


_LOOSE_SQL = (
    "SELECT c_custkey, concat(c_name, ', c/o \"Dock ', CAST(c_custkey % 9 AS VARCHAR), '\"') "
    "AS c_name, CASE WHEN c_custkey % 6 > 2 THEN c_mktsegment END AS c_mktsegment, "
    "CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal FROM customer"
)


@query("read_csv_rules", _LOOSE_SQL)
def read_csv_rules(spark, sf_dir):
    schema = "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"
    return readers.read_csv(spark, loose_csv(spark, sf_dir), schema=schema)


@query("read_csv_inferred", _LOOSE_SQL)
def read_csv_inferred(spark, sf_dir):
    read = readers.read_csv(spark, loose_csv(spark, sf_dir), infer=True)
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("read_json_array", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_json_array(spark, sf_dir):
    # Lines of arrays with at most fifty objects each.
    customer = table(spark, sf_dir, "customer")
    lines = (
        customer.select(
            F.floor(F.col("c_custkey") / 50).alias("line"),
            F.struct("c_custkey", "c_name", "c_acctbal").alias("object"),
        )
        .groupBy("line")
        .agg(F.to_json(F.collect_list("object")).alias("value"))
    )
    path = scratch_dir(spark, "json-arrays")
    lines.select("value").write.text(path)
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    return readers.read_json(spark, path, schema=schema, whole_file=False)


@query("read_parquet", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def read_parquet(spark, sf_dir):
    supplier = readers.read_staged(spark, f"{sf_dir}/supplier.parquet", readers.PARQUET_FORMAT)
    return supplier.filter(F.col("s_acctbal") > 0).select("s_suppkey", "s_name")


@query("read_by_format", "SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand")
def read_by_format(spark, sf_dir):
    # A format without a rule of its own goes to the reader of that name.
    path = scratch_dir(spark, "orc")
    table(spark, sf_dir, "part").write.orc(path)
    parts = readers.read_staged(spark, path, "ORC_FORMAT")
    return parts.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


_LISTED = ["customer", "orders", "lineitem"]


@query(
    "list_files",
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS rows, true AS has_bytes FROM {t}"
        for t in _LISTED
    ),
)
def list_files(spark, sf_dir):
    pattern = r".*/(" + "|".join(_LISTED) + r")\.parquet\z"
    listed = readers.list_files(spark, sf_dir, pattern)
    rows = None
    for t in _LISTED:
        named = table(spark, sf_dir, t).select(F.col("_metadata.file_name").alias("file_name"))
        rows = named if rows is None else rows.unionByName(named)
    counts = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(counts, "file_name").select(
        "file_name", "rows", (F.col("size_bytes") > 0).alias("has_bytes")
    )


@query(
    "many_files",
    " UNION ALL ".join(
        f"SELECT c_mktsegment AS source, '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value "
        "FROM (SELECT c_mktsegment, c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 4 > 0 "
        "THEN c_acctbal END AS c_acctbal FROM customer) GROUP BY c_mktsegment"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    ),
)
def many_files(spark, sf_dir):
    path = scratch_dir(spark, "many-files")
    table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 4 > 0, F.col("c_acctbal"))
    ).write.partitionBy("c_mktsegment").option("header", True).csv(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
    read = readers.read_csv(spark, f"{path}/c_mktsegment=*", schema=schema, with_file=True)
    source = F.regexp_extract("source_path", "/c_mktsegment=([^/]+)/", 1)
    rows = prof.profile(read.withColumn("source", source).drop("source_path"), by=["source"])
    return rows.select(
        "source",
        "column_name",
        "row_count",
        "null_count",
        "distinct_count",
        "min_value",
        "max_value",
    )


@query(
    "sample_rows",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10000",
)
def sample_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return readers.sample(orders, ["o_orderkey"])


@query("preview_rows", "SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def preview_rows(spark, sf_dir):
    return readers.preview(table(spark, sf_dir, "part"), ["p_partkey"])


@query(
    "sample_share",
    "SELECT o_orderkey FROM orders WHERE "
    "CAST(concat('0x', substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 6)) AS INTEGER) < 1677721",
)
def sample_share(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return readers.sample_share(orders, 0.1, keys=["o_orderkey"]).select("o_orderkey")


@query(
    "profile_sample",
    sqltext.profile(
        sqltext.column_rows(
            "(SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000) AS s",
            sqltext.columns("orders"),
            "sample",
        )
    ),
)
def profile_sample(spark, sf_dir):
    taken = readers.sample(table(spark, sf_dir, "orders"), ["o_orderkey"])
    return prof.profile_tables({"sample": taken})


@query(
    "append_result",
    "SELECT run, table_name, count(*) AS columns, CAST(sum(row_count) AS BIGINT) AS cells FROM ("
    f"SELECT 'first' AS run, * FROM ({sqltext.raw_rows('customer', 'orders')}) AS a UNION ALL "
    f"SELECT 'second' AS run, * FROM ({sqltext.raw_rows('orders', 'part')}) AS b) AS h "
    "GROUP BY run, table_name",
)
def append_result(spark, sf_dir):
    path = scratch_dir(spark, "history")
    for run, names in (("first", ("customer", "orders")), ("second", ("orders", "part"))):
        counted = prof.column_counts(tables(spark, sf_dir, *names))
        payload = counted.select(
            F.lit(run).alias("run"),
            "table_name",
            F.struct("column_name", "row_count", "non_null_count").alias("statistics"),
        )
        sinks.append_rows(payload, path)
    history = spark.read.parquet(path)
    return history.groupBy("run", "table_name").agg(
        F.count(F.lit(1)).alias("columns"), F.sum("statistics.row_count").alias("cells")
    )


@query(
    "insert_select",
    "SELECT table_name, column_name, row_count FROM "
    f"({sqltext.raw_rows('customer', 'supplier')}) AS r",
)
def insert_select(spark, sf_dir):
    name = f"profiling_results_{uuid.uuid4().hex[:12]}"
    layout = "table_name STRING, column_name STRING, row_count BIGINT"
    sinks.create_table(spark, name, layout, scratch_dir(spark, name))
    counted = prof.column_counts(tables(spark, sf_dir, "customer", "supplier"))
    sinks.insert_select(counted, name, ["table_name", "column_name", "row_count"])
    return spark.table(name)


@query("snapshot_copy", "SELECT * FROM nation")
def snapshot_copy(spark, sf_dir):
    name = f"nation_backup_{uuid.uuid4().hex[:12]}"
    return sinks.copy_table(table(spark, sf_dir, "nation"), name)


@query(
    "failed_inputs",
    "SELECT 'customer.parquet' AS file_name, 'COMPLETED' AS status, count(*) AS row_count, "
    "CAST(NULL AS VARCHAR) AS summary FROM customer UNION ALL "
    "SELECT 'orders.parquet', 'COMPLETED', count(*), NULL FROM orders UNION ALL "
    "SELECT 'nowhere.parquet', 'FAILED', NULL, 'Error: PATH_NOT_FOUND' UNION ALL "
    "SELECT 'part.parquet', 'FAILED', NULL, 'Error: DATA_SOURCE_NOT_FOUND'",
)
def failed_inputs(spark, sf_dir):
    inputs = [
        (f"{sf_dir}/customer.parquet", readers.PARQUET_FORMAT),
        (f"{sf_dir}/orders.parquet", readers.PARQUET_FORMAT),
        (f"{sf_dir}/nowhere.parquet", readers.PARQUET_FORMAT),
        (f"{sf_dir}/part.parquet", "TAPE_FORMAT"),
    ]
    return sinks.measure_inputs(spark, inputs).select(
        "file_name", "status", "row_count", "summary"
    )


_BROKEN = "CASE WHEN event_id % 13 = 0 THEN substring(props, 1, 3) ELSE props END"


@query(
    "corrupt_lines",
    "SELECT substring(props, 1, 3) AS line, count(*) AS lines FROM events "
    "WHERE event_id % 13 = 0 GROUP BY ALL",
)
def corrupt_lines(spark, sf_dir):
    path = scratch_dir(spark, "broken-json")
    table(spark, sf_dir, "events").selectExpr(f"{_BROKEN} AS value").write.text(path)
    lines = readers.read_json_lines(spark, path, "k bigint")
    return (
        lines.filter(F.col("corrupt_line").isNotNull())
        .groupBy(F.col("corrupt_line").alias("line"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query("read_json_whole", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_json_whole(spark, sf_dir):
    # A folder of documents, each an array over many lines.
    customer = table(spark, sf_dir, "customer")
    documents = (
        customer.select(
            F.floor(F.col("c_custkey") / 500).alias("file"),
            F.to_json(F.struct("c_custkey", "c_name", "c_acctbal")).alias("object"),
        )
        .groupBy("file")
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("object"), ",\n"), F.lit("\n]")).alias("value"))
    )
    path = scratch_dir(spark, "json-documents")
    documents.repartition("file").write.partitionBy("file").text(path)
    read = readers.read_staged(spark, path, readers.JSON_FORMAT)
    return read.select("c_custkey", "c_name", "c_acctbal")


@query(
    "read_csv_headers",
    "SELECT n_nationkey, n_name, CASE WHEN n_regionkey < 3 THEN n_regionkey END AS n_regionkey "
    "FROM nation",
)
def read_csv_headers(spark, sf_dir):
    # Files of other columns in another order; what a file lacks is NULL.
    nation = table(spark, sf_dir, "nation")
    path = scratch_dir(spark, "csv-headers")
    first = nation.filter("n_regionkey < 3").select("n_regionkey", "n_name", "n_nationkey")
    second = nation.filter("n_regionkey >= 3").select("n_nationkey", "n_name")
    for rows in (first, second):
        rows.write.mode("append").option("header", True).csv(path)
    schema = "n_nationkey int, n_name string, n_regionkey int"
    read = readers.read_csv(spark, path, schema=schema, by_header=True)
    return read.select("n_nationkey", "n_name", "n_regionkey")


@query(
    "read_csv_errors",
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_acctbal END "
    "AS c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS lost FROM customer",
)
def read_csv_errors(spark, sf_dir):
    path = scratch_dir(spark, "csv-errors")
    table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "if(c_custkey % 4 = 0, 'unknown', CAST(c_acctbal AS STRING)) AS c_acctbal"
    ).write.option("header", True).csv(path)
    schema = "c_custkey bigint, c_acctbal double"
    read = readers.read_csv(spark, path, schema=schema, with_errors=True)
    return read.select("c_custkey", "c_acctbal", F.size(readers.CAST_ERRORS).alias("lost"))


@query(
    "schema_declared",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, {i} AS order_id, count({c}) AS given "
        "FROM lineitem"
        for i, (c, t) in enumerate(sqltext.columns("lineitem"))
    ),
)
def schema_declared(spark, sf_dir):
    lineitem = readers.read_staged(spark, f"{sf_dir}/lineitem.parquet", readers.PARQUET_FORMAT)
    counts = prof.column_counts({"": lineitem}).select(
        "column_name", F.col("non_null_count").alias("given")
    )
    rows = prof.declared_schema(lineitem).select("column_name", "data_type", "order_id")
    return rows.join(counts, "column_name")
