"""Mapping and load queries: matched columns, mapped data, quarantine, incremental load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.operators import dictionary as dic
from berth.operators import load
from berth.operators import mapping as mp
from berth.operators import profile as prof
from berth.operators.layout import local_rows
from berth.operators.runlog import instant
from berth.plans import sqltext
from berth.plans.dictionary import FEED_SQL, order_feed
from berth.plans.registry import query, table, tables

SCHEMAS = {
    "sales": ["customer", "orders", "lineitem"],
    "supply": ["supplier", "part"],
    "geo": ["nation", "region"],
    "text": ["documents", "pages", "conversations", "labels", "benchmark"],
    "log": ["events"],
    "vectors": ["embeddings"],
}

# Targets for the orders table, with the name prefix of its columns left out.
ORDER_TARGET = (
    "ORDERKEY string, custkey bigint, OrderStatus string, totalprice decimal(18,2), "
    "orderdate date, region string"
)


def catalog(spark, sf_dir) -> DataFrame:
    """Catalogue rows of all schemas, with row counts taken from the tables."""
    every = tables(spark, sf_dir)
    rows = dic.catalog_rows(spark, {(s, t): every[t] for s, ts in SCHEMAS.items() for t in ts})
    counts = prof.column_counts({t: every[t] for ts in SCHEMAS.values() for t in ts})
    return rows.join(
        counts.select("table_name", "column_name", "row_count"), ["table_name", "column_name"]
    )


def _catalog_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{s}' AS table_schema, '{t}' AS table_name, '{c}' AS column_name, "
        f"{i} AS ordinal, '{d}' AS data_type, count(*) AS row_count FROM {t}"
        for s, ts in SCHEMAS.items()
        for t in ts
        for i, (c, d) in enumerate(sqltext.columns(t))
    )


@query(
    "catalog_columns",
    f"SELECT table_name, column_name, ordinal, data_type, row_count FROM ({_catalog_sql()}) AS c "
    "WHERE table_schema = 'sales'",
)
def catalog_columns(spark, sf_dir):
    found = mp.target_schema(catalog(spark, sf_dir), "sales")
    return found.select("table_name", "column_name", "ordinal", "data_type", "row_count")


@query(
    "catalog_one_table",
    f"SELECT column_name, ordinal, data_type, row_count FROM ({_catalog_sql()}) AS c "
    "WHERE table_schema = 'supply' AND table_name = 'part'",
)
def catalog_one_table(spark, sf_dir):
    found = mp.target_schema(catalog(spark, sf_dir), "supply", "part")
    return found.select("column_name", "ordinal", "data_type", "row_count")


@query(
    "tables_per_schema",
    "SELECT table_schema, count(DISTINCT table_name) AS table_count, "
    "CAST(sum(row_count) AS BIGINT) AS rows FROM ("
    f"SELECT DISTINCT table_schema, table_name, row_count FROM ({_catalog_sql()}) AS c) AS t "
    "GROUP BY table_schema",
)
def tables_per_schema(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    sizes = rows.filter("ordinal = 0").groupBy("table_schema").agg(F.sum("row_count").alias("rows"))
    return mp.tables_per_schema(rows).join(sizes, "table_schema")


def _counted(df: DataFrame, mappings: DataFrame) -> DataFrame:
    """Mappings with the number of values that each source column brings."""
    counts = prof.column_counts({"": df}).select("ordinal", "non_null_count")
    return mappings.join(F.broadcast(counts), "ordinal")


def _mapping_sql(source: str, prefix: str, target: list[tuple[str, str]]) -> str:
    parts = []
    lowered = {}
    for name, dtype in target:
        lowered.setdefault(name.lower(), (name, dtype))
    for i, (full, dtype) in enumerate(sqltext.columns(source)):
        name = full.removeprefix(prefix)
        hit = lowered.get(name.lower())
        to, to_type = hit or (name.lower().replace(" ", "_"), dtype)
        cast = hit is not None and to_type != dtype
        logic = f"CAST({name} AS {to_type})" if cast else name
        parts.append(
            f"SELECT {i} AS ordinal, '{name}' AS source_column, '{to}' AS target_column, "
            f"'{dtype}' AS source_data_type, '{to_type}' AS target_data_type, "
            f"'{'TYPE_CAST' if cast else 'DIRECT'}' AS transformation_type, "
            f"'{logic}' AS transformation_logic, "
            f"CAST({0.95 if hit else 0.7} AS DOUBLE) AS confidence_score, false AS ai_generated, "
            f"{'false' if hit else 'true'} AS suggestion, count({full}) AS non_null_count "
            f"FROM {source}"
        )
    return " UNION ALL ".join(parts)


@query("map_columns", _mapping_sql("customer", "", sqltext.columns("supplier")))
def map_columns(spark, sf_dir):
    customer, supplier = (table(spark, sf_dir, t) for t in ("customer", "supplier"))
    mappings = mp.match_columns(mp.source_columns(customer), mp.source_columns(supplier))
    return _counted(customer, mappings)


_STRIPPED = [(c.removeprefix("s_"), t) for c, t in sqltext.columns("supplier")]


def _renamed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    customer, supplier = (table(spark, sf_dir, t) for t in ("customer", "supplier"))
    mappings = mp.match_columns(
        mp.source_columns(customer, "c_"), mp.source_columns(supplier, "s_")
    )
    return customer, mappings


@query("map_columns_renamed", _mapping_sql("customer", "c_", _STRIPPED))
def map_columns_renamed(spark, sf_dir):
    return _counted(*_renamed(spark, sf_dir))


_ORDER_COLUMNS = [
    ("ORDERKEY", "string"),
    ("custkey", "bigint"),
    ("OrderStatus", "string"),
    ("totalprice", "decimal(18,2)"),
    ("orderdate", "date"),
    ("region", "string"),
]


def _stripped_orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.toDF(*[c.removeprefix("o_") for c in orders.columns])


def _order_mappings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = _stripped_orders(spark, sf_dir)
    target = mp.columns_from_ddl(orders, ORDER_TARGET)
    return orders, mp.match_columns(mp.source_columns(orders), target)


_ORDERS_MAPPED = _mapping_sql("orders", "o_", _ORDER_COLUMNS)


@query("map_columns_cast", _ORDERS_MAPPED)
def map_columns_cast(spark, sf_dir):
    return _counted(*_order_mappings(spark, sf_dir))


@query(
    "mapping_confidence",
    f"SELECT count(*) AS mappings, round(avg(confidence_score), 2) AS confidence, "
    f"CAST(sum(non_null_count) AS BIGINT) AS values FROM ({_ORDERS_MAPPED}) AS m",
)
def mapping_confidence(spark, sf_dir):
    counted = _counted(*_order_mappings(spark, sf_dir))
    return mp.confidence(counted, F.sum("non_null_count").alias("values"))


@query(
    "mapping_rows",
    "SELECT 'm1' AS mapping_id, source_column, CASE WHEN suggestion THEN 'UNMAPPED' "
    "ELSE target_column END AS target_column, source_data_type, 'UNKNOWN' AS target_data_type, "
    "transformation_logic, transformation_type, CASE WHEN suggestion THEN CAST(0.5 AS DOUBLE) "
    f"ELSE confidence_score END AS confidence_score, true AS ai_generated, non_null_count "
    f"FROM ({_ORDERS_MAPPED}) AS m",
)
def mapping_rows(spark, sf_dir):
    # Answers of a model may lack fields; here targets and scores of the suggestions do.
    orders, mappings = _order_mappings(spark, sf_dir)
    partial = mappings.select(
        "ordinal",
        "source_column",
        F.when(~F.col("suggestion"), F.col("target_column")).alias("target_column"),
        "source_data_type",
        "transformation_logic",
        "transformation_type",
        F.when(~F.col("suggestion"), F.col("confidence_score")).alias("confidence_score"),
    )
    stored = mp.with_defaults(partial, F.lit("m1"))
    counts = prof.column_counts({"": orders}).select(
        F.col("column_name").alias("source_column"), "non_null_count"
    )
    return stored.join(F.broadcast(counts), "source_column")


_LINES = (
    "concat('    ', transformation_logic, ' AS ', target_column)"
)


@query(
    "transformation_text",
    "SELECT concat('SELECT', chr(10), string_agg("
    f"{_LINES}, ',' || chr(10) ORDER BY ordinal), ',', chr(10), "
    "'    CURRENT_TIMESTAMP() AS LOADED_AT,', chr(10), '    CURRENT_USER() AS LOADED_BY', chr(10), "
    "'FROM STAGING.orders') AS transformation_sql, max(non_null_count) AS rows "
    f"FROM ({_ORDERS_MAPPED}) AS m",
)
def transformation_text(spark, sf_dir):
    counted = _counted(*_order_mappings(spark, sf_dir))
    rows = F.max("non_null_count").alias("rows")
    return mp.transformation_text(counted, "STAGING.orders", rows)


LOADED_AT = dt.datetime(2024, 2, 1)


@query(
    "apply_mapping",
    'SELECT CAST(o_orderkey AS VARCHAR) AS "ORDERKEY", o_custkey AS custkey, '
    'o_orderstatus AS "OrderStatus", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) '
    "AS totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS orderdate, "
    "o_orderpriority AS orderpriority, TIMESTAMP '2024-02-01' AS loaded_at, "
    "'loader' AS loaded_by FROM orders",
)
def apply_mapping(spark, sf_dir):
    orders, mappings = _order_mappings(spark, sf_dir)
    mapped = mp.apply_mapping(orders, mp.cast_plan(mappings), instant(LOADED_AT), F.lit("loader"))
    return mapped.drop("cast_errors").withColumns(
        {
            "totalprice": F.col("totalprice").cast("double"),
            "orderdate": F.col("orderdate").cast("string"),
        }
    )


# Target of the incoming text feed of orders.
FEED_PLAN = [
    ("o_orderkey", "orderkey", "bigint"),
    ("o_custkey", "custkey", "int"),
    ("o_orderstatus", "orderstatus", "string"),
    ("o_totalprice", "totalprice", "decimal(18,2)"),
    ("o_orderdate", "orderdate", "date"),
]
_FEED_MAPPED = (
    "SELECT TRY_CAST(o_orderkey AS BIGINT) AS orderkey, TRY_CAST(o_custkey AS INTEGER) AS custkey, "
    "o_orderstatus AS orderstatus, TRY_CAST(o_totalprice AS DECIMAL(18,2)) AS totalprice, "
    "TRY_CAST(o_orderdate AS DATE) AS orderdate, concat_ws(',', "
    "CASE WHEN o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(18,2)) IS NULL "
    "THEN 'totalprice' END, CASE WHEN o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS DATE) "
    f"IS NULL THEN 'orderdate' END) AS cast_errors FROM ({FEED_SQL}) AS feed"
)


@query(
    "cast_failures",
    " UNION ALL ".join(
        f"SELECT '{s}' AS source_column, '{t}' AS target_column, '{d}' AS target_data_type, "
        f"count({s}) AS non_null_count, count(*) FILTER (WHERE {s} IS NOT NULL AND "
        f"TRY_CAST({s} AS {'VARCHAR' if d == 'string' else d}) IS NULL) AS failures "
        f"FROM ({FEED_SQL}) AS feed"
        for s, t, d in FEED_PLAN
    ),
)
def cast_failures(spark, sf_dir):
    return mp.cast_failures(order_feed(spark, sf_dir), FEED_PLAN)


def flagged_feed(spark, sf_dir) -> DataFrame:
    mapped = mp.apply_mapping(
        order_feed(spark, sf_dir), FEED_PLAN, instant(LOADED_AT), F.lit("loader")
    )
    rules = {
        "orderkey is given": F.col("orderkey").isNotNull(),
        "custkey is given": F.col("custkey").isNotNull(),
        "casts succeed": F.size("cast_errors") == 0,
        "status is known": F.col("orderstatus").isin("F", "O", "P"),
    }
    return load.flag_validity(mapped, rules)


_FLAGGED = (
    "SELECT *, concat_ws(', ', CASE WHEN orderkey IS NULL THEN 'orderkey is given' END, "
    "CASE WHEN custkey IS NULL THEN 'custkey is given' END, "
    "CASE WHEN cast_errors <> '' THEN 'casts succeed' END, "
    "CASE WHEN orderstatus NOT IN ('F', 'O', 'P') THEN 'status is known' END) AS violations "
    f"FROM ({_FEED_MAPPED}) AS mapped"
)
_FEED_SHOWN = (
    "orderkey, custkey, orderstatus, CAST(totalprice AS DOUBLE) AS totalprice, "
    "CAST(orderdate AS VARCHAR) AS orderdate"
)


def _feed_shown(df: DataFrame, *more) -> DataFrame:
    return df.select(
        "orderkey",
        "custkey",
        "orderstatus",
        F.col("totalprice").cast("double").alias("totalprice"),
        F.col("orderdate").cast("string").alias("orderdate"),
        *more,
    )


@query("clean_rows", f"SELECT {_FEED_SHOWN} FROM ({_FLAGGED}) AS f WHERE violations = ''")
def clean_rows(spark, sf_dir):
    return _feed_shown(load.clean_rows(flagged_feed(spark, sf_dir)))


@query(
    "reject_rows",
    f"SELECT {_FEED_SHOWN}, cast_errors, violations FROM ({_FLAGGED}) AS f WHERE violations <> ''",
)
def reject_rows(spark, sf_dir):
    return _feed_shown(
        load.reject_rows(flagged_feed(spark, sf_dir)),
        F.array_join("cast_errors", ",").alias("cast_errors"),
        F.array_join("violations", ", ").alias("violations"),
    )


@query(
    "not_null_tests",
    " UNION ALL ".join(
        f"SELECT 'feed' AS table_name, '{t}' AS column_name, 'not_null' AS test, "
        f"count(*) - count({t}) AS failures FROM ({_FEED_MAPPED}) AS m"
        for _, t, _ in FEED_PLAN
    ),
)
def not_null_tests(spark, sf_dir):
    mapped = mp.apply_mapping(order_feed(spark, sf_dir), FEED_PLAN)
    return dic.not_null_test(mapped, "feed", [t for _, t, _ in FEED_PLAN])


@query(
    "staging_view",
    "SELECT orderstatus, count(*) AS rows, CAST(sum(totalprice) AS DOUBLE) AS total "
    f"FROM ({_FEED_MAPPED}) AS m GROUP BY orderstatus",
)
def staging_view(spark, sf_dir):
    mapped = mp.apply_mapping(order_feed(spark, sf_dir), FEED_PLAN)
    view = load.stage_view(mapped, "Orders")
    return spark.sql(
        f"SELECT orderstatus, count(*) AS rows, CAST(sum(totalprice) AS DOUBLE) AS total "
        f"FROM {view} GROUP BY orderstatus"
    )


# Two loads of orders: everything before 1998, then a source in which prices have changed.
_FIRST = "o_orderdate < TIMESTAMP '1998-01-01'"


def _batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    loaded = F.col("o_orderdate").alias("loaded_at")
    existing = orders.filter(F.col("o_orderdate") < instant(dt.datetime(1998, 1, 1)))
    existing = existing.select("o_orderkey", "o_orderstatus", "o_totalprice", loaded)
    source = orders.select(
        "o_orderkey",
        F.lower("o_orderstatus").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        loaded,
    )
    return existing, source


def _load_sql(comparison: str) -> str:
    taken = f"o_orderdate {comparison} (SELECT max(o_orderdate) FROM orders WHERE {_FIRST})"
    return (
        "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS loaded_at FROM orders "
        f"WHERE {_FIRST} AND NOT ({taken}) UNION ALL SELECT o_orderkey, lower(o_orderstatus), "
        f"o_totalprice * 2, o_orderdate FROM orders WHERE {taken}"
    )


@query("incremental_load", _load_sql(">"))
def incremental_load(spark, sf_dir):
    existing, source = _batches(spark, sf_dir)
    curated = load.incremental_load(existing, source, ["o_orderkey"], "loaded_at")
    return load.write_snapshot(curated, label="curated")


@query("incremental_load_inclusive", _load_sql(">="))
def incremental_load_inclusive(spark, sf_dir):
    existing, source = _batches(spark, sf_dir)
    return load.incremental_load(existing, source, ["o_orderkey"], "loaded_at", inclusive=True)


@query(
    "upsert_repeated_keys",
    "WITH incoming AS (SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS loaded_at FROM lineitem "
    "GROUP BY l_orderkey) SELECT o.o_orderkey, coalesce(i.loaded_at, o.o_orderdate) AS loaded_at "
    "FROM orders o LEFT JOIN incoming i USING (o_orderkey) UNION ALL SELECT o_orderkey, loaded_at "
    "FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)",
)
def upsert_repeated_keys(spark, sf_dir):
    existing = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("loaded_at")
    )
    incoming = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("loaded_at")
    )
    return load.upsert(existing, incoming, ["o_orderkey"], ["loaded_at"])


_KEYISH = r"regexp_matches(column_name, '(?i)(key|_id)\z')"
_MODELS = ["lineitem", "orders", "customer", "supplier", "part", "nation", "events", "labels"]


@query(
    "model_type",
    "SELECT *, CASE WHEN key_columns >= 2 AND measure_columns >= 1 AND unique_keys = 0 "
    "THEN 'fct' ELSE 'dim' END AS model_type FROM (SELECT table_name, "
    f"count(*) FILTER (WHERE {_KEYISH}) AS key_columns, "
    f"count(*) FILTER (WHERE data_type = 'double' AND NOT {_KEYISH}) AS measure_columns, "
    f"count(*) FILTER (WHERE {_KEYISH} AND cardinality = 'UNIQUE' AND null_count = 0) "
    f"AS unique_keys FROM ({sqltext.profile(sqltext.raw_rows(*_MODELS))}) AS p "
    "GROUP BY table_name) AS t",
)
def model_type(spark, sf_dir):
    return mp.model_type(prof.profile_tables(tables(spark, sf_dir, *_MODELS)))


def _similar_sql() -> str:
    def rows(names):
        return " UNION ALL ".join(
            f"SELECT '{c}' AS name, count({c}) AS n FROM {t}"
            for t in names
            for c, _ in sqltext.columns(t)
        )

    return (
        f"WITH a AS (SELECT name, CAST(sum(n) AS BIGINT) AS n, string_split(name, '_') AS w "
        f"FROM ({rows(['orders', 'lineitem', 'events'])}) GROUP BY name), "
        f"b AS (SELECT name, CAST(sum(n) AS BIGINT) AS n, string_split(name, '_') AS w "
        f"FROM ({rows(sqltext.COLUMNS)}) GROUP BY name), "
        "p AS (SELECT a.name AS column_name, b.name AS known_name, a.n AS values, "
        "b.n AS known_values, CAST(len(list_intersect(a.w, b.w)) AS DOUBLE) / "
        "len(list_distinct(list_concat(a.w, b.w))) AS similarity, "
        "CAST(levenshtein(a.name, b.name) AS INTEGER) AS edit_distance "
        "FROM a JOIN b ON a.name <> b.name), "
        "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY similarity DESC, "
        "known_name) AS INTEGER) AS rank FROM p WHERE similarity >= CAST(0.3 AS DOUBLE)) "
        "SELECT * FROM r WHERE rank <= 3"
    )


@query("synonyms", _similar_sql())
def synonyms(spark, sf_dir):
    every = tables(spark, sf_dir)
    new = ["orders", "lineitem", "events"]
    rows = dic.catalog_rows(spark, {("", t): df for t, df in every.items()})
    similar = mp.similar_names(rows.filter(F.col("table_name").isin(new)), rows, min_share=0.3)
    # Names come from the schemas; the tables are read once, for the numbers of values.
    sizes = (
        prof.column_counts(every)
        .groupBy("column_name")
        .agg(
            F.sum(F.when(F.col("table_name").isin(new), F.col("non_null_count"))).alias("values"),
            F.sum("non_null_count").alias("known_values"),
        )
    )
    known = sizes.select(F.col("column_name").alias("known_name"), "known_values")
    return similar.join(sizes.drop("known_values"), "column_name").join(known, "known_name")


def _suggested_sql(source: str, target: list[tuple[str, str]]) -> str:
    known = ", ".join(f"('{c}', '{t}')" for c, t in target)
    return (
        f"WITH RECURSIVE m AS ({_mapping_sql(source, '', target)}), "
        "a AS (SELECT source_column AS name, string_split(source_column, '_') AS w FROM m "
        "WHERE suggestion), "
        f"b AS (SELECT * FROM (VALUES {known}) AS v(name, dtype) "
        "WHERE name NOT IN (SELECT target_column FROM m WHERE NOT suggestion)), "
        "p AS (SELECT a.name AS source_column, b.name AS known, b.dtype, "
        "CAST(len(list_intersect(a.w, string_split(b.name, '_'))) AS DOUBLE) / "
        "len(list_distinct(list_concat(a.w, string_split(b.name, '_')))) AS s FROM a, b), "
        # The best pair of columns that are both free, again and again.
        "o AS (SELECT *, row_number() OVER (ORDER BY s DESC, source_column, known) AS i FROM p "
        "WHERE s >= CAST(0.3 AS DOUBLE)), "
        "g AS (SELECT CAST(0 AS BIGINT) AS pos, CAST([] AS VARCHAR[]) AS us, CAST([] AS VARCHAR[]) AS ut "
        "UNION ALL SELECT pos + 1, CASE WHEN list_contains(us, source_column) OR list_contains(ut, known) "
        "THEN us ELSE list_append(us, source_column) END, CASE WHEN list_contains(us, source_column) OR "
        "list_contains(ut, known) THEN ut ELSE list_append(ut, known) END FROM g JOIN o ON i = pos + 1), "
        "t AS (SELECT o.* FROM o JOIN (SELECT unnest(us) AS source_column, unnest(ut) AS known FROM "
        "(SELECT * FROM g ORDER BY pos DESC LIMIT 1)) USING (source_column, known)) "
        "SELECT ordinal, source_column, coalesce(known, target_column) AS target_column, "
        "coalesce(dtype, target_data_type) AS target_data_type, "
        "coalesce(s, confidence_score) AS confidence_score, CASE WHEN known IS NULL THEN "
        "transformation_type WHEN dtype <> source_data_type THEN 'TYPE_CAST' ELSE 'DERIVED' END "
        "AS transformation_type, CASE WHEN dtype <> source_data_type THEN concat('CAST(', "
        "source_column, ' AS ', dtype, ')') ELSE transformation_logic END AS transformation_logic, "
        "non_null_count FROM m LEFT JOIN t "
        "USING (source_column)"
    )


def _suggested(spark, sf_dir, source: str, target: DataFrame) -> DataFrame:
    given = table(spark, sf_dir, source)
    columns = mp.source_columns(given)
    mappings = mp.match_columns(columns, target)
    similar = mp.similar_names(columns, target, min_share=0.3, k=50)
    suggested = mp.with_suggestions(mappings, similar, target)
    return _counted(given, suggested).select(
        "ordinal",
        "source_column",
        "target_column",
        "target_data_type",
        "confidence_score",
        "transformation_type",
        "transformation_logic",
        "non_null_count",
    )


@query("map_with_suggestions", _suggested_sql("lineitem", sqltext.columns("supplier")))
def map_with_suggestions(spark, sf_dir):
    return _suggested(spark, sf_dir, "lineitem", mp.source_columns(table(spark, sf_dir, "supplier")))


# Targets for which several source columns compete, one of them taken by name.
_CONTESTED = [("key_l", "string"), ("l_tax", "double"), ("date_l", "date"), ("l_number", "int")]


@query("map_with_competition", _suggested_sql("lineitem", _CONTESTED))
def map_with_competition(spark, sf_dir):
    target = local_rows(
        spark,
        [(c, t, i) for i, (c, t) in enumerate(_CONTESTED)],
        "column_name string, data_type string, ordinal int",
    )
    return _suggested(spark, sf_dir, "lineitem", target)


# Marks of other types than time: whole numbers and text, and a stamp on what was loaded.
_MARKED = "o_orderkey < (SELECT max(o_orderkey) / 2 FROM orders)"
_STAMP = "2024-05-01 00:00:00"


def _halves(spark, sf_dir, mark: Column) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    middle = orders.agg((F.max("o_orderkey") / 2).alias("middle")).collect()[0]["middle"]
    rows = orders.select("o_orderkey", "o_totalprice", mark.alias("mark"))
    changed = rows.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return rows.filter(F.col("o_orderkey") < middle), changed


def _halves_sql(mark: str, stamp: bool) -> str:
    old, new = (
        (", CAST(NULL AS TIMESTAMP) AS updated_at", f", TIMESTAMP '{_STAMP}'") if stamp else ("", "")
    )
    return (
        f"SELECT o_orderkey, o_totalprice, {mark} AS mark{old} FROM orders WHERE {_MARKED} "
        f"UNION ALL SELECT o_orderkey, o_totalprice * 2, {mark}{new} FROM orders WHERE NOT {_MARKED}"
    )


@query("incremental_load_number", _halves_sql("o_orderkey", False))
def incremental_load_number(spark, sf_dir):
    existing, source = _halves(spark, sf_dir, F.col("o_orderkey"))
    return load.incremental_load(existing, source, ["o_orderkey"], "mark")


_PADDED = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"


@query("incremental_load_stamped", _halves_sql(_PADDED, True))
def incremental_load_stamped(spark, sf_dir):
    padded = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    existing, source = _halves(spark, sf_dir, padded)
    stamp = F.lit(_STAMP).cast("timestamp_ntz")
    return load.incremental_load(existing, source, ["o_orderkey"], "mark", updated_at=stamp)
