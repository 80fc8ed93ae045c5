"""Dictionary queries over whole tables: entries, proposals, keys and constraint tests."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.operators import dictionary as dic
from berth.operators import mapping as mp
from berth.operators import profile as prof
from berth.operators import sensitive as sens
from berth.operators.runlog import instant
from berth.plans import runlog, sqltext
from berth.plans.registry import query, table, tables
from berth.plans.sensitive import CONTACT_COLUMNS, contacts, contacts_sql, findings_sql

CREATED = dt.datetime(2024, 1, 1)
UPDATED = dt.datetime(2024, 2, 1)

_CONTACT_TYPES = [("c_custkey", "bigint"), *[(c, "string") for c in CONTACT_COLUMNS]]
_CONTACTS = f"({contacts_sql()}) AS contacts"
# What a later onboarding brings: customer again, and the new contact file.
_FOUND_IN = {"contacts": _CONTACT_TYPES, "customer": sqltext.columns("customer")}


def _found(spark, sf_dir) -> DataFrame:
    return sens.value_findings(
        {"contacts": contacts(spark, sf_dir), "customer": table(spark, sf_dir, "customer")}
    )


def _counts(every: dict[str, DataFrame]) -> DataFrame:
    types = reduce(
        DataFrame.unionByName,
        [
            mp.source_columns(df).select(F.lit(t).alias("table_name"), "column_name", "data_type")
            for t, df in every.items()
        ],
    )
    return prof.column_counts(every).join(F.broadcast(types), ["table_name", "column_name"])


def first_entries(spark, sf_dir) -> DataFrame:
    """A dictionary as an earlier onboarding left it: all types text, nothing found."""
    known = prof.column_counts(tables(spark, sf_dir, "customer", "orders", "part"))
    return known.select(
        F.lit("lake").alias("source_system"),
        "table_name",
        "column_name",
        F.lit("string").alias("data_type"),
        F.lit(False).alias("is_pii"),
        F.lit(None).cast("string").alias("pii_type"),
        F.concat(F.lit("about "), "column_name").alias("description"),
        "row_count",
        instant(CREATED).alias("created_at"),
        instant(CREATED).alias("updated_at"),
    )


def next_entries(spark, sf_dir) -> DataFrame:
    """Entries of a later onboarding: customer again, and the new contact file."""
    every = {
        "customer": table(spark, sf_dir, "customer"),
        "contacts": contacts(spark, sf_dir),
    }
    return dic.dictionary_rows(_counts(every), _found(spark, sf_dir), "lake")


def upserted(spark, sf_dir) -> DataFrame:
    return dic.upsert_dictionary(
        first_entries(spark, sf_dir), next_entries(spark, sf_dir), instant(UPDATED)
    )


def _entries_sql(table_name: str, cols: list[tuple[str, str]], relation: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table_name}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, "
        f"count(*) AS row_count FROM {relation}"
        for c, t in cols
    )


def _upsert_sql() -> str:
    old = " UNION ALL ".join(
        _entries_sql(t, sqltext.columns(t), t) for t in ("customer", "orders", "part")
    )
    new = " UNION ALL ".join(
        [
            _entries_sql("customer", sqltext.columns("customer"), "customer"),
            _entries_sql("contacts", _CONTACT_TYPES, _CONTACTS),
        ]
    )
    return (
        f"WITH o AS ({old}), n AS (SELECT * FROM ({new}) AS c LEFT JOIN (SELECT table_name, "
        f"column_name, label FROM ({findings_sql(_FOUND_IN)}) AS g) AS f "
        "USING (table_name, column_name)) "
        "SELECT 'lake' AS source_system, table_name, column_name, "
        "coalesce(n.data_type, 'string') AS data_type, n.label IS NOT NULL AS is_pii, "
        "n.label AS pii_type, "
        "CASE WHEN o.row_count IS NOT NULL THEN concat('about ', column_name) END AS description, "
        "coalesce(n.row_count, o.row_count) AS row_count, "
        "CASE WHEN o.row_count IS NOT NULL THEN TIMESTAMP '2024-01-01' "
        "ELSE TIMESTAMP '2024-02-01' END AS created_at, "
        "CASE WHEN n.row_count IS NOT NULL THEN TIMESTAMP '2024-02-01' "
        "ELSE TIMESTAMP '2024-01-01' END AS updated_at "
        "FROM o FULL OUTER JOIN n USING (table_name, column_name)"
    )


@query("dictionary_upsert", _upsert_sql())
def dictionary_upsert(spark, sf_dir):
    return upserted(spark, sf_dir)


@query(
    "dictionary_list",
    f"SELECT table_name, column_name, data_type, is_pii, pii_type FROM ({_upsert_sql()}) AS d "
    "ORDER BY table_name, column_name LIMIT 10",
)
def dictionary_list(spark, sf_dir):
    listed = dic.listing(upserted(spark, sf_dir), 10)
    return listed.select("table_name", "column_name", "data_type", "is_pii", "pii_type")


@query(
    "dictionary_summary",
    "SELECT count(*) AS columns_enriched, count(label) AS pii_tagged FROM ("
    + _entries_sql("customer", sqltext.columns("customer"), "customer")
    + " UNION ALL "
    + _entries_sql("contacts", _CONTACT_TYPES, _CONTACTS)
    + ") AS c LEFT JOIN (SELECT table_name, column_name, label FROM "
    f"({findings_sql(_FOUND_IN)}) AS g) AS f USING (table_name, column_name)",
)
def dictionary_summary(spark, sf_dir):
    return next_entries(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("columns_enriched"), F.count("pii_type").alias("pii_tagged")
    )


def _narrow_sql(t: str, relation: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, dtype) in enumerate(cols):
        if dtype in ("int", "bigint"):
            proposal = (
                f"CASE WHEN min({c}) IS NULL THEN '{dtype}' "
                f"WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
                f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' "
                f"WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' "
                "ELSE 'bigint' END"
            )
        elif dtype == "double":
            proposal = (
                f"CASE WHEN bool_and({c} = round({c}, 2)) AND max(abs({c})) < 1e12 THEN "
                f"concat('decimal(', length(CAST(CAST(floor(max(abs({c}))) AS BIGINT) AS VARCHAR)) "
                f"+ 2, ',2)') ELSE 'double' END"
            )
        elif dtype == "string":
            proposal = f"concat('varchar(', greatest(coalesce(max(length({c})), 1), 1), ')')"
        elif dtype == "timestamp_ntz":
            proposal = (
                f"CASE WHEN bool_and({c} = date_trunc('day', {c})) THEN 'date' ELSE '{dtype}' END"
            )
        else:
            proposal = f"'{dtype}'"
        parts.append(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal, "
            f"'{dtype}' AS data_type, {proposal} AS proposed_type, "
            f"count(*) = 0 OR count({c}) < count(*) AS nullable FROM {relation}"
        )
    return " UNION ALL ".join(parts)


_NARROW = " UNION ALL ".join(_narrow_sql(t, t, sqltext.columns(t)) for t in sqltext.COLUMNS)


@query("narrow_types", _NARROW)
def narrow_types(spark, sf_dir):
    return dic.narrow_types(tables(spark, sf_dir))


def _ddl_sql(type_column: str) -> str:
    rows = " UNION ALL ".join(
        [_NARROW, _narrow_sql("contacts", _CONTACTS, _CONTACT_TYPES)]
    )
    line = (
        f"concat('    ', column_name, ' ', {type_column}, CASE WHEN NOT nullable THEN "
        "' NOT NULL' ELSE '' END, CASE WHEN label IS NOT NULL THEN "
        "' COMMENT ''PII - Apply masking policy''' ELSE '' END)"
    )
    return (
        "SELECT table_name, count(*) AS column_count, "
        "concat('CREATE OR REPLACE TABLE LAKE.STAGING.', table_name, ' (', chr(10), "
        f"string_agg({line}, ',' || chr(10) ORDER BY ordinal), chr(10), chr(10), ');') AS ddl, "
        f"table_name AS ddl_table_name FROM ({rows}) AS c LEFT JOIN (SELECT table_name, "
        f"column_name, label FROM ({findings_sql()}) AS g) AS f "
        "USING (table_name, column_name) GROUP BY table_name"
    )


def _proposals(spark, sf_dir, type_column) -> DataFrame:
    every = {**tables(spark, sf_dir), "contacts": contacts(spark, sf_dir)}
    found = sens.value_findings(every).select("table_name", "column_name", "label")
    columns = dic.narrow_types(every).join(found, ["table_name", "column_name"], "left")
    texts = dic.ddl_texts(columns, "LAKE", "STAGING", type_column)
    return texts.withColumn("ddl_table_name", dic.ddl_table_name(F.col("ddl")))


@query("ddl_all_tables", _ddl_sql("data_type"))
def ddl_all_tables(spark, sf_dir):
    return _proposals(spark, sf_dir, "data_type")


@query("ddl_narrowed", _ddl_sql("proposed_type"))
def ddl_narrowed(spark, sf_dir):
    return _proposals(spark, sf_dir, "proposed_type")


@query(
    "key_candidates",
    "SELECT table_name, column_name, distinct_count, cardinality, role FROM (SELECT *, "
    "CASE WHEN cardinality = 'UNIQUE' AND null_count = 0 AND row_count > 0 THEN 'PRIMARY_KEY' "
    "WHEN (cardinality IN ('LOW', 'MEDIUM') AND distinct_count > 1) OR data_type IN "
    "('date', 'timestamp_ntz') THEN 'CLUSTERING' END AS role FROM ("
    + sqltext.profile(sqltext.raw_rows(*sqltext.COLUMNS))
    + ") AS p) AS c WHERE role IS NOT NULL",
)
def key_candidates(spark, sf_dir):
    rows = dic.key_candidates(prof.profile_tables(tables(spark, sf_dir)))
    return rows.select("table_name", "column_name", "distinct_count", "cardinality", "role")


_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
_REFERENCES = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("documents", "doc_id", "labels", "doc_id"),
]


def _tests_sql() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS test, "
        f"count(*) - count({c}) AS failures FROM {t}"
        for t, cols in _KEYS.items()
        for c in cols
    ]
    parts += [
        f"SELECT '{t}', '{', '.join(cols)}', 'unique', count(*) FROM (SELECT 1 FROM {t} "
        f"GROUP BY {', '.join(cols)} HAVING count(*) > 1)"
        for t, cols in _KEYS.items()
    ]
    parts += [
        f"SELECT '{t}', '{c}', 'references', count(*) FROM {t} WHERE {c} IS NOT NULL AND "
        f"{c} NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)"
        for t, c, p, pc in _REFERENCES
    ]
    return " UNION ALL ".join(parts)


@query("constraint_tests", _tests_sql())
def constraint_tests(spark, sf_dir):
    every = tables(spark, sf_dir)
    tests = [dic.not_null_test(every[t], t, cols) for t, cols in _KEYS.items()]
    tests += [dic.unique_test(every[t], t, cols) for t, cols in _KEYS.items()]
    tests += [dic.reference_test(every[t], t, c, every[p], pc) for t, c, p, pc in _REFERENCES]
    return reduce(DataFrame.unionByName, tests)


# Orders as an incoming text file in which some cells do not fit the proposed types.
FEED = {
    "o_orderkey": "CAST(o_orderkey AS STRING)",
    "o_custkey": "CASE WHEN o_orderkey % 83 <> 0 THEN CAST(o_custkey AS STRING) END",
    "o_orderstatus": "CASE WHEN o_orderkey % 101 = 0 THEN 'Z' ELSE o_orderstatus END",
    "o_totalprice": (
        "CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END"
    ),
    "o_orderdate": (
        "CASE WHEN o_orderkey % 89 = 0 THEN 'soon' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"
    ),
}
FEED_SQL = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in FEED.items()) + " FROM orders"
).replace("AS STRING", "AS VARCHAR")
FEED_DDL = (
    "o_orderkey bigint, o_custkey int, o_orderstatus string, o_totalprice decimal(12,2), "
    "o_orderdate date"
)


def order_feed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in FEED.items()])


def _conformity_sql() -> str:
    parts = []
    for part in ("o_orderkey bigint", "o_custkey int", "o_orderstatus string",
                 "o_totalprice decimal(12,2)", "o_orderdate date"):
        name, dtype = part.split(" ", 1)
        sql_type = "VARCHAR" if dtype == "string" else dtype
        bad = f"count(*) FILTER (WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {sql_type}) IS NULL)"
        parts.append(
            f"SELECT '{name}' AS column_name, '{dtype}' AS proposed_type, count(*) AS row_count, "
            f"{bad} AS failures, {bad} = 0 AS passed FROM ({FEED_SQL}) AS feed"
        )
    return " UNION ALL ".join(parts)


@query("landing_conformity", _conformity_sql())
def landing_conformity(spark, sf_dir):
    return dic.conformity(order_feed(spark, sf_dir), FEED_DDL)


# Every run makes a proposal; purchases approve and errors reject it.
_STATES = (
    f"{runlog._WITH}, decided AS (SELECT s.*, e.event_type, row_number() OVER (PARTITION BY "
    "s.workflow_id ORDER BY s.start_time DESC, s.execution_id DESC) AS place FROM steps s JOIN "
    "events e ON e.event_id = s.execution_id WHERE e.event_type IN ('purchase', 'error')), "
    "states AS (SELECT r.workflow_id AS proposal_id, r.step_count, coalesce(CASE d.event_type "
    "WHEN 'purchase' THEN 'APPROVED' WHEN 'error' THEN 'REJECTED' END, 'PENDING') AS "
    "approval_status, CASE WHEN d.event_type = 'purchase' THEN CAST(d.user_id AS VARCHAR) END "
    "AS approved_by, CASE WHEN d.event_type = 'purchase' THEN d.start_time END AS approved_at "
    "FROM runs r LEFT JOIN decided d ON d.workflow_id = r.workflow_id AND d.place = 1)"
)


def _states(spark, sf_dir) -> DataFrame:
    proposals = runlog.runs(spark, sf_dir).select(
        F.col("workflow_id").alias("proposal_id"), "step_count"
    )
    kinds = {"purchase": "APPROVED", "error": "REJECTED"}
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*kinds))
    decisions = events.select(
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")
        ).alias("proposal_id"),
        F.when(F.col("event_type") == "purchase", "APPROVED").otherwise("REJECTED").alias(
            "decision"
        ),
        F.col("user_id").cast("string").alias("decided_by"),
        F.col("ts").alias("decided_at"),
        F.col("event_id").alias("seq"),
    )
    return dic.proposal_state(proposals, decisions)


@query("proposals_state", f"{_STATES} SELECT * FROM states")
def proposals_state(spark, sf_dir):
    return _states(spark, sf_dir)


@query("proposals_executable", f"{_STATES} SELECT * FROM states WHERE approval_status = 'APPROVED'")
def proposals_executable(spark, sf_dir):
    return dic.executable(_states(spark, sf_dir))
