"""Queries for sensitive data: by name, by value, in running text, and masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.functions import sensitive as sens
from berth.operators import profile as prof
from berth.operators import sensitive as op
from berth.plans import sqltext
from berth.plans.registry import query, table, tables

# Contact and health fields derived from customer, one per label, plus two that must not match.
CONTACT_COLUMNS = {
    "person": "CASE c_custkey % 3 WHEN 0 THEN 'Ann Baker' WHEN 1 THEN 'Bo Chen' ELSE 'Cy Diaz' END",
    "contact": "concat(lower(c_mktsegment), CAST(c_custkey AS STRING), '@mail.example.com')",
    "line": (
        "concat('555-', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '-', "
        "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))"
    ),
    "national_id": (
        "concat(lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '-', "
        "lpad(CAST(c_custkey % 100 AS STRING), 2, '0'), '-', "
        "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))"
    ),
    "card": (
        "CASE WHEN c_custkey % 4 < 3 THEN '4111 1111 1111 1111' "
        "ELSE lpad(CAST(c_custkey AS STRING), 16, '4') END"
    ),
    "street": "concat(CAST(c_custkey AS STRING), ' Harbour St')",
    "born": (
        "concat('19', lpad(CAST(c_custkey % 100 AS STRING), 2, '0'), '-0', "
        "CAST(c_custkey % 9 + 1 AS STRING), '-1', CAST(c_custkey % 10 AS STRING))"
    ),
    "travel_document": "concat('AB', lpad(CAST(c_custkey AS STRING), 7, '0'))",
    "chart": "concat('MRN-', lpad(CAST(c_custkey AS STRING), 6, '0'))",
    "insurer": "concat('HPN', lpad(CAST(c_custkey AS STRING), 8, '0'))",
    "code": (
        "concat('E1', CAST(c_custkey % 10 AS STRING), '.', CAST(c_custkey % 7 AS STRING))"
    ),
    "drug": "concat('aspirin ', CAST(c_custkey % 90 + 10 AS STRING), ' mg')",
    "test": "concat('glucose ', CAST(c_custkey % 90 + 10 AS STRING), ' mg/dL')",
    "remark": (
        "CASE WHEN c_custkey % 5 = 0 THEN concat('n', CAST(c_custkey AS STRING), "
        "'@mail.example.com') WHEN c_custkey % 5 < 3 THEN 'none' END"
    ),
    "segment": "c_mktsegment",
}


def contacts(spark, sf_dir) -> DataFrame:
    """A customer file with contact and health fields, for the value rules."""
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr("c_custkey", *[f"{e} AS {n}" for n, e in CONTACT_COLUMNS.items()])


def contacts_sql() -> str:
    cells = ", ".join(f"{e} AS {n}" for n, e in CONTACT_COLUMNS.items())
    return f"SELECT c_custkey, {cells} FROM customer".replace("AS STRING", "AS VARCHAR")


def _luhn_sql(value: str) -> str:
    digits = f"regexp_replace({value}, '[ -]', '', 'g')"
    digit = f"CAST(substr({digits}, CAST(length({digits}) - i AS BIGINT), 1) AS INTEGER)"
    return (
        f"(list_sum(list_transform(range(0, length({digits})), lambda i: CASE WHEN i % 2 = 1 THEN "
        f"CASE WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END ELSE {digit} END)) "
        f"% 10 = 0)"
    )


def label_sql(value: str, name: str | None = None) -> str:
    """Label of a value; with a column name, its hints take part."""
    hints = sens.name_hints(name) if name else {}
    tests = []
    for label in sens.PII_LABELS + sens.PHI_LABELS:
        test = f"regexp_full_match({value}, '{sens.SHAPES[label]}')"
        if label == "CREDIT_CARD":
            test = f"CASE WHEN {test} THEN {_luhn_sql(value)} ELSE false END"
        if hints.get("PHONE") and label == "PHONE":
            test = f"({test} OR regexp_full_match({value}, '{sens.BARE_PHONE}'))"
        if label in ("DATE_OF_BIRTH", "NAME") and hints and not hints[label]:
            continue
        tests.append(f"WHEN {test} THEN '{label}'")
    return f"CASE {' '.join(tests)} END"


# Numbers and times among the contacts, as schema inference leaves them.
TYPED_CONTACTS = {
    "card_number": ("CAST(4111111111111111 AS BIGINT)", "bigint"),
    "mobile": ("CAST(2015550000 + c_custkey % 10000 AS BIGINT)", "bigint"),
    "birth_time": ("CAST('1980-02-03' AS TIMESTAMP_NTZ)", "timestamp_ntz"),
    "opened": ("CAST('1980-02-03' AS TIMESTAMP_NTZ)", "timestamp_ntz"),
}


def typed_contacts(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr("c_custkey", *[f"{e} AS {n}" for n, (e, _) in TYPED_CONTACTS.items()])


def typed_contacts_sql() -> str:
    cells = ", ".join(f"{e} AS {n}" for n, (e, _) in TYPED_CONTACTS.items())
    return f"SELECT c_custkey, {cells} FROM customer".replace("TIMESTAMP_NTZ", "TIMESTAMP")


# All columns of all tables whose values can be searched, with their types.
_SEARCHED = {
    "contacts": [("c_custkey", "bigint"), *[(c, "string") for c in CONTACT_COLUMNS]],
    "typed_contacts": [("c_custkey", "bigint"), *[(c, t) for c, (_, t) in TYPED_CONTACTS.items()]],
    **{
        t: [(c, kind) for c, kind in sqltext.columns(t) if not kind.startswith("array")]
        for t in sqltext.COLUMNS
    },
}


def _relation(name: str) -> str:
    own = {"contacts": contacts_sql, "typed_contacts": typed_contacts_sql}
    return f"({own[name]()}) AS {name}" if name in own else name


def _as_text_sql(name: str, dtype: str) -> str:
    if dtype == "timestamp_ntz":
        return (
            f"CASE WHEN {name} = date_trunc('day', {name}) THEN CAST(CAST({name} AS DATE) AS "
            f"VARCHAR) ELSE CAST({name} AS VARCHAR) END"
        )
    return f"CAST({name} AS VARCHAR)"


def _order_sql(label: str) -> str:
    labels = sens.PII_LABELS + sens.PHI_LABELS
    return "CASE " + label + " " + " ".join(
        f"WHEN '{x}' THEN {i + 1}" for i, x in enumerate(labels)
    ) + " END"


def _kind_sql(label: str) -> str:
    pii = ", ".join(f"'{x}'" for x in sens.PII_LABELS)
    return f"CASE WHEN {label} IN ({pii}) THEN 'PII' ELSE 'PHI' END"


def findings_sql(searched: dict[str, list[tuple[str, str]]] = _SEARCHED) -> str:
    """One finding per column at most, as a query text over CTE-free relations."""
    parts = []
    for name, cols in searched.items():
        for c, dtype in cols:
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, {label_sql('v', c)} AS label, "
                f"v FROM (SELECT {_as_text_sql(c, dtype)} AS v FROM {_relation(name)}) "
                "WHERE v IS NOT NULL"
            )
    values = " UNION ALL ".join(parts)
    return (
        f"WITH vals AS ({values}), totals AS (SELECT table_name, column_name, "
        "count(*) AS non_null_count FROM vals GROUP BY ALL), counts AS ("
        "SELECT table_name, column_name, label, count(*) AS matches, "
        "min(substr(v, 1, 3)) AS prefix FROM vals WHERE label IS NOT NULL GROUP BY ALL), "
        "ranked AS (SELECT c.*, t.non_null_count, row_number() OVER ("
        f"PARTITION BY c.table_name, c.column_name ORDER BY {_order_sql('c.label')}) AS rn "
        "FROM counts c JOIN totals t USING (table_name, column_name) "
        "WHERE matches >= non_null_count * CAST(0.5 AS DOUBLE)) "
        "SELECT table_name, column_name, label, "
        f"{_kind_sql('label')} AS kind, matches, non_null_count, "
        "CAST(matches AS DOUBLE) / non_null_count AS match_share, "
        f"CASE WHEN {_kind_sql('label')} = 'PHI' THEN '***REDACTED***' "
        "ELSE concat(prefix, '***') END AS sample_value_masked FROM ranked WHERE rn = 1"
    )


def searched_tables(spark, sf_dir) -> dict[str, DataFrame]:
    own = {"contacts": contacts(spark, sf_dir), "typed_contacts": typed_contacts(spark, sf_dir)}
    return {**own, **tables(spark, sf_dir)}


@query("pii_by_value", findings_sql())
def pii_by_value(spark, sf_dir):
    return op.value_findings(searched_tables(spark, sf_dir))


def _name_test(parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(column_name), '{p}')" for p in parts) + ")"


def _names_sql() -> str:
    parts = []
    for t in sqltext.COLUMNS:
        for i, (c, _) in enumerate(sqltext.columns(t)):
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal, "
                f"count(*) AS row_count, count({c}) AS non_null_count FROM {t}"
            )
    for i, c in enumerate(["c_custkey", *_RENAMED]):
        parts.append(
            f"SELECT 'patients' AS table_name, '{c}' AS column_name, {i} AS ordinal, "
            f"count(*) AS row_count, count({_RENAMED.get(c, c)}) AS non_null_count "
            f"FROM ({contacts_sql()}) AS contacts"
        )
    return (
        "SELECT *, CASE WHEN " + _name_test(sens.PII_NAME_PARTS) + " THEN 'DETECTED_BY_PATTERN' "
        "END AS pii_type, CASE WHEN " + _name_test(sens.PHI_NAME_PARTS)
        + " THEN 'DETECTED_BY_PATTERN' END AS phi_type, CASE WHEN "
        + _name_test(sens.PII_NAME_PARTS) + " OR " + _name_test(sens.PHI_NAME_PARTS)
        + " THEN 'MEDIUM' END AS confidence FROM (" + " UNION ALL ".join(parts) + ") AS names"
    )


# A table whose column names tell more than those of the plain tables.
_RENAMED = {
    "Patient_Name": "person",
    "EMAIL": "contact",
    "phone_no": "line",
    "home_address": "street",
    "diagnosis_code": "code",
    "health_plan": "insurer",
    "remark": "remark",
}


def named_columns(spark, sf_dir) -> DataFrame:
    """Name findings with row counts for every column of every table."""
    people = contacts(spark, sf_dir).select(
        "c_custkey", *[F.col(old).alias(new) for new, old in _RENAMED.items()]
    )
    every = {**tables(spark, sf_dir), "patients": people}
    return op.name_findings(prof.column_counts(every))


@query("columns_by_name", _names_sql())
def columns_by_name(spark, sf_dir):
    return named_columns(spark, sf_dir)


@query(
    "pii_by_name",
    f"SELECT table_name, column_name, row_count, non_null_count, pii_type, confidence "
    f"FROM ({_names_sql()}) AS n WHERE pii_type IS NOT NULL",
)
def pii_by_name(spark, sf_dir):
    found = named_columns(spark, sf_dir).filter(F.col("pii_type").isNotNull())
    return found.select(
        "table_name", "column_name", "row_count", "non_null_count", "pii_type", "confidence"
    )


@query(
    "phi_by_name",
    f"SELECT table_name, column_name, row_count, non_null_count, phi_type, confidence "
    f"FROM ({_names_sql()}) AS n WHERE phi_type IS NOT NULL",
)
def phi_by_name(spark, sf_dir):
    found = named_columns(spark, sf_dir).filter(F.col("phi_type").isNotNull())
    return found.select(
        "table_name", "column_name", "row_count", "non_null_count", "phi_type", "confidence"
    )


@query(
    "risk_level",
    "SELECT *, CASE WHEN phi_count > 0 OR pii_count > 3 THEN 'HIGH' WHEN pii_count > 1 THEN "
    "'MEDIUM' WHEN pii_count > 0 THEN 'LOW' ELSE 'NONE' END AS pii_risk_level FROM ("
    "SELECT table_name, count(*) AS column_count, count(pii_type) AS pii_count, "
    f"count(phi_type) AS phi_count FROM ({_names_sql()}) AS n GROUP BY table_name) AS t",
)
def risk_level(spark, sf_dir):
    return op.table_risk(named_columns(spark, sf_dir))


def _find_sql(label: str) -> str:
    found = f"regexp_extract_all(text, '{sens.SHAPES[label]}')"
    if label == "CREDIT_CARD":
        found = f"list_filter({found}, lambda x: {_luhn_sql('x')})"
    return f"len({found})"


@query(
    "pii_in_text",
    " UNION ALL ".join(
        f"SELECT '{x}' AS label, count(*) FILTER (WHERE {_find_sql(x)} > 0) AS rows_with_label, "
        f"CAST(coalesce(sum({_find_sql(x)}), 0) AS BIGINT) AS pieces FROM documents"
        for x in sens.TEXT_LABELS
    ),
)
def pii_in_text(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.text_findings(texts, "text")


def redact_sql(text: str) -> str:
    """Nested SELECTs, one for each label, so that a text is written down once a step."""
    step = f"SELECT doc_id, {text} AS t FROM documents"
    for x in sens.TEXT_LABELS:
        if x == "CREDIT_CARD":
            cards = f"list_filter(regexp_extract_all(t, '{sens.SHAPES[x]}'), lambda x: {_luhn_sql('x')})"
            put = f"list_reduce(list_prepend(t, {cards}), lambda a, b: replace(a, b, '[{x}]'))"
        else:
            put = f"regexp_replace(t, '{sens.SHAPES[x]}', '[{x}]', 'g')"
        step = f"SELECT doc_id, {put} AS t FROM ({step})"
    return f"SELECT doc_id, t AS redacted FROM ({step})"


@query("mask_text", redact_sql("text"))
def mask_text(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.select("doc_id", sens.redact(F.col("text")).alias("redacted"))


def _mask_sql(name: str, label: str) -> str:
    if label in sens.PHI_LABELS:
        return f"CASE WHEN {name} IS NOT NULL THEN '***REDACTED***' END AS {name}"
    return f"CASE WHEN {name} IS NOT NULL THEN concat(substr({name}, 1, 3), '***') END AS {name}"


# What pii_by_value finds in the contact file, written down for the SQL twin.
_CONTACT_LABELS = {
    "person": "NAME",
    "contact": "EMAIL",
    "line": "PHONE",
    "national_id": "SSN",
    "card": "CREDIT_CARD",
    "street": "ADDRESS",
    "born": "DATE_OF_BIRTH",
    "travel_document": "PASSPORT",
    "chart": "MEDICAL_RECORD_NUMBER",
    "insurer": "HEALTH_PLAN",
    "code": "DIAGNOSIS",
    "drug": "PRESCRIPTION",
    "test": "LAB_RESULT",
}


def _mask_cell_sql(name: str) -> str:
    label = label_sql(name, name)
    return (
        f"CASE WHEN {label} IS NULL THEN {name} WHEN {_kind_sql(label)} = 'PHI' THEN "
        f"'***REDACTED***' ELSE concat(substr({name}, 1, 3), '***') END AS {name}"
    )


@query(
    "masked_table",
    f"SELECT c_custkey, {_mask_cell_sql('remark')}, {_mask_cell_sql('segment')}, "
    + ", ".join(_mask_sql(n, x) for n, x in _CONTACT_LABELS.items())
    + f" FROM ({contacts_sql()}) AS contacts",
)
def masked_table(spark, sf_dir):
    people = contacts(spark, sf_dir)
    found = op.value_findings({"contacts": people})
    return op.mask_columns(people, op.findings_map(found, "contacts"), cells=True)


@query(
    "tokenized_table",
    f"SELECT c_custkey, sha256(contact) AS contact, segment FROM ({contacts_sql()}) AS contacts",
)
def tokenized_table(spark, sf_dir):
    people = contacts(spark, sf_dir).select("c_custkey", "contact", "segment")
    return op.mask_columns(people, {"contact": "EMAIL"}, digest=True)


def _tags_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS non_null_count "
        f"FROM {_relation(t)}"
        for t, cs in {**_SEARCHED, "embeddings": sqltext.columns("embeddings")}.items()
        for c, _ in cs
    )
    named = f"({_name_test(sens.PII_NAME_PARTS)} OR {_name_test(sens.PHI_NAME_PARTS)})"
    return (
        "SELECT table_name, column_name, non_null_count, label, "
        f"CASE WHEN kind IS NOT NULL THEN kind WHEN {named} THEN 'SENSITIVE' ELSE 'PUBLIC' "
        "END AS tag, CASE WHEN kind = 'PHI' OR label IN ('SSN', 'CREDIT_CARD', 'PASSPORT') THEN "
        "'RESTRICTED' WHEN kind = 'PII' THEN 'CONFIDENTIAL' ELSE 'INTERNAL' END "
        f"AS data_classification FROM ({rows}) AS c LEFT JOIN (SELECT table_name, column_name, "
        f"label, kind FROM ({findings_sql()}) AS g) AS f USING (table_name, column_name)"
    )


def tagged_columns(spark, sf_dir) -> DataFrame:
    every = searched_tables(spark, sf_dir)
    columns = prof.column_counts(every).select("table_name", "column_name", "non_null_count")
    return op.tag_columns(columns, op.value_findings(every))


@query("tag_columns", _tags_sql())
def tag_columns(spark, sf_dir):
    return tagged_columns(spark, sf_dir).select(
        "table_name", "column_name", "non_null_count", "label", "tag", "data_classification"
    )


@query(
    "findings_per_class",
    "SELECT data_classification, count(*) AS columns, count(label) AS findings, "
    f"CAST(sum(non_null_count) AS BIGINT) AS values FROM ({_tags_sql()}) AS t "
    "GROUP BY data_classification",
)
def findings_per_class(spark, sf_dir):
    return (
        tagged_columns(spark, sf_dir)
        .groupBy("data_classification")
        .agg(
            F.count(F.lit(1)).alias("columns"),
            F.count("label").alias("findings"),
            F.sum("non_null_count").alias("values"),
        )
    )
