"""Finding and masking personal and health data in whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.functions import quality
from berth.functions import sensitive as sens
from berth.operators.layout import literal
from berth.operators.profile import quoted, tick


def name_findings(columns: DataFrame) -> DataFrame:
    """Findings by column name; every input column is kept.

    ``columns`` has one row per column of any number of tables (``column_name`` and
    whatever else describes it, such as profile counts).
    """
    name = F.col("column_name")
    pii = sens.name_contains(name, sens.PII_NAME_PARTS)
    phi = sens.name_contains(name, sens.PHI_NAME_PARTS)
    return columns.withColumns(
        {
            "pii_type": F.when(pii, sens.NAME_FINDING),
            "phi_type": F.when(phi, sens.NAME_FINDING),
            "confidence": F.when(pii | phi, sens.NAME_CONFIDENCE),
        }
    )


def table_risk(findings: DataFrame, by: str = "table_name") -> DataFrame:
    """Numbers of findings and the risk level per table."""
    counted = findings.groupBy(by).agg(
        F.count(F.lit(1)).alias("column_count"),
        F.count("pii_type").alias("pii_count"),
        F.count("phi_type").alias("phi_count"),
    )
    return counted.withColumn(
        "pii_risk_level", quality.risk_level(F.col("pii_count"), F.col("phi_count"))
    )


def value_as_text(name: str, dtype: T.DataType) -> str | None:
    """A value as it is searched; days without a time read as dates. None for nested types,
    truth values and bytes."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        column = tick(name)
        return (
            f"CASE WHEN {column} = date_trunc('DAY', {column}) THEN "
            f"CAST(CAST({column} AS date) AS string) ELSE CAST({column} AS string) END"
        )
    if isinstance(dtype, (T.StringType, T.DateType, T.NumericType)):
        return f"CAST({tick(name)} AS string)"
    return None


def _kind(dtype: T.DataType, hints: dict[str, bool]) -> str | None:
    """Which labels the values of a type can have; None for none."""
    if isinstance(dtype, T.StringType):
        return "text"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "day" if hints["DATE_OF_BIRTH"] else None
    if isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale == 0):
        return "phone" if hints["PHONE"] else "number"
    return None


def value_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Values per (table, column, label), with the smallest masked sample of each label.

    Every value of every column of text, numbers, dates or times is labelled in the scan. Rows
    shrink to (column, label, three characters) counts on the map side, so what is shuffled
    does not grow with the tables.
    """
    parts = []
    for table, df in tables.items():
        cells = []
        for field in df.schema.fields:
            value = value_as_text(field.name, field.dataType)
            if value is not None:
                hints = sens.name_hints(field.name)
                kind = _kind(field.dataType, hints)
                told = ", ".join(f"{str(hint).lower()} AS {label}" for label, hint in hints.items())
                cells.append(
                    f"struct({literal(field.name)} AS column_name, {tick(field.name)} IS NOT NULL AS given, "
                    f"{value if kind else 'NULL'} AS value, {literal(kind)} AS kind, {told})"
                )
        if cells:
            values = df.selectExpr(f"inline(array({', '.join(cells)}))").filter("given")
            parts.append(values.withColumn("table_name", F.lit(table)))
    hinted = {label: label for label in sens.NAME_HINTS}
    # What a type cannot hold is not looked for: numbers can be cards or telephone numbers, days
    # can be birthdays, and fractions are nothing.
    kind = F.col("kind")
    label = (
        F.when(kind == "text", sens.value_label("value", hinted))
        .when(kind == "phone", sens.number_label("value", phone=True))
        .when(kind == "number", sens.number_label("value", phone=False))
        .when(kind == "day", sens.day_label("value"))
    )
    labelled = reduce(DataFrame.unionByName, parts).withColumn("label", label)
    prefix = F.when(F.col("label").isNotNull(), F.substring("value", 1, sens.PREFIX_LENGTH))
    by_prefix = (
        labelled.groupBy("table_name", "column_name", "label", prefix.alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return by_prefix.groupBy("table_name", "column_name", "label").agg(
        F.sum("n").alias("matches"), F.min("prefix").alias("prefix")
    )


def value_findings(tables: dict[str, DataFrame], threshold: float = 0.5) -> DataFrame:
    """At most one finding per column: the first label that enough values have.

    Labels are tested in the order personal data, then health data. The share is taken
    over all non-null values of the column.
    """
    counts = value_counts(tables)
    label = F.col("label")
    totals = counts.groupBy("table_name", "column_name").agg(
        F.sum("matches").alias("non_null_count"),
        F.collect_list(
            F.when(
                label.isNotNull(),
                F.struct(
                    sens.priority(label).alias("priority"), "label", "matches", "prefix"
                ),
            )
        ).alias("labels"),  # at most one entry per known label
    )
    enough = F.filter(
        F.col("labels"), lambda x: x["matches"] >= F.col("non_null_count") * F.lit(threshold)
    )
    best = F.array_min(enough)
    found = totals.withColumn("best", best).filter(F.col("best").isNotNull())
    return found.select(
        "table_name",
        "column_name",
        F.col("best.label").alias("label"),
        sens.kind_of(F.col("best.label")).alias("kind"),
        F.col("best.matches").alias("matches"),
        "non_null_count",
        (F.col("best.matches") / F.col("non_null_count")).alias("match_share"),
        F.when(sens.kind_of(F.col("best.label")) == "PHI", F.lit(sens.REDACTED))
        .otherwise(F.concat("best.prefix", F.lit(sens.PREFIX_TAIL)))
        .alias("sample_value_masked"),
    )


def text_findings(df: DataFrame, column: str, labels: list[str] | None = None) -> DataFrame:
    """Rows and pieces per label within running text; one scan, one row per label."""
    labels = labels or sens.TEXT_LABELS
    sizes = df.select(
        *[F.size(sens.find_all(F.col(column), x)).alias(f"_{x}") for x in labels]
    )
    wide = sizes.agg(
        *[F.count_if(F.col(f"_{x}") > 0).alias(f"_rows_{x}") for x in labels],
        *[
            F.coalesce(F.sum(F.greatest(F.col(f"_{x}"), F.lit(0))), F.lit(0)).alias(f"_all_{x}")
            for x in labels
        ],
    )
    rows = [
        F.struct(
            F.lit(x).alias("label"),
            F.col(f"_rows_{x}").alias("rows_with_label"),
            F.col(f"_all_{x}").alias("pieces"),
        )
        for x in labels
    ]
    return wide.select(F.inline(F.array(*rows)))


def mask_columns(
    df: DataFrame, findings: dict[str, str], digest: bool = False, cells: bool = False
) -> DataFrame:
    """Mask columns by finding (column -> label); the other columns stay as they are.

    With ``cells`` single values of the other text columns are masked too where they have a
    label of their own, as in a column of which too few values have one for a finding.
    """
    masked = {
        name: sens.mask_digest(quoted(name)) if digest else sens.mask_value(quoted(name), label)
        for name, label in findings.items()
        if name in df.columns
    }
    if cells:
        for field in df.schema.fields:
            if isinstance(field.dataType, T.StringType) and field.name not in masked:
                hints = {k: str(h).lower() for k, h in sens.name_hints(field.name).items()}
                label, value = sens.value_label(tick(field.name), hints), quoted(field.name)
                hidden = F.when(
                    sens.kind_of(label) == "PHI", F.lit(sens.REDACTED)
                ).otherwise(sens.mask_prefix(value))
                masked[field.name] = F.when(label.isNotNull(), hidden).otherwise(value)
    return df.withColumns(masked)


def findings_map(findings: DataFrame, table: str) -> dict[str, str]:
    """Findings of one table as column -> label; at most one entry per column."""
    rows = findings.filter(F.col("table_name") == table).select("column_name", "label").collect()
    return {r["column_name"]: r["label"] for r in rows}


def tag_columns(columns: DataFrame, findings: DataFrame) -> DataFrame:
    """Tag and protection class of every column row, from value and name findings."""
    keys = ["table_name", "column_name"]
    by_name = name_findings(columns)
    joined = by_name.join(findings.select(*keys, "label", "kind"), keys, "left")
    named = F.col("pii_type").isNotNull() | F.col("phi_type").isNotNull()
    return joined.withColumns(
        {
            "tag": sens.tag(F.col("kind"), named),
            "data_classification": sens.classification(F.col("label"), F.col("kind")),
        }
    )


def attach_tags(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Put tags into the column metadata, where they stay with the schema."""
    for name, value in tags.items():
        if value not in sens.TAGS:
            raise ValueError(f"tag {value} is not allowed")
        df = df.withMetadata(name, {**df.schema[name].metadata, "tag": value})
    return df
