"""Reading staged files: CSV with loose rules, JSON, Parquet; samples and listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.operators.layout import literal
from berth.operators.profile import infer_text_schema, quoted, tick

# Names of the file formats, and cells that stand for no value.
CSV_FORMAT = "CSV_FORMAT"
JSON_FORMAT = "JSON_FORMAT"
PARQUET_FORMAT = "PARQUET_FORMAT"
NULL_TOKENS = ["NULL", "null", ""]
SAMPLE_SIZE = 10000
PREVIEW_SIZE = 5


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Replace the null tokens in all text columns."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return df.selectExpr(
        *[
            f"CASE WHEN {tick(f.name)} IN ({tokens}) THEN NULL ELSE {tick(f.name)} END "
            f"AS {tick(f.name)}"
            if isinstance(f.dataType, T.StringType)
            else tick(f.name)
            for f in df.schema.fields
        ]
    )


CAST_ERRORS = "cast_errors"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    infer: bool = False,
    multi_line: bool = False,
    with_file: bool = False,
    by_header: bool = False,
    with_errors: bool = False,
) -> DataFrame:
    """Comma-separated files with a header, optional quotes and padding.

    Rows with too few cells are filled with nulls, surplus cells are dropped. Cells are
    read as text, null tokens become NULL, and only then are they typed: by ``schema``,
    by ``infer`` (a pass over all rows), or not at all. A cell that does not fit its type
    becomes NULL; ``with_errors`` names the columns of such cells in ``cast_errors``.
    Files whose header differs from the first one's are an error, never read by position;
    with ``by_header`` files are read per header and put together by name, for which their
    first lines are collected in a pass over the text. ``multi_line`` allows line breaks
    within quotes but keeps a file from being split among tasks, so it is off unless asked for.
    """
    groups = files_by_header(spark, path) if by_header else [path]
    frames = [_csv_text(spark, g, multi_line, with_file) for g in groups]
    text = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if schema is not None:
        types = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema).fields}
    elif infer:
        names = [n for n in text.columns if not (with_file and n == "source_path")]
        rows = infer_text_schema(text.select(*[tick(n) for n in names])).collect()
        types = {r["column_name"]: r["data_type"] for r in rows}
    else:
        types = {}
    typed = [
        f"try_cast({tick(n)} AS {types[n]}) AS {tick(n)}" if n in types else tick(n)
        for n in text.columns
    ]
    if with_errors:
        lost = [
            f"CASE WHEN {tick(n)} IS NOT NULL AND try_cast({tick(n)} AS {types[n]}) IS NULL "
            f"THEN {literal(n)} END"
            for n in text.columns
            if n in types
        ]
        empty = "CAST(array() AS array<string>)"
        named = f"array_compact(array({', '.join(lost)}))" if lost else empty
        typed.append(f"{named} AS {CAST_ERRORS}")
    return text.selectExpr(*typed) if types or with_errors else text


def _csv_text(
    spark: SparkSession, path: str | list[str], multi_line: bool, with_file: bool
) -> DataFrame:
    text = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .csv(path)
    )
    if with_file:
        text = text.withColumn("source_path", F.col("_metadata.file_path"))
    return null_tokens_to_null(text)


def files_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """Paths grouped by their first line, from one job; a row per file comes to the driver."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
        "value",
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        groups.setdefault(row["header"], []).append(row["file"])
    return list(groups.values())


def read_json(
    spark: SparkSession, path: str | list[str], schema: str | None = None, whole_file: bool = True
) -> DataFrame:
    """JSON files; an outer array becomes rows.

    With ``whole_file`` a file is one document. Without it every line is one (an object
    or an array of objects), which lets large files be split among tasks.
    """
    reader = spark.read.option("multiLine", whole_file)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines with a fixed schema; a line that is no JSON is kept in ``corrupt_line``."""
    parsed = F.from_json(
        "value",
        f"{schema}, corrupt_line string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt_line"},
    )
    return spark.read.text(path).select(parsed.alias("line")).select("line.*")


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    paths = [path] if isinstance(path, str) else path
    return reader.parquet(*paths)


def read_staged(spark: SparkSession, path: str, file_format: str = CSV_FORMAT) -> DataFrame:
    """Read by format name; an unknown name goes to the reader of that name in Spark."""
    if file_format == CSV_FORMAT:
        return read_csv(spark, path, infer=True)
    if file_format == JSON_FORMAT:
        return read_json(spark, path)
    if file_format == PARQUET_FORMAT:
        return read_parquet(spark, path)
    return spark.read.format(file_format.removesuffix("_FORMAT").lower()).load(path)


def sample(df: DataFrame, keys: list[str], n: int = SAMPLE_SIZE) -> DataFrame:
    """The first n rows in key order: the same rows every time, a bounded heap per task."""
    return df.orderBy(*keys).limit(n)


def sample_share(
    df: DataFrame, share: float, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """A share of the rows; no shuffle and no sort.

    By ``seed`` the draw depends on how the rows are laid out in files. By ``keys`` it depends
    on the digest of the key only, so the same rows are drawn from any copy of the table.
    """
    if keys is None:
        return df.sample(fraction=share, seed=seed)
    text = F.concat_ws("|", *[quoted(k).cast("string") for k in keys])
    drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("int")
    return df.filter(drawn < F.lit(int(share * 16**6)))


def preview(df: DataFrame, keys: list[str]) -> DataFrame:
    return sample(df, keys, PREVIEW_SIZE)


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.regexp_extract(path, r"[^/]+\z", 0)


def list_files(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """Files below a path whose full path matches a pattern; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"), "modificationTime")
    )
    return files.filter(F.col("path").rlike(pattern)).select(
        "path",
        file_name(F.col("path")).alias("file_name"),
        "size_bytes",
        F.col("modificationTime").alias("modified_at"),
    )
