"""Matching source columns to a target schema, and applying the result to the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from berth.operators.layout import literal, local_rows
from berth.operators.load import write_snapshot
from berth.operators.profile import tick

# Scores of mappings by rule, and what stands in for missing fields.
MATCHED_SCORE = 0.95
SUGGESTED_SCORE = 0.7
MISSING_SCORE = 0.5
MISSING_TARGET = "UNMAPPED"
MISSING_TYPE = "UNKNOWN"
MISSING_LOGIC = "DIRECT"
MISSING_KIND = "DIRECT"


def target_schema(catalog: DataFrame, schema: str, table: str | None = None) -> DataFrame:
    """Catalogue rows of a schema or of one of its tables, in their order."""
    rows = catalog.filter(F.col("table_schema") == schema)
    if table is not None:
        rows = rows.filter(F.col("table_name") == table)
    return rows.orderBy("table_name", "ordinal")


def schema_exists(catalog: DataFrame, schema: str, table: str | None = None) -> DataFrame:
    """One row: whether the target exists and how many columns it has."""
    rows = target_schema(catalog, schema, table)
    return rows.agg(F.count(F.lit(1)).alias("column_count")).select(
        F.lit(schema).alias("table_schema"),
        "column_count",
        (F.col("column_count") > 0).alias("exists"),
    )


def tables_per_schema(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("table_schema").agg(F.count_distinct("table_name").alias("table_count"))


def match_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Map every source column (column_name, data_type, ordinal) by name.

    The first target column of the same name, in any case, wins. Where its type
    differs the value is cast. Source columns without a match suggest a new target.
    """
    first = Window.partitionBy("_name").orderBy("_place", "_target", "_type")
    targets = (
        target.select(
            F.lower("column_name").alias("_name"),
            F.col("column_name").alias("_target"),
            F.col("data_type").alias("_type"),
            F.col("ordinal").alias("_place"),
        )
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
    )
    joined = source.withColumn("_name", F.lower("column_name")).join(targets, "_name", "left")
    matched = F.col("_target").isNotNull()
    cast = matched & (F.col("_type") != F.col("data_type"))
    return joined.select(
        F.col("ordinal"),
        F.col("column_name").alias("source_column"),
        F.coalesce("_target", F.replace(F.col("_name"), F.lit(" "), F.lit("_"))).alias(
            "target_column"
        ),
        F.col("data_type").alias("source_data_type"),
        F.coalesce("_type", "data_type").alias("target_data_type"),
        F.when(cast, "TYPE_CAST").otherwise("DIRECT").alias("transformation_type"),
        F.when(
            cast,
            F.concat(F.lit("CAST("), "column_name", F.lit(" AS "), "_type", F.lit(")")),
        )
        .otherwise(F.col("column_name"))
        .alias("transformation_logic"),
        F.when(matched, MATCHED_SCORE).otherwise(SUGGESTED_SCORE).alias("confidence_score"),
        F.lit(False).alias("ai_generated"),
        (~matched).alias("suggestion"),
    )


def name_tokens(name: Column) -> Column:
    """Distinct words of a column name: split at underscores, blanks and inner capitals."""
    spaced = F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2")
    parts = F.split(F.lower(spaced), r"[^a-z0-9]+")
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


#: Names of more words than this are not met by the sets of their words, of which there are
#: two to the power of their number.
MOST_WORDS = 8


def _shared_sets(words: Column, min_share: float) -> Column:
    """All sets of words that a name may share with a name as similar as ``min_share``.

    Common words must be at least that share of the larger name, so of this one too.
    """
    every = F.aggregate(
        words,
        F.array(F.array().cast("array<string>")),
        lambda sets, w: F.concat(sets, F.transform(sets, lambda s: F.array_append(s, w))),
    )
    least = F.ceil(F.size(words) * F.lit(min_share))
    return F.filter(every, lambda s: (F.size(s) > 0) & (F.size(s) >= least))


def _rarest_words(names: DataFrame, every: DataFrame, min_share: float) -> DataFrame:
    """(name, words, word): the rarest words of each name. Names as similar as ``min_share``
    differ in too few words to share none of these."""
    counts = every.select(F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = (
        names.select("name", F.explode("words").alias("word"))
        .join(counts, "word")
        .groupBy("name")
        .agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("ranked"))
    )
    size = F.size("ranked")
    kept = size - F.ceil(size * F.lit(min_share)).cast("int") + 1
    rare = F.slice("ranked", F.lit(1), kept)
    return ranked.select(
        "name",
        F.transform("ranked", lambda x: x["word"]).alias("words"),
        F.explode(F.transform(rare, lambda x: x["word"])).alias("word"),
    )


def _similar_long(new: DataFrame, known: DataFrame, min_share: float) -> DataFrame:
    """Pairs (column_name, known_name) that may be similar, of which one name is long."""
    every = new.union(known).distinct()
    a = _rarest_words(new, every, min_share).toDF("column_name", "_new", "word")
    b = _rarest_words(known, every, min_share).toDF("known_name", "_known", "word")
    sizes = F.size("_new"), F.size("_known")
    near = (F.least(*sizes) >= F.greatest(*sizes) * F.lit(min_share)) & (
        F.greatest(*sizes) > MOST_WORDS
    )
    return a.join(b, "word").filter(near).select("column_name", "known_name", "_new", "_known")


def similar_names(
    new: DataFrame, known: DataFrame, min_share: float = 0.5, k: int = 3
) -> DataFrame:
    """The k known names most similar to each new name, by shared words.

    Similarity is the share of common words (Jaccard), at least ``min_share``; ties go in
    order of the known name. Names meet on the exact set of words they share and on the
    size of the known name. Known names under the same set and size are equally similar
    or better, so the first k + 1 of them in order (one may be the new name itself) are
    all that can be among the best k: the join grows with the names, not with their
    pairs, however many share a word. Names of more than MOST_WORDS words, and their
    partners, meet on their rarest words instead, of which they have few.
    """
    words_of = F.array_sort(name_tokens(F.col("name")))
    news, knowns = (
        df.select(F.col("column_name").alias("name")).distinct().withColumn("words", words_of)
        for df in (new, known)
    )
    short = F.size("words") <= MOST_WORDS
    known_sets = (
        knowns.filter(short)
        .select(F.col("name").alias("known_name"), F.col("words").alias("_known"))
        .withColumn("_size", F.size("_known"))
        .withColumn("_shared", F.explode(_shared_sets(F.col("_known"), min_share)))
        .withColumn("_shared", F.array_join("_shared", " "))
    )
    in_order = Window.partitionBy("_shared", "_size").orderBy("known_name")
    candidates = (
        known_sets.withColumn("_place", F.row_number().over(in_order))
        .filter(F.col("_place") <= k + 1)
        .drop("_place")
    )
    largest = F.floor(F.size("_set") / F.lit(min_share)) + F.size("_set") - F.size("_new")
    wanted = (
        news.filter(short)
        .select(F.col("name").alias("column_name"), F.col("words").alias("_new"))
        .withColumn("_set", F.explode(_shared_sets(F.col("_new"), min_share)))
        .filter(largest >= F.size("_set"))
        .withColumn("_size", F.explode(F.sequence(F.size("_set"), largest.cast("int"))))
        .withColumn("_shared", F.array_join("_set", " "))
    )
    met = wanted.join(candidates, ["_shared", "_size"]).select(
        "column_name", "known_name", "_new", "_known"
    )
    common = F.size(F.array_intersect("_new", "_known"))
    pairs = (
        met.unionByName(_similar_long(news, knowns, min_share))
        .filter(F.col("column_name") != F.col("known_name"))
        .select(
            "column_name",
            "known_name",
            (common / F.size(F.array_union("_new", "_known"))).alias("similarity"),
        )
        .filter(F.col("similarity") >= F.lit(min_share))
        .distinct()
        .withColumn("edit_distance", F.levenshtein("column_name", "known_name"))
    )
    best = Window.partitionBy("column_name").orderBy(F.desc("similarity"), "known_name")
    return pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _assigned(pairs: DataFrame) -> DataFrame:
    """A stable assignment among scored pairs (source_column, _similar, _score): no source and
    target that are not given to each other both have each other before what they got. Ties go in
    order of the names.

    In each round the pairs that are best for both sides stand, and all other pairs of these
    columns go; a column whose first choice was given away is free for its next one. Rounds are as
    many as choices hang on one another, mostly one to three.
    """
    for_source = Window.partitionBy("source_column").orderBy(F.desc("_score"), "_similar")
    for_target = Window.partitionBy("_similar").orderBy(F.desc("_score"), "source_column")
    left = write_snapshot(pairs, label="pairs")
    stand: list[DataFrame] = [left.limit(0)]
    while left.limit(1).count():
        agreed = (
            left.withColumn("_first", F.row_number().over(for_source))
            .withColumn("_second", F.row_number().over(for_target))
            .filter((F.col("_first") == 1) & (F.col("_second") == 1))
            .drop("_first", "_second")
        )
        agreed = write_snapshot(agreed, label="pairs")
        stand.append(agreed)
        for side in ("source_column", "_similar"):
            left = left.join(agreed.select(side), side, "left_anti")
        left = write_snapshot(left, label="pairs")
    return reduce(DataFrame.unionByName, stand)


def with_suggestions(
    mappings: DataFrame, similar: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Give unmatched source columns a similar target, scored by the similarity.

    Targets are given once: one that a column already has by name is out, and the others are
    assigned among all ``similar`` pairs, so a column that another one outdoes gets its next choice. With
    ``target`` (column_name, data_type) the target's type is taken over, and a cast if it
    differs from the source's.
    """
    taken = mappings.filter(~F.col("suggestion")).select(F.col("target_column").alias("_similar"))
    open_pairs = (
        similar.select(
            F.col("column_name").alias("source_column"),
            F.col("known_name").alias("_similar"),
            F.col("similarity").alias("_score"),
        )
        .join(mappings.filter("suggestion").select("source_column"), "source_column", "left_semi")
        .join(taken, "_similar", "left_anti")
    )
    agreed = _assigned(open_pairs)
    if target is not None:
        types = target.groupBy(F.col("column_name").alias("_similar")).agg(
            F.min("data_type").alias("_type")
        )
        agreed = agreed.join(types, "_similar", "left")
    else:
        agreed = agreed.withColumn("_type", F.lit(None).cast("string"))
    use = F.col("_similar").isNotNull()
    cast = use & (F.col("_type") != F.col("source_data_type"))
    logic = F.concat(F.lit("CAST("), "source_column", F.lit(" AS "), "_type", F.lit(")"))
    changes = {
        "target_column": F.coalesce("_similar", "target_column"),
        "confidence_score": F.coalesce("_score", "confidence_score"),
        "transformation_type": F.when(cast, "TYPE_CAST")
        .when(use, "DERIVED")
        .otherwise(F.col("transformation_type")),
        "target_data_type": F.coalesce("_type", "target_data_type"),
        "transformation_logic": F.when(cast, logic).otherwise(F.col("transformation_logic")),
    }
    return (
        mappings.join(agreed, "source_column", "left")
        .withColumns(changes)
        .drop("_similar", "_score", "_type")
    )


def confidence(mappings: DataFrame, *measures: Column) -> DataFrame:
    """Mean score, two decimals; 0.0 without mappings. Further measures may be added."""
    score = F.coalesce(F.col("confidence_score"), F.lit(MISSING_SCORE))
    return mappings.agg(
        F.count(F.lit(1)).alias("mappings"),
        F.coalesce(F.round(F.avg(score), 2), F.lit(0.0)).alias("confidence"),
        *measures,
    )


def with_defaults(mappings: DataFrame, mapping_id: Column) -> DataFrame:
    """Mapping rows as they are stored, with defaults for whatever is missing."""

    def filled(name: str, default) -> Column:
        if name not in mappings.columns:
            return F.lit(default).alias(name)
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    return mappings.select(
        mapping_id.alias("mapping_id"),
        "source_column",
        filled("target_column", MISSING_TARGET),
        filled("source_data_type", MISSING_TYPE),
        filled("target_data_type", MISSING_TYPE),
        filled("transformation_logic", MISSING_LOGIC),
        filled("transformation_type", MISSING_KIND),
        filled("confidence_score", MISSING_SCORE),
        filled("ai_generated", True),
    )


def transformation_text(mappings: DataFrame, relation: str, *measures: Column) -> DataFrame:
    """SELECT text of a mapping; brings together as many rows as the source has columns."""
    line = F.concat(F.lit("    "), "transformation_logic", F.lit(" AS "), "target_column")
    lines = F.array_sort(F.collect_list(F.struct(F.col("ordinal"), line.alias("line"))))
    text = mappings.agg(lines.alias("_lines"), *measures)
    return text.withColumn(
        "transformation_sql",
        F.concat(
            F.lit("SELECT\n"),
            F.array_join(F.transform("_lines", lambda x: x["line"]), ",\n"),
            F.lit(",\n    CURRENT_TIMESTAMP() AS LOADED_AT,\n    CURRENT_USER() AS LOADED_BY\n"),
            F.lit(f"FROM {relation}"),
        ),
    ).drop("_lines")


def cast_plan(mappings: DataFrame) -> list[tuple[str, str, str]]:
    """(source, target, type) in source order; one row per column of the source."""
    rows = mappings.orderBy("ordinal").select(
        "source_column", "target_column", "target_data_type"
    )
    return [tuple(r) for r in rows.collect()]


def target_names(mappings: DataFrame) -> list[str]:
    """Names of the mapped columns in source order."""
    return [target for _, target, _ in cast_plan(mappings)]


def apply_mapping(
    df: DataFrame,
    plan: list[tuple[str, str, str]],
    loaded_at: Column | None = None,
    loaded_by: Column | None = None,
) -> DataFrame:
    """Project and cast the data by a plan, with load time and user.

    A cell that its target type cannot hold becomes NULL, and its target column is
    named in ``cast_errors``, so that no bad row stops a load or gets lost.
    """
    columns, failures = [], []
    for source, target, dtype in plan:
        cast = f"try_cast({tick(source)} AS {dtype})"
        columns.append(f"{cast} AS {tick(target)}")
        failures.append(
            f"CASE WHEN {tick(source)} IS NOT NULL AND {cast} IS NULL "
            f"THEN {literal(target)} END"
        )
    mapped = df.selectExpr(
        *columns, f"array_compact(array({', '.join(failures)})) AS cast_errors"
    )
    return mapped.withColumns(
        {
            "loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
            "loaded_by": F.current_user() if loaded_by is None else loaded_by,
        }
    )


def cast_failures(df: DataFrame, plan: list[tuple[str, str, str]]) -> DataFrame:
    """Non-null cells and failed casts per mapped column; one aggregate."""
    measures, structs = ["count(1) AS _rows"], []
    for i, (source, target, dtype) in enumerate(plan):
        name = tick(source)
        measures += [
            f"count({name}) AS _n{i}",
            f"count_if({name} IS NOT NULL AND try_cast({name} AS {dtype}) IS NULL) AS _bad{i}",
        ]
        structs.append(
            f"struct({literal(source)} AS source_column, "
            f"{literal(target)} AS target_column, '{dtype}' AS target_data_type, "
            f"_n{i} AS non_null_count, _bad{i} AS failures)"
        )
    return df.agg(*[F.expr(m) for m in measures]).selectExpr(
        f"inline(array({', '.join(structs)}))"
    )


def source_columns(df: DataFrame, strip_prefix: str = "") -> DataFrame:
    """Column rows of a frame, optionally without a common name prefix."""
    rows = [
        (f.name.removeprefix(strip_prefix), f.dataType.simpleString(), i)
        for i, f in enumerate(df.schema.fields)
    ]
    return local_rows(
        df.sparkSession, rows, "column_name string, data_type string, ordinal int"
    )


def columns_from_ddl(df: DataFrame, ddl: str) -> DataFrame:
    """Column rows of a target given as a schema text."""
    rows = [
        (f.name, f.dataType.simpleString(), i)
        for i, f in enumerate(T.StructType.fromDDL(ddl).fields)
    ]
    return local_rows(
        df.sparkSession, rows, "column_name string, data_type string, ordinal int"
    )


def model_type(profile_rows: DataFrame) -> DataFrame:
    """Fact or dimension per table from its profile.

    A table with two or more key columns, a measure, and no key that is unique on
    its own is a fact; any other is a dimension.
    """
    is_key = F.col("column_name").rlike(r"(?i)(key|_id)\z")
    measures = ["double", "float"]
    is_measure = F.col("data_type").isin(measures) | F.col("data_type").startswith("decimal")
    unique_key = is_key & (F.col("cardinality") == "UNIQUE") & (F.col("null_count") == 0)
    counted = profile_rows.groupBy("table_name").agg(
        F.count_if(is_key).alias("key_columns"),
        F.count_if(is_measure & ~is_key).alias("measure_columns"),
        F.count_if(unique_key).alias("unique_keys"),
    )
    fact = (
        (F.col("key_columns") >= 2)
        & (F.col("measure_columns") >= 1)
        & (F.col("unique_keys") == 0)
    )
    return counted.withColumn("model_type", F.when(fact, "fct").otherwise("dim"))
