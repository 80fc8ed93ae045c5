from __future__ import annotations

import random

from pyspark.sql import functions as F

from berth.operators import dictionary as dic
from berth.operators import mapping as mp
from berth.operators import profile as prof

LAYOUT = "column_name string, data_type string, ordinal int"


def test_first_target_wins_and_types_decide(spark):
    source = spark.createDataFrame(
        [("ID", "int", 0), ("Full Name", "string", 1), ("amount", "string", 2)], LAYOUT
    )
    target = spark.createDataFrame(
        [("id", "int", 3), ("Id", "bigint", 1), ("AMOUNT", "decimal(10, 2)", 2)], LAYOUT
    )
    rows = {r["source_column"]: r for r in mp.match_columns(source, target).collect()}
    assert rows["ID"]["target_column"] == "Id"
    assert rows["ID"]["transformation_logic"] == "CAST(ID AS bigint)"
    assert rows["amount"]["transformation_type"] == "TYPE_CAST"
    assert rows["Full Name"]["target_column"] == "full_name"
    assert rows["Full Name"]["suggestion"] and rows["Full Name"]["confidence_score"] == 0.7
    assert mp.confidence(mp.match_columns(source, target)).collect()[0]["confidence"] == 0.87
    assert mp.confidence(source.limit(0).select(F.lit(1.0).alias("confidence_score"))).collect()[0][
        "confidence"
    ] == 0.0


def jaccard(a, b):
    a, b = set(a.split("_")), set(b.split("_"))
    return len(a & b) / len(a | b)


def test_similar_names_match_brute_force(spark):
    random.seed(3)
    words = ["customer"] * 12 + ["order", "id", "key", "name", "date", "total", "ship", "line"]
    names = sorted({"_".join(dict.fromkeys(random.choices(words, k=random.randint(1, 4)))) for _ in range(220)})
    new, known = names[::2], names
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "column_name string")
    for share, k in ((0.5, 3), (0.3, 2), (0.75, 4)):
        got = {}
        for r in mp.similar_names(frame(new), frame(known), share, k).collect():
            got.setdefault(r["column_name"], {})[r["rank"]] = (r["known_name"], round(r["similarity"], 9))
        for name in new:
            scored = sorted(
                (-jaccard(name, o), o) for o in known if o != name and jaccard(name, o) >= share
            )[:k]
            expected = {i + 1: (o, round(-s, 9)) for i, (s, o) in enumerate(scored)}
            assert got.get(name, {}) == expected


def test_apply_mapping_keeps_bad_rows(spark):
    df = spark.createDataFrame([("1", "2.50"), ("x", "3"), (None, "y")], "a string, b string")
    mapped = mp.apply_mapping(df, [("a", "id", "int"), ("b", "price", "decimal(5,2)")])
    rows = [(r["id"], r["price"], r["cast_errors"]) for r in mapped.collect()]
    assert [(i, None if p is None else float(p), e) for i, p, e in rows] == [
        (1, 2.5, []),
        (None, 3.0, ["id"]),
        (None, None, ["price"]),
    ]
    assert mapped.schema["loaded_at"].dataType.simpleString() == "timestamp"


def test_defaults_and_text(spark):
    partial = spark.createDataFrame([(0, "a", None), (1, "b", "bb")], "ordinal int, source_column string, target_column string")
    rows = {r["source_column"]: r for r in mp.with_defaults(partial, F.lit("m")).collect()}
    assert rows["a"]["target_column"] == "UNMAPPED" and rows["b"]["target_column"] == "bb"
    assert rows["a"]["source_data_type"] == "UNKNOWN" and rows["a"]["confidence_score"] == 0.5
    assert rows["a"]["ai_generated"] is True and rows["a"]["transformation_logic"] == "DIRECT"
    lines = spark.createDataFrame([(1, "b", "y"), (0, "a", "x")], "ordinal int, transformation_logic string, target_column string")
    text = mp.transformation_text(lines, "S.T").collect()[0]["transformation_sql"]
    assert text.splitlines() == [
        "SELECT",
        "    a AS x,",
        "    b AS y,",
        "    CURRENT_TIMESTAMP() AS LOADED_AT,",
        "    CURRENT_USER() AS LOADED_BY",
        "FROM S.T",
    ]


def test_target_schema(spark):
    catalog = dic.catalog_rows(spark, {("s", "t"): spark.range(1), ("s", "u"): spark.range(1)})
    assert mp.target_schema(catalog, "s").count() == 2
    assert mp.schema_exists(catalog, "s", "t").collect()[0]["exists"] is True
    assert mp.schema_exists(catalog, "s", "none").collect()[0]["exists"] is False
    assert mp.tables_per_schema(catalog).collect()[0]["table_count"] == 2


def test_ddl_and_table_name(spark):
    columns = spark.createDataFrame(
        [("t", "b", 1, "string", True, None), ("t", "a", 0, "int", False, "SSN")],
        "table_name string, column_name string, ordinal int, data_type string, nullable boolean, label string",
    )
    ddl = dic.ddl_texts(columns, "DB", "S").collect()[0]["ddl"]
    assert ddl == (
        "CREATE OR REPLACE TABLE DB.S.t (\n"
        "    a int NOT NULL COMMENT 'PII - Apply masking policy',\n"
        "    b string\n\n);"
    )
    texts = [ddl, "create table x (a int)", "CREATE TABLE a.b.C_1(", "select 1"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    names = [r["n"] for r in df.select(dic.ddl_table_name(F.col("d")).alias("n")).collect()]
    assert names == ["t", "x", "C_1", "UNKNOWN_TABLE"]
    more = {
        "create table if not exists x (a int)": "x",
        'CREATE OR REPLACE TEMPORARY TABLE a . "My ""T""" (a int)': 'My "T"',
        "create transient table c.s.`odd ``name`` 1` as select 1": "odd `name` 1",
        "CREATE\n TABLE\tiffy(a int)": "iffy",
        "CREATE VIEW v AS SELECT 1": "UNKNOWN_TABLE",
    }
    df = spark.createDataFrame([(t,) for t in more], "d string")
    assert [r["n"] for r in df.select(dic.ddl_table_name(F.col("d")).alias("n")).collect()] == [*more.values()]


def test_dictionary_upsert_is_idempotent(spark):
    layout = "source_system string, table_name string, column_name string, data_type string, is_pii boolean, pii_type string"
    old = spark.createDataFrame([("s", "t", "a", "int", False, None), ("s", "t", "b", "int", False, None)], layout)
    old = old.withColumns({"created_at": F.lit("old"), "updated_at": F.lit("old"), "description": F.lit("kept")})
    new = spark.createDataFrame([("s", "t", "b", "string", True, "SSN"), ("s", "u", "a", "date", False, None)], layout)
    once = dic.upsert_dictionary(old, new, F.lit("now"))
    rows = {(r["table_name"], r["column_name"]): r for r in once.collect()}
    assert len(rows) == 3
    assert rows["t", "a"]["updated_at"] == "old" and rows["t", "b"]["updated_at"] == "now"
    assert rows["t", "b"]["created_at"] == "old" and rows["t", "b"]["description"] == "kept"
    assert rows["t", "b"]["pii_type"] == "SSN" and rows["u", "a"]["created_at"] == "now"
    twice = dic.upsert_dictionary(once, new, F.lit("now"))
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_type_proposals(spark):
    df = spark.sql(
        "SELECT CAST(id * 100 AS bigint) AS small, id / 4 AS cents, id / 3 AS thirds, "
        "concat('x', id) AS s, TIMESTAMP_NTZ '2024-01-01' + make_interval(0,0,0,id) AS day, "
        "CAST(NULL AS bigint) AS none FROM range(200)"
    )
    got = {r["column_name"]: r["proposed_type"] for r in dic.narrow_types({"t": df}).collect()}
    assert got == {
        "small": "smallint",
        "cents": "decimal(4,2)",
        "thirds": "double",
        "s": "varchar(4)",
        "day": "date",
        "none": "bigint",
    }


def test_constraints_on_a_hot_reference(spark):
    child = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 99).otherwise(F.col("id") % 5).alias("ref"))
    parent = spark.range(5).toDF("k")
    assert dic.reference_test(child, "c", "ref", parent, "k").collect()[0]["failures"] == 334
    assert dic.unique_test(child, "c", ["ref"]).collect()[0]["failures"] == 6
    assert dic.unique_test(parent, "p", ["k"]).collect()[0]["failures"] == 0


def test_model_type_and_keys(spark):
    fact = spark.range(20).selectExpr("id % 3 AS a_key", "id % 4 AS b_key", "id * 1.5D AS amount")
    dim = spark.range(20).selectExpr("id AS a_key", "concat('n', id) AS label")
    rows = prof.profile_tables({"f": fact, "d": dim})
    kinds = {r["table_name"]: r["model_type"] for r in mp.model_type(rows).collect()}
    assert kinds == {"f": "fct", "d": "dim"}
    roles = {(r["table_name"], r["column_name"]): r["role"] for r in dic.key_candidates(rows).collect()}
    assert roles["d", "a_key"] == "PRIMARY_KEY" and roles["f", "a_key"] == "CLUSTERING"


def test_names_of_many_words(spark):
    words = [f"w{i}" for i in range(40)]
    names = ["_".join(words), "_".join(words[:30] + ["x"]), "_".join(words[:8]), "_".join(words[:12]), "w1_w2"]
    df = spark.createDataFrame([(n,) for n in names], "column_name string")
    got = {(r["column_name"], r["known_name"]): r["similarity"] for r in mp.similar_names(df, df, 0.5, 5).collect()}
    expected = {}
    for a in names:
        for b in names:
            x, y = set(a.split("_")), set(b.split("_"))
            if a != b and len(x & y) / len(x | y) >= 0.5:
                expected[a, b] = len(x & y) / len(x | y)
    assert got == expected


def test_competing_sources_get_one_target_each(spark):
    source = spark.createDataFrame([("part_key", "bigint", 0), ("old_part_key", "bigint", 1)], "column_name string, data_type string, ordinal int")
    target = spark.createDataFrame([("key_part", "string", 0)], "column_name string, data_type string, ordinal int")
    mappings = mp.match_columns(source, target)
    rows = {r["source_column"]: r for r in mp.with_suggestions(mappings, mp.similar_names(source, target), target).collect()}
    best, other = rows["part_key"], rows["old_part_key"]
    assert (best["target_column"], best["target_data_type"], best["transformation_type"]) == ("key_part", "string", "TYPE_CAST")
    assert best["transformation_logic"] == "CAST(part_key AS string)"
    assert (other["target_column"], other["target_data_type"]) == ("old_part_key", "bigint")


def test_a_column_that_is_outdone_gets_its_next_choice(spark):
    layout = "column_name string, data_type string, ordinal int"
    source = spark.createDataFrame([("part_key", "bigint", 0), ("part_key_code", "bigint", 1)], layout)
    target = spark.createDataFrame([("key_part", "bigint", 0), ("part_code_zone", "bigint", 1)], layout)
    mappings = mp.match_columns(source, target)
    rows = {
        r["source_column"]: (r["target_column"], r["confidence_score"])
        for r in mp.with_suggestions(mappings, mp.similar_names(source, target), target).collect()
    }
    assert rows == {"part_key": ("key_part", 1.0), "part_key_code": ("part_code_zone", 0.5)}


def test_assignments_are_stable_and_complete(spark):
    import random

    draw = random.Random(5)
    names = [[f"{side}{n:02}" for n in range(12)] for side in "st"]
    pairs = {(a, b): draw.randint(1, 6) / 6 for a in names[0] for b in names[1] if draw.random() < 0.5}
    df = spark.createDataFrame([(*k, v) for k, v in pairs.items()], "source_column string, _similar string, _score double")
    got = {(r["source_column"], r["_similar"]) for r in mp._assigned(df).collect()}
    given, taken, expected = set(), set(), set()
    for a, b in sorted(pairs, key=lambda p: (-pairs[p], p)):
        if a not in given and b not in taken:
            expected.add((a, b))
            given.add(a)
            taken.add(b)
    assert got == expected
