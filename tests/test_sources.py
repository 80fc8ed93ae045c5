from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from berth.session import scratch_dir
from berth.sources import readers, sinks


def test_csv_rules(spark, tmp_path):
    text = (
        "id,name,amount\n"
        '1,  padded  ,"1,5"\n'
        '2,NULL,null\n'
        '3,,"say ""hi"""\n'
        "4,short\n"
        "5,long,2.5,surplus,more\n"
    )
    (tmp_path / "a.csv").write_text(text)
    rows = {r["id"]: (r["name"], r["amount"]) for r in readers.read_csv(spark, str(tmp_path)).collect()}
    assert rows == {
        "1": ("padded", "1,5"),
        "2": (None, None),
        "3": (None, 'say "hi"'),
        "4": ("short", None),
        "5": ("long", "2.5"),
    }
    typed = readers.read_csv(spark, str(tmp_path), schema="id int, amount double")
    assert dict(typed.dtypes) == {"id": "int", "name": "string", "amount": "double"}
    assert {r["id"]: r["amount"] for r in typed.collect()}[1] is None


def test_csv_header_only_and_many_files(spark, tmp_path):
    (tmp_path / "customer_a.csv").write_text("x,y\n")
    (tmp_path / "customer_b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "other.csv").write_text("x,y\n9,9\n")
    empty = readers.read_csv(spark, str(tmp_path / "customer_a.csv"), infer=True)
    assert empty.columns == ["x", "y"] and empty.count() == 0
    many = readers.read_csv(spark, str(tmp_path / "customer_*.csv"), with_file=True)
    assert [r["x"] for r in many.collect()] == ["1"]
    names = many.select(readers.file_name(many["source_path"]).alias("n")).collect()
    assert [r["n"] for r in names] == ["customer_b.csv"]


def test_json_outer_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "x"},\n {"a": 2}]')
    rows = readers.read_json(spark, str(tmp_path)).orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1, "x"), (2, None)]


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "sample_data.csv").write_text("a\n1\n")
    (tmp_path / "z.txt").write_text("zz")
    rows = readers.list_files(spark, str(tmp_path), r".*sample_data.*").collect()
    assert [(r["file_name"], r["size_bytes"]) for r in rows] == [("sample_data.csv", 4)]


def test_sample_is_repeatable(spark):
    df = spark.range(1000).repartition(7)
    assert [r["id"] for r in readers.sample(df, ["id"], 5).collect()] == [0, 1, 2, 3, 4]
    one = readers.sample_share(spark.range(1000), 0.3, seed=7)
    assert one.collect() == one.collect()


def test_failed_inputs_do_not_stop_the_rest(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("a\n1\n2\n")
    (tmp_path / "bad.parquet").write_text("no parquet at all")
    inputs = [
        (str(tmp_path / "ok.csv"), "CSV_FORMAT"),
        (str(tmp_path / "gone.csv"), "CSV_FORMAT"),
        (str(tmp_path / "bad.parquet"), "PARQUET_FORMAT"),
    ]
    rows = {r["file_name"]: r for r in sinks.measure_inputs(spark, inputs).collect()}
    assert rows["ok.csv"]["status"] == "COMPLETED" and rows["ok.csv"]["row_count"] == 2
    assert rows["gone.csv"]["summary"] == "Error: PATH_NOT_FOUND"
    assert rows["bad.parquet"]["status"] == "FAILED"
    assert rows["bad.parquet"]["summary"].startswith("Error: ")


def test_append_copy_and_insert(spark):
    path = scratch_dir(spark, "append")
    for i in range(3):
        sinks.append_rows(spark.range(i, i + 1).selectExpr("id", "array(struct(id)) AS nested"), path)
    assert spark.read.parquet(path).count() == 3
    name = "copy_" + path[-12:]
    assert sinks.copy_table(spark.range(4).toDF("a"), name).count() == 4
    with pytest.raises(PySparkException):
        sinks.copy_table(spark.range(4).toDF("a"), name)


def test_scratch_folder_is_shared(spark):
    base = spark.sparkContext.getCheckpointDir()
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    base = base or spark.sparkContext.getCheckpointDir()
    assert first.startswith(base.rstrip("/"))


def test_columns_are_never_swapped_between_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x,z\n3,4,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path)).collect()
    rows = readers.read_csv(spark, str(tmp_path), by_header=True, infer=True).collect()
    assert sorted((r["x"], r["y"], r["z"]) for r in rows if r["z"]) == [(4, 3, 5)]
    assert [(r["x"], r["y"]) for r in rows if r["z"] is None] == [(1, 2)]


def test_lost_cells_are_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\nbad,3\nNULL,worse\n")
    rows = readers.read_csv(spark, str(tmp_path), schema="x int, y int", with_errors=True).collect()
    assert [(r["x"], r["y"], r["cast_errors"]) for r in rows] == [(1, 2, []), (None, 3, ["x"]), (None, None, ["y"])]


def test_damage_behind_an_intact_footer_is_found(spark, tmp_path):
    import glob

    spark.range(100_000).selectExpr("id", "concat('v', id) AS v").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(7).write.parquet(str(tmp_path / "ok.parquet"))
    part = glob.glob(str(tmp_path / "t.parquet" / "part-*.parquet"))[0]
    with open(part, "r+b") as f:
        f.seek(1000)
        f.write(b"\0" * 200_000)
    for crc in glob.glob(str(tmp_path / "t.parquet" / ".part-*.crc")):
        open(crc, "wb").close()
    inputs = [(str(tmp_path / n), "PARQUET_FORMAT") for n in ("ok.parquet", "t.parquet")]
    rows = {r["file_name"]: r for r in sinks.measure_inputs(spark, inputs).collect()}
    assert (rows["ok.parquet"]["status"], rows["ok.parquet"]["row_count"]) == ("COMPLETED", 7)
    assert rows["t.parquet"]["status"] == "FAILED"
