import datetime

from pyspark.sql import types as T

from surveyloom.plans import silver
from surveyloom.session import scratch_path
from surveyloom.sources import catalogue, files


def test_csv_keeps_quotes_newlines_and_spaces(spark, rows):
    data = [(1, 'a "b", c'), (2, "two\nlines"), (3, "  kept  "), (4, None), (5, "ação"), (6, 'ends with "')]
    df = spark.createDataFrame(data, "id int, t string")
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    assert rows(files.read_csv(spark, path, df.schema)) == rows(df)
    assert files.csv_schema(spark, path).simpleString() == "struct<id:int,t:string>"


def test_csv_columns_go_by_name(spark, rows):
    path = scratch_path(spark, "csv dir")
    spark.createDataFrame([("id,x,y\n1,a,b\n2,c,d",)], "v string").coalesce(1).write.text(path)
    spark.createDataFrame([("id,y,x,more\n3,f,e,9",)], "v string").coalesce(1).write.mode("append").text(path)
    df = files.read_csv(spark, path)
    assert rows(df.select("id", "x", "y", "more")) == [(1, "a", "b", None), (2, "c", "d", None), (3, "e", "f", 9)]
    known = files.read_csv(spark, path, T.StructType.fromDDL("id INT, x STRING, y STRING, z DATE"))
    assert rows(known) == [(1, "a", "b", None), (2, "c", "d", None), (3, "e", "f", None)]


def test_csv_infers_types(spark):
    path = scratch_path(spark, "csv")
    files.write_csv(spark.createDataFrame([(1, True, 0.5, "x"), (2, None, 1.0, None)], "a int, b boolean, c double, d string"), path)
    assert [t for _, t in files.read_csv(spark, path).dtypes] == ["int", "boolean", "double", "string"]


def test_overwrite_only_the_written_editions(spark, rows):
    path = scratch_path(spark, "silver")
    files.write_parquet(spark.createDataFrame([(1, 2023), (2, 2024)], "id int, ano int"), path, "ano")
    files.write_parquet(spark.createDataFrame([(9, 2024)], "id int, ano int"), path, "ano")
    assert rows(files.read_parquet(spark, path)) == [(1, 2023), (9, 2024)]


def test_overwrite_the_whole_table(spark, rows):
    path = scratch_path(spark, "silver")
    silver.write_silver(spark.createDataFrame([(1, 2023), (2, 2024)], "id int, ano int"), path)
    back = silver.write_silver(spark.createDataFrame([(9, 2024)], "id int, ano int"), path, replace="table")
    assert rows(back) == [(9, 2024)]


def test_rows_per_file(spark):
    path = scratch_path(spark, "files")
    files.write_parquet(spark.range(100).coalesce(1), path, rows_per_file=10)
    assert len(files.read_parquet(spark, path).inputFiles()) == 10


def test_catalogue(spark):
    df = spark.createDataFrame([(1, datetime.date(2024, 1, 1))], "id int, d date")
    catalogue.register_view(df, "survey_view")
    assert catalogue.show_columns(spark, "survey_view") == ["id", "d"]
    catalogue.create_database(spark, "gold_db")
    catalogue.create_database(spark, "gold_db")
    catalogue.save_table(df, "gold_db.answers")
    assert catalogue.show_columns(spark, "gold_db.answers") == ["id", "d"]
    assert [r[0] for r in spark.sql("SHOW COLUMNS IN gold_db.answers").collect()] == ["id", "d"]
    spark.sql("DROP DATABASE gold_db CASCADE")
