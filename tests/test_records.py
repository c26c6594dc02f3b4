"""CSV records over split files: against the csv module and Spark's own one-task reader; rejected records; positions."""

import csv
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import types as T

from surveyloom.session import scratch_path
from surveyloom.sources import files, records


@contextmanager
def small_splits(spark, size):
    """Splits of about so many bytes, so that small files are read by many tasks."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(key)


def write_file(path, name, text):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", newline="", encoding="utf-8") as out:
        out.write(text)


def rows_as_csv(rows, line_end="\n"):
    import io

    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=line_end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("line, from_outside, from_inside", [
    ("a,b", False, True), ('a,"b', True, False), ('a,"b",c', False, True), ('"', True, False), ('""', False, True),
    ('5" pipe,x', False, False), ('a,"b ""c"" d",e', False, True), ('"x"",y"', False, False), ('a,"""b', True, False),
    ('a,"""b,c', True, False), ('a,"""', True, False), ("", False, True),
])
def test_state_of_a_line(line, from_outside, from_inside):
    assert records.state_after(False, line) == from_outside
    assert records.state_after(True, line) == from_inside


TRICKY = ["plain", "", 'say "hi"', "two\nlines", "a,b", '"', '""', 'ends"', "\n", "x\n\n,\"y\n", "ação", " lead", "trail ", "a\r\nb", ",", "\n\"\n"]


@pytest.mark.parametrize("size", [60, 300, 1 << 20])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_split_files_are_read_as_one_task_would(spark, size, line_end):
    rng = random.Random(size)
    rows = [[i, rng.choice(TRICKY), rng.choice(TRICKY), f"end{i}"] for i in range(150)]
    path = scratch_path(spark, "csv split")
    write_file(path, "one file.csv", rows_as_csv([["id", "x", "y", "z"], *rows], line_end))
    schema = "id int, x string, y string, z string"
    whole = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    with small_splits(spark, size):
        split = files.read_csv(spark, path, T.StructType.fromDDL(schema))
        got = sorted(tuple(r) for r in split.collect())
        tasks = spark.read.text(path).rdd.getNumPartitions()
    assert size > 500 or tasks > 10
    one_task = sorted(tuple(r) for r in whole.collect())
    if line_end == "\n":
        assert got == one_task
    else:  # Spark's reader writes line ends inside fields anew, here they stay as they are
        same = [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in got]
        assert same == one_task
    assert [(i, x or None, y or None) for i, x, y, _ in got] == [(i, x or None, y or None) for i, x, y, _ in rows]


def test_quotes_inside_unquoted_fields_are_text(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", 'id,x,y\n1,5" pipe,a\n2,b,"two\nlines"\n3,c 6",d\n4,"e","f"\n')
    for size in (12, 30, 1 << 20):
        with small_splits(spark, size):
            got = sorted(tuple(r) for r in files.read_csv(spark, path).collect())
        assert got == [(1, '5" pipe', "a"), (2, "b", "two\nlines"), (3, 'c 6"', "d"), (4, "e", "f")]


def test_header_forms(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", '﻿id,"two\nlines",x,x,\n1,a,b,c,d\n')
    df = files.read_csv(spark, path)
    assert df.columns == ["id", "two\nlines", "x2", "x3", "_c4"] and tuple(df.first()) == (1, "a", "b", "c", "d")


def test_empty_files(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", "")
    write_file(path, "b.csv", "id,x\n")
    write_file(path, "c.csv", "id,x\n\n  \n1,\n\n")
    assert [tuple(r) for r in files.read_csv(spark, path).collect()] == [(1, None)]
    assert files.read_csv(spark, path, T.StructType.fromDDL("id int, q date")).columns == ["id", "q"]


def test_types_are_inferred_over_all_files(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", "a,b,c,d,e,f,g,h\n1,9999999999,1,true,2024-01-02,2024-01-02 10:00:00,x,\n")
    write_file(path, "b.csv", "a,b,c,d,e,f,g,h\n,5,1.5,FALSE,2024-02-30,2024-01-02T10:00,y,\n")
    kinds = dict(files.read_csv(spark, path).dtypes)
    assert kinds == {"a": "int", "b": "bigint", "c": "double", "d": "boolean", "e": "string", "f": "timestamp", "g": "string", "h": "string"}


def test_rejected_records_are_listed(spark):
    path = scratch_path(spark, "csv dir")
    write_file(path, "a.csv", 'id,x,y\n1,a,b\n2,c,d,EXTRA\nzz,e,f\n3,"g\nh",i\n4,j\n5,k,l,\n6,"open,\nend\n')
    write_file(path, "b.csv", "y,id,when\nq,7,2024-01-01\nr,8,soon\ns,,2024-01-03\n")
    schema = T.StructType.fromDDL("id int, x string, y string, when date")
    for size in (10, 25, 1 << 20):
        with small_splits(spark, size):
            table = files.CsvFiles(spark, path, schema)
            rows = sorted((tuple(r) for r in table.rows().collect()), key=repr)
            bad = sorted((r.file.rsplit("/", 1)[1], r.line, r.reason, r.field) for r in table.rejected().collect())
            counts = {(r.reason, r.n_records) for r in files.rejected_counts(table.rejected()).collect()}
        assert bad == [
            ("a.csv", 3, "extra fields", None), ("a.csv", 4, "bad value", "id"), ("a.csv", 7, "missing fields", None),
            ("a.csv", 8, "extra fields", None), ("a.csv", 9, "open quote", None), ("b.csv", 3, "bad value", "when"),
        ]
        assert counts == {("extra fields", 2), ("bad value", 1), ("missing fields", 1), ("open quote", 1)}
        # nothing is lost: what could be read of a rejected record is a row
        assert len(rows) == 10 and (2, "c", "d", None) in rows and (None, "e", "f", None) in rows and (8, None, "r", None) in rows


def test_rows_in_file_order(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", "id,x\n" + "".join(f"{i % 7},{99 - i}\n" for i in range(50)))
    write_file(path, "b.csv", "x,id\n" + "".join(f"{-i},{i % 9}\n" for i in range(50)))
    with small_splits(spark, 30):
        got = [tuple(r) for r in files.read_csv(spark, path, position="_at").orderBy("_at").select("id", "x").collect()]
    assert got == [(i % 7, 99 - i) for i in range(50)] + [(i % 9, -i) for i in range(50)]


def test_parquet_rows_in_file_order(spark):
    path = scratch_path(spark, "parquet")
    spark.createDataFrame([(i, 9 - i) for i in range(10)], "a int, b int").coalesce(1).write.parquet(path)
    assert [r.a for r in files.read_parquet(spark, path, "_at").orderBy("_at").collect()] == list(range(10))


def test_changed_splits_are_noticed(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", "id,x\n" + "1,a\n" * 100)
    table = files.CsvFiles(spark, path, T.StructType.fromDDL("id int, x string"))
    with small_splits(spark, 50):
        with pytest.raises(Exception, match="changed between two passes"):
            table.rows().collect()


def test_delimiter(spark):
    path = scratch_path(spark, "csv")
    write_file(path, "a.csv", 'id;x\n1;"a;\nb"\n2;c,d\n')
    got = sorted(tuple(r) for r in files.CsvFiles(spark, path, delimiter=";").rows().collect())
    assert got == [(1, "a;\nb"), (2, "c,d")]
