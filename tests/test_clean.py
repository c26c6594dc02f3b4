import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import clean_header_text, coerce_number, flag_int, is_ticked, normalise_text, percent, as_flag
from surveyloom.functions.names import clean_header, normalise_name
from surveyloom.functions.rules import map_by_table, map_values
from surveyloom.operators import clean, harmonise, profile, reshape, unify
from surveyloom.operators.unify import widest_type


def test_dedup_keeps_the_first_and_one_null_key(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 3)], "id string, v int")
    assert rows(clean.dedup_by_key(df, "id", ["v"])) == [("a", 1), ("b", 3), (None, 4)]
    assert rows(clean.dedup_rare_repeats(df, "id", ["v"])) == [("a", 1), ("b", 3), (None, 4)]


def test_hot_key_dedup_ranks_before_the_shuffle(spark, rows):
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS id", "id AS v")
    assert clean.dedup_by_key(df, "id", ["v"]).where("id = -1").collect()[0].v == 0
    assert clean.dedup_by_key(df, "id", ["v"]).count() == 20001
    assert clean.dedup_rare_repeats(df, "id", ["v"]).count() == 20001


def test_flag_text(spark):
    words = ["1", "1.0", " 1 ", "true", "TRUE", "Sim", "0", "0.0", "False", "não", "NAO", "0.9", "2", "", "x", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(flag_int(F.col("w"))).collect()]
    assert got == [1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, None, None, None, None, None]
    assert [bool(r[0]) for r in df.select(is_ticked(F.col("w"))).collect()] == [
        *[True] * 6, *[False] * 10,
    ]


def test_coerce_number(spark):
    df = spark.createDataFrame([("7",), (" 2.5 ",), ("1d",), ("nan",), ("",), (None,), ("-1e2",)], "w string")
    assert [r[0] for r in df.select(coerce_number(df, "w")).collect()] == [7.0, 2.5, 0.0, 0.0, 0.0, 0.0, -100.0]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in flags.select(coerce_number(flags, "b")).collect()] == [1.0, 0.0, 0.0]


def test_percent_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 2000), (1, 8), (5, 0), (None, 3), (3, 3)], "a long, b long")
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [0.1, 12.5, None, None, 100.0]


def test_binary_detection(spark):
    df = spark.createDataFrame(
        [(1, 0.0, True, 0.5, "TRUE", "a", None, 7, "1"), (None, 1.0, None, 1.0, "FALSE", None, None, 1, "Nao_informado")],
        "a int, b double, c boolean, d double, e string, f string, g int, h int, i string",
    )
    assert clean.binary_columns(df) == ["a", "b", "c", "e"]
    both = clean.binary_columns_of({1: df, 2: df.select("f", "b")})
    assert both == {1: ["a", "b", "c", "e"], 2: ["b"]}


def test_fill_answers(spark, rows):
    df = spark.createDataFrame([(None, None, None, None), ("x", 1.0, "TRUE", "t")], "id string, f double, g string, t string")
    filled = clean.fill_answers(df, ["f", "g"], keep=["id"])
    assert dict(filled.dtypes) == {"id": "string", "f": "int", "g": "int", "t": "string"}
    assert rows(filled) == [("x", 1, 1, "t"), (None, 0, 0, "Nao_informado")]


def test_no_nulls_after_filling(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, "a")], "id int, f int, t string")
    filled = clean.fill_answers(df, clean.binary_columns(df.select("f")), keep=["id"])
    assert profile.null_total(filled).first()[0] == 0


def test_bool_to_flag(spark, rows):
    df = spark.createDataFrame([(True, "TRUE", "x"), (False, "FALSE", "TRUE"), (None, None, "y")], "a boolean, b string, c string")
    assert rows(clean.bool_to_flag(df)) == [(0, "0", "1"), (1, "1", "x"), (None, None, "y")]


TEXTS = [
    "Olá, Mundo!", "água  FRIA", "", "___", "Já É 100%", "C++/C#", "ÀÉÎÕÜç", "straße", "naïve—façade", "日本 x", "a\u0301gua e\u0302", None,
]


def test_text_rule_equals_name_rule(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(normalise_text(F.col("t"))).collect()]
    assert got == [None if t is None else normalise_name(t) for t in TEXTS]


def test_text_rule_equals_name_rule_for_every_character(spark):
    points = [p for p in range(0x20, 0x20000) if not 0xD800 <= p < 0xE000]
    df = spark.createDataFrame([(i, f"a{chr(p)}b") for i, p in enumerate(points)], "id long, t string")
    found = {r.id: r.n for r in df.select("id", normalise_text(F.col("t")).alias("n")).collect()}
    assert [hex(p) for i, p in enumerate(points) if found[i] != normalise_name(f"a{chr(p)}b")] == []


def test_header_rule_equals_name_rule(spark):
    headers = [
        "('P2_o_1 ', 'Remuneração/Salário')", "('P4_b', \"ETL's usados\")", "2.o.1_Salário 100%", "12 x", "(solto", "4.l.1  N",
    ]
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    assert [r[0] for r in df.select(clean_header_text(F.col("h"))).collect()] == [clean_header(h) for h in headers]


def test_label_maps(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    labels = {"a": "A"}
    assert rows(df.select(map_values(F.col("v"), labels, True))) == [("A",), ("b",), (None,)]
    assert rows(df.select(map_values(F.col("v"), labels))) == [("A",), (None,), (None,)]
    table = spark.createDataFrame([("a", "A")], "source string, target string")
    assert rows(map_by_table(df, "v", table, "v", True)) == [("A",), ("b",), (None,)]
    twice = spark.createDataFrame([("a", "B"), ("a", "A")], "source string, target string")
    with pytest.raises(ValueError):
        map_by_table(df, "v", twice, "v")
    longer = {str(i): "x" for i in range(1000)} | {"a": "A"}
    assert rows(df.select(map_values(F.col("v"), longer)))[0] == ("A",)


def test_twin_columns(spark, rows):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 6)], "a int, b int, c int").toDF("x", "x", "c")
    assert rows(harmonise.drop_twins(df)) == [(0, 5), (1, 6)]
    assert rows(harmonise.drop_twins(df, "first")) == [(1, 5), (1, 6)]
    twins = spark.createDataFrame([(1, 0), (1, None)], "a int, b int")
    assert twins.agg(harmonise.greatest_twin_sum(twins, ["a", "b"])).first()[0] == 2


def test_ticked_options(spark, rows):
    df = spark.createDataFrame([(1, True, "0", 1.0), (2, None, "1", None)], "id int, a boolean, b string, c double")
    options = {"a": "A", "b": "B", "c": None, "z": "Z"}
    assert rows(reshape.ticked_options(df, ["id"], options)) == [(1, "A"), (1, None), (2, "B")]
    assert rows(reshape.ticked_options(df, ["id"], {"a": "S", "b": "S"})) == [(1, "S"), (2, "S")]
    assert rows(reshape.ticked_options(df, ["id"], {"z": "Z"})) == []


def test_stacked_counts_equal_counted_stack(spark, rows):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a")], "now string, ideal string")
    tagged = {"Atual": "now", "Ideal": "ideal"}
    long = reshape.stack_columns(df, tagged, "modelo", "situacao")
    assert rows(long) == [("a", "Atual"), ("a", "Atual"), ("a", "Ideal"), ("b", "Ideal")]
    assert rows(reshape.count_stacked(df, tagged, "modelo", "situacao")) == rows(
        long.groupBy("modelo", "situacao").count()
    )


def test_unify_types_and_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, 1, True, "x", 1)], "id int, f int, b boolean, t string, only int")
    b = spark.createDataFrame([(2, 0.5, 1, 7)], "id long, f double, b int, t int")
    frames = {2023: unify.tag_year(a, 2023), 2024: unify.tag_year(b, 2024)}
    common = unify.unify(frames)
    assert common.dtypes == [("id", "bigint"), ("ano", "int"), ("f", "double"), ("b", "int"), ("t", "string")]
    assert rows(common) == [(1, 2023, 1.0, 1, "x"), (2, 2024, 0.5, 1, "7")]
    outer = unify.unify(frames, "outer")
    assert rows(outer.select("id", "only")) == [(1, 1), (2, None)]
    assert {t for _, t in unify.unify(frames, as_string=True).dtypes} == {"string"}


def test_number_repeats_over_slices(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('n', id % 11) END AS n", "id AS k")
    got = {r.k: r.twin for r in profile.number_repeats(df, "n", "k", slice_bits=6).collect()}
    seen, expected = {}, {}
    for r in df.orderBy("k").collect():
        expected[r.k] = seen.get(r.n, 0)
        seen[r.n] = expected[r.k] + 1
    assert got == expected


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None), (6, "a")], "k int, t string")
    for wide in (False, True):
        assert rows(profile.duplicate_rows(df, ["t"], "k", wide).select("k")) == [(2,), (5,), (6,)]
        assert rows(profile.duplicate_groups(df, ["t"], wide)) == [("a", 2), (None, 1)]
        assert profile.duplicate_count(df, ["t"], wide).first()[0] == 3
    assert profile.duplicate_count(df).first()[0] == 0


def test_key_quality(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert rows(profile.key_quality(df, "id")) == [(5, 2, 2, 2)]


def test_numbers_are_flags_only_as_zero_and_one(spark, rows):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (0.5, 5), (1.7, -1), (None, None)], "a double, b int")
    assert rows(df.select(as_flag(df, "a"), as_flag(df, "b"))) == sorted(
        [(0, 0), (1, 1), (None, None), (None, None), (None, None)], key=repr)


def test_true_and_false_in_any_case(spark, rows):
    df = spark.createDataFrame([("TRUE",), (" true ",), ("False",), ("Sim",), (None,)], "t string")
    assert [r[0] for r in clean.bool_to_flag(df).collect()] == ["1", "1", "0", "Sim", None]


def test_nan_is_no_answer(spark):
    df = spark.createDataFrame([(1.0, 1.0), (float("nan"), 0.5), (0.0, 0.0), (None, None)], "a double, b double")
    assert clean.binary_columns(df) == ["a"]


def test_profiles_without_numeric_columns(spark):
    df = spark.createDataFrame([("x",)], "t string")
    assert profile.describe(df).collect() == [] and profile.min_max(df).collect() == []


def test_describe_a_column_without_values(spark):
    row = profile.describe(spark.createDataFrame([(None,)], "x int")).first()
    assert (row["count"], row["q50"], row["max"]) == (0, None, None)


def test_key_named_n(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "n int")
    assert rows(profile.key_quality(df, "n")) == [(3, 1, 1, 1)]


def test_duplicate_rows_without_ids(spark, rows):
    data = [(1, "a"), (None, "a"), (None, "b"), (None, "c"), (None, "c"), (2, None), (3, None)]
    df = spark.createDataFrame(data, "id int, v string")
    found = [tuple(r) for r in profile.duplicate_rows(df, ["v"], "id").collect()]
    assert sorted(found, key=str) == sorted([(None, "a"), (None, "c"), (None, "c"), (3, None)], key=str)


def test_widest_types():
    long, double, date = T.LongType(), T.DoubleType(), T.DateType()
    assert widest_type([T.IntegerType(), T.DecimalType(6, 2)]) == T.DecimalType(12, 2)
    assert widest_type([T.DecimalType(20, 4), T.DecimalType(6, 2)]) == T.DecimalType(20, 4)
    assert widest_type([long, T.DecimalType(38, 30)]) == T.StringType()
    assert widest_type([date, T.TimestampType()]) == T.TimestampType()
    assert widest_type([date, T.TimestampNTZType()]) == T.TimestampNTZType()
    assert widest_type([T.IntegerType(), double]) == double
    assert widest_type([long, double]) == T.StringType()
