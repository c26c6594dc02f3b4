"""Stacks of editions, rule tables, lineage, replaced and bucketed tables."""

import os
import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from surveyloom.functions.names import trace
from surveyloom.operators import clean, editions, harmonise
from surveyloom.operators.rule_tables import classify_by_table
from surveyloom.plans import questionnaire as Q
from surveyloom.plans import silver
from surveyloom.session import scratch_path
from surveyloom.sources import catalogue, files, versions

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_editions_of_one_table_are_scanned_once(spark):
    assert plan(queries()["totals_across_editions"](spark, SF_DIR)).count("lineitem.parquet") == 1
    for name in ("extract_challenge_totals", "extract_value_totals", "extract_ai_uses", "extract_ai_answers"):
        assert plan(queries()[name](spark, SF_DIR)).count("lineitem.parquet") == 1, name


@pytest.fixture
def frames(spark):
    return {
        2023: spark.createDataFrame([("a", 1, True), ("b", None, False)], "id string, x int, y boolean"),
        2024: spark.createDataFrame([("c", 1.0, "1", 5)], "id string, x double, x_1 string, z int"),
        2025: spark.createDataFrame([], "id string, y boolean"),
    }


def test_stack_of_frames(frames, rows):
    stack = editions.stack_of(frames)
    assert stack.rows.columns == ["id", "x", "y", "ano", "x_1", "z"] and stack.rows.count() == 3
    assert stack.knows("z") and not stack.knows("w")
    assert rows(stack.rows.where(stack.has("x", "y")).select("id")) == [("a",), ("b",)]
    assert rows(stack.rows.where(stack.has("w"))) == []


def test_totals_of_a_stack(frames, rows):
    twins = {"X": ["x", "x_1"], "Y": ["y"], "Z": ["z"], "W": ["w"]}
    assert rows(editions.totals_across(frames, twins)) == [("W", 0), ("X", 2), ("Y", 1), ("Z", 5)]
    nothing = {year: df.limit(0) for year, df in frames.items()}
    assert rows(editions.totals_across(nothing, twins)) == [("W", 0), ("X", 0), ("Y", 0), ("Z", 0)]


def test_percents_are_null_where_the_edition_lacks_the_column(frames, rows):
    got = rows(editions.percents_by_year(frames, {"x": "x", "z": "z", "w": "w"}))
    assert got == [(2023, 50.0, None, None), (2024, 100.0, 500.0, None)]


def test_stack_from_one_frame(spark, rows):
    df = spark.createDataFrame([(1, 1995, 7, 8), (2, 1996, 7, 8), (3, 1997, 7, 8), (4, None, 7, 8)], "id int, ano int, p int, q int")
    stack = editions.stack_from(df, "ano", {1995: {"id": "id", "a": "p"}, 1996: {"id": "id", "a": "q", "b": "p"}})
    assert rows(stack.rows) == [(1995, 1, 7, None), (1996, 2, 8, 7)]
    assert stack.present[1995] == {"id", "a"}


def test_read_stack(spark, frames, rows):
    folders = {}
    for year, df in frames.items():
        folders[year] = scratch_path(spark, "edition")
        df.write.parquet(folders[year])
    stack = editions.read_stack(spark, folders)
    assert rows(stack.rows) == rows(editions.stack_of(frames).rows) and stack.present[2024] == {"id", "x", "x_1", "z"}


# ---- lineage


def test_trace_of_twins_and_chains():
    origins = trace(["1.a_X", "2.a_X", "Y", "Z"], [{"x": "z", "x_1": "x"}, {"y": "w"}])
    assert [(o.clean, o.name, o.step) for o in origins] == [("x", None, 1), ("x_1", "x", 1), ("y", "w", 2), ("z", "z", 0)]
    first = trace(["1.a_X", "2.a_X", "Y", "Z"], [{"x": "z", "x_1": "x"}, {"y": "w"}], "first")
    assert [o.name for o in first] == ["z", "x", "w", None]


def test_lineage_agrees_with_harmonisation(spark):
    raw = {
        1: spark.createDataFrame([(1, 2, None), (3, 4, 5)], "id int, a int, b int"),
        2: spark.createDataFrame([(1, None, 2)], "token int, `1.x_A` int, new int"),
    }
    steps = {2: [{"token": "id"}]}
    got = {(r.edition, r.position): (r["column"], r.status, r.non_null) for r in harmonise.lineage(raw, steps, 1).collect()}
    assert got == {
        (1, 0): ("id", "same", 2), (1, 1): ("a", "same", 2), (1, 2): ("b", "same", 1),
        (2, 0): ("id", "renamed", 1), (2, 1): ("a", "same", 0), (2, 2): ("new", "unmapped", 1),
    }
    assert harmonise.harmonise(harmonise.clean_columns(raw[2]), steps[2]).columns == ["id", "a", "new"]


SPELLINGS_2024 = [
    "e_gestao_de_projetos_envolvendo_areas_multidisciplinares", "f_organizar_as_informacoes_com_qualidade_e_confiabilidade",
    "g_processar_e_armazenar_um_alto_volume_de_dados", "h_gerar_valor_para_as_areas_de_negocios",
    "j_gerenciar_a_expectativa_das_areas", "k_garantir_a_manutencao_dos_projetos_e_modelos_em_producao",
]


def test_spellings_of_2024_are_mapped():
    from surveyloom.functions.names import steps_for

    for name in SPELLINGS_2024:
        (origin,) = trace([name], steps_for(Q.mapping_rows(), "2024"))
        plain = name.split("_", 1)[1]
        (usual,) = trace([plain], steps_for(Q.mapping_rows(), "2025"))
        assert origin.name == usual.name != name


# ---- rules


def chained(value, rules, otherwise, ignore_case):
    for _, how, fragment, label in sorted(rules, key=lambda r: r[0]):
        if value is None or fragment is None:
            continue
        v, f = (value.lower(), fragment.lower()) if ignore_case else (value, fragment)
        if v.startswith(f) if how == "starts" else f in v if how == "contains" else v == f:
            return label
    return otherwise


@pytest.mark.parametrize("ignore_case", [False, True])
def test_rule_tables_equal_a_chain_of_rules(spark, ignore_case):
    rng = random.Random(3)
    word = lambda most: "".join(rng.choices("abAé ", k=rng.randrange(most)))
    values = [(i, word(14) if i % 9 else None) for i in range(400)] + [(400, ""), (401, "abcdefghijkl")]
    rules = [(i, rng.choice(["starts", "contains", "equals"]), word(9) or "ab", rng.choice(["x", "y", None, f"l{i}"])) for i in range(1, 200)]
    rules += [(500, "contains", None, "never"), (501, "starts", "abcdefghij", "long")]
    for table in (rules, rules[-2:], [(1, "contains", "", "all")], rules[:1]):
        df = spark.createDataFrame(values, "id int, v string")
        made = spark.createDataFrame(table, "place int, how string, fragment string, label string")
        got = {r.id: r.g for r in classify_by_table(df, "v", made, "g", "none", ignore_case).collect()}
        assert got == {i: chained(v, table, "none", ignore_case) for i, v in values}


def test_rule_tables_are_checked(spark):
    df = spark.createDataFrame([("a",)], "v string")
    kind = "place int, how string, fragment string, label string"
    with pytest.raises(ValueError, match="same place"):
        classify_by_table(df, "v", spark.createDataFrame([(1, "starts", "a", "x"), (1, "starts", "b", "y")], kind), "g", None)
    with pytest.raises(ValueError, match="neither"):
        classify_by_table(df, "v", spark.createDataFrame([(1, "like", "a", "x")], kind), "g", None)
    assert classify_by_table(df, "v", spark.createDataFrame([], kind), "g", "none").first().g == "none"


def test_many_rules_make_no_condition_per_rule(spark):
    df = spark.range(50).select(F.concat(F.lit("value "), "id").alias("v"))
    rules = spark.range(10_000).select(
        F.col("id").alias("place"), F.lit("contains").alias("how"), F.concat(F.lit("e "), "id").alias("fragment"), F.concat(F.lit("l"), "id").alias("label")
    )
    made = classify_by_table(df, "v", rules, "g", None)
    assert "BroadcastNestedLoopJoin" not in plan(made) and "CartesianProduct" not in plan(made)
    assert plan(made).count("CASE WHEN") < 20
    got = {r.v: r.g for r in made.collect()}
    assert got["value 7"] == "l7" and got["value 49"] == "l4"


def test_fragments_of_every_length_meet_texts_at_every_place(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("aé\n😀 b", k=n))
    lengths = [1, 2, 3, 4, 6, 7, 8, 9, 14, 15, 16, 17, 30, 31, 32, 33, 45, 63, 64, 65, 90, 128, 129]
    fragments = {n: word(n) for n in lengths}
    values = [(n * 100 + at, word(at) + fragments[n] + word(at % 5)) for n in lengths for at in range(20)]
    values += [(20_000 + n, fragments[n][:-1]) for n in lengths] + [(20_500 + n, fragments[n]) for n in lengths] + [(30_000, None), (30_001, "")]
    df = spark.createDataFrame(values, "id int, v string")
    longest_first = sorted(lengths, reverse=True)
    for hows in (["contains"], ["starts"], ["starts", "contains", "equals"]):
        rules = [(10 * i, hows[i % len(hows)], fragments[n], f"l{n}") for i, n in enumerate(longest_first)]
        for every in ([], [(-1, "starts", "", "first")], [(95, "contains", "", "middle"), (145, "starts", "", "later")]):
            table = rules + every
            made = spark.createDataFrame(table, "place int, how string, fragment string, label string")
            got = {r.id: r.g for r in classify_by_table(df, "v", made, "g", "none").collect()}
            assert got == {i: chained(v, table, "none", False) for i, v in values}


def test_rule_tables_write_little_besides_the_texts(spark, monkeypatch):
    """Not a row for each run of characters that a text shares with some fragment, nor one for each repeated rule."""
    rng = random.Random(7)
    syllables = ["ta", "ri", "mo", "en", "lu", "sk", "o ", "e "]
    text = lambda n: "".join(rng.choices(syllables, k=n))
    texts = [(i, text(600)) for i in range(60)]
    rules = [(i, "contains", text(20), f"r{i}") for i in range(100)] + [(100 + i, "contains", texts[i][1][301:341], f"p{i}") for i in range(0, 60, 2)]
    rules += [(1000 + i, "starts", texts[i % 60][1][:12], f"s{i}") for i in range(3000)]
    shared = tempfile.mkdtemp(prefix="surveyloom-tests-")
    monkeypatch.setattr("surveyloom.operators.rule_tables.scratch_path", lambda _, label: f"{shared}/{label}-{uuid.uuid4().hex}")
    df = spark.createDataFrame(texts, "id int, v string")
    made = spark.createDataFrame(rules, "place int, how string, fragment string, label string")
    got = {r.id: r.g for r in classify_by_table(df, "v", made, "g", "none").collect()}
    assert got == {i: chained(v, rules, "none", False) for i, v in texts}
    assert {got[i] for i in range(60)} >= {"p0", "p58", "s1", "s59"}
    written = {folder.split("-")[0]: spark.read.parquet(f"{shared}/{folder}").count() for folder in os.listdir(shared) if folder.startswith(("rules-", "value-"))}
    assert written["value"] < 20 * len(texts)
    assert written["rules"] == 130 + 60


# ---- tables


def test_first_in_file_order_differs_from_first_by_columns(spark, rows):
    path = scratch_path(spark, "parquet")
    spark.createDataFrame([(1, "z"), (2, "m"), (1, "a"), (None, "q"), (None, "b")], "k int, v string").coalesce(1).write.parquet(path)
    by_file = clean.dedup_by_key(files.read_parquet(spark, path, "_at"), "k", ["_at"]).drop("_at")
    assert rows(by_file) == [(1, "z"), (2, "m"), (None, "q")]
    assert rows(clean.dedup_by_key(spark.read.parquet(path), "k", ["v"])) == [(1, "a"), (2, "m"), (None, "b")]


def test_silver_keeps_the_first_row_of_the_files(spark, rows):
    path = scratch_path(spark, "bronze")
    lines = ["id,x,nota", "a,1,z", "b,0,b", "a,0,a"]
    spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.text(path)
    raw = {2023: files.read_csv(spark, path, position="_position")}
    for stage in (False, True):
        assert rows(silver.build_silver(raw, stage=stage)) == [("a", 2023, 1, "z"), ("b", 2023, 0, "b")]
    curated = silver.build_silver(raw, curated=["NOTA", "id"])
    assert curated.columns == ["id", "ano", "nota"] and rows(curated) == [("a", 2023, "z"), ("b", 2023, "b")]


def test_staged_editions_go_after_the_write(spark):
    import os

    raw = {2023: spark.createDataFrame([("a", 1), ("a", 1), ("b", 0)], "id string, x int")}
    built = silver.build_silver(raw)
    from surveyloom.session import scratch_folders

    staged = scratch_folders(built, ("staged", "repeats"))
    assert len(staged) == 2 and all(os.path.isdir(f.removeprefix("file:")) for f in staged)
    table = silver.write_silver(built, scratch_path(spark, "silver"))
    assert table.count() == 2 and not any(os.path.exists(f.removeprefix("file:")) for f in staged)


def test_replaced_table_is_whole_at_any_time(spark, rows):
    import os

    root, name = scratch_path(spark, "versions"), "replaced_by_test"
    versions.replace_table(spark.range(5).toDF("x"), name, root)
    reader = spark.table(name)
    broken = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("x")
    )
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(broken, name, root)
    assert rows(spark.table(name)) == [(i,) for i in range(5)]  # the job died midway
    assert len(os.listdir(root)) == 2  # with what it left
    versions.replace_table(spark.table(name).select((F.col("x") + 10).alias("x")), name, root)
    assert rows(spark.table(name)) == [(i + 10,) for i in range(5)]
    assert rows(reader) == [(i,) for i in range(5)]  # a reader of the version before can finish
    assert len(os.listdir(root)) == 2
    versions.replace_table(spark.range(1).toDF("x"), name, root)
    assert rows(spark.table(name)) == [(0,)] and len(os.listdir(root)) == 2
    versions.drop_table(spark, name, root)
    assert os.listdir(root) == [] and versions.current_version(spark, name) is None


def test_bucketed_table_needs_no_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 300).alias("id"), F.col("id").alias("v"), F.lit(2023).alias("ano"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            catalogue.save_bucketed(rows, name, "id", 4, scratch_path(spark, "bucketed"))
        one, two = spark.table("bucketed_a"), spark.table("bucketed_b")
        single = clean.dedup_by_key(one, "id", ["v"])
        assert "Exchange" not in plan(single) and single.count() == 300
        joined = single.join(clean.dedup_by_key(two, "id", ["v"]), "id")
        assert "Exchange" not in plan(joined) and joined.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_shares_of_the_whole_need_no_single_task_window(spark):
    text = plan(queries()["share_overall"](spark, SF_DIR))
    assert "Window" not in text


def test_own_widths_in_proof_counts(spark):
    table = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, ano int")
    assert [tuple(r) for r in silver.proof_counts(table, widths={2023: 193, 2024: 188}).collect()] == [(2023, 1, 193), (2024, 1, 188)]
