"""Three messy CSV editions through the whole way: silver table, view, indicators, extracts."""

import csv
import os

import pytest

from surveyloom.functions.names import repeated_names, steps_for
from surveyloom.operators.harmonise import clean_columns, harmonise
from surveyloom.operators.reshape import ticked_options
from surveyloom.plans import extracts, gold, silver
from surveyloom.plans import questionnaire as Q
from surveyloom.session import scratch_path
from surveyloom.sources import catalogue, files

E2023 = [
    ["('P0', 'id')", "('P1_a ', 'Gênero')", "('P2_h ', 'Faixa Salarial')", "('P4_a ', 'Atuação')",
     "('P2_o_1 ', 'Remuneração/Salário')", "('P4_d_3 ', 'Python')", "('P3_x', \"A. Contratar novos talentos.\")",
     "('P2_r ', 'Atualmente qual a sua forma de trabalho?')"],
    ["a1", "Feminino", "de R$ 12.001/mês a R$ 16.000/mês", "Gestor", "1", "1.0", "1", "Modelo 100% remoto"],
    ["a2", "Masculino", "", "", "", "", "0", ""],
    ["a2", "Masculino", "", "", "", "", "0", ""],
]
E2024 = [
    ["0.a_token", "1.b_Gênero", "2.h_Faixa salarial", "4.a_Atuação em dados", "2.m.1_Remuneração/Salário",
     "2.o.1_Remuneração/Salário", "4.d.3_Python", "3.x.1_Contratar talentos", "2.r_Modelo de trabalho atual"],
    ["b1", "Feminino", "Acima de R$ 40.001/mês", "Análise de Dados", "TRUE", "FALSE", "TRUE", "TRUE",
     "Modelo 100% presencial"],
    ["b2", "Masculino", "de R$ 1.001/mês", "Gestor", "FALSE", "TRUE", "", "FALSE", "Outro,\ncom \"aspas\""],
]
E2025 = [
    ["0.a_token", "1.b_Gênero", "2.h_Faixa salarial", "4.a_Atuação em dados", "2.m.1_Remuneração/Salário",
     "2.o.1_Remuneração/Salário", "4.d.3_Python", "2.r_Modelo de trabalho atual"],
    ["c1", "Outro", "de R$ 20.001/mês a R$ 25.000/mês", "0", "TRUE", "TRUE", "FALSE", ""],
]


@pytest.fixture(scope="module")
def raw(spark):
    frames = {}
    for year, lines in ((2023, E2023), (2024, E2024), (2025, E2025)):
        path = scratch_path(spark, f"bronze-{year}")
        os.makedirs(path)
        with open(f"{path}/edition.csv", "w", newline="") as out:
            csv.writer(out).writerows(lines)
        frames[year] = files.read_csv(spark, path)
    return frames


@pytest.mark.parametrize("stage", [False, True])
def test_silver(spark, raw, stage):
    built = silver.build_silver(raw, mapping=Q.mapping_rows(), stage=stage)
    table = silver.write_silver(built, scratch_path(spark, "silver"))
    assert table.columns == [
        "id", "ano", "genero", "faixa_salarial", "atuacao", "remuneracao_salario", "python",
        "atualmente_qual_a_sua_forma_de_trabalho",
    ]
    assert repeated_names(table.columns) == []
    got = {r.id: r for r in table.collect()}
    assert set(got) == {"a1", "a2", "b1", "b2", "c1"}
    assert (got["a2"].python, got["a2"].remuneracao_salario, got["a2"].atuacao) == (0, 0, "Nao_informado")
    # The first question of a repeated header is about dissatisfaction, the second is the criterion.
    assert (got["b1"].remuneracao_salario, got["b2"].remuneracao_salario) == (0, 1)
    assert got["b2"].atualmente_qual_a_sua_forma_de_trabalho == 'Outro,\ncom "aspas"'
    assert [tuple(r) for r in silver.proof_counts(table).collect()] == [(2023, 2, 8), (2024, 2, 8), (2025, 1, 8)]

    view = gold.gold_view(table)
    assert {r.id: (r.atuacao_ok, r.top_tier) for r in view.collect()} == {
        "a1": ("Gestor", 1), "a2": ("Análise de Dados", 0), "b1": ("Análise de Dados", 1), "b2": ("Gestor", 0),
        "c1": ("Gestor", 1),
    }
    shares = gold.INDICATORS["gender_shares"].run(table)
    assert [tuple(r) for r in shares.collect()] == [(2023, 50.0, 50.0), (2024, 50.0, 50.0), (2025, 0.0, 0.0)]
    assert tuple(gold.INDICATORS["edition_growth"].run(table).first()) == (2, 1, -50.0)


def test_write_editions(spark, raw):
    built = silver.build_editions(raw, Q.mapping_rows())
    written = silver.write_editions(built, scratch_path(spark, "editions"))
    assert {year: len(df.columns) for year, df in written.items()} == {2023: 9, 2024: 10, 2025: 9}
    assert {year: df.count() for year, df in written.items()} == {2023: 2, 2024: 2, 2025: 1}


def test_as_string(raw):
    built = silver.build_silver(raw, mapping=Q.mapping_rows(), as_string=True)
    assert {t for _, t in built.dtypes} == {"string"}
    assert {r.python for r in built.collect()} == {"0", "1"}
    # The view and the indicators accept a table of strings too.
    assert [tuple(r) for r in gold.gold_view(built).where("id = 'c1'").select("atuacao_ok", "top_tier").collect()] == [
        ("Gestor", 1)
    ]


def test_curated(raw):
    built = silver.build_silver(raw, mapping=Q.mapping_rows(), curated=["ID", "Python", "não há", *gold.GOLD_COLUMNS])
    assert built.columns[:3] == ["id", "ano", "python"]


def test_mapping_from_csv(spark):
    path = scratch_path(spark, "mapping")
    rows = [("2024", 1, "token", "id"), ("2025", 2, "a, b", "c")]
    files.write_csv(spark.createDataFrame(rows, "edition string, step int, source string, target string"), path)
    assert sorted(silver.read_mapping(spark, path)) == rows


def test_extracts(raw, rows):
    editions = {
        year: harmonise(clean_columns(df), steps_for(Q.mapping_rows(), str(year))) for year, df in raw.items()
    }
    totals = extracts.challenge_totals(editions)
    assert totals.first().asDict() == {"desafio": "Contratar talentos", "contagem": 2}
    values = {r.valor: r.contagem for r in extracts.value_totals(editions).collect()}
    assert values["Remuneração"] == 3 and values["Propósito"] == 0


def test_indicator_columns_are_the_curated_ones():
    assert Q.KEY == gold.GOLD_COLUMNS[0] and Q.YEAR not in gold.GOLD_COLUMNS
    assert len(gold.GOLD_COLUMNS) == len(set(gold.GOLD_COLUMNS))
    assert len(gold.INDICATORS) == 44


@pytest.fixture(scope="module")
def table(spark, raw):
    return silver.write_silver(silver.build_silver(raw, mapping=Q.mapping_rows()), scratch_path(spark, "silver"))


def test_sql_over_the_registered_view(spark, table, rows):
    catalogue.register_view(gold.gold_view(table), "vw")
    by_sql = spark.sql(
        "SELECT ano, atuacao, count(*) AS total, CAST(round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ano), 1) "
        "AS DOUBLE) AS pct FROM vw GROUP BY ano, atuacao"
    )
    assert rows(by_sql) == rows(gold.INDICATORS["roles_share"].run(table))
    by_sql = spark.sql("SELECT ano, sum(try_cast(python AS INT)) AS python FROM vw GROUP BY ano")
    assert rows(by_sql) == rows(gold.INDICATORS["languages"].run(table.selectExpr(
        "ano", "python", *[f"0 AS `{c}`" for c in Q.LANGUAGES.values() if c != "python"]
    )).select("ano", "python"))


def test_two_years_read_two_partitions(table):
    plan = gold.INDICATORS["edition_growth"].run(table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ano" in plan


def test_unified_rows_are_the_sum_of_the_editions(raw, table):
    built = silver.build_editions(raw, Q.mapping_rows())
    assert table.count() == sum(df.count() for df in built.values())
    assert table.select("ano", "id").distinct().count() == table.count()


def test_long_rows_are_the_sum_of_the_flags(table):
    long = ticked_options(table, ["id"], {"python": "Python", "remuneracao_salario": "Remuneração"})
    sums = table.selectExpr("sum(python) + sum(remuneracao_salario)").first()[0]
    assert long.count() == sums
