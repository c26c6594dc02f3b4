"""Every indicator gives the same figures on the typed table and on the all-text table."""

import pytest
from pyspark.sql import functions as F

from fixtures import literal, views
from fixtures.oracle import ORACLE
from surveyloom.operators import indicators
from surveyloom.operators.clean import fill_answers
from surveyloom.operators.unify import unify
from surveyloom.plans import extracts, gold
from surveyloom.plans import questionnaire as Q
from surveyloom.session import scratch_path
from surveyloom.sources import files
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    answers = views.survey(spark, SF_DIR, Q.KEY, Q.YEAR, *[c for c in gold.GOLD_COLUMNS if c != Q.KEY])
    filled = fill_answers(answers, views.TICK_COLUMNS, keep=[Q.KEY])
    path = scratch_path(spark, "survey")
    files.write_parquet(filled, path, Q.YEAR)
    typed = files.read_parquet(spark, path)
    return typed, unify({2023: typed}, as_string=True)


@pytest.mark.parametrize("name", sorted(gold.INDICATORS))
def test_typed_and_text_agree(tables, name):
    typed, text = (
        [tuple(str(v) for v in r) for r in gold.INDICATORS[name].run(table).collect()] for table in tables
    )
    assert typed and typed == text


@pytest.mark.parametrize("name", ["roles_share", "ai_use_groups", "gender_share_long"])
def test_shares_of_a_year_add_up(tables, name):
    sums = gold.INDICATORS[name].run(tables[0]).groupBy(Q.YEAR).agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r.s - 100) < 0.5 for r in sums)


def test_an_indicator_reads_only_its_columns(tables):
    plan = gold.INDICATORS["data_maturity"].run(tables[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert f"ReadSchema: struct<{Q.DATA_LAKE}:string,{Q.DATA_WAREHOUSE}:string>" in plan


def test_rankings_are_sorted(tables):
    got = gold.INDICATORS["challenges"].run(tables[0]).collect()
    assert got == sorted(got, key=lambda r: (r.ano, -r.total, r.desafio))
    assert len(got) == 5 * len({r.ano for r in got})


def test_short_model(tables):
    short = extracts.with_short_model(tables[0]).select(Q.MODEL_NOW, "forma_trabalho_curta").distinct()
    assert {r[0]: r[1] for r in short.collect()} == {**Q.MODEL_LABELS, "Nao_informado": "Não informado"}


def test_every_option_has_answers_of_its_own(spark):
    """No two multi-select columns of the test view agree, so a query that reads the wrong one gives other figures."""
    rows = views.survey(spark, SF_DIR, *views.TICK_COLUMNS).collect()
    columns = list(zip(*rows))
    assert len(set(columns)) == len(views.TICK_COLUMNS) > 60


@pytest.mark.parametrize("name, table", [("languages", "LANGUAGES"), ("bi_tools_ranking", "BI_TOOLS_RANKED"), ("values", "VALUES")])
def test_twins_notice_swapped_columns(spark, name, table):
    """The SQL knows names and labels on its own: swapping any two neighbouring columns makes the row differ."""
    flags = getattr(Q, table)
    assert flags == getattr(literal, table)
    labels = list(flags)
    sql, con = ORACLE[f"gold_{name}"], connect(SF_DIR)
    answers = views.survey(spark, SF_DIR, Q.YEAR, *flags.values()).cache()
    for one, two in zip(labels, labels[1:]):
        swapped = {**flags, one: flags[two], two: flags[one]}
        if name == "languages":
            made = indicators.flag_sums(answers, Q.YEAR, swapped)
        else:
            by = () if name == "bi_tools_ranking" else Q.YEAR
            made = indicators.ranking(answers, swapped, by, label="opcao" if by == () else "valor")
        assert differences(made, con, sql) != []
    answers.unpersist()


def test_names_and_labels_agree_with_the_twins():
    for name in dir(literal):
        if name.isupper() and hasattr(Q, name):
            assert getattr(Q, name) == getattr(literal, name), name
    assert views.TICK_COLUMNS == literal.TICKS
