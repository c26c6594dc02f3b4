import pytest

from surveyloom.functions import names as N
from surveyloom.plans import questionnaire as Q


@pytest.mark.parametrize("raw, clean", [
    ("('P2_o_1 ', 'Remuneração/Salário')", "remuneracao_salario"),
    ("('P0', 'id')", "id"),
    ("('P4_b', \"ETL's usados\")", "etl_s_usados"),
    ('("P4_c", "Só (Excel)?")', "so_excel"),
    ("2.o.1_Remuneração/Salário", "remuneracao_salario"),
    ("4.l.1 Nível", "nivel"),
    ("0.a_token", "token"),
    ("modelo 100% presencial.", "modelo_100pct_presencial"),
    ("C/C++/C#", "c_c_c"),
    ("água", "agua"),
    ("  .NET  ", "net"),
    ("(fora do padrão)", "fora_do_padrao"),
])
def test_clean_header(raw, clean):
    assert N.clean_header(raw) == clean


def test_twins_never_collide():
    assert N.suffix_twins(["x", "x", "x_1", "x"]) == ["x", "x_2", "x_1", "x_3"]
    assert N.suffix_twins(["x", "y", "x", "x"]) == ["x", "y", "x_1", "x_2"]
    assert N.repeated_names(N.suffix_twins(["a", "a", "a_1", "a_1", "a"])) == []


def test_mapping_is_simultaneous():
    step = N.mapping_step([("x", "y"), ("x_1", "x")])
    back = N.mapping_step([("x_1", "x"), ("x", "y")])
    for s in (step, back):
        assert N.resolve(["x", "x_1"], [s]) == [(0, "y"), (1, "x")]


@pytest.mark.parametrize("pairs", [
    [("a", "a")], [("á?", "a")], [("a", "b"), ("a", "c")], [("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a")],
])
def test_bad_mappings_are_rejected(pairs):
    with pytest.raises(ValueError):
        N.mapping_step(pairs)


def test_twins_after_a_step_keep_last_or_first():
    step = N.mapping_step([("b", "a")])
    assert N.resolve(["a", "b", "c"], [step]) == [(1, "a"), (2, "c")]
    assert N.resolve(["a", "b", "c"], [step], keep="first") == [(0, "a"), (2, "c")]


def test_steps_run_in_order():
    rows = [("2024", 2, "b", "c"), ("2024", 1, "a", "b"), ("2025", 1, "a", "z")]
    assert N.resolve(["a"], N.steps_for(rows, "2024")) == [(0, "c")]
    assert N.resolve(["a"], N.steps_for(rows, "2025")) == [(0, "z")]
    assert N.steps_for(rows, "2023") == []


def test_inverted():
    assert N.inverted({"id": "token"}) == {"token": "id"}


def test_pick_common_diff_keyword():
    assert N.pick_columns(["id", "modelo_100pct", "b"], ["ID", "modelo 100%", "x", "id"]) == ["id", "modelo_100pct"]
    assert N.common_names([["a", "id", "ano", "b"], ["b", "ano", "id", "a"], ["id", "b", "ano"]], ("id", "ano")) == [
        "id", "ano", "b",
    ]
    assert N.diff_names(["a", "b"], ["b", "c"]) == {"matched": ["b"], "missing": ["a"], "new": ["c"]}
    assert N.names_with(["uso_IA", "llm_x", "outro"], ["ia", "LLM"]) == ["uso_IA", "llm_x"]


def test_questionnaire_mapping_is_valid():
    for edition in ("2024", "2025"):
        steps = N.steps_for(Q.mapping_rows(), edition)
        left = dict(N.resolve(["token", "remuneracao_salario", "remuneracao_salario_1", "possui_data_lake"], steps))
        assert left == {
            0: "id", 1: "salario_atual_nao_corresponde_ao_mercado", 2: "remuneracao_salario", 3: Q.DATA_LAKE,
        }
