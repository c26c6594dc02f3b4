from pyspark.sql import functions as F

from surveyloom.operators import editions
from surveyloom.operators import indicators as ind


def survey(spark):
    rows = [
        (2023, "a", "x", 1, "1"), (2023, "a", "y", 0, "true"), (2023, "b", "x", None, None), (2024, "a", "x", 1, "0"),
        (2024, "c", "x", 1, "1.0"), (2024, "c", "y", 0, "0.9"), (2025, "b", "y", 0, "sim"),
    ]
    return spark.createDataFrame(rows, "ano int, papel string, g string, f int, t string")


def test_share_order_and_total(spark):
    got = [tuple(r) for r in ind.share(survey(spark), "papel", "ano").collect()]
    assert got == [
        (2023, "a", 2, 66.7), (2023, "b", 1, 33.3), (2024, "c", 2, 66.7), (2024, "a", 1, 33.3), (2025, "b", 1, 100.0),
    ]


def test_shares_add_up(spark):
    totals = ind.share(survey(spark), "papel", "ano").groupBy("ano").agg(F.sum("pct")).collect()
    assert all(abs(t[1] - 100) <= 0.2 for t in totals)


def test_share_overall_with_rate(spark):
    got = [tuple(r) for r in ind.share(survey(spark), "papel", flag="f").collect()]
    assert got == [("a", 3, 66.7, 42.9), ("c", 2, 50.0, 28.6), ("b", 2, 0.0, 28.6)]


def test_top_k_breaks_ties_by_value(spark):
    assert [tuple(r) for r in ind.top_k(survey(spark), "papel", 2).collect()] == [("a", 3), ("b", 2)]


def test_value_counts(spark):
    assert [tuple(r) for r in ind.value_counts(survey(spark), "f").collect()] == [(0, 3), (1, 3)]
    assert [tuple(r) for r in ind.value_counts(survey(spark), "f", nulls=True).collect()] == [(0, 3), (1, 3), (None, 1)]


def test_flags_of_any_type(spark):
    sums = ind.flag_sums(survey(spark), "ano", {"n": "f", "t": "t"})
    assert [tuple(r) for r in sums.collect()] == [(2023, 1, 2), (2024, 2, 1), (2025, 0, 1)]
    shares = ind.flag_percents(survey(spark), "ano", {"n": "f"})
    assert [tuple(r) for r in shares.collect()] == [(2023, 33.3), (2024, 66.7), (2025, 0.0)]


def test_ranking(spark):
    got = [tuple(r) for r in ind.ranking(survey(spark), {"Um (1)": "f", "Dois, p/ x": "t"}).collect()]
    assert got == [("Dois, p/ x", 4), ("Um (1)", 3)]
    by_year = [tuple(r) for r in ind.ranking(survey(spark), {"F": "f", "T": "t"}, "ano").collect()]
    assert by_year == [(2023, "T", 2), (2023, "F", 1), (2024, "F", 2), (2024, "T", 1), (2025, "T", 1), (2025, "F", 0)]


def test_ranking_of_nothing_is_zero(spark):
    empty = survey(spark).where("ano > 3000")
    assert [tuple(r) for r in ind.ranking(empty, {"F": "f"}).collect()] == [("F", 0)]


def test_rates(spark):
    assert [tuple(r) for r in ind.rate(survey(spark), "g", "f").collect()] == [("x", 4, 75.0), ("y", 3, 0.0)]
    gap = ind.conditional_rate(
        survey(spark), "ano", {"x": (F.col("f") == 1, F.col("g") == "x"), "z": (F.col("f") == 1, F.col("g") == "z")}
    )
    assert [tuple(r) for r in gap.collect()] == [(2023, 50.0, None), (2024, 100.0, None), (2025, None, None)]
    shares = ind.conditional_share(survey(spark), "ano", {"x": F.col("g") == "x"})
    assert [tuple(r) for r in shares.collect()] == [(2023, 66.7), (2024, 66.7), (2025, 0.0)]


def test_growth(spark):
    assert tuple(ind.growth(survey(spark), "ano", 2023, 2025).first()) == (3, 1, -66.7)
    assert tuple(ind.growth(survey(spark), "ano", 1999, 2025).first()) == (0, 1, None)


def test_totals_across_editions(spark):
    frames = {
        1: spark.createDataFrame([(1, 0), (1, 1)], "a int, a_1 int"),
        2: spark.createDataFrame([("1",), ("x",)], "a string"),
        3: spark.createDataFrame([(True,)], "b boolean"),
    }
    got = editions.totals_across(frames, {"A": ["a", "a_1"], "B": ["b"], "C": ["c"]})
    assert [tuple(r) for r in got.collect()] == [("A", 3), ("B", 1), ("C", 0)]
