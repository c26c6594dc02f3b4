"""Long and wide extracts for a BI tool, from harmonised editions: ``{year: frame}``, or a ``Stack`` of them.

Each extract is one pass over the stack, so a table that holds all editions is scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_flag, named
from ..functions.rules import classify, first_true, map_values
from ..operators.clean import bool_to_flag
from ..operators.editions import Stack, percents_by_year, stack_of, totals_across
from ..operators.reshape import stack_columns, ticked_options
from . import questionnaire as Q

Editions = Mapping[int, DataFrame] | Stack


def _flagged(editions: Editions) -> Stack:
    """The editions with booleans and the texts TRUE and FALSE as 1 and 0, as the silver table has them."""
    return stack_of(editions, Q.YEAR).map_rows(bool_to_flag)


def current_vs_ideal(editions: Editions) -> DataFrame:
    """Work model now and ideal, stacked, with short labels; editions lacking one are left out."""
    stack = stack_of(editions, Q.YEAR)
    rows = stack.rows.where(stack.has(Q.MODEL_NOW, Q.MODEL_IDEAL))
    stacked = stack_columns(rows, {"Atual": Q.MODEL_NOW, "Ideal": Q.MODEL_IDEAL}, "modelo", "situacao")
    return stacked.withColumn("modelo", map_values(F.col("modelo"), Q.MODEL_LABELS, keep_unmapped=True))


def challenge_totals(editions: Editions) -> DataFrame:
    """Ticks of each manager challenge over all editions."""
    return totals_across(_flagged(editions), {label: [c] for label, c in Q.CHALLENGES.items()}, "desafio", "contagem")


def value_totals(editions: Editions) -> DataFrame:
    """Ticks of each valued criterion over all editions."""
    return totals_across(_flagged(editions), {label: [c] for label, c in Q.VALUES.items()}, "valor", "contagem")


def maturity_by_edition(editions: Editions) -> DataFrame:
    """Percentage of respondents whose company has a data lake, and a data warehouse."""
    return percents_by_year(_flagged(editions), {"pct_lake": Q.DATA_LAKE, "pct_dw": Q.DATA_WAREHOUSE})


def ai_barriers_long(editions: Editions, more: bool = False) -> DataFrame:
    """One row per respondent and barrier ticked; ``more`` adds the third barrier."""
    options = Q.BARRIER_OPTIONS_MORE if more else Q.BARRIER_OPTIONS
    return ticked_options(stack_of(editions, Q.YEAR).rows, [Q.KEY, Q.YEAR], options, "barreira")


def ai_uses_long(editions: Editions) -> DataFrame:
    """One row per respondent and way of using AI."""
    return ticked_options(stack_of(editions, Q.YEAR).rows, [Q.KEY, Q.YEAR], Q.AI_USE_OPTIONS, "forma_uso")


def ai_answers(editions: Editions) -> DataFrame:
    """The AI questions of every edition with three groupings; null where an edition lacks one."""
    stack = stack_of(editions, Q.YEAR)
    df = stack.rows
    kept = [
        Q.AI_AT_WORK, Q.AI_PRIORITY, Q.AI_NO_PRIORITY, *Q.AI_PAYER.values(),
        "uso_solucoes_do_tipo_copilot", Q.AI_IN_COMPANY["copilots"], Q.AI_RESULTS,
    ]
    is_first, is_second, other = Q.AI_PRIORITY_LABELS
    groups = [
        classify(named(Q.AI_AT_WORK), Q.AI_USE_TWO_GROUPS, Q.AI_USE_TWO_OTHER).alias("uso_ia_grupo"),
        first_true(
            [(as_flag(df, Q.AI_PRIORITY) == 1, is_first), (as_flag(df, Q.AI_NO_PRIORITY) == 1, is_second)], other
        ).alias("prioridade_grupo"),
    ]
    if stack.knows(Q.AI_RESULTS):
        results = classify(named(Q.AI_RESULTS), Q.AI_RESULT_RULES, Q.AI_RESULT_OTHER, ignore_case=True)
        groups.append(F.when(stack.has(Q.AI_RESULTS), results).alias("resultado_grupo"))
    return df.select(Q.YEAR, Q.KEY, *groups, *[named(c) for c in kept if c in df.columns])


def with_short_model(silver: DataFrame) -> DataFrame:
    """The whole silver table with a short name of the current work model."""
    short = classify(F.col(Q.MODEL_NOW), Q.MODEL_RULES, Q.MODEL_OTHER, ignore_case=True)
    return silver.withColumn("forma_trabalho_curta", short)
