"""The view over the silver table and the indicators that answer the seven questions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MISSING_TEXT, is_ticked
from ..functions.rules import classify, recode, tier_flag
from ..operators import indicators as ind
from . import questionnaire as Q


def gold_view(silver: DataFrame) -> DataFrame:
    """Silver with the comparable role and the top-tier flag, where their sources are present."""
    view = silver
    if Q.ROLE in silver.columns:
        view = view.withColumn("atuacao_ok", recode(F.col(Q.YEAR), F.col(Q.ROLE), Q.ROLE_RECODES))
    if Q.BAND in silver.columns:
        view = view.withColumn("top_tier", tier_flag(F.col(Q.BAND), Q.TOP_BANDS, Q.TOP_PREFIX))
    return view


@dataclass(frozen=True)
class Indicator:
    """One question's indicator: the silver columns it reads and how it is computed from the view."""

    question: str
    reads: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]

    def run(self, silver: DataFrame) -> DataFrame:
        """Compute from a silver table; only the columns read are taken from it."""
        return self.build(gold_view(silver.select(*dict.fromkeys([Q.YEAR, *self.reads]))))


def _count(question: str, *by: str) -> Indicator:
    def build(vw: DataFrame) -> DataFrame:
        order = [*[F.asc(k) for k in by[:-1]], F.desc("total"), F.asc(by[-1])]
        return ind.counts(vw, list(by), order=order)

    return Indicator(question, by, build)


def _tier(question: str, *by: str) -> Indicator:
    return Indicator(question, (*by, Q.BAND), lambda vw: ind.rate(vw, list(by), "top_tier"))


def _sums(question: str, flags: dict[str, str], by: Sequence[str] = (Q.YEAR,)) -> Indicator:
    return Indicator(question, (*by, *flags.values()), lambda vw: ind.flag_sums(vw, list(by), flags))


def _percents(question: str, flags: dict[str, str]) -> Indicator:
    return Indicator(question, tuple(flags.values()), lambda vw: ind.flag_percents(vw, Q.YEAR, flags))


def _ranking(question: str, flags: dict[str, str], by: Sequence[str] = (), label: str = "opcao") -> Indicator:
    return Indicator(question, tuple(flags.values()), lambda vw: ind.ranking(vw, flags, list(by), label))


def _prejudice(column: str, flag: str, name: str, with_total: bool) -> Indicator:
    def build(vw: DataFrame) -> DataFrame:
        order = [F.desc("total" if with_total else name), F.asc(column)]
        return ind.flag_sums(vw, column, {name: flag}, with_total, order)

    return Indicator("P3", (column, flag), build)


def _education(vw: DataFrame) -> DataFrame:
    known = vw.where(F.col(Q.EDUCATION) != MISSING_TEXT)
    return ind.share(known, Q.EDUCATION, flag="top_tier", share_name="pct_mercado", rate_name="pct_top_tier")


def _gender_shares(vw: DataFrame) -> DataFrame:
    gender = F.col(Q.GENDER)
    return ind.conditional_share(vw, Q.YEAR, {"mulheres": gender == Q.WOMAN, "homens": gender == Q.MAN})


def _gender_gap(vw: DataFrame) -> DataFrame:
    gender, top = F.col(Q.GENDER), F.col("top_tier") == 1
    return ind.conditional_rate(
        vw, Q.YEAR, {"mulheres_top": (top, gender == Q.WOMAN), "homens_top": (top, gender == Q.MAN)}
    )


def _gender_rate(vw: DataFrame) -> DataFrame:
    picked = vw.where(F.col(Q.GENDER).isin(Q.MAN, Q.WOMAN))
    return ind.rate(picked, Q.GENDER, "top_tier", with_total=False)


def _ai_groups(vw: DataFrame) -> DataFrame:
    group = classify(F.col(Q.AI_AT_WORK), Q.AI_USE_RULES, Q.AI_USE_OTHER)
    return ind.share(vw.select(Q.YEAR, group.alias("uso_ia_grupo")), "uso_ia_grupo", Q.YEAR)


def _maturity(vw: DataFrame) -> DataFrame:
    return ind.conditional_share(
        vw, Q.YEAR, {"pct_lake": is_ticked(F.col(Q.DATA_LAKE)), "pct_dw": is_ticked(F.col(Q.DATA_WAREHOUSE))}
    )


INDICATORS: dict[str, Indicator] = {
    # P1: how is the market structured?
    "editions": Indicator("P1", (Q.YEAR,), lambda vw: ind.counts(vw, Q.YEAR, order=[F.asc(Q.YEAR)])),
    "roles_share": Indicator("P1", (Q.ROLE,), lambda vw: ind.share(vw, Q.ROLE, Q.YEAR)),
    "roles_comparable_share": Indicator("P1", (Q.ROLE,), lambda vw: ind.share(vw, "atuacao_ok", Q.YEAR)),
    "seniority": _count("P1", Q.YEAR, Q.LEVEL),
    "top_sectors": Indicator("P1", (Q.SECTOR,), lambda vw: ind.top_k(vw, Q.SECTOR, 10)),
    # P2: which profiles are valued most?
    "tier_by_role": _tier("P2", Q.ROLE),
    "tier_by_seniority": _tier("P2", Q.LEVEL),
    "tier_by_education": Indicator("P2", (Q.EDUCATION, Q.BAND), _education),
    # P3: gender and race
    "gender_shares": Indicator("P3", (Q.GENDER,), _gender_shares),
    "gender_share_long": Indicator("P3", (Q.GENDER,), lambda vw: ind.share(vw, Q.GENDER, Q.YEAR)),
    "gender_tier_gap": Indicator("P3", (Q.GENDER, Q.BAND), _gender_gap),
    "gender_tier_rate": Indicator("P3", (Q.GENDER, Q.BAND), _gender_rate),
    "prejudice_by_gender": _prejudice(Q.GENDER, Q.PREJUDICE_GENDER, "preconceito_genero", False),
    "prejudice_by_race": _prejudice(Q.RACE, Q.PREJUDICE_RACE, "preconceito_raca", True),
    # P4: which technologies are used?
    "languages": _sums("P4", Q.LANGUAGES),
    "languages_pct": _percents("P4", Q.LANGUAGES_MORE),
    "databases": _sums("P4", Q.DATABASES),
    "databases_ranking": _ranking("P4", Q.DATABASES_RANKED),
    "clouds": _sums("P4", Q.CLOUDS),
    "clouds_pct": _percents("P4", Q.CLOUDS_MAIN),
    "preferred_cloud": _count("P4", Q.YEAR, Q.CLOUD_PREFERRED),
    "bi_tools": _sums("P4", Q.BI_TOOLS),
    "bi_tools_ranking": _ranking("P4", Q.BI_TOOLS_RANKED),
    "daily_bi_tool": _count("P4", Q.YEAR, Q.BI_DAILY),
    # P5: use of AI
    "ai_use_groups": Indicator("P5", (Q.AI_AT_WORK,), _ai_groups),
    "ai_payer_pct": _percents("P5", Q.AI_PAYER),
    "ai_in_company_pct": _percents("P5", Q.AI_IN_COMPANY),
    "ai_priority_pct": _percents("P5", Q.AI_PRIORITIES),
    "ai_barriers": _sums("P5", Q.AI_BARRIERS),
    "ai_barriers_ranking": _ranking("P5", Q.AI_BARRIERS_RANKED),
    "edition_growth": Indicator(
        "P5", (Q.YEAR,), lambda vw: ind.growth(vw, Q.YEAR, Q.FIRST_EDITION, Q.LAST_EDITION)
    ),
    # P6: regions and work models
    "tier_by_model": _tier("P6", Q.YEAR, Q.MODEL_NOW),
    "tier_by_model_overall": _tier("P6", Q.MODEL_NOW),
    "tier_by_region": _tier("P6", Q.YEAR, Q.REGION),
    "tier_by_region_overall": _tier("P6", Q.REGION),
    "current_model": _count("P6", Q.YEAR, Q.MODEL_NOW),
    "current_model_overall": _count("P6", Q.MODEL_NOW),
    "ideal_model": _count("P6", Q.YEAR, Q.MODEL_IDEAL),
    "ideal_model_overall": _count("P6", Q.MODEL_IDEAL),
    # P7: challenges and opportunities
    "challenges": _ranking("P7", Q.CHALLENGES, (Q.YEAR,), "desafio"),
    "challenges_ranking": _ranking("P7", Q.CHALLENGES, (), "desafio"),
    "values": _ranking("P7", Q.VALUES, (Q.YEAR,), "valor"),
    "values_ranking": _ranking("P7", Q.VALUES, (), "valor"),
    "data_maturity": Indicator("P7", (Q.DATA_LAKE, Q.DATA_WAREHOUSE), _maturity),
}

# The columns any indicator reads: the curated selection of a silver table made for them.
GOLD_COLUMNS = list(dict.fromkeys([Q.KEY, *[c for indicator in INDICATORS.values() for c in indicator.reads]]))
GOLD_COLUMNS.remove(Q.YEAR)
