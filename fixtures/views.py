"""Survey-shaped views of the test tables.

Dimension keys are unique and every order finds its customer, nation and region, so a view
joins only the dimensions whose columns are asked for; the rows are the same either way.
No join is hinted: Spark broadcasts a side only while its size is under the session threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.names import Step, clean_headers, mapping_step, steps_for
from surveyloom.functions.rules import map_values
from surveyloom.operators.editions import Stack, stack_from
from surveyloom.operators.harmonise import clean_columns, harmonise
from surveyloom.plans import questionnaire as Q
from surveyloom.plans.gold import GOLD_COLUMNS
from surveyloom.session import scratch_path
from surveyloom.sources.files import write_parquet

FLAGS = ["f_returned", "f_accepted", "f_open", "f_discount", "f_bulk"]


# Known schemas spare the job that would otherwise read file footers for each table.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _band() -> Column:
    price = F.col("o_totalprice")
    return (
        F.when(price <= 100000, "ate 100.000")
        .when(price <= 200000, "de 100.001 a 200.000")
        .when(price <= 300000, "de 200.001 a 300.000")
        .when(price <= 400000, "de 300.001 a 400.000")
        .otherwise("Acima de 400.001")
    )


Computed = dict[str, tuple[str, Callable[[], Column]]]


def respondents(spark: SparkSession, sf_dir: str, computed: Computed) -> DataFrame:
    """Orders as respondents, with columns computed from the tables each of them names.

    ``computed`` maps a column to ``(deepest dimension it needs, expression)``.
    """
    columns = [expression().alias(name) for name, (_, expression) in computed.items()]
    depth = ["orders", "customer", "nation", "region"]
    deepest = max(depth.index(level) for level, _ in computed.values())
    rows = table(spark, sf_dir, "orders")
    if deepest == 0:
        return rows.select(*columns)
    # The dimensions are joined among themselves first, so the orders take part in one join only.
    places = table(spark, sf_dir, "nation")
    if deepest == 3:
        places = places.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf_dir, "customer")
    if deepest >= 2:
        customers = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(*columns)




def _source(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


RESP_COLUMNS: Computed = {
    "id": ("orders", _source("o_orderkey")),
    "ano": ("orders", lambda: F.year("o_orderdate")),
    "cargo": ("orders", _source("o_orderpriority")),
    "nivel": ("orders", _source("o_orderstatus")),
    "valor": ("orders", _source("o_totalprice")),
    "faixa": ("orders", _band),
    "setor": ("customer", _source("c_mktsegment")),
    "pais": ("nation", _source("n_name")),
    "regiao": ("region", _source("r_name")),
}


def resp(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One single-choice row per respondent, with the columns asked for."""
    return respondents(spark, sf_dir, {name: RESP_COLUMNS[name] for name in columns or RESP_COLUMNS})


def _with_ticks(spark: SparkSession, sf_dir: str, rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows joined with the options ticked by any line of their order, as bits of ``_ticks``.

    All options travel in one integer per order. Editions that ask for the same options share
    one aggregate and one shuffle of the lines within a query.
    """
    tests = {
        "f_returned": F.col("l_returnflag") == "R",
        "f_accepted": F.col("l_returnflag") == "A",
        "f_open": F.col("l_linestatus") == "O",
        "f_discount": F.col("l_discount") >= 0.09,
        "f_bulk": F.col("l_quantity") >= 45,
    }
    bits = [F.when(tests[name], _tick_bit(name)).otherwise(0) for name in names]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    ticks = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bit_or(mask).alias("_ticks"))
    return rows.join(ticks, F.col("id") == F.col("l_orderkey"), "left")


def _tick_bit(name: str) -> int:
    return 1 << FLAGS.index(name)


def _tick(name: str) -> Column:
    """1 or 0 for an option, null where the order has no line."""
    bit = _tick_bit(name)
    return (F.col("_ticks").bitwiseAND(bit) == bit).cast("int")


def flags(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Respondents with multi-select answers, null where an order has no line."""
    columns = columns or (*RESP_COLUMNS, *FLAGS)
    ticks = [c for c in columns if c in FLAGS]
    base = resp(spark, sf_dir, *dict.fromkeys(["id", *[c for c in columns if c not in FLAGS]]))
    joined = _with_ticks(spark, sf_dir, base, ticks)
    return joined.select(*[_tick(c).alias(c) if c in FLAGS else c for c in columns])


def labels_wide(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with their nullable 0/1 labels."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select(*(columns or ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")))


EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day, 1 where the event type occurred and null where it did not."""
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    ticks = [F.max(F.when(F.col("event_type") == kind, 1)).alias(kind) for kind in EVENT_TYPES]
    return events.groupBy("user_id", "day").agg(*ticks)


# Messy headers of three editions, as (header, column of flags(), kind).
TUPLE_HEADERS = [
    ("('P0', 'id')", "id", None),
    ("('P1_a ', 'Cargo Atual')", "cargo", None),
    ("('P1_b ', 'Nível')", "nivel", None),
    ("('P1_c', \"Setor d'atuação\")", "setor", None),
    ("('P2_a ', 'Região onde mora')", "regiao", None),
    ("('P2_h ', 'Faixa Salarial')", "faixa", None),
    ("('P3_a ', 'Item Devolvido?')", "f_returned", None),
    ("('P3_b ', 'Item Aceito?')", "f_accepted", None),
    ("('P3_c ', 'Pedido/Aberto')", "f_open", None),
    ("('P3_d ', 'Desconto 100%')", "f_discount", None),
    ("('P3_e ', 'Compra em Volume')", "f_bulk", None),
]
CODE_HEADERS_BOOLEAN = [
    ("0.a_token", "id", None),
    ("1.b_Cargo Atual", "cargo", None),
    ("1.c.1_Nível", "nivel", None),
    ("1.d_Setor d'atuação", "setor", None),
    ("2.a_Região onde mora", "regiao", None),
    ("2.h_Faixa Salarial", "faixa", None),
    ("3.a.1_Item Devolvido?", "f_discount", "boolean"),
    ("3.b.1_Item Aceito?", "f_accepted", "boolean"),
    ("3.c.1_Pedido em aberto", "f_open", "boolean"),
    ("4.a.1_Item Devolvido?", "f_returned", "boolean"),
    ("4.b.1_Compra em Volume", "f_bulk", "boolean"),
]
CODE_HEADERS_DOUBLE = [
    ("0.a_token", "id", None),
    ("1.b_Cargo Atual", "cargo", None),
    ("1.c.1 Nível", "nivel", None),
    ("1.d_Setor d'atuação", "setor", None),
    ("2.a_Região onde mora", "regiao", None),
    ("2.h_Faixa Salarial", "faixa", None),
    ("3.a.1_Item Devolvido?", "f_returned", "double"),
    ("3.b.1_Item Aceito?", "f_accepted", "double"),
    ("3.c.1_Pedido em aberto", "f_open", "double"),
    ("3.d.1_Desconto 100%", "f_discount", "double"),
]
EDITION_HEADERS = {
    1995: TUPLE_HEADERS, 1996: CODE_HEADERS_BOOLEAN, 1997: CODE_HEADERS_DOUBLE, 1998: CODE_HEADERS_BOOLEAN,
    1999: CODE_HEADERS_DOUBLE, 2000: TUPLE_HEADERS, 2001: CODE_HEADERS_BOOLEAN,
}

# Mapping rows (edition, step, source, target) to the vocabulary of the first edition.
MAPPING = [
    row
    for year, headers in EDITION_HEADERS.items()
    for row in {
        id(TUPLE_HEADERS): [],
        id(CODE_HEADERS_BOOLEAN): [
            (str(year), 1, "token", "id"),
            (str(year), 1, "pedido_em_aberto", "pedido_aberto"),
            (str(year), 2, "item_devolvido", "desconto_100pct"),
            (str(year), 2, "item_devolvido_1", "item_devolvido"),
        ],
        id(CODE_HEADERS_DOUBLE): [
            (str(year), 1, "pedido_em_aberto", "pedido_aberto"),
            (str(year), 2, "token", "id"),
        ],
    }[id(headers)]
]
SWAP: Step = mapping_step([("item_devolvido", "desconto_100pct"), ("item_devolvido_1", "item_devolvido")])


def editions(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """The raw editions under their messy headers, as files of a year each.

    The answers of all years are put together once and written split by year; each edition reads its own part.
    """
    path = scratch_path(spark, "answers")
    columns = [c for _, c, _ in TUPLE_HEADERS]
    write_parquet(flags(spark, sf_dir, "ano", *columns), path, "ano")

    def edition(year: int) -> DataFrame:
        rows = spark.read.parquet(f"{path}/ano={year}")
        return rows.select(*[
            (F.col(column).cast(kind) if kind else F.col(column)).alias(header)
            for header, column, kind in EDITION_HEADERS[year]
        ])

    return {year: edition(year) for year in EDITION_HEADERS}


def harmonised_editions(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """The editions under the vocabulary of the first."""
    return {
        year: harmonise(clean_columns(df), steps_for(MAPPING, str(year)))
        for year, df in editions(spark, sf_dir).items()
    }


def edition_stack(spark: SparkSession, sf_dir: str) -> Stack:
    """The raw editions under their cleaned names, straight from the tables."""
    layouts = {
        year: dict(zip(clean_headers([h for h, _, _ in headers]), [c for _, c, _ in headers]))
        for year, headers in EDITION_HEADERS.items()
    }
    return stack_from(flags(spark, sf_dir, "ano", *[c for _, c, _ in TUPLE_HEADERS]), "ano", layouts)


# A silver table under the questionnaire's own names, so that every indicator can run.

# Single-choice answers: (source column, {source value: answer}); other values have no answer.
ANSWERS: dict[str, tuple[str, str, dict[str, str]]] = {
    Q.ROLE: ("orders", "o_orderpriority", {
        "1-URGENT": "Engenharia de Dados", "2-HIGH": "Análise de Dados", "3-MEDIUM": "Ciência de Dados",
        "4-NOT SPECIFIED": "Nao_informado", "5-LOW": "0",
    }),
    Q.LEVEL: ("orders", "o_orderstatus", {"F": "Júnior", "O": "Pleno", "P": "Sênior"}),
    Q.EDUCATION: ("customer", "c_mktsegment", {
        "AUTOMOBILE": "Graduação", "BUILDING": "Mestrado", "FURNITURE": "Doutorado", "HOUSEHOLD": "Nao_informado",
        "MACHINERY": "Pós-graduação",
    }),
    Q.MODEL_NOW: ("customer", "c_mktsegment", {
        "AUTOMOBILE": "Modelo 100% remoto", "BUILDING": "Modelo 100% presencial",
        "FURNITURE": "Modelo híbrido com dias fixos de trabalho presencial",
        "HOUSEHOLD": "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no "
        "escritório presencialmente)",
    }),
    Q.MODEL_IDEAL: ("orders", "o_orderpriority", {
        "1-URGENT": "Modelo 100% remoto", "2-HIGH": "Modelo 100% presencial", "3-MEDIUM": "Outro modelo",
        "5-LOW": "Modelo híbrido com dias fixos de trabalho presencial",
    }),
    Q.CLOUD_PREFERRED: ("customer", "c_mktsegment", {
        "AUTOMOBILE": "AWS", "BUILDING": "Azure", "FURNITURE": "GCP", "HOUSEHOLD": "Nao_informado", "MACHINERY": "AWS",
    }),
    Q.BI_DAILY: ("orders", "o_orderpriority", {
        "1-URGENT": "Tableau", "2-HIGH": "Looker", "3-MEDIUM": "Power BI", "4-NOT SPECIFIED": "Nao_informado",
        "5-LOW": "Power BI",
    }),
    Q.AI_AT_WORK: ("orders", "o_orderpriority", {
        "1-URGENT": "Utilizo todos os dias", "2-HIGH": "Utilizo às vezes", "3-MEDIUM": "Não utilizo",
        "4-NOT SPECIFIED": "Nao_informado", "5-LOW": "Prefiro não dizer; Utilizo pouco",
    }),
    Q.AI_RESULTS: ("orders", "o_orderpriority", {
        "1-URGENT": "Sim, ótimos", "2-HIGH": "Em partes", "3-MEDIUM": "A empresa ainda não começou",
        "5-LOW": "Não conseguimos",
    }),
    Q.DATA_LAKE: ("orders", "o_orderpriority", {
        "1-URGENT": "1", "2-HIGH": "1.0", "3-MEDIUM": "0", "4-NOT SPECIFIED": "TRUE", "5-LOW": "não",
    }),
    Q.DATA_WAREHOUSE: ("orders", "o_orderstatus", {"F": "Sim", "O": "0", "P": "1"}),
}
PRICE_BANDS = [
    (100000, "de R$ 4.001/mês a R$ 6.000/mês"), (200000, "de R$ 8.001/mês a R$ 12.000/mês"),
    (300000, "de R$ 12.001/mês a R$ 16.000/mês"), (400000, "de R$ 20.001/mês a R$ 25.000/mês"),
]
TOP_BAND = "Acima de R$ 40.001/mês"
YEAR_SHIFT = 24

SINGLE_CHOICE = [*ANSWERS, Q.BAND, Q.SECTOR, Q.REGION, Q.RACE, Q.GENDER]
TICK_COLUMNS = list(dict.fromkeys([
    *[c for c in GOLD_COLUMNS if c not in SINGLE_CHOICE and c not in (Q.KEY, Q.YEAR)],
    *Q.BARRIER_OPTIONS_MORE, *Q.AI_USE_OPTIONS,
]))


def tick_rule(column: str) -> tuple[int, int]:
    """Factor and bound of an option: an order ticks it when its parts times the factor, modulo 9973, are below."""
    code = zlib.crc32(column.encode())
    return code % 9972 + 1, 1000 + code % 6700


def _survey_band() -> Column:
    band = F.lit(TOP_BAND)
    for limit, text in reversed(PRICE_BANDS):
        band = F.when(F.col("o_totalprice") <= limit, text).otherwise(band)
    return band


def _survey_gender() -> Column:
    balance = F.col("c_acctbal")
    return F.when(balance < 0, "Outro").when(balance < 4000, Q.WOMAN).otherwise(Q.MAN)


def _answer(source: str, answers: dict[str, str]) -> Callable[[], Column]:
    return lambda: map_values(F.col(source), answers)


SURVEY_COLUMNS: Computed = {
    Q.KEY: ("orders", _source("o_orderkey")),
    Q.YEAR: ("orders", lambda: F.year("o_orderdate") + YEAR_SHIFT),
    "_date": ("orders", _source("o_orderdate")),
    Q.BAND: ("orders", _survey_band),
    Q.GENDER: ("customer", _survey_gender),
    Q.SECTOR: ("nation", _source("n_name")),
    Q.REGION: ("region", _source("r_name")),
    Q.RACE: ("nation", lambda: F.concat(F.lit("n"), (F.col("n_nationkey") % 7).cast("string"))),
    **{name: (level, _answer(source, answers)) for name, (level, source, answers) in ANSWERS.items()},
}


def survey(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Orders as answered questionnaires, with the columns asked for."""
    ticks = [c for c in columns if c in TICK_COLUMNS]
    base = dict.fromkeys([*([Q.KEY] if ticks else []), *[c for c in columns if c not in TICK_COLUMNS]])
    rows = respondents(spark, sf_dir, {c: SURVEY_COLUMNS[c] for c in base})
    if ticks:
        bought = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_partkey").alias("_parts"))
        rows = rows.join(bought, F.col(Q.KEY) == F.col("l_orderkey"), "left")
    rule = {c: tick_rule(c) for c in ticks}
    tick = {c: (F.col("_parts") * factor % 9973 < bound).cast("int").alias(c) for c, (factor, bound) in rule.items()}
    return rows.select(*[tick.get(c, c) for c in columns])


LACKING = (2020, 2023)


def survey_editions(spark: SparkSession, sf_dir: str, *columns: str) -> Stack:
    """The questionnaires of all years as harmonised editions; two editions lack the last column asked for."""
    rows = survey(spark, sf_dir, Q.KEY, Q.YEAR, *columns)
    last = F.when(~F.col(Q.YEAR).isin(*LACKING), F.col(columns[-1])).alias(columns[-1])
    years = [year + YEAR_SHIFT for year in EDITION_HEADERS]
    present = {year: frozenset({Q.KEY, *(columns[:-1] if year in LACKING else columns)}) for year in years}
    return Stack(rows.select(Q.KEY, Q.YEAR, *columns[:-1], last), present, Q.YEAR)
