"""The engine's operators bound to the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import (
    as_flag, clean_header_text, coerce_number, is_ticked, normalise_text, try_int,
)
from surveyloom.functions.names import POSITION, steps_for
from surveyloom.functions.rules import classify, first_true, map_by_table, map_values, recode, tier_flag
from surveyloom.operators import clean, editions, harmonise, indicators, profile, reshape, unify
from surveyloom.operators.rule_tables import classify_by_table
from surveyloom.plans import extracts, silver
from surveyloom.plans import questionnaire as Q
from surveyloom.plans.gold import INDICATORS, gold_view
from surveyloom.session import scratch_path
from surveyloom.sources import catalogue, files, versions

from . import views
from .views import FLAGS, activity, flags, labels_wide, resp, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under the function's name, less a trailing underscore."""
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


UNKNOWN = "4-NOT SPECIFIED"
LABELS = {
    "f_returned": "Devolvido", "f_accepted": "Aceito", "f_open": "Aberto",
    "f_discount": "Desconto alto", "f_bulk": "Volume",
}
BY_LABEL = {label: column for column, label in LABELS.items()}


def tiered(spark, sf, *columns):
    wide = resp(spark, sf, *dict.fromkeys([*columns, "faixa"]))
    return wide.withColumn("top_tier", tier_flag(F.col("faixa"), ["300.001"], "Acima"))


# Counts, shares, rates

@query
def count_by_edition(spark, sf):
    return indicators.counts(resp(spark, sf, "ano"), "ano", order=[F.asc("ano")])


@query
def count_by_edition_level(spark, sf):
    order = [F.asc("ano"), F.desc("total"), F.asc("nivel")]
    return indicators.counts(resp(spark, sf, "ano", "nivel"), ["ano", "nivel"], order=order)


@query
def share_within_group(spark, sf):
    return indicators.share(resp(spark, sf, "ano", "cargo"), "cargo", "ano")


@query
def share_overall(spark, sf):
    known = tiered(spark, sf, "cargo").where(F.col("cargo") != UNKNOWN)
    return indicators.share(known, "cargo", flag="top_tier", share_name="pct_mercado", rate_name="pct_top_tier")


@query
def top_k(spark, sf):
    return indicators.top_k(resp(spark, sf, "pais"), "pais", 10)


@query
def tier_rate(spark, sf):
    return indicators.rate(tiered(spark, sf, "cargo"), "cargo", "top_tier")


@query
def tier_rate_by_two(spark, sf):
    return indicators.rate(tiered(spark, sf, "ano", "regiao"), ["ano", "regiao"], "top_tier")


@query
def tier_rate_in(spark, sf):
    picked = tiered(spark, sf, "nivel").where(F.col("nivel").isin("F", "O"))
    return indicators.rate(picked, "nivel", "top_tier", with_total=False)


@query
def conditional_share(spark, sf):
    level = F.col("nivel")
    return indicators.conditional_share(
        resp(spark, sf, "ano", "nivel"), "ano", {"fechados": level == "F", "abertos": level == "O"}
    )


@query
def conditional_rate(spark, sf):
    level, top = F.col("nivel"), F.col("top_tier") == 1
    return indicators.conditional_rate(
        tiered(spark, sf, "ano", "nivel"), "ano",
        {"fechados_top": (top, level == "F"), "abertos_top": (top, level == "O"), "sem_base": (top, level == "X")},
    )


@query
def growth(spark, sf):
    return indicators.growth(resp(spark, sf, "ano"), "ano", 1995, 2000)


@query
def truthy_rate(spark, sf):
    year = F.col("ano")
    yes = F.when(year == 1995, "1").when(year == 1996, "1.0").when(year == 1997, "TRUE").otherwise("Sim")

    def spelled(name):
        return F.when(F.col(name) == 1, yes).when(F.col(name) == 0, "não").alias(name)

    texts = flags(spark, sf, "ano", "f_returned", "f_bulk").select("ano", spelled("f_returned"), spelled("f_bulk"))
    return indicators.conditional_share(
        texts, "ano",
        {"pct_returned": is_ticked(F.col("f_returned")), "pct_bulk": is_ticked(F.col("f_bulk"))},
    )


@query
def value_counts(spark, sf):
    return indicators.value_counts(labels_wide(spark, sf, "quality"), "quality")


@query
def value_counts_nulls(spark, sf):
    return indicators.value_counts(labels_wide(spark, sf, "quality"), "quality", nulls=True)


@query
def grouped_value_counts(spark, sf):
    return indicators.counts(resp(spark, sf, "faixa", "cargo"), ["faixa", "cargo"])


@query
def distinct_values(spark, sf):
    return indicators.distinct_values(labels_wide(spark, sf, "quality"), "quality")


# Flag measures

@query
def flag_sum(spark, sf):
    return indicators.flag_sums(flags(spark, sf, "nivel", "f_bulk"), "nivel", {"em_volume": "f_bulk"}, with_total=True)


@query
def multi_flag_sum(spark, sf):
    return indicators.flag_sums(flags(spark, sf, "ano", *FLAGS), "ano", {f"n_{c}": c for c in FLAGS})


@query
def multi_flag_pct(spark, sf):
    return indicators.flag_percents(flags(spark, sf, "ano", *FLAGS), "ano", {f"pct_{c}": c for c in FLAGS})


@query
def ranking_overall(spark, sf):
    return indicators.ranking(flags(spark, sf, *FLAGS), BY_LABEL)


@query
def ranking_by_edition(spark, sf):
    return indicators.ranking(flags(spark, sf, "ano", *FLAGS), BY_LABEL, "ano")


@query
def totals_across_editions(spark, sf):
    options = {
        "Devolvido": ["item_devolvido", "item_devolvido_1"],
        "Aceito": ["item_aceito"],
        "Volume": ["compra_em_volume"],
        "Ausente": ["nao_existe"],
    }
    return editions.totals_across(views.edition_stack(spark, sf), options)


# Long form

@query
def unpivot_flags(spark, sf):
    options = {c: LABELS[c] for c in ("f_returned", "f_discount", "f_bulk")}
    return reshape.ticked_options(flags(spark, sf, "id", "ano", *options), ["id", "ano"], options)


@query
def current_vs_ideal(spark, sf):
    labels = {"BUILDING": "Construção", "1-URGENT": "Urgente", "5-LOW": "Baixa"}
    pairs = resp(spark, sf, "cargo", "setor").withColumn(
        "cargo", F.when(F.col("cargo") != UNKNOWN, F.col("cargo"))
    )
    counted = reshape.count_stacked(pairs, {"Atual": "cargo", "Ideal": "setor"}, "modelo", "situacao")
    return counted.withColumn("modelo", map_values(F.col("modelo"), labels, keep_unmapped=True))


# Classifiers and maps

@query
def tier_flag_(spark, sf):
    return tiered(spark, sf, "id", "faixa").select("id", "top_tier")



@query
def recode_by_edition(spark, sf):
    rules = [(2001, ["4-NOT SPECIFIED", "5-LOW"], "Gestor"), (1995, ["4-NOT SPECIFIED"], "Análise")]
    rows = resp(spark, sf, "id", "ano", "cargo")
    return rows.select("id", recode(F.col("ano"), F.col("cargo"), rules).alias("cargo_ok"))


@query
def classify_prefix(spark, sf):
    rules = [("starts", "1-", "Urgente"), ("starts", ["2-", "3-"], "Normal")]
    grouped = resp(spark, sf, "ano", "cargo").select(
        "ano", classify(F.col("cargo"), rules, "Sem informação").alias("grupo")
    )
    return indicators.share(grouped, "grupo", "ano")


@query
def classify_contains(spark, sf):
    group = classify(F.col("p_name"), [("contains", "ring", "Anel")], "Outro")
    return table(spark, sf, "part").select("p_partkey", group.alias("grupo"))


@query
def classify_two_flags(spark, sf):
    rules = [(F.col("f_discount") == 1, "Com desconto"), (F.col("f_bulk") == 1, "Em volume")]
    return flags(spark, sf, "id", "f_discount", "f_bulk").select(
        "id", first_true(rules, "Outro cenário").alias("grupo")
    )


@query
def classify_ordered(spark, sf):
    rules = [
        ("starts", "red", "Vermelho"), ("starts", "small r", "Pequeno r"),
        ("contains", "ring", "Anel"), ("starts", "small", "Pequeno"),
    ]
    name = F.when(F.col("p_size") != 7, F.upper("p_name"))
    return table(spark, sf, "part").select(
        "p_partkey", classify(name, rules, "Sem resposta", ignore_case=True).alias("grupo")
    )


@query
def classify_keywords(spark, sf):
    rules = [
        ("contains", "acima", "Topo"), ("contains", ["300.001", "400.000"], "Alta"),
        ("contains", "200.0", "Média"),
    ]
    return resp(spark, sf, "id", "faixa").select(
        "id", classify(F.col("faixa"), rules, "Base", ignore_case=True).alias("grupo")
    )


PRIORITY = {"1-URGENT": "Urgente", "2-HIGH": "Alta", "3-MEDIUM": "Média", "5-LOW": "Baixa"}


@query
def map_with_fallback(spark, sf):
    return resp(spark, sf, "id", "cargo").select("id", map_values(F.col("cargo"), PRIORITY, True).alias("rotulo"))


@query
def map_no_fallback(spark, sf):
    return resp(spark, sf, "id", "cargo").select("id", map_values(F.col("cargo"), PRIORITY).alias("rotulo"))


@query
def map_long_table(spark, sf):
    target = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))  # the others keep their number
    names = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("source"), target.alias("target"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cliente"))
    return map_by_table(rows, "cliente", names, "cliente", keep_unmapped=True)


@query
def classify_rule_table(spark, sf):
    """Documents by the first of thousands of rules, made of the names of parts and the texts of the benchmark."""
    words = F.split("p_name", " ")
    names = table(spark, sf, "part").select(
        F.col("p_partkey").alias("place"), F.when(F.col("p_partkey") % 3 == 0, "starts").otherwise("contains").alias("how"),
        F.concat_ws(" ", words[0], F.substring(words[1], 1, 4)).alias("fragment"), F.concat(F.lit("peça "), "p_partkey").alias("label"),
    )
    passages = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        (F.lit(10_000_000) + F.col("item_id")).alias("place"), F.lit("contains").alias("how"),
        F.substring("text", 1, 40).alias("fragment"), F.concat(F.lit("passagem "), "item_id").alias("label"),
    )
    openings = table(spark, sf, "documents").select(
        (F.lit(20_000_000) + F.col("doc_id")).alias("place"), F.lit("starts").alias("how"),
        F.substring("text", 1, 12).alias("fragment"), F.concat(F.lit("início "), "doc_id").alias("label"),
    )
    rules = names.unionByName(passages).unionByName(openings)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return classify_by_table(docs, "text", rules, "grupo", "outro", ignore_case=True).select("doc_id", "grupo")


# Row cleaning

@query
def dedup_first_in_file(spark, sf):
    """One order per customer: the first in the file, where an order by columns would take another."""
    rows = files.read_parquet(spark, f"{sf}/orders.parquet", POSITION).select(
        POSITION, "o_orderstatus", "o_custkey", "o_orderkey", "o_totalprice"
    )
    return clean.dedup_by_key(rows, "o_custkey", [POSITION]).drop(POSITION)


@query
def dedup_by_key(spark, sf):
    return clean.dedup_by_key(table(spark, sf, "documents"), "text", ["doc_id"])


@query
def dedup_rare_repeats(spark, sf):
    return clean.dedup_rare_repeats(table(spark, sf, "documents"), "text", ["doc_id"])


@query
def bool_to_flag(spark, sf):
    rows = flags(spark, sf, "id", "f_returned", "f_accepted").select(
        "id", F.col("f_returned").cast("boolean").alias("f_returned"),
        F.upper(F.col("f_accepted").cast("boolean").cast("string")).alias("f_accepted"),
    )
    return clean.bool_to_flag(rows)


@query
def binary_columns(spark, sf):
    wide = labels_wide(spark, sf, "doc_id", "lang", "n_chars", "quality", "toxic").withColumn(
        "half", F.col("quality") * F.lit(0.5)
    ).withColumn("texto", F.when(F.col("toxic") == 1, "TRUE").when(F.col("toxic") == 0, "FALSE"))
    return clean.binary_profile(wide)


@query
def fill_binary(spark, sf):
    sparse = activity(spark, sf)
    return clean.fill_binary(sparse, clean.binary_columns(sparse.select(*views.EVENT_TYPES)))


@query
def fill_text(spark, sf):
    rows = labels_wide(spark, sf, "doc_id", "lang", "quality").select(
        "doc_id", F.when(F.col("quality").isNotNull(), F.col("lang")).alias("lingua"), "quality"
    )
    return clean.fill_text(rows)


def _event_number():
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    return F.when(F.col("event_type") == "error", F.col("props")).otherwise(digits)


@query
def try_cast_sum(spark, sf):
    rows = table(spark, sf, "events").select("event_type", _event_number().alias("k"))
    return rows.groupBy("event_type").agg(F.count("*").alias("total"), F.sum(try_int(F.col("k"))).alias("soma"))


@query
def coerce_numeric(spark, sf):
    rows = table(spark, sf, "events").select("event_type", _event_number().alias("k"))
    return rows.groupBy("event_type").agg(F.sum(coerce_number(rows, "k")).alias("soma"))


# Text and headers as data

@query
def normalise_text_(spark, sf):
    return table(spark, sf, "documents").select("doc_id", normalise_text(F.col("text")).alias("texto"))



@query
def clean_headers_(spark, sf):
    key, name = F.col("p_partkey").cast("string"), F.concat_ws(" / ", F.initcap("p_name"), "p_type")
    header = (
        F.when(F.col("p_size") < 15, F.concat(F.lit("('P"), key, F.lit("_a ', 'Opção "), name, F.lit("?')")))
        .when(F.col("p_size") < 30, F.concat(F.lit("('P"), key, F.lit("', \"Peça d'água 100% "), name, F.lit('")')))
        .when(F.col("p_size") < 40, F.concat(key, F.lit(".o.1_Remuneração/Salário "), name))
        .otherwise(F.concat(key, F.lit("  "), name, F.lit(" (É só isso).")))
    )
    return table(spark, sf, "part").select("p_partkey", clean_header_text(header).alias("nome"))



@query
def twin_suffix(spark, sf):
    numbered = profile.number_repeats(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "p_partkey")
    suffixed = F.when(F.col("twin") == 0, F.col("p_name")).otherwise(F.concat_ws("_", "p_name", "twin"))
    return numbered.select("p_partkey", suffixed.alias("nome"))


# Harmonisation

@query
def harmonise_editions(spark, sf):
    frames = views.harmonised_editions(spark, sf)
    return unify.unify({year: unify.tag_year(df, year) for year, df in frames.items()})


@query
def swap_correction(spark, sf):
    """Editions whose header occurs twice get the columns of the two questions right, the others have them so."""
    fixed = {}
    for year, df in views.editions(spark, sf).items():
        cleaned = harmonise.clean_columns(df)
        steps = [views.SWAP] if "item_devolvido_1" in cleaned.columns else []
        named = harmonise.harmonise(cleaned, [*steps, *([{"token": "id"}] if "token" in cleaned.columns else [])])
        fixed[year] = unify.tag_year(
            named.select("id", *[as_flag(named, c).alias(c) for c in ("desconto_100pct", "item_devolvido")]), year
        )
    return unify.unify(fixed)


@query
def curated_select(spark, sf):
    wanted = ["ID", "Faixa salarial", "desconto_100%", "Compra em Volume.", "não existe", "id"]
    picked = {
        year: unify.tag_year(harmonise.select_curated(df, wanted), year)
        for year, df in views.harmonised_editions(spark, sf).items()
    }
    return unify.unify(picked, "outer")


def _built(spark, sf):
    return silver.build_editions(views.editions(spark, sf), views.MAPPING, stage=True)


@query
def unify_common(spark, sf):
    return unify.unify(_built(spark, sf))


@query
def unify_outer(spark, sf):
    frames = views.harmonised_editions(spark, sf)
    ticks = ["item_devolvido", "compra_em_volume"]
    picked = {
        year: unify.tag_year(
            df.select("id", *[as_flag(df, c).alias(c) for c in ticks if c in df.columns]), year
        )
        for year, df in frames.items()
    }
    return unify.unify(picked, "outer")


@query
def unify_as_string(spark, sf):
    return unify.unify(_built(spark, sf), as_string=True)


def _twins(spark, sf):
    wide = flags(spark, sf, "id", "f_returned", "f_discount")
    return wide.select("id", F.col("f_returned").alias("marca"), F.col("f_discount").alias("marca"))


@query
def dup_columns_last(spark, sf):
    return harmonise.drop_twins(_twins(spark, sf), "last")


@query
def dup_columns_first(spark, sf):
    return harmonise.drop_twins(_twins(spark, sf), "first")


@query
def dup_columns_max_sum(spark, sf):
    wide = flags(spark, sf, "ano", "f_returned", "f_discount")
    total = harmonise.greatest_twin_sum(wide, ["f_returned", "f_discount"])
    return wide.groupBy("ano").agg(total.cast("bigint").alias("contagem"))


def _by_year(frames):
    return reduce(DataFrame.unionByName, [df.withColumn("ano", F.lit(year)) for year, df in frames.items()])


@query
def schema_diff(spark, sf):
    counts = {
        year: profile.non_null_counts(harmonise.clean_columns(df)) for year, df in views.editions(spark, sf).items()
    }
    base = counts.pop(1995)
    return _by_year({year: harmonise.schema_diff(base, other) for year, other in counts.items()})


@query
def keyword_columns(spark, sf):
    found = {
        year: profile.non_null_counts(
            harmonise.keyword_columns(harmonise.clean_columns(df), ["ITEM", "desconto", "salari"])
        ).select("column", "dtype", "non_null")
        for year, df in views.editions(spark, sf).items()
    }
    return _by_year(found)


@query
def column_lineage(spark, sf):
    steps = {year: steps_for(views.MAPPING, str(year)) for year in views.EDITION_HEADERS}
    return harmonise.lineage(views.editions(spark, sf), steps, 1995)


# Profiles

@query
def profile_shape(spark, sf):
    return profile.shape(labels_wide(spark, sf))


@query
def profile_nonnull(spark, sf):
    return profile.non_null_counts(labels_wide(spark, sf))


@query
def profile_nulls(spark, sf):
    return profile.null_counts(labels_wide(spark, sf))


@query
def null_total(spark, sf):
    return profile.null_total(labels_wide(spark, sf))


def _rounded(described):
    rounded = [F.round(c, 7).alias(c) if c in ("mean", "std", "q25", "q50", "q75") else F.col(c) for c in described.columns]
    return described.select(*rounded)


@query
def profile_describe(spark, sf):
    return _rounded(profile.describe(labels_wide(spark, sf)))


@query
def describe_many_values(spark, sf):
    return _rounded(profile.describe(table(spark, sf, "lineitem")))


@query
def minmax_sweep(spark, sf):
    return profile.min_max(labels_wide(spark, sf))


@query
def duplicate_rows(spark, sf):
    repeats = profile.duplicate_rows(table(spark, sf, "documents"), ["text", "lang"], "doc_id", wide=True)
    return repeats.select("doc_id", "lang", "n_chars")


@query
def duplicate_groups(spark, sf):
    return profile.duplicate_groups(table(spark, sf, "documents"), ["text", "lang"])


@query
def duplicate_groups_wide(spark, sf):
    return profile.duplicate_groups(table(spark, sf, "documents"), ["text", "lang"], wide=True)


@query
def duplicate_count(spark, sf):
    return profile.duplicate_count(table(spark, sf, "documents"), ["text", "lang"])


@query
def key_quality(spark, sf):
    docs = profile.key_quality(labels_wide(spark, sf, "doc_id"), "doc_id").withColumn("base", F.lit("labels_wide"))
    lines = profile.key_quality(table(spark, sf, "lineitem"), "l_orderkey").withColumn("base", F.lit("lineitem"))
    return docs.unionByName(lines)


@query
def show_columns(spark, sf):
    return profile.non_null_counts(resp(spark, sf)).select("position", "column", "non_null")


@query
def preview(spark, sf):
    return resp(spark, sf).orderBy("id").limit(5)


# Sources and sinks

@query
def csv_roundtrip(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "documents-csv")
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema)


def _faulty_files(spark, sf):
    """Orders as CSV files of two headers, some with line breaks in fields, some with faults."""
    key, price, text = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), F.col("o_orderpriority")
    note = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit('"'), text, F.lit(',\n""x"" "'))).otherwise(text)
    plain = F.concat_ws(",", key, price, note)
    first = (
        F.when(F.col("o_orderkey") % 97 == 0, F.concat_ws(",", plain, F.lit("mais")))
        .when(F.col("o_orderkey") % 89 == 1, F.concat_ws(",", key, F.lit("n/a"), note))
        .when(F.col("o_orderkey") % 83 == 2, F.concat_ws(",", key, price)).otherwise(plain)
    )
    second = F.when(F.col("o_orderkey") % 79 == 3, F.concat_ws(",", note, F.lit("x1"), price)).otherwise(F.concat_ws(",", note, key, price))
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "faulty")
    for header, line, mine in (
        ("o_orderkey,o_totalprice,nota", first, "F"), ("nota,o_orderkey,o_totalprice", second, "O"),
    ):
        status = F.col("o_orderstatus") == "F"
        lines = orders.where(status if mine == "F" else ~status).select(
            F.pmod(F.xxhash64("o_orderkey"), F.lit(3)).alias("part"), F.lit(1).alias("rank"), line.alias("value")
        )
        heads = spark.range(3).select(F.col("id").alias("part"), F.lit(0).alias("rank"), F.lit(header).alias("value"))
        ordered = lines.unionByName(heads).repartitionByRange(3, "part").sortWithinPartitions("part", "rank")
        # each part lies in one task, its header first
        ordered.select("part", "value").write.partitionBy("part").mode("append").text(path)
    return files.CsvFiles(spark, path, T.StructType.fromDDL("o_orderkey BIGINT, o_totalprice DOUBLE, nota STRING"))


@query
def csv_deviating_files(spark, sf):
    return _faulty_files(spark, sf).rows()


@query
def csv_rejected_rows(spark, sf):
    counted = files.rejected_counts(_faulty_files(spark, sf).rejected())
    return counted.groupBy("reason", "field").agg(F.sum("n_records").alias("n_records"))


@query
def bucketed_dedup(spark, sf):
    """Lines kept in buckets of their order: one line an order, joined with the order, without a shuffle of lines."""
    name = f"bucketed_{uuid.uuid4().hex}"
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    catalogue.save_bucketed(lines, name, "l_orderkey", 8, scratch_path(spark, "bucketed"))
    return clean.dedup_by_key(spark.table(name), "l_orderkey", ["l_shipdate", "l_linenumber", "l_quantity"])


@query
def replaced_table(spark, sf):
    """A table replaced by a frame that reads the table itself."""
    name, root = f"versioned_{uuid.uuid4().hex}", scratch_path(spark, "versions")
    versions.replace_table(resp(spark, sf), name, root, ["ano"])
    doubled = spark.table(name).withColumn("valor", F.col("valor") * 2)
    versions.replace_table(doubled, name, root, ["ano"])
    return spark.table(name).select(*views.RESP_COLUMNS)


@query
def parquet_partition_roundtrip(spark, sf):
    path = scratch_path(spark, "resp-parquet")
    rows = resp(spark, sf)
    files.write_parquet(rows, path, "ano")
    return files.read_parquet(spark, path).select(*rows.columns)


@query
def silver_from_csv(spark, sf):
    """Editions written as CSV under messy headers, read back, and built into the silver table."""
    path = scratch_path(spark, "bronze")

    def as_csv(edition):
        year, df = edition
        files.write_csv(df, f"{path}/ano_{year}")
        return year, files.read_csv(spark, f"{path}/ano_{year}", df.schema, position=POSITION)

    frames = views.editions(spark, sf)
    with ThreadPoolExecutor(len(frames)) as pool:
        raw = dict(pool.map(as_csv, frames.items()))
    built = silver.build_silver(raw, mapping=views.MAPPING, stage=True)
    return silver.write_silver(built, scratch_path(spark, "silver"))


# The seven questions: every indicator over the questionnaire-shaped view

def _indicator(name: str) -> Query:
    indicator = INDICATORS[name]

    def run(spark, sf):
        return indicator.run(views.survey(spark, sf, *dict.fromkeys([Q.YEAR, *indicator.reads])))

    return run


for _name in INDICATORS:
    REGISTRY[f"gold_{_name}"] = _indicator(_name)


@query
def gold_view_rows(spark, sf):
    return gold_view(views.survey(spark, sf, Q.KEY, Q.YEAR, Q.ROLE, Q.BAND))


# Extracts

@query
def extract_current_vs_ideal(spark, sf):
    frames = views.survey_editions(spark, sf, Q.MODEL_NOW, Q.MODEL_IDEAL, Q.DATA_LAKE)
    return indicators.counts(extracts.current_vs_ideal(frames), ["modelo", "situacao"])


@query
def extract_challenge_totals(spark, sf):
    return extracts.challenge_totals(views.survey_editions(spark, sf, *Q.CHALLENGES.values()))


@query
def extract_value_totals(spark, sf):
    return extracts.value_totals(views.survey_editions(spark, sf, *Q.VALUES.values()))


@query
def extract_maturity(spark, sf):
    return extracts.maturity_by_edition(
        views.survey_editions(spark, sf, Q.DATA_LAKE, Q.DATA_WAREHOUSE, Q.MODEL_NOW)
    )


@query
def extract_ai_barriers(spark, sf):
    return extracts.ai_barriers_long(views.survey_editions(spark, sf, *Q.BARRIER_OPTIONS))


@query
def extract_ai_barriers_more(spark, sf):
    return extracts.ai_barriers_long(views.survey_editions(spark, sf, *Q.BARRIER_OPTIONS_MORE), more=True)


@query
def extract_ai_uses(spark, sf):
    return extracts.ai_uses_long(views.survey_editions(spark, sf, *Q.AI_USE_OPTIONS))


@query
def extract_ai_answers(spark, sf):
    columns = [Q.AI_AT_WORK, Q.AI_PRIORITY, Q.AI_NO_PRIORITY, Q.AI_PAYER["gratis"], Q.AI_RESULTS]
    return extracts.ai_answers(views.survey_editions(spark, sf, *columns))


@query
def extract_short_model(spark, sf):
    return extracts.with_short_model(views.survey(spark, sf, Q.KEY, Q.YEAR, Q.MODEL_NOW, Q.ROLE))
