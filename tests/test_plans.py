"""Physical plans: one scan, pruned columns, no Python, partial steps before shuffles."""

import re

import pytest

from __spark_entry__ import queries
from fixtures.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    def text(name):
        return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()

    return text


# The library's own queries. Reading CSV records whose fields span lines is the one step that leaves the JVM.
READ_CSV = {"csv_roundtrip", "csv_deviating_files", "csv_rejected_rows"}
LAZY = [n for n in sorted(REGISTRY) if n not in READ_CSV]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_rdd_no_cartesian(plan, name):
    text = plan(name)
    for word in ("Python", "MapInArrow", "MapInPandas", "ExistingRDD", "MapPartitions", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("name, scans", [
    ("ranking_overall", 2), ("ranking_by_edition", 2), ("multi_flag_pct", 2), ("count_by_edition", 1),
    ("share_within_group", 1), ("current_vs_ideal", 2), ("gold_challenges", 2), ("gold_roles_share", 1),
])
def test_each_table_is_scanned_once(plan, name, scans):
    assert plan(name).count("FileScan") == scans


def test_columns_are_pruned(plan):
    found = re.search(r"ReadSchema: struct<([^>]*)>", plan("share_within_group")).group(1)
    assert found == "o_orderdate:timestamp_ntz,o_orderpriority:string"


def test_top_k_is_taken_not_sorted(plan):
    assert "TakeOrderedAndProject" in plan("top_k")


def test_dedup_is_limited_before_the_shuffle(plan):
    text = plan("dedup_by_key")
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_numbering_shuffles_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = queries()["twin_suffix"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows_side = text[: text.index("FileScan")]
    assert rows_side.count("Exchange") == 1


def test_indicators_aggregate_before_the_shuffle(plan):
    for name in ("tier_rate", "conditional_rate", "flag_sum", "key_quality", "value_counts"):
        assert "partial_" in plan(name)
