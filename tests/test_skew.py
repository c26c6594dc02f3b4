"""One key with a third of all rows: results stay whole, and no task gets the whole group."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from surveyloom.functions.rules import map_by_table
from surveyloom.operators import clean, indicators, profile, reshape
from surveyloom.session import scratch_path
from tests.compare import connect, differences
from tests.hot import write_hot_tables

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """Every third row belongs to key -1; the others have keys of their own."""
    return spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.concat(F.lit("x" * 50), F.col("id").cast("string")).alias("wide"),
    )


@pytest.fixture
def small_partitions(spark):
    """Thresholds that make a few hundred kilobytes count as a skewed partition, and no broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.toString()


def test_hot_value_of_a_label_table_is_split(spark, hot, small_partitions):
    labels = spark.range(ROWS).select(
        (F.col("id") - 1).cast("string").alias("source"), F.concat(F.lit("rótulo "), F.col("id")).alias("target")
    )
    rows = hot.select(F.col("k").cast("string").alias("k"), "v", "wide")
    mapped = map_by_table(rows, "k", labels, "k", keep_unmapped=True)
    assert len(mapped.collect()) == ROWS
    assert "skew=true" in executed(mapped)


def test_dedup(hot):
    for found in (clean.dedup_by_key(hot, "k", ["v"]), clean.dedup_rare_repeats(hot, "k", ["v"])):
        assert found.count() == ROWS * 2 // 3 + 1
        assert found.where("k = -1").select("v").collect() == [(0,)]


def test_rows_with_a_key_of_their_own_are_not_shuffled(hot):
    once, again = clean.split_repeats(hot, ["k"], clean.repeated_hashes({0: hot}, ["k"]))
    assert once.count() == ROWS * 2 // 3 and again.count() == ROWS // 3
    assert "Exchange hashpartitioning" not in executed(once)


def test_duplicates(hot):
    assert profile.duplicate_count(hot, ["k"]).first()[0] == ROWS // 3 - 1
    assert profile.duplicate_rows(hot, ["k"], "v").count() == ROWS // 3 - 1
    assert profile.duplicate_groups(hot, ["k"], wide=True).collect() == [(-1, ROWS // 3 - 1)]
    assert tuple(profile.key_quality(hot, "k").first()) == (ROWS, ROWS * 2 // 3 + 1, ROWS // 3 - 1, 0)


def test_numbering(hot):
    named = hot.select(F.col("k").cast("string").alias("n"), "v")
    numbers = profile.number_repeats(named, "n", "v", slice_bits=10).where("n = '-1'")
    assert [tuple(r) for r in numbers.agg(F.min("twin"), F.max("twin"), F.count_distinct("twin")).collect()] == [
        (0, ROWS // 3 - 1, ROWS // 3)
    ]


def test_counts_and_stacks(hot):
    assert indicators.top_k(hot, "k", 1).first().total == ROWS // 3
    counted = reshape.count_stacked(hot.select("k", F.col("k").alias("j")), {"A": "k", "B": "j"}, "m", "s")
    assert counted.where("m = -1").select("total").distinct().collect() == [(ROWS // 3,)]


@pytest.fixture(scope="module")
def hot_dir(spark):
    return write_hot_tables("/root/testdata/sf0.01", scratch_path(spark, "hot"))


@pytest.mark.parametrize("name", [
    "top_k", "tier_rate_by_two", "ranking_by_edition", "unpivot_flags", "dedup_by_key", "dedup_rare_repeats",
    "duplicate_rows", "duplicate_groups_wide", "key_quality", "twin_suffix", "fill_binary", "map_long_table",
])
def test_queries_on_skewed_tables(spark, hot_dir, name):
    assert differences(queries()[name](spark, hot_dir), connect(hot_dir), oracle_sql()[name]) == []


def test_hot_customer_is_split(spark, hot_dir, small_partitions):
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
    # A partition is split along the tasks that wrote it, so the tables need several files.
    spread = scratch_path(spark, "spread")
    for name in ("orders", "customer", "nation", "region"):
        spark.read.parquet(f"{hot_dir}/{name}.parquet").repartition(8).write.parquet(f"{spread}/{name}.parquet")
    df = queries()["tier_rate_by_two"](spark, spread)
    assert df.collect() == queries()["tier_rate_by_two"](spark, hot_dir).collect()
    assert "skew=true" in executed(df)
