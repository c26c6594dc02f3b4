"""Moments and exact quantiles against numpy; at most four scans whatever the values are."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import quantiles
from surveyloom.operators.profile import describe

POINTS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture
def scans(monkeypatch):
    """Number of histograms taken, each of which is one scan."""
    taken = []
    plain = quantiles._histogram
    monkeypatch.setattr(quantiles, "_histogram", lambda *args: taken.append(1) or plain(*args))
    return taken


def _check(spark, scans, values, most=4):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    (moments,), found = quantiles.moments_and_quantiles(df, ["x"], POINTS)
    known = [v for v in values if v is not None and v == v]
    for p in POINTS:
        assert found["x", p] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-12)
    assert moments.n == len(known) and (moments.low, moments.high) == (min(known), max(known))
    assert moments.mean == pytest.approx(np.mean(known)) and moments.std == pytest.approx(np.std(known, ddof=1))
    assert len(scans) <= most


def bits(value):
    whole = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -whole if value < 0 else whole


def test_keys_are_the_bits_of_the_values(spark):
    rng = np.random.default_rng(3)
    powers = [2.0**k for k in range(-1074, 1024)]
    values = [0.0, -0.0, 1.0, float("inf"), 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, *powers]
    values += [np.nextafter(p, 0) for p in powers] + [np.nextafter(p, np.inf) for p in powers]
    values += [float(v) for v in np.frombuffer(rng.bytes(80_000), np.float64) if v == v]
    values = [float(v) for v in values]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", quantiles.order_key(F.col("x")).alias("k"))
    assert all(row.k == bits(row.x) for row in df.collect())


def test_spread_values(spark, scans):
    rng = np.random.default_rng(7)
    _check(spark, scans, [float(v) for v in rng.normal(size=4000)] + [None] * 50 + [float("nan")] * 20)


def test_values_of_very_different_sizes(spark, scans):
    rng = np.random.default_rng(9)
    _check(spark, scans, [float(s * 10.0**e) for s, e in zip(rng.normal(size=3000), rng.integers(-150, 150, 3000))])


def test_values_that_differ_in_the_last_bits(spark, scans):
    rng = np.random.default_rng(10)
    _check(spark, scans, [1.0 + float(i) * 2.0**-52 for i in rng.integers(0, 5000, 3000)])


def test_a_third_of_the_values_are_one(spark, scans):
    rng = np.random.default_rng(8)
    _check(spark, scans, [float(v) for v in rng.normal(size=2000)] + [0.123] * 1000)


def test_two_hot_values_at_the_boundary(spark, scans):
    _check(spark, scans, [1.0] * 1000 + [2.0] * 1000 + [1.0 + i / 1000 for i in range(1, 900)])


def test_few_values_take_one_scan(spark, scans):
    _check(spark, scans, [float(v) for v in [0, 1, 1, 0, 1, 5, -3] * 100], most=1)


def test_all_columns_share_the_scans(spark, scans):
    df = spark.range(1001).select(
        (F.col("id") * 3).alias("x"), F.rand(3).alias("y"), F.lit(None).cast("int").alias("nothing"),
        (F.col("id") * 7 % 10).cast("decimal(38,10)").alias("z"), F.when(F.col("id") == 4, F.lit(2**62)).alias("one"),
    )
    moments, found = quantiles.moments_and_quantiles(df, df.columns, [0.25, 0.333, 0.5])
    assert found["x", 0.25] == 750.0 and found["x", 0.333] == pytest.approx(999.0) and found["z", 0.5] == 4.0
    assert moments[2].n == 0 and moments[2].mean is None and found["nothing", 0.5] is None
    assert found["one", 0.25] == 2.0**62 and moments[4].std is None
    assert len(scans) <= 4


def test_describe_without_numbers(spark):
    assert describe(spark.createDataFrame([("a",)], "x string")).count() == 0
    row = describe(spark.createDataFrame([], "x int, y string")).first()
    assert (row["column"], row["count"], row["q50"]) == ("x", 0, None)
