"""Moments and exact quantiles of many columns in at most four scans, by radix histograms.

A value's order key is a whole number of 64 bits that sorts as the value does. The first scan counts values by the
top 16 bits of their keys, for all columns at once, together with the moments of each count. The counts tell in which
of its 65,536 bins a sought place lies; the next scan counts the values of those bins by 16 more bits, and so on. A
place whose bin holds one value only is settled at once, so columns of few values take one or two scans.

Bins are counted in the task before they are shuffled, and at most 65,536 rows a column and sought bin are added up
in order. The driver gets one row per column and per sought place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named
from ..session import scratch_path

STEP = 16
_SMALLEST_NORMAL = 2.0**-1022


def _near(value: Column) -> Column:
    """The binary exponent of a value, off by one at most, next to a power of two."""
    return F.least(F.floor(F.log2(F.abs(value))), F.lit(1023))


def _key(value: Column, near: Column, power: Column) -> Column:
    size = F.abs(value)
    exponent = near - F.when(power > size, 1).otherwise(0) + F.when(power * 2 <= size, 1).otherwise(0)
    scale = F.when(power > size, power / 2).when(power * 2 <= size, power * 2).otherwise(power)
    bits = (
        F.when(size == 0, F.lit(0))
        .when(size == float("inf"), F.lit(2047 << 52))
        .when(size < _SMALLEST_NORMAL, (size * 2.0**537 * 2.0**537).cast("bigint"))
        .otherwise((exponent + 1023) * F.lit(1 << 52) + ((size / scale - 1) * 2.0**52).cast("bigint"))
    )
    return F.when(value < 0, -bits).otherwise(bits)


def order_key(value: Column) -> Column:
    """Whole number that orders doubles as they are ordered themselves: their bits, negated below zero."""
    near = _near(value)
    return _key(value, near, F.pow(F.lit(2.0), near))


@dataclass
class Place:
    """A sought place of a column's sorted values: where it is inside the bin found so far."""

    column: int
    place: int
    bin: int | None = None
    value: float | None = None
    low: float | None = None  # the least and the greatest value of the bin
    high: float | None = None


@dataclass
class Moments:
    n: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None


def _as_double(df: DataFrame, name: str) -> Column:
    value = named(name).cast("double")
    return F.when(~F.isnan(value), value)  # NaN is no answer


Ranges = dict[int, set[tuple[float, float]]]


def _histogram(df: DataFrame, columns: Sequence[str], depth: int, sought: Ranges | None) -> DataFrame:
    """Counts by the top ``depth * STEP`` key bits: of all values, or of those in the ranges of values sought.

    Columns are brought into rows first, so that the key is made in one place, however many columns there are.
    """
    places = [i for i in range(len(columns)) if sought is None or i in sought]
    entries = [part for i in places for part in (F.lit(i), _as_double(df, columns[i]))]
    values = df.select(F.stack(F.lit(len(places)), *entries).alias("column", "x")).where("x IS NOT NULL")
    if sought is not None:
        tests = [
            (F.col("column") == i) & F.col("x").between(F.lit(low), F.lit(high))
            for i, ranges in sorted(sought.items()) for low, high in sorted(ranges)
        ]
        values = values.where(reduce(lambda a, b: a | b, tests))
    keyed = values.withColumn("_near", _near(F.col("x"))).withColumn("_power", F.pow(F.lit(2.0), F.col("_near")))
    key = _key(F.col("x"), F.col("_near"), F.col("_power"))
    bin_of = F.shiftright(key, 64 - STEP * depth) if depth < 64 // STEP else key
    one = keyed.select("column", bin_of.alias("bin"), "x")
    measures = [F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")]
    if sought is None:
        measures += [F.avg("x").alias("mean"), F.var_pop("x").alias("spread")]
    counted = one.groupBy("column", "bin").agg(*measures)
    path = scratch_path(df.sparkSession, "histogram")
    counted.write.parquet(path)
    return df.sparkSession.read.schema(counted.schema).parquet(path)


def _moments(bins: DataFrame, columns: Sequence[str]) -> list[Moments]:
    """Moments of each column, put together from those of its bins."""
    whole = bins.groupBy("column").agg(F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    apart = F.col("n") * (F.col("spread") + (F.col("mean") - F.col("centre")) * (F.col("mean") - F.col("centre")))
    rows = bins.join(whole, "column").groupBy("column").agg(
        F.first("total").alias("n"), F.first("centre").alias("mean"), F.sum(apart).alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).collect()
    out = [Moments(0, None, None, None, None) for _ in columns]
    for row in rows:
        std = math.sqrt(row["squares"] / (row["n"] - 1)) if row["n"] > 1 else None
        out[row["column"]] = Moments(row["n"], row["mean"], std, row["low"], row["high"])
    return out


def _locate(bins: DataFrame, places: list[Place], shift: int | None) -> None:
    """Find the bin of each place among the bins of its parent, and the place inside it."""
    spark = bins.sparkSession
    parent = F.lit(0).cast("bigint") if shift is None else F.shiftright("bin", shift)
    order = Window.partitionBy("column", "parent").orderBy("bin")
    summed = bins.withColumn("parent", parent).withColumn("until", F.sum("n").over(order))
    wanted = spark.createDataFrame(
        [(i, p.column, p.bin or 0, p.place) for i, p in enumerate(places)], "id int, column int, parent bigint, place bigint"
    )
    found = summed.join(wanted, ["column", "parent"]).where("place < until AND place >= until - n")
    for row in found.select("id", "bin", (F.col("place") - F.col("until") + F.col("n")).alias("inside"), "low", "high").collect():
        place = places[row["id"]]
        place.bin, place.place, place.low, place.high = row["bin"], row["inside"], row["low"], row["high"]
        if row["low"] == row["high"]:
            place.value = row["low"]


def moments_and_quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float] = ()
) -> tuple[list[Moments], dict[tuple[str, float], float | None]]:
    """Moments of each column, and its quantiles by linear interpolation; null and NaN are no values."""
    if not columns:
        return [], {}
    bins = _histogram(df, columns, 1, None)
    moments = _moments(bins, columns)
    ends: dict[tuple[int, float], tuple[Place, Place, float]] = {}
    places: dict[tuple[int, int], Place] = {}
    for i, moment in enumerate(moments):
        for p in points if moment.n else ():
            at = (moment.n - 1) * p
            low, high = (places.setdefault((i, k), Place(i, k)) for k in (math.floor(at), math.ceil(at)))
            ends[i, p] = low, high, at - math.floor(at)
    depth, open_places = 1, list(places.values())
    if open_places:
        _locate(bins, open_places, None)
    while open_places := [p for p in open_places if p.value is None]:
        depth += 1
        sought: Ranges = {}
        for place in open_places:
            sought.setdefault(place.column, set()).add((place.low, place.high))
        _locate(_histogram(df, columns, depth, sought), open_places, STEP)
    quantiles: dict[tuple[str, float], float | None] = {}
    for i, name in enumerate(columns):
        for p in points:
            found = ends.get((i, p))
            quantiles[name, p] = None if found is None else _between(*found)
    return moments, quantiles


def _between(low: Place, high: Place, share: float) -> float:
    if share == 0 or low.value == high.value:
        return low.value
    return low.value + (high.value - low.value) * share
