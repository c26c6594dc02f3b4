"""Bring an edition to the common column vocabulary. Each function is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import coerce_number, named
from ..functions.names import Step, clean_headers, keep_positions, names_with, pick_columns, resolve, trace
from .reshape import literal_rows, wide_row_to_long


def _by_position(df: DataFrame, picked: Sequence[tuple[int, str]]) -> DataFrame:
    """Select columns by position, which works even where names repeat."""
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{position}").alias(name) for position, name in picked])


def clean_columns(df: DataFrame) -> DataFrame:
    """Raw headers to plain, unique names."""
    return df.toDF(*clean_headers(df.columns))


def harmonise(df: DataFrame, steps: Sequence[Step], keep: str = "last") -> DataFrame:
    """Apply mapping steps to clean names; twins that arise keep their last (or first) column."""
    return _by_position(df, resolve(df.columns, steps, keep))


def drop_twins(df: DataFrame, keep: str = "last") -> DataFrame:
    """One column per name where a frame carries repeated names."""
    return _by_position(df, keep_positions(list(enumerate(df.columns)), keep))


def select_curated(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the edition has, in the wanted order."""
    return df.select(*[named(name) for name in pick_columns(df.columns, wanted)])


def greatest_twin_sum(df: DataFrame, twins: Sequence[str]) -> Column:
    """Aggregate expression: the sum of each twin, and of those the greatest."""
    sums = [F.sum(coerce_number(df, name)) for name in twins]
    return F.greatest(*sums) if len(sums) > 1 else sums[0]


def schema_diff(base: DataFrame, other: DataFrame) -> DataFrame:
    """Compare two editions by the frames ``profile.non_null_counts`` gives for them.

    One row per column name: matched, missing from ``other``, or new in it.
    """
    left = base.select(F.col("column"), F.col("non_null").alias("base_non_null"))
    right = other.select(F.col("column"), F.col("non_null").alias("other_non_null"))
    status = (
        F.when(F.col("other_non_null").isNull(), "missing")
        .when(F.col("base_non_null").isNull(), "new")
        .otherwise("matched")
    )
    return left.join(right, "column", "full_outer").select(
        "column", "base_non_null", "other_non_null", status.alias("status")
    )


def keyword_columns(df: DataFrame, words: Sequence[str]) -> DataFrame:
    """Columns whose name holds a keyword."""
    return df.select(*[named(name) for name in names_with(df.columns, words)])


def lineage(editions: Mapping[int, DataFrame], steps: Mapping[int, Sequence[Step]], base: int, keep: str = "last") -> DataFrame:
    """Every raw column of every edition: where it went, by which step, and how many answers it holds.

    Status is ``same`` or ``renamed`` for columns of the base edition's vocabulary, ``unmapped`` for names the base
    doesn't have, and ``replaced`` for a column whose name a twin took. Names are settled on the driver, as they are
    in the harmonisation itself; answers are counted by one aggregate per edition.
    """
    vocabulary = {origin.name for origin in trace(editions[base].columns, steps.get(base, ()), keep)}
    rows, counts = [], []
    for edition, df in editions.items():
        for origin in trace(df.columns, steps.get(edition, ()), keep):
            status = (
                "replaced" if origin.name is None
                else "unmapped" if origin.name not in vocabulary
                else "same" if origin.name == origin.clean else "renamed"
            )
            rows.append((edition, origin.position, origin.header, origin.clean, origin.step, origin.name, status))
        numbered = df.toDF(*[str(i) for i in range(len(df.columns))])
        counted = numbered.agg(*[F.count(named(c)).alias(c) for c in numbered.columns])
        counts.append(wide_row_to_long(counted, "position", "non_null").select(
            F.lit(edition).alias("edition"), F.col("position").cast("int").alias("position"), "non_null"
        ))
    names = literal_rows(
        editions[base].sparkSession, rows, "edition int, position int, header string, clean string, step int, column string, status string"
    )
    return names.join(reduce(DataFrame.unionByName, counts), ["edition", "position"])
