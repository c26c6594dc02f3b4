"""Data-quality profiles. Each is one aggregate over one scan, except quantiles, which take four at most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named
from .clean import repeated_hashes, split_repeats
from .quantiles import moments_and_quantiles
from .reshape import literal_rows, wide_row_to_long

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def shapes_by(df: DataFrame, by: str) -> DataFrame:
    """Rows per edition of the unified table and its number of columns, from one count."""
    return df.groupBy(named(by)).agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, non_null)`` for every column."""
    row = df.agg(*[F.count(named(c)).alias(c) for c in df.columns])
    long = wide_row_to_long(row, "column", "non_null")
    position = F.lit(None).cast("int")
    dtype = F.lit(None).cast("string")
    for place, (name, kind) in enumerate(df.dtypes):
        position = F.when(F.col("column") == name, place).otherwise(position)
        dtype = F.when(F.col("column") == name, kind).otherwise(dtype)
    return long.select(position.alias("position"), "column", dtype.alias("dtype"), "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column."""
    row = df.agg(*[F.count_if(named(c).isNull()).alias(c) for c in df.columns])
    return wide_row_to_long(row, "column", "nulls")


def null_total(df: DataFrame) -> DataFrame:
    """Nulls in the whole frame."""
    return null_counts(df).agg(F.sum("nulls").alias("nulls"))


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    wanted = df.columns if columns is None else columns
    return [c for c in wanted if isinstance(df.schema[c].dataType, T.NumericType)]


def min_max(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, min_value, max_value)`` of every numeric column, as doubles."""
    names = _numeric(df, columns)
    if not names:
        return _no_rows(df, "column STRING, min_value DOUBLE, max_value DOUBLE")
    row = df.agg(
        *[F.min(named(c)).cast("double").alias(f"min {c}") for c in names],
        *[F.max(named(c)).cast("double").alias(f"max {c}") for c in names],
    )
    return _paired_row_to_long(row, names, {"min_value": "min", "max_value": "max"})


def _no_rows(df: DataFrame, schema: str) -> DataFrame:
    """The profile of a frame without a column to profile."""
    return df.sparkSession.createDataFrame([], schema)


def _paired_row_to_long(row: DataFrame, names: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One summary row with ``"<prefix> <column>"`` fields to one row per column."""
    entries = [
        F.struct(F.lit(name).alias("column"), *[named(f"{prefix} {name}").alias(m) for m, prefix in measures.items()])
        for name in names
    ]
    return row.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of every numeric column; null and NaN are no values."""
    names = _numeric(df, columns)
    doubles = ", ".join(f"{f} DOUBLE" for f in ("mean", "std", "min", *QUARTILES, "max"))
    moments, quantiles = moments_and_quantiles(df, names, list(QUARTILES.values()))
    rows = [
        (name, m.n, m.mean, m.std, m.low, *[quantiles[name, p] for p in QUARTILES.values()], m.high)
        for name, m in zip(names, moments)
    ]
    return literal_rows(df.sparkSession, rows, f"column STRING, count BIGINT, {doubles}")


def _may_repeat(df: DataFrame, names: Sequence[str], wide: bool) -> DataFrame:
    """The frame, or for wide rows from files only those whose values may occur again."""
    return split_repeats(df, names, repeated_hashes({0: df}, names))[1] if wide else df


def duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None, wide: bool = False) -> DataFrame:
    """Values that occur more than once, with the number of repeats after the first.

    With ``wide``, for long values read from files, values that occur once are not shuffled.
    """
    names = df.columns if columns is None else list(columns)
    rows = _may_repeat(df.select(*[named(c) for c in names]), names, wide)
    return rows.groupBy(*[named(c) for c in names]).agg((F.count("*") - 1).alias("repeats")).where("repeats > 0")


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None, wide: bool = False) -> DataFrame:
    """Rows that repeat an earlier row."""
    return duplicate_groups(df, columns, wide).agg(
        F.coalesce(F.sum("repeats"), F.lit(0).cast("bigint")).alias("duplicate_rows")
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str], row_id: str, wide: bool = False) -> DataFrame:
    """Rows that repeat an earlier row on the columns, rows being told apart by a unique id.

    The first row of each group comes from a map-side combined minimum; every other row is
    found by an anti-join on the unique id, so no group of copies is ever brought together.
    A row without an id comes after those with one; where a group has none, one row is the first
    only if it is alone, so of rows without any id all are listed as soon as there are two.
    """
    rows = _may_repeat(df, columns, wide)
    firsts = rows.groupBy(*[named(c) for c in columns]).agg(
        F.min(named(row_id)).alias("_first"), F.count("*").alias("_rows")
    )
    ids = firsts.where(F.col("_first").isNotNull()).select(F.col("_first").alias(row_id))
    alone = firsts.where("_first IS NULL AND _rows = 1").drop("_first", "_rows")
    with_id = rows.where(named(row_id).isNotNull()).join(ids, row_id, "left_anti")
    without = rows.where(named(row_id).isNull()).alias("_r")
    same = [F.col("_r." + _quoted(c)).eqNullSafe(F.col("_a." + _quoted(c))) for c in columns]
    left = without.join(alone.alias("_a"), same, "left_anti")
    names = [named(c) for c in df.columns]
    return with_id.select(*names).unionByName(left.select(*names))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def key_quality(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, repeats after the first, and null keys, from one count per key."""
    per_key = df.groupBy(named(key).alias("_key")).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.count("_key").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0).cast("bigint")).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0).cast("bigint")).alias("null_keys"),
    )


def number_repeats(
    df: DataFrame, name: str, order: str, output: str = "twin", slice_bits: int = 20
) -> DataFrame:
    """Number the rows of each name 0, 1, 2, … by a unique whole-number ``order`` column.

    Rows are numbered inside slices of ``2 ** slice_bits`` order values, and the counts of the
    earlier slices are added, so a name that holds a third of all rows spreads over many tasks
    and no group of rows to sort exceeds a slice. A null name is a name of its own.
    """
    # Null-free keys let the window and the join share one shuffle of the rows.
    keys = {
        "_name": F.coalesce(named(name), F.lit("")),
        "_nameless": named(name).isNull(),
        "_slice": F.coalesce(F.shiftright(named(order).cast("bigint"), slice_bits), F.lit(-(1 << 62))),
    }
    sliced = df.withColumns(keys)
    in_slice = Window.partitionBy(*keys).orderBy(named(order))
    earlier = Window.partitionBy("_name", "_nameless").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    placed = sliced.withColumn("_place", F.row_number().over(in_slice)).join(offsets, list(keys))
    number = (F.col("_before") + F.col("_place") - 1).cast("bigint")
    return placed.select(*[named(c) for c in df.columns], number.alias(output))
