"""Row cleaning: repeated respondents, 0/1 answers, missing categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import FLAG_ONLY_TEXT, MISSING_TEXT, as_flag, named
from ..session import scratch_path
from .reshape import wide_row_to_long


def _key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[named(c) for c in columns])


def repeated_hashes(frames: Mapping[int, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Hashes of keys that occur more than once in a frame, as ``(edition, _hash)``.

    Only a hash per row is shuffled, for all frames in one job. The hashes found are written to
    the shared scratch folder, so that Spark knows their size when they are joined.
    """
    hashed = [df.select(F.lit(label).alias("edition"), _key_hash(columns).alias("_hash")) for label, df in frames.items()]
    counted = reduce(DataFrame.union, hashed).groupBy("edition", "_hash").agg(F.count("*").alias("_n"))
    spark = counted.sparkSession
    path = scratch_path(spark, "repeats")
    counted.where("_n > 1").select("edition", "_hash").write.parquet(path)
    return spark.read.schema("edition INT, _hash BIGINT").parquet(path)


def split_repeats(df: DataFrame, columns: Sequence[str], repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose columns occur once, and rows whose columns may occur again.

    ``repeated`` comes from ``repeated_hashes``. There is no broadcast hint: while the stored hashes
    are below the session's threshold, Spark broadcasts them and wide rows are split where they lie.
    Equal hashes of different values only add to the second frame.
    """
    marked = df.withColumn("_hash", _key_hash(columns))
    small = repeated.select("_hash")
    once = marked.join(small, "_hash", "left_anti").select(*[named(c) for c in df.columns])
    again = marked.join(small, "_hash", "left_semi").select(*[named(c) for c in df.columns])
    return once, again


def dedup_rare_repeats(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str], repeated: DataFrame | None = None
) -> DataFrame:
    """``dedup_by_key`` for wide rows from files, of whose keys few repeat.

    Rows with a key of their own are not ranked. The frame is read more than once, so it should
    come from files, not from costly steps.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if repeated is None:
        repeated = repeated_hashes({0: df}, keys)
    once, again = split_repeats(df, keys, repeated)
    return once.unionByName(dedup_by_key(again, keys, order))


def dedup_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order; all null keys count as one key.

    Spark cuts the ranking to one row per key before the shuffle as well as after it, so a key
    that holds a third of all rows sends at most one row from each input task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = Window.partitionBy(*[named(k) for k in keys]).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def bool_to_flag(df: DataFrame) -> DataFrame:
    """Booleans to 1/0, and the texts TRUE and FALSE in any case to '1' and '0', in every column."""

    def fixed(field: T.StructField) -> Column:
        value = named(field.name)
        if isinstance(field.dataType, T.BooleanType):
            value = value.cast("int")
        elif isinstance(field.dataType, T.StringType):
            word = F.lower(F.trim(value))
            value = F.when(word == "true", "1").when(word == "false", "0").otherwise(value)
        return value.alias(field.name)

    return df.select(*[fixed(field) for field in df.schema.fields])


def _is_flag_value(field: T.StructField) -> Column | None:
    """Test that one value is a 0/1 answer, or None for types that never hold one."""
    value = named(field.name)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(value.isNotNull(), True)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value.isin(0, 1))  # NaN is no answer
    if isinstance(field.dataType, T.NumericType):
        return value.isin(0, 1)
    if isinstance(field.dataType, T.StringType):
        return F.lower(F.trim(value)).isin(*FLAG_ONLY_TEXT)
    return None


def binary_tests(df: DataFrame) -> DataFrame:
    """One row, one boolean per column: every answer given is 0 or 1, and there is one.

    One aggregate over one scan. A column without any answer is not binary.
    """

    def test(field: T.StructField) -> Column:
        ok = _is_flag_value(field)
        every = F.lit(False) if ok is None else F.coalesce(F.bool_and(ok), F.lit(False))
        return every.alias(field.name)

    return df.agg(*[test(field) for field in df.schema.fields])


def binary_profile(df: DataFrame) -> DataFrame:
    """The verdict of ``binary_tests`` as rows ``(column, is_binary)``."""
    return wide_row_to_long(binary_tests(df), "column", "is_binary")


def binary_columns(df: DataFrame) -> list[str]:
    """Names of the binary columns; brings the one summary row to the driver."""
    verdict = binary_tests(df).first()
    return [name for name, is_binary in zip(df.columns, verdict) if is_binary]


def binary_columns_of(frames: Mapping[int, DataFrame]) -> dict[int, list[str]]:
    """``binary_columns`` of several editions in one job; one row per edition and column comes back."""
    profiles = [binary_profile(df).withColumn("edition", F.lit(year)) for year, df in frames.items()]
    rows = reduce(lambda a, b: a.unionByName(b), profiles).where("is_binary").collect()
    found = {(row["edition"], row["column"]) for row in rows}
    return {year: [c for c in df.columns if (year, c) in found] for year, df in frames.items()}


def fill_answers(
    df: DataFrame, flags: Sequence[str], keep: Sequence[str] = (), missing: str = MISSING_TEXT
) -> DataFrame:
    """Unticked flags to 0 and missing text to its category, in one projection."""
    flag_set, kept = set(flags), set(keep)

    def filled(field: T.StructField) -> Column:
        value = named(field.name)
        if field.name in flag_set:
            value = F.coalesce(as_flag(df, field.name), F.lit(0))
        elif isinstance(field.dataType, T.StringType) and field.name not in kept:
            value = F.coalesce(value, F.lit(missing))
        return value.alias(field.name)

    return df.select(*[filled(field) for field in df.schema.fields])


def fill_binary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Unticked flags to integer 0; text stays as it is."""
    return fill_answers(df, flags, keep=df.columns)


def fill_text(df: DataFrame, keep: Sequence[str] = ("id",), missing: str = MISSING_TEXT) -> DataFrame:
    """Missing text to its category, in every text column but the kept ones."""
    return fill_answers(df, (), keep, missing)
