"""Wide to long: ticked options, stacked columns, summary rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_flag, named


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few known rows as part of the plan, so that nothing is shipped from the driver when it runs."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    entries = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))


def wide_row_to_long(row: DataFrame, name: str, value: str, ids: Sequence[str] = ()) -> DataFrame:
    """Aggregated columns as rows ``(ids…, name, value)``."""
    values = [c for c in row.columns if c not in ids]
    return row.unpivot([named(c) for c in ids], [named(c) for c in values], name, value)


def ticked_options(
    df: DataFrame, ids: Sequence[str], options: Mapping[str, str | None], name: str = "option"
) -> DataFrame:
    """One row per respondent and ticked option, from ``{column: label}``.

    Options the edition lacks are left out; an option without label comes out as null. Columns
    take their labels before the unpivot, so no lookup runs per row, and only ticked options
    leave the stage.
    """
    present = {column: label for column, label in options.items() if column in df.columns}
    if not present:
        typed = df.select(*[named(c) for c in ids], F.lit(None).cast("string").alias(name))
        return typed.where(F.lit(False))
    labelled = {column: label for column, label in present.items() if label is not None}
    if len(set(labelled.values())) != len(labelled) or len(labelled) != len(present):
        keyed = {column: column for column in present}
    else:
        keyed = labelled
    wide = df.select(*[named(c) for c in ids], *[as_flag(df, c).alias(keyed[c]) for c in present])
    long = wide.unpivot([named(c) for c in ids], [named(keyed[c]) for c in present], name, "ticked")
    ticked = long.where("ticked = 1").drop("ticked")
    if keyed is labelled:
        return ticked
    shown: Column = F.lit(None).cast("string")
    for column, label in labelled.items():
        shown = F.when(F.col(name) == column, label).otherwise(shown)
    return ticked.withColumn(name, shown)


def stack_columns(df: DataFrame, tagged: Mapping[str, str], value: str, tag: str) -> DataFrame:
    """Several columns on top of each other, from ``{tag: column}``, without nulls."""
    wide = df.select(*[named(column).alias(label) for label, column in tagged.items()])
    long = wide.unpivot([], [named(label) for label in tagged], tag, value)
    return long.where(named(value).isNotNull()).select(value, tag)


def count_stacked(df: DataFrame, tagged: Mapping[str, str], value: str, tag: str, total: str = "total") -> DataFrame:
    """Counts of ``stack_columns``, made from one count per combination of the columns.

    The stacking then works on the combinations, not on the respondents.
    """
    names = list(tagged)
    wide = df.select(*[named(tagged[label]).alias(label) for label in names])
    combos = wide.groupBy(*[named(label) for label in names]).agg(F.count("*").alias("_n"))
    long = combos.unpivot([F.col("_n")], [named(label) for label in names], tag, value)
    return (
        long.where(named(value).isNotNull())
        .groupBy(named(value), named(tag))
        .agg(F.sum("_n").alias(total))
    )
