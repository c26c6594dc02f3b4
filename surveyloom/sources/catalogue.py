"""Names for SQL: views, databases, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import named


def register_view(df: DataFrame, name: str) -> None:
    """Make a frame available to SQL under a name."""
    df.createOrReplaceTempView(name)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def save_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
    """Save as a catalogue table in Parquet."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save as a table dealt into buckets of a key and sorted by it within each.

    Deduplication by the key, and joins by it with a table of as many buckets, then need no shuffle. One shuffle
    before the write gives each bucket one file instead of one from every task.
    """
    writer = df.repartition(buckets, named(key)).write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def show_columns(spark: SparkSession, name: str) -> list[str]:
    """Column names of a table or view."""
    return spark.table(name).columns
