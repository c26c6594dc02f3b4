"""Tables whose content is replaced as a whole, without a moment at which readers see half of it.

A table is a view over one folder of files, a version. A new version is written to a folder of its own, and only when
it is complete does the view change over to it, in one step of the catalogue. A job that dies while it writes leaves
a folder nobody reads; the next replacement clears it away. Versions before the one just replaced go with it, so
that readers of the replaced one can finish.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder
from .files import write_parquet

_PREFIX = "version-"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def current_version(spark: SparkSession, name: str) -> str | None:
    """Folder that a table reads, or None where there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {_quoted(name)}").first()[0]
    found = re.search(rf"parquet\.`([^`]*/{_PREFIX}[^`]*)`", text)
    return found.group(1) if found else None


def _versions(spark: SparkSession, root: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    return [str(f.getPath().getName()) for f in store.listStatus(path) if f.getPath().getName().startswith(_PREFIX)]


def replace_table(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = ()) -> str:
    """Make the frame the new content of a table whose versions lie below ``root``; returns the new folder.

    The frame may read the table itself. Replacements of one table must not run side by side.
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    before = current_version(spark, name)
    folder = f"{root}/{_PREFIX}{uuid.uuid4().hex}"
    write_parquet(df, folder, list(partition_by), whole=True)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM parquet.`{folder}`")
    kept = {path.rsplit("/", 1)[1] for path in (folder, before) if path}
    for old in _versions(spark, root):
        if old not in kept:
            delete_folder(spark, f"{root}/{old}")
    return folder


def drop_table(spark: SparkSession, name: str, root: str) -> None:
    """Drop a table and all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")
    for old in _versions(spark, root.rstrip("/")):
        delete_folder(spark, f"{root.rstrip('/')}/{old}")
