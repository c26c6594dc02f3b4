"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster run wants: adaptive execution merges small shuffle partitions and splits
# skewed join partitions, also where that costs another shuffle.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


SHUFFLE_PARTITION_BYTES = 128 << 20


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions that keep a shuffle of this size at about 128 MB each; adaptive execution merges them for less."""
    return max(200, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app: str = "surveyloom", master: str | None = None, shuffle_bytes: int = 0, **conf: str
) -> SparkSession:
    """Session with ``CLUSTER_CONF``; keyword arguments use ``__`` for the dots of a setting.

    ``shuffle_bytes`` is the largest shuffle expected, and sets the number of its partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(CLUSTER_CONF)
    if shuffle_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset the warehouse folder serves, which all executors share as well.
    """
    return f"{_shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_folders(df: DataFrame, labels: tuple[str, ...]) -> list[str]:
    """Scratch folders with one of the labels that a frame reads from."""
    pattern = re.compile(rf"(?:.*/)?(?:{'|'.join(map(re.escape, labels))})-[0-9a-f]{{32}}(?=/)")
    found = (pattern.match(unquote(file)) for file in df.inputFiles())
    return sorted({match.group(0) for match in found if match})


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
