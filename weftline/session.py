"""Scratch tables, broadcast bounds and input spreading."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only when its measured size stays below this.
BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024

#: Bytes of one Arrow batch between the JVM and a Python worker where the session leaves Spark's default; both sides hold one or two.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b")

_ROW_SHARE_BYTES = 32

_shipped: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder named by spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/weftline/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that its owner is done with."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def row_bytes(table: DataFrame) -> Column:
    """Size of a row in memory: the lengths of its texts and arrays, and a share."""
    size = F.lit(_ROW_SHARE_BYTES)
    for field in table.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            size += 8 * F.coalesce(F.size(field.name), F.lit(0))
        else:
            size += 8
    return size.cast("long")


def table_bytes(table: DataFrame) -> int:
    """Measured size in memory."""
    return table.agg(F.sum(row_bytes(table))).first()[0] or 0


def fits_broadcast(size: int, limit: int | None = None) -> bool:
    return size <= (BROADCAST_LIMIT_BYTES if limit is None else limit)


def share(spark: SparkSession, value):
    """Broadcast a value of bounded size, and make this package importable in Python tasks."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="weftline-package-")) / root.name
        spark.sparkContext.addPyFile(shutil.make_archive(str(archive), "zip", root.parent, root.name))
        _shipped.add(app)
    return spark.sparkContext.broadcast(value)


def bound_batches(spark: SparkSession) -> None:
    """Hand rows of texts and token arrays to tasks in batches of bounded size: a worker's memory then follows no table."""
    if spark.conf.get(_BATCH_SETTING[0]) == _BATCH_SETTING[1]:
        spark.conf.set(_BATCH_SETTING[0], BATCH_BYTES)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Repartition a file scan that has fewer splits than the cluster has task slots.

    A scan with enough splits is returned as it is: large inputs pay no shuffle.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= slots else scan.repartition(slots, *keys)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash partitions on the keys, as many as the session is set to.

    The number is given so that small rows that are widened afterwards keep all tasks busy:
    partitions of a plain repartition would be merged by their size before the widening.
    """
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def other_columns(df: DataFrame, *names: str) -> list[str]:
    """The key columns of a frame: all but the given ones."""
    return [c for c in df.columns if c not in names]
