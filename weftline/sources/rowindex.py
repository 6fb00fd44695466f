"""Dense row numbers, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.session import fits_broadcast, materialize, shuffle_partitions

_OFFSET_BYTES = 64


def _with_offsets(blocks: DataFrame, order: list[str]) -> DataFrame:
    # One row per file block or partition, never one per data row.
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return blocks.withColumn("_offset", F.sum("_rows").over(earlier) - F.col("_rows"))


def _add_index(tagged: DataFrame, offsets: DataFrame, size: int, keys: list[str], name: str) -> DataFrame:
    if fits_broadcast(size):
        offsets = F.broadcast(offsets)
    changed = F.raise_error(F.lit("the input changed while its rows were being numbered")).cast("long")
    place = F.col("_id") - F.col("_first")
    inside = (place >= 0) & (F.col("_id") <= F.col("_last"))
    index = F.when(inside, F.col("_offset") + place).otherwise(changed)
    return tagged.join(offsets, keys, "left").withColumn(name, index)


def pin_splits(spark: SparkSession) -> None:
    """Keep the least number of file splits at its value of now, where the session leaves it to Spark.

    Spark takes it from the task slots at hand, which change as executors come and go; two scans of one plan must cut alike.
    """
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, spark.sparkContext.defaultParallelism)


def _blocks_bytes(scan: DataFrame) -> int:
    """A bound of the bytes of a row for each file block, from the plan alone.

    Spark packs blocks into partitions that are half full on average at least, so a scan of f files and p partitions
    has no more than f + 2p blocks.
    """
    files = scan.inputFiles()
    longest = max((len(f.encode()) for f in files), default=0)
    return (len(files) + 2 * scan.rdd.getNumPartitions()) * (longest + _OFFSET_BYTES)


def number_file_rows(scan: DataFrame, name: str) -> DataFrame:
    """Number the rows of a file scan from 0, by file path and then by place in the file.

    Nothing is written: the plan scans the files twice, once to count the rows of each file block and once to number
    them, and both scans of a job cut and pack the files alike, whatever the settings are when it runs. A row whose
    block was not counted in the same cut fails the job instead of getting a wrong number. An empty scan has no rows.
    """
    pin_splits(scan.sparkSession)
    columns, keys = scan.columns, ["_file", "_block", "_length"]
    tagged = scan.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_block_length").alias("_length"),
        F.monotonically_increasing_id().alias("_id"),
    )
    blocks = tagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"), F.max("_id").alias("_last")
    )
    torn = F.raise_error(F.lit("the rows of a file block do not stand together")).cast("long")
    blocks = blocks.withColumn("_first", F.when(F.col("_last") - F.col("_first") + 1 == F.col("_rows"), F.col("_first")).otherwise(torn))
    offsets = _with_offsets(blocks, keys[:2]).drop("_rows")
    return _add_index(tagged, offsets, _blocks_bytes(scan), keys, name).select(name, *columns)


def number_sorted_rows(df: DataFrame, order: list, name: str) -> DataFrame:
    """Number rows from 0 in a total order: range sort, rows per partition, offsets.

    The sorted rows are written once, so both steps see the same range bounds.
    """
    columns = df.columns
    ranked = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    ranked = materialize(ranked.withColumn("_part", F.spark_partition_id()), "sorted")
    parts = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    offsets = _with_offsets(parts, ["_part"]).drop("_rows")
    most = shuffle_partitions(df.sparkSession)  # a sort makes no more partitions than this
    return _add_index(ranked, offsets, most * _OFFSET_BYTES, ["_part"], name).select(*columns, name)
