"""Text corpora: document tables and text files, as lines and line groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import other_columns, spread
from weftline.sources.rowindex import number_file_rows


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, text; only these two columns are read."""
    return spread(read_table(spark, folder, "documents", "doc_id", "text"), "doc_id")


def document_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """Keys, line_no (dense from 0 in each document), line."""
    lines = F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    numbered = documents.select(*other_columns(documents, text), lines)
    return numbered.withColumn("line_no", F.col("line_no").cast("long"))


def document_groups(documents: DataFrame, lines_per_group: int, text: str = "text") -> DataFrame:
    """Keys, group_id, text: every n lines of a document joined with a line feed.

    A document is one row, so its groups are slices of its line array and need no shuffle.
    """
    keys = other_columns(documents, text)
    lines = documents.select(*keys, F.split(text, "\n").alias("_lines"))
    last = F.floor((F.size("_lines") - 1) / lines_per_group).cast("int")
    groups = lines.select(*keys, "_lines", F.explode(F.sequence(F.lit(0), last)).alias("_g"))
    members = F.slice("_lines", F.col("_g") * lines_per_group + 1, F.lit(lines_per_group))
    return groups.select(*keys, F.col("_g").cast("long").alias("group_id"), F.array_join(members, "\n").alias("text"))


def text_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no, line: lines of text files, numbered over all files in path order."""
    return number_file_rows(spark.read.text(path).withColumnRenamed("value", "line"), "line_no")


def group_lines(lines: DataFrame, lines_per_group: int) -> DataFrame:
    """Keys, group_id, text for numbered lines that may lie in different partitions.

    At most `lines_per_group` lines meet in one group, and neighbours are combined
    before the shuffle.
    """
    keys = other_columns(lines, "line_no", "line")
    group = F.floor(F.col("line_no") / lines_per_group).cast("long").alias("group_id")
    grouped = lines.groupBy(*keys, group).agg(F.collect_list(F.struct("line_no", "line")).alias("_members"))
    return grouped.select(*keys, "group_id", F.array_join(F.sort_array("_members")["line"], "\n").alias("text"))
