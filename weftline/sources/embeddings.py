"""Embedding tables: typed CSV (token; vector as ';'-joined floats) and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.sources.rowindex import number_file_rows

# The columns of the embedding CSV, and the separator inside a vector.
CSV_COLUMNS = ["word", "embeddings", "word1", "word2", "word3", "word4"]
VECTOR_SEPARATOR = ";"

_CSV_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def parse_vector(column: str, dim: int):
    """Text to array<float>; a vector of another length fails the job."""
    vector = F.split(column, VECTOR_SEPARATOR).cast("array<float>")
    wrong = F.raise_error(F.concat(F.lit("vector length is not "), F.lit(str(dim)))).cast("array<float>")
    return F.when(F.size(vector) == dim, vector).otherwise(wrong)


def read_embedding_csv(spark: SparkSession, path: str, dim: int, extra_columns: int = 4, multi_line: bool = False) -> DataFrame:
    """row_no, token, vector in file order. Set multi_line when tokens hold line feeds.

    Only the first two columns are parsed. The schema is given, so numeric tokens stay text.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS[: 2 + extra_columns]])
    raw = (
        spark.read.schema(schema)
        .options(**_CSV_FORMAT, mode="FAILFAST", multiLine=str(multi_line).lower())
        .csv(path)
    )
    numbered = number_file_rows(raw.select("word", "embeddings"), "row_no")
    return numbered.select("row_no", F.col("word").alias("token"), parse_vector("embeddings", dim).alias("vector"))


def write_embedding_csv(table: DataFrame, path: str, order: str) -> None:
    """Write token and vector; the part files keep the given row order."""
    vector = F.array_join(F.col("vector").cast("array<string>"), VECTOR_SEPARATOR)
    rows = table.orderBy(order).select(F.col("token").alias("word"), vector.alias("embeddings"))
    rows.write.options(**_CSV_FORMAT).csv(path)
