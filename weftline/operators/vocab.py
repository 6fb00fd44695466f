"""Vocabularies: token counts, dense indices, duplicates and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import materialize, other_columns
from weftline.sources.rowindex import number_sorted_rows


def token_counts(tokens: DataFrame) -> DataFrame:
    """token, n."""
    return tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def vocab_index(counts: DataFrame) -> DataFrame:
    """token, n, token_index: dense from 0, by falling count and then by token.

    One table serves token to index and index to token.
    """
    return number_sorted_rows(counts, [F.desc("n"), F.asc("token")], "token_index")


def last_row_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the one that comes last in the given order."""
    columns = other_columns(rows, key)
    last = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_last"))
    return last.select(key, "_last.*")


def attach_vectors(vocab: DataFrame, embeddings: DataFrame, label: str = "vocab") -> DataFrame:
    """token, token_index, vector for the indices that have a vector; written once."""
    vectors = embeddings.select(F.col("vec_id").alias("token_index"), F.col("embedding").alias("vector"))
    return materialize(vocab.join(vectors, "token_index").select("token", "token_index", "vector"), label)


def vocab_from_csv(rows: DataFrame) -> DataFrame:
    """token, token_index, vector of an embedding CSV: the index is the row number.

    Of equal tokens the last row counts, as in a map that is filled in row order.
    """
    return materialize(last_row_wins(rows.withColumnRenamed("row_no", "token_index"), "token", "token_index"), "vocab")


def vocab_by_id(vocab: DataFrame, pieces: DataFrame) -> DataFrame:
    """The vocabulary keyed by byte-pair id: each id is decoded once, not once per occurrence."""
    return pieces.join(vocab, pieces["piece"] == vocab["token"]).select(
        F.col("id").alias("token"), "token_index", "vector"
    )
