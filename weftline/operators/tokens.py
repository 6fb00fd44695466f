"""Token arrays: words, byte-pair ids, and their text forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.arrays import words
from weftline.functions.bpe import BpeVocabulary
from weftline.session import other_columns


def word_tokens(groups: DataFrame, text: str = "text") -> DataFrame:
    """Keys, tokens array<string>."""
    return groups.select(*other_columns(groups, text), words(text).alias("tokens"))


def bpe_tokens(groups: DataFrame, bpe: BpeVocabulary, text: str = "text") -> DataFrame:
    """Keys, tokens array<int>: byte-pair ids of each word in turn, without a leading space."""
    encode = bpe.encoder(groups.sparkSession)
    return groups.select(*other_columns(groups, text), encode(words(text)).alias("tokens"))


def tokens_to_string(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("tokens", F.array_join(F.col("tokens").cast("array<string>"), " "))


def string_to_tokens(strings: DataFrame, element: str = "string") -> DataFrame:
    return strings.withColumn("tokens", words("tokens").cast(f"array<{element}>"))


def token_occurrences(tokens: DataFrame) -> DataFrame:
    """Keys, pos, token: one row per token.

    The outer form with a filter after it: for the plain form the optimizer adds a test of
    the array size below, where the array would be computed a second time.
    """
    rows = tokens.select(*other_columns(tokens, "tokens"), F.posexplode_outer("tokens").alias("pos", "token"))
    return rows.where(F.col("pos").isNotNull())


def decode_bpe(tokens: DataFrame, bpe: BpeVocabulary) -> DataFrame:
    """Keys, text: the bytes of all ids of a row in order, as UTF-8."""
    decode = bpe.decoder(tokens.sparkSession)
    return tokens.select(*other_columns(tokens, "tokens"), decode("tokens").alias("text"))
