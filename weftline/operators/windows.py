"""Overlapping windows over token arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.config import WindowConfig
from weftline.functions.arrays import pad_right, up_to, window_count, window_input, window_target
from weftline.session import other_columns


def window_counts(tokens: DataFrame, config: WindowConfig) -> DataFrame:
    """Keys, n_tokens, n_windows, from the array size alone."""
    size = F.size("tokens")
    return tokens.select(
        *other_columns(tokens, "tokens"),
        size.cast("long").alias("n_tokens"),
        window_count(size, config.window_size, config.stride).alias("n_windows"),
    )


def window_total(tokens: DataFrame, config: WindowConfig) -> DataFrame:
    return window_counts(tokens, config).agg(F.coalesce(F.sum("n_windows"), F.lit(0)).alias("n_windows"))


def sliding_windows(tokens: DataFrame, config: WindowConfig) -> DataFrame:
    """Keys, window_no, input, target: up to window_size tokens and the token after them.

    A narrow plan: every row makes its own windows, so nothing is shuffled.
    """
    keys = other_columns(tokens, "tokens")
    n = window_count(F.size("tokens"), config.window_size, config.stride)
    numbered = tokens.select(*keys, "tokens", F.explode(up_to(n)).alias("window_no"))
    shape = (F.col("tokens"), F.col("window_no"), config.window_size, config.stride)
    return numbered.select(
        *keys, "window_no", window_input(*shape).alias("input"), window_target(*shape).alias("target")
    )


def pad_windows(windows: DataFrame, config: WindowConfig) -> DataFrame:
    """Fill the end of each input with the padding token up to window_size."""
    element = windows.schema["input"].dataType.elementType
    pad = F.lit(config.pad_token).cast(element)
    return windows.withColumn("input", pad_right(F.col("input"), config.window_size, pad))


def segments(tokens: DataFrame, config: WindowConfig) -> DataFrame:
    """Keys, segment, tokens: pieces of a token array that hold segment_windows windows each.

    Neighbouring segments overlap by the tokens their windows share, so windows never cross
    a segment. However long a group is, what is joined and collected back per key is bounded.
    """
    keys = other_columns(tokens, "tokens")
    n = window_count(F.size("tokens"), config.window_size, config.stride)
    n_segments = F.ceil(n / config.segment_windows)
    numbered = tokens.select(*keys, "tokens", F.explode(up_to(n_segments)).alias("segment"))
    start = (F.col("segment") * (config.segment_windows * config.stride) + 1).cast("int")
    length = (config.segment_windows - 1) * config.stride + config.window_size + 1
    return numbered.select(*keys, "segment", F.slice("tokens", start, F.lit(length)).alias("tokens"))


def segment_windows(parts: DataFrame, config: WindowConfig, *arrays: str) -> DataFrame:
    """Like sliding_windows on segments: the given arrays run parallel to the tokens.

    Gives <array>_input (not padded) and <array>_target for each array.
    """
    keys = other_columns(parts, "segment", *arrays)
    n = window_count(F.size(arrays[0]), config.window_size, config.stride)
    numbered = parts.select(*keys, "segment", *arrays, F.explode(up_to(n)).alias("_k"))
    window_no = F.col("segment") * config.segment_windows + F.col("_k")
    out = []
    for name in arrays:
        shape = (F.col(name), F.col("_k"), config.window_size, config.stride)
        out += [window_input(*shape).alias(f"{name}_input"), window_target(*shape).alias(f"{name}_target")]
    return numbered.select(*keys, window_no.alias("window_no"), *out)
