"""Positional vectors of a window: window_size x embedding_dim values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def positional_value(j: Column, window_size: int, dim: int, mode: str) -> Column:
    """Value at flat index j.

    "standard": position j div dim, sine at even and cosine at odd places, exponent i / dim.
    "reference": values of successive positions are written at index position + i, later
    ones over earlier ones, with exponent 2i / dim; the form below is what remains.
    """
    if mode == "standard":
        position = F.floor(j / dim).cast("long")
        place = j % dim
        exponent = (place - place % 2) / dim
        inside = F.lit(True)
    elif mode == "reference":
        position = F.least(F.lit(window_size - 1).cast("long"), j)
        place = j - position
        exponent = 2 * (place - place % 2) / dim
        inside = place < dim
    else:
        raise ValueError(f"unknown positional mode: {mode}")
    angle = position / F.pow(F.lit(10000.0), exponent)
    value = F.when(place % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))
    return F.when(inside, value).otherwise(0.0).cast("float")


def positional_table(spark: SparkSession, window_size: int, dim: int, mode: str) -> DataFrame:
    """j, value."""
    return spark.range(window_size * dim).select(
        F.col("id").alias("j"), positional_value(F.col("id"), window_size, dim, mode).alias("value")
    )


_vectors: dict[tuple[int, int, str], list[float]] = {}


def positional_vector(spark: SparkSession, window_size: int, dim: int, mode: str | None) -> list[float]:
    """The table as a list, made once; its size is set by the configuration, not by the data."""
    if mode is None:
        return [0.0] * (window_size * dim)
    key = (window_size, dim, mode)
    if key not in _vectors:
        rows = positional_table(spark, window_size, dim, mode).orderBy("j").collect()
        _vectors[key] = [row["value"] for row in rows]
    return list(_vectors[key])


def add_vector(features: Column, vector: list[float]) -> Column:
    """Element-wise float sum with a constant vector."""
    return F.zip_with(features, F.lit(vector).cast("array<float>"), lambda x, y: x + y)
