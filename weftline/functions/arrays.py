"""Array columns built from code-generated functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: str) -> Column:
    """Split on the space only (a line feed stays inside a word); empty words are dropped."""
    return F.array_remove(F.split(text, " "), "")


def up_to(n: Column) -> Column:
    """0, 1, .. n - 1; null, which explodes to no rows, when n is 0."""
    return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))


def window_count(n: Column, window_size: int, stride: int) -> Column:
    """Overlapping windows of window_size + 1 tokens over n tokens, the last one perhaps short."""
    reach = max(window_size + 1, stride)
    further = F.floor((n - reach + stride - 1) / stride)
    return F.when(n > 0, F.greatest(further, F.lit(0)) + 1).otherwise(0).cast("long")


def window_input(tokens: Column, k: Column, window_size: int, stride: int) -> Column:
    start = (k * stride).cast("int")
    return F.slice(tokens, start + 1, F.least(F.lit(window_size), F.size(tokens) - start - 1))


def window_target(tokens: Column, k: Column, window_size: int, stride: int) -> Column:
    return F.element_at(tokens, F.least((k * stride + window_size + 1).cast("int"), F.size(tokens)))


def pad_right(values: Column, size: int, pad: Column) -> Column:
    return F.concat(values, F.array_repeat(pad, size - F.size(values)))


def one_hot(index: Column, size: int) -> Column:
    """All zeros for an index outside 0 .. size - 1."""
    zero, one = F.lit(0.0).cast("float"), F.lit(1.0).cast("float")
    place = index.cast("int")
    hot = F.concat(F.array_repeat(zero, place), F.array(one), F.array_repeat(zero, size - 1 - place))
    return F.when((index >= 0) & (index < size), hot).otherwise(F.array_repeat(zero, size))


def one_hot_sparse(index: Column, size: int) -> Column:
    """The same label as its size and the places and values of its cells that are not zero."""
    known = (index >= 0) & (index < size)
    indices = F.when(known, F.array(index.cast("int"))).otherwise(F.array().cast("array<int>"))
    values = F.when(known, F.array(F.lit(1.0).cast("float"))).otherwise(F.array().cast("array<float>"))
    return F.struct(F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))


def argmax(scores: Column) -> Column:
    """0-based place of the first maximum."""
    return F.array_position(scores, F.array_max(scores)) - 1


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)
