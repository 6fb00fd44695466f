"""Batch prediction: query windows, forward pass, argmax, index to token."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.config import MISSING_TOKEN, WindowConfig
from weftline.functions.arrays import argmax, pad_right
from weftline.functions.network import BLOCK, best_class, best_rounded, forward
from weftline.operators.features import checked_size, float_lists, gatherer, pieces, share_inputs, token_index, with_classes
from weftline.operators.lookup import index_tokens, lookup, token_places
from weftline.operators.tokens import token_occurrences
from weftline.session import by_key, other_columns, share


#: Classes that are scored at a time.
CLASS_TILE = 8192
#: The same where scores are rounded: fewer, so that more rows go through all classes together.
ROUNDED_TILE = 1024
#: Cells of a score matrix that is held at once.
_SCORE_CELLS = 4_000_000


def query_windows(tokens: DataFrame, config: WindowConfig) -> DataFrame:
    """Keys, input: the first window_size tokens, padded at the end."""
    pad = F.lit(config.pad_token).cast(tokens.schema["tokens"].dataType.elementType)
    first = F.slice("tokens", 1, config.window_size)
    return tokens.select(*other_columns(tokens, "tokens"), pad_right(first, config.window_size, pad).alias("input"))


def index_windows(windows: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """Keys, input_index: the input tokens as vocabulary indices, -1 when missing."""
    keys = other_columns(windows, "input")
    places = token_places(vocab, limit)
    if places is not None:
        found = index_tokens(windows.withColumnRenamed("input", "tokens"), places)
        return found.select(*keys, F.col("tokens").alias("input_index"))
    rows = token_occurrences(by_key(windows, *keys).withColumnRenamed("input", "tokens"))
    found = token_index(rows, vocab, limit)
    members = F.sort_array(F.collect_list(F.struct("pos", F.col("token_index").cast("int").alias("index"))))
    return found.groupBy(*keys).agg(members["index"].alias("input_index"))


def _model_input(samples: DataFrame, config: WindowConfig, matrix: np.ndarray | None, inputs=None):
    """The column that a model reads, and the function that makes feature rows of it.

    Samples carry either features, or input_index, whose vectors are gathered from the
    broadcast matrix.
    """
    if matrix is None:
        return "features", _dense
    return "input_index", gatherer(inputs or share_inputs(samples.sparkSession, matrix, config))


def score(
    samples: DataFrame, parameters: dict[str, np.ndarray], config: WindowConfig, matrix: np.ndarray | None = None
) -> DataFrame:
    """Add scores array<double>: the forward pass over Arrow batches.

    Rows leave in pieces of _SCORE_CELLS scores or feature values, so many classes need no more memory at once.
    """
    column, to_features = _model_input(samples, config, matrix)
    shared = share(samples.sparkSession, parameters)

    place, cells = samples.columns.index(column), _SCORE_CELLS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widest = max(config.feature_size, *(max(value.shape) for value in shared.value.values()))
        for part in pieces(batches, max(1, cells // widest)):
            out = forward(shared.value, to_features(part.column(place)).astype(np.float64))
            yield part.append_column("scores", float_lists(out))

    return samples.mapInArrow(task, T.StructType([*samples.schema, T.StructField("scores", T.ArrayType(T.DoubleType()))]))


def classify(
    samples: DataFrame,
    parameters: dict[str, np.ndarray] | None,
    config: WindowConfig,
    matrix: np.ndarray | None = None,
    digits: int | None = None,
    inputs=None,
    weights=None,
) -> DataFrame:
    """Add prediction, the first maximum of the scores, without handing the scores back.

    With digits, scores that agree to that many places count as equal.

    A batch is scored in pieces of rows and in tiles of classes, so that many classes or wide features fit in memory; only
    rounded shares of a network with a hidden layer take all scores of a row. A caller that scores again and
    again passes its broadcasts: inputs (share_inputs) and weights (the parameters, or a state that tasks read themselves).
    """
    column, to_features = _model_input(samples, config, matrix, inputs)
    shared = weights or share(samples.sparkSession, parameters)
    cells = _SCORE_CELLS

    @F.arrow_udf("long")
    def best(values: pa.Array) -> pa.Array:
        out = [np.empty(0, np.int64)]
        features, classes = config.feature_size, max(b.shape[0] for n, b in shared.value.items() if n[0] == "b")
        whole = digits is not None and "w1" in shared.value  # shares are rounded, which takes all scores of a row
        tile = classes if whole else min(classes, CLASS_TILE if digits is None else ROUNDED_TILE)
        rows = max(1, cells // max(features, tile, classes // BLOCK))
        for start in range(0, len(values), rows):
            part = to_features(values.slice(start, rows)).astype(np.float64)
            if digits is None:
                out.append(best_class(shared.value, part, tile))
            elif not whole:
                out.append(best_rounded(shared.value, part, digits, tile))
            else:
                out.append(forward(shared.value, part).round(digits).argmax(axis=1))
        return pa.array(np.concatenate(out))

    return samples.withColumn("prediction", best(column))


def _dense(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy().reshape(len(values), -1)


def predict_index(scored: DataFrame, digits: int | None = None) -> DataFrame:
    """Add prediction, the 0-based place of the first maximum of the scores.

    With digits, scores that agree to that many places count as equal.
    """
    scores = F.col("scores")
    if digits is not None:
        scores = F.transform(scores, lambda x: F.round(x, digits))
    return scored.withColumn("prediction", argmax(scores).cast("long"))


def decode_predictions(predictions: DataFrame, vocab: DataFrame, index: str = "prediction") -> DataFrame:
    """Add token for a predicted index; an index outside the vocabulary gives NULL as text."""
    names = vocab.select(F.col("token_index").alias(index), "token")
    found = lookup(predictions, names, index)
    return found.withColumn("token", F.coalesce(F.col("token").cast("string"), F.lit(MISSING_TOKEN)))


def linear_parameters(spark: SparkSession, vocab: DataFrame, config: WindowConfig) -> dict[str, np.ndarray]:
    """One linear layer that scores a class by its vector, the same at every position.

    Its weights are those of one position (see over_positions), in the precision of the vectors:
    embedding_dim x vocab_size, as configured or as the vocabulary has.
    """
    config = with_classes(config, vocab)
    weights = np.zeros((config.embedding_dim, config.vocab_size), np.float32)
    vector = checked_size(F.col("vector"), config.embedding_dim).alias("vector")
    table = vocab.where(F.col("token_index") < config.vocab_size).select("token_index", vector).toArrow()
    if table.num_rows:
        vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        weights[:, table["token_index"].to_numpy()] = vectors.T
    return {"w0": weights, "b0": np.zeros(config.vocab_size)}
