"""Vocabulary indices, embedded features, labels and training samples."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.config import WindowConfig
from weftline.functions.arrays import one_hot, one_hot_sparse, pad_right, zeros
from weftline.functions.network import gather
from weftline.functions.positional import add_vector, positional_vector
from weftline.operators.lookup import index_tokens, lookup, token_places
from weftline.operators.tokens import token_occurrences
from weftline.operators.windows import segment_windows, segments, sliding_windows
from weftline.session import BROADCAST_LIMIT_BYTES, by_key, fits_broadcast, other_columns, share, table_bytes

#: Values of feature rows that are gathered at a time.
FEATURE_CELLS = 4_000_000
#: The same where only a summary of them leaves the task.
SUMMARY_CELLS = 1 << 18


def checked_size(vector: Column, dim: int) -> Column:
    wrong = F.raise_error(F.lit(f"vector is not of length {dim}")).cast("array<float>")
    return F.when(F.size(vector) == dim, vector).otherwise(wrong)


def token_index(rows: DataFrame, vocab: DataFrame, limit: int | None = None) -> DataFrame:
    """Add token_index for the column token, -1 when it is missing."""
    found = lookup(rows, vocab.select("token", "token_index"), "token", limit)
    return found.withColumn("token_index", F.coalesce("token_index", F.lit(-1).cast("long")))


def token_vector(rows: DataFrame, vocab: DataFrame, dim: int, limit: int | None = None) -> DataFrame:
    """Add token_index and vector for the column token; a missing token gets zeros.

    The length of a vector is checked once per row of the vocabulary.
    """
    vectors = vocab.select("token", "token_index", checked_size(F.col("vector"), dim).alias("vector"))
    found = lookup(rows, vectors, "token", limit)
    return found.withColumns(
        {
            "token_index": F.coalesce("token_index", F.lit(-1).cast("long")),
            "vector": F.coalesce("vector", zeros(dim)),
        }
    )


def _regroup(found: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """One row per segment again, its arrays in token order; at most one segment per key."""
    members = F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("_members")
    grouped = found.groupBy(*keys).agg(members)
    return grouped.select(*keys, *[F.col("_members")[c].alias(c) for c in columns])


def _segment_rows(tokens: DataFrame, config: WindowConfig) -> tuple[DataFrame, list[str]]:
    """Token rows of segments, partitioned by segment before they are widened.

    Only the compact token arrays are shuffled: the broadcast lookup and the regrouping
    keep this partitioning.
    """
    parts = segments(tokens, config)
    keys = other_columns(parts, "tokens")
    return token_occurrences(by_key(parts, *keys)), keys


def pad_entry(vocab: DataFrame, config: WindowConfig) -> tuple[int, list[float]]:
    """Index and vector of the padding token; -1 and zeros when it is not in the vocabulary."""
    token = F.lit(config.pad_token).cast(vocab.schema["token"].dataType)
    row = vocab.where(F.col("token") == token).select("token_index", "vector").first()
    return (row["token_index"], list(row["vector"])) if row else (-1, [0.0] * config.embedding_dim)


def label_index(index: Column, vocab_size: int | None) -> Column:
    """Indices beyond a configured size count as missing."""
    if vocab_size is None:
        return index
    return F.when(index < vocab_size, index).otherwise(F.lit(-1).cast("long"))


def index_samples(tokens: DataFrame, vocab: DataFrame, config: WindowConfig, limit: int | None = None) -> DataFrame:
    """Keys, window_no, input_index array<int> of window_size, target_index.

    The compact form of a training sample: 4 bytes per token instead of 4 x embedding_dim. Tokens of a vocabulary
    within the broadcast bound are looked up in their arrays, without a shuffle; else they are joined by segment.
    """
    places = token_places(vocab, limit)
    if places is None:
        rows, keys = _segment_rows(tokens, config)
        found = token_index(rows, vocab, limit).withColumn("index", F.col("token_index").cast("int"))
        windows = segment_windows(_regroup(found, keys, "index"), config, "index")
        windows = windows.withColumnsRenamed({"index_input": "input", "index_target": "target"})
    else:
        windows = sliding_windows(index_tokens(tokens, places), config)
    pad = F.lit(pad_entry(vocab, config)[0]).cast("int")
    return windows.select(
        *other_columns(windows, "input", "target"),
        pad_right(F.col("input"), config.window_size, pad).alias("input_index"),
        label_index(F.col("target").cast("long"), config.vocab_size).alias("target_index"),
    )


def embed_windows(tokens: DataFrame, vocab: DataFrame, config: WindowConfig, limit: int | None = None) -> DataFrame:
    """Keys, window_no, features array<float> of window_size x embedding_dim, target_index.

    Vectors are looked up once per token of a segment and then sliced into windows. Beyond the broadcast bound indices
    are looked up first; vectors of the first indices are gathered in the tasks, the others are joined once for each
    distinct token of a segment.
    """
    rows, keys = _segment_rows(tokens, config)
    if fits_broadcast(table_bytes(vocab.select("token", "token_index", "vector")), limit):
        found = token_vector(rows, vocab, config.embedding_dim, limit)
        parts = _regroup(found, keys, "vector", "token_index")
    else:
        parts = _gathered_segments(_regroup(token_index(rows, vocab, limit), keys, "token_index"), keys, vocab, config, limit)
    windows = segment_windows(parts, config, "vector", "token_index")
    pad = F.lit(pad_entry(vocab, config)[1]).cast("array<float>")
    features = F.flatten(pad_right(F.col("vector_input"), config.window_size, pad))
    return windows.select(
        *other_columns(windows, "vector_input", "vector_target", "token_index_input", "token_index_target"),
        features.alias("features"),
        label_index(F.col("token_index_target"), config.vocab_size).alias("target_index"),
    )


def _gathered_segments(parts: DataFrame, keys: list[str], vocab: DataFrame, config: WindowConfig, limit: int | None) -> DataFrame:
    """Segments of token_index with vector, their arrays of vectors.

    Vectors of the first indices, as many as fit the broadcast bound, are gathered in the tasks: none of them is exchanged.
    Only (segment, distinct index) rows of the others meet their vectors; occurrences are filled in from the segment's own
    map, whose size is bounded by the segment.
    """
    first, whole = first_vectors(vocab, config, limit)
    n_first = len(first) - 1
    if whole:
        return _with_first_vectors(parts, keys, first, config)
    named = parts.select(*[F.col(c).alias(f"_{c}") for c in keys], F.explode(F.array_distinct("token_index")).alias("token_index"))
    vectors = vocab.select("token_index", checked_size(F.col("vector"), config.embedding_dim).alias("vector"))
    found = lookup(named.where(F.col("token_index") >= n_first), vectors.where(F.col("token_index") >= n_first), "token_index", limit)
    entries = F.map_from_entries(F.collect_list(F.struct("token_index", "vector"))).alias("_vectors")
    held = found.groupBy(*[f"_{c}" for c in keys]).agg(entries)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    joined = parts.join(held, same, "left").select(*keys, "token_index", "_vectors")
    missing = zeros(config.embedding_dim)

    def joined_vector(index: Column) -> Column:
        return F.coalesce(F.try_element_at("_vectors", index), missing)

    if not n_first:
        return joined.select(*keys, F.transform("token_index", joined_vector).alias("vector"), "token_index")
    gathered = _with_first_vectors(joined, keys, first, config)
    filled = F.transform(
        "token_index", lambda index, at: F.when(index < n_first, F.col("vector")[at]).otherwise(joined_vector(index))
    )
    return gathered.select(*keys, filled.alias("vector"), "token_index")


def first_vectors(vocab: DataFrame, config: WindowConfig, limit: int | None = None) -> tuple[np.ndarray, bool]:
    """Vectors of the first indices, as many as fit the broadcast bound, with one zero row at the end; whether these are all.

    The indices of a vocabulary of words follow the number of their occurrences, so these are the vectors asked for most.
    """
    last = vocab.agg(F.max("token_index")).first()[0]
    rows, row = 0 if last is None else last + 1, 4 * config.embedding_dim
    most = rows if fits_broadcast((rows + 1) * row, limit) else max(0, (BROADCAST_LIMIT_BYTES if limit is None else limit) // row - 1)
    vector = checked_size(F.col("vector"), config.embedding_dim).alias("vector")
    table = vocab.where(F.col("token_index") < most).select("token_index", vector).toArrow()
    index = table["token_index"].to_numpy()
    if len(np.unique(index)) < len(index):  # a key of two vectors is left to the join
        return np.zeros((1, config.embedding_dim), np.float32), False
    matrix = np.zeros((most + 1, config.embedding_dim), np.float32)
    if len(index):
        matrix[index] = table["vector"].combine_chunks().flatten().to_numpy().reshape(len(index), -1)
    return matrix, most == rows


def _with_first_vectors(parts: DataFrame, keys: list[str], first: np.ndarray, config: WindowConfig) -> DataFrame:
    """Add vector, the vectors of token_index; zeros for an index that is missing or not among the first.

    Rows leave the task in pieces of FEATURE_CELLS values.
    """
    shared, kept = share(parts.sparkSession, first), other_columns(parts, "vector")
    longest = (config.segment_windows - 1) * config.stride + config.window_size + 1
    rows = max(1, FEATURE_CELLS // (longest * config.embedding_dim))
    place = kept.index("token_index")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = shared.value
        none = len(vectors) - 1
        for part in pieces(batches, rows):
            lists = part.column(place)
            index = lists.flatten().to_numpy()
            found = float_lists(vectors[np.where((index >= 0) & (index < none), index, none)])
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            yield part.append_column("vector", pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), found))

    schema = [parts.schema[c] for c in kept] + [T.StructField("vector", T.ArrayType(T.ArrayType(T.FloatType())))]
    found = parts.select(*kept).mapInArrow(task, T.StructType(schema))
    return found.select(*keys, "vector", *other_columns(found, *keys, "vector"))


def add_positions(samples: DataFrame, config: WindowConfig) -> DataFrame:
    """Add the positional vector to the features."""
    if config.positional is None:
        return samples
    vector = positional_vector(samples.sparkSession, config.window_size, config.embedding_dim, config.positional)
    return samples.withColumn("features", add_vector(F.col("features"), vector))


def embedding_matrix(vocab: DataFrame, config: WindowConfig, limit: int | None = None) -> np.ndarray | None:
    """Vectors by index with one zero row at the end, or None beyond the broadcast bound."""
    last = vocab.agg(F.max("token_index")).first()[0]
    rows = 0 if last is None else last + 1
    if not fits_broadcast((rows + 1) * 4 * config.embedding_dim, limit):
        return None
    matrix = np.zeros((rows + 1, config.embedding_dim), np.float32)
    if rows:
        table = vocab.select("token_index", "vector").toArrow()
        vectors = table["vector"].combine_chunks().flatten().to_numpy()
        matrix[table["token_index"].to_numpy()] = vectors.reshape(-1, config.embedding_dim)
    return matrix


def share_inputs(spark: SparkSession, matrix: np.ndarray | None, config: WindowConfig):
    """The matrix within the broadcast bound and the positions, as a broadcast."""
    positions = positional_vector(spark, config.window_size, config.embedding_dim, config.positional)
    return share(spark, (matrix, np.array(positions, np.float32)))


def gatherer(shared):
    """Function from an Arrow list array of indices to feature rows with positions, by the shared inputs."""

    def features(index: pa.Array) -> np.ndarray:
        vectors, offsets = shared.value
        return gather(vectors, index.flatten().to_numpy().reshape(len(index), -1)) + offsets

    return features


def gather_features(samples: DataFrame, matrix: np.ndarray, config: WindowConfig, summary=None) -> DataFrame:
    """Replace input_index by features with positions, some rows of an Arrow batch at a time.

    With summary, a function from a matrix of feature rows to an Arrow array and its type, a column summary leaves
    the task instead of features: wide rows that are only summed up are not handed on.
    """
    to_features = gatherer(share_inputs(samples.sparkSession, matrix, config))
    kept = other_columns(samples, "input_index")
    make, kind = summary or (float_lists, "array<float>")
    name, cells = ("summary", SUMMARY_CELLS) if summary else ("features", FEATURE_CELLS)
    place, rows = len(kept), max(1, cells // config.feature_size)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, rows):
            yield part.select(kept).append_column(name, make(to_features(part.column(place))))

    schema = [samples.schema[c] for c in kept] + [*T.StructType.fromDDL(f"{name} {kind}")]
    return samples.select(*kept, "input_index").mapInArrow(task, T.StructType(schema))


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, so many at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def float_lists(rows: np.ndarray) -> pa.ListArray:
    """A list for each row of a matrix, of fewer than 2^31 cells."""
    bounds = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(rows.ravel()))


def with_classes(config: WindowConfig, vocab: DataFrame) -> WindowConfig:
    """The configuration with its number of classes: as given, or the largest index of the vocabulary plus one."""
    if config.vocab_size is not None:
        return config
    return replace(config, vocab_size=max(1, (vocab.agg(F.max("token_index")).first()[0] or 0) + 1))


def one_hot_labels(samples: DataFrame, vocab_size: int, sparse: bool = False) -> DataFrame:
    """Add label: array<float> of vocab_size cells, or a sparse vector (size, indices, values) of the same label.

    Dense labels of all samples have samples x classes cells; both grow with the corpus, so whole tables take sparse ones.
    """
    label = one_hot_sparse if sparse else one_hot
    return samples.withColumn("label", label(F.col("target_index"), vocab_size))


def training_samples(tokens: DataFrame, vocab: DataFrame, config: WindowConfig, summary=None) -> DataFrame:
    """Keys, window_no, features with positions, target_index.

    Vectors within the broadcast bound are gathered by index; others are joined. Gathered features may leave as
    a summary (see gather_features).
    """
    matrix = embedding_matrix(vocab, config)
    if matrix is None:
        return add_positions(embed_windows(tokens, vocab, config), config)
    return gather_features(index_samples(tokens, vocab, config), matrix, config, summary)
