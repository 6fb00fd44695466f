"""Corpus to samples, vocabulary, training and prediction, put together."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import TrainConfig, WindowConfig
from weftline.functions.bpe import BpeVocabulary
from weftline.operators.features import add_positions, embed_windows, embedding_matrix, index_samples
from weftline.operators.scoring import (
    classify,
    decode_predictions,
    index_windows,
    query_windows,
)
from weftline.operators.split import hash_split
from weftline.operators.tokens import bpe_tokens, word_tokens
from weftline.operators.exchange import StoredState, can_share
from weftline.operators.training import Model, TrainedModel, load_state, train
from weftline.operators.vocab import attach_vectors, token_counts, vocab_by_id, vocab_from_csv, vocab_index
from weftline.operators.windows import window_total
from weftline.session import discard, materialize, scratch_path
from weftline.sources.corpus import document_groups, group_lines, read_documents, read_table, text_file_lines
from weftline.sources.embeddings import read_embedding_csv


def document_words(spark: SparkSession, folder: str, config: WindowConfig) -> DataFrame:
    """doc_id, group_id, tokens."""
    return word_tokens(document_groups(read_documents(spark, folder), config.lines_per_group))


def word_vocab(spark: SparkSession, folder: str, config: WindowConfig) -> DataFrame:
    """token, token_index, vector: the words of the documents by frequency, and the embeddings by vec_id."""
    index = vocab_index(token_counts(document_words(spark, folder, config)))
    return attach_vectors(index, read_table(spark, folder, "embeddings", "vec_id", "embedding"))


def query_texts(spark: SparkSession, folder: str) -> DataFrame:
    """query_id, text: the benchmark items and all turns."""
    items = read_table(spark, folder, "benchmark", "item_id", "text")
    turns = read_table(spark, folder, "conversations", "conv_id", "turn", "text")
    return items.select(F.concat(F.lit("item-"), "item_id").alias("query_id"), "text").unionByName(
        turns.select(F.concat(F.lit("turn-"), "conv_id", F.lit("-"), "turn").alias("query_id"), "text")
    )


def model_samples(
    tokens: DataFrame, vocab: DataFrame, config: WindowConfig, limit: int | None = None
) -> DataFrame:
    """Samples as indices while the vectors fit the broadcast bound, else with features."""
    if embedding_matrix(vocab, config, limit) is not None:
        return index_samples(tokens, vocab, config)
    return add_positions(embed_windows(tokens, vocab, config, limit), config)


def fit(
    tokens: DataFrame,
    vocab: DataFrame,
    window: WindowConfig,
    config: TrainConfig,
    keys: tuple[str, ...],
    model_path: str | None = None,
    limit: int | None = None,
    resume: str | None = None,
) -> TrainedModel:
    """Samples, split, training with a test accuracy per epoch, saved model; `resume` is the folder of a saved epoch.

    Only samples with a label are stored: the filter runs before the inputs are sliced.
    """
    spark = tokens.sparkSession
    n_windows = window_total(tokens, window).first()["n_windows"]
    samples = model_samples(tokens, vocab, window, limit)
    path = scratch_path(spark, "samples")
    samples.where(F.col("target_index") >= 0).write.parquet(path)
    fitted, test = hash_split(spark.read.schema(samples.schema).parquet(path), *keys)
    state = None
    if resume:
        state = StoredState(resume) if can_share(spark, resume) else load_state(spark, resume)
    model = train(fitted, vocab, window, config, test, keys, model_path, n_windows, state)
    discard(spark, path)
    return model


def predict(
    queries: DataFrame, vocab: DataFrame, names: DataFrame, model: Model, config: WindowConfig
) -> DataFrame:
    """Keys, prediction, token for rows with tokens.

    The vocabulary is keyed as the tokens are; names gives the text of an index.
    """
    windows = query_windows(queries, config)
    if model.matrix is None:
        # One window of window_size tokens and any target has the query as its input.
        target = F.array(F.lit(config.pad_token).cast(windows.schema["input"].dataType.elementType))
        tokens = windows.withColumn("tokens", F.concat("input", target)).drop("input")
        samples = add_positions(embed_windows(tokens, vocab, replace(config, stride=config.window_size + 1)), config)
        samples = samples.drop("window_no", "target_index")
    else:
        samples = index_windows(windows, vocab)
    predicted = classify(samples, None, config, model.matrix, weights=model.weights(queries.sparkSession))
    return decode_predictions(predicted.drop("features", "input_index"), names)


def train_on_files(
    spark: SparkSession,
    text_path: str,
    embedding_path: str,
    bpe: BpeVocabulary,
    window: WindowConfig,
    config: TrainConfig,
    model_path: str | None = None,
    resume: str | None = None,
) -> tuple[TrainedModel, DataFrame, DataFrame]:
    """Text files and an embedding CSV to a trained model over byte-pair ids.

    Returns the model, the vocabulary keyed by id, and the vocabulary keyed by text.
    """
    names = vocab_from_csv(read_embedding_csv(spark, embedding_path, window.embedding_dim))
    vocab = materialize(vocab_by_id(names, bpe.table(spark)), "vocab-by-id")
    groups = group_lines(text_file_lines(spark, text_path), window.lines_per_group)
    tokens = bpe_tokens(groups, bpe)
    return fit(tokens, vocab, window, config, ("group_id", "window_no"), model_path, resume=resume), vocab, names
