"""The registered queries: each takes (spark, folder) and runs over whole tables."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import TrainConfig, WindowConfig
from weftline.functions.bpe import BpeVocabulary
from weftline.functions.digest import SCHEMA as DIGEST
from weftline.functions.digest import digest_lists, digest_matrix
from weftline.operators import evaluation
from weftline.operators.averaging import CHUNK, average_chunks, parameter_rows
from weftline.operators.features import (
    add_positions,
    embed_windows,
    embedding_matrix,
    index_samples,
    one_hot_labels,
    token_vector,
    training_samples,
    with_classes,
)
from weftline.operators.scoring import (
    classify,
    decode_predictions,
    index_windows,
    linear_parameters,
    query_windows,
    score,
)
from weftline.operators.split import hash_split, in_train, random_split
from weftline.operators.tokens import (
    bpe_tokens,
    decode_bpe,
    string_to_tokens,
    token_occurrences,
    tokens_to_string,
    word_tokens,
)
from weftline.operators.training import LOSS, Model, mean_gradient, read_model
from weftline.operators.vocab import (
    attach_vectors,
    last_row_wins,
    token_counts,
    vocab_by_id,
    vocab_from_csv,
    vocab_index,
)
from weftline.operators.windows import pad_windows, sliding_windows, window_counts, window_total
from weftline.plans.pipelines import document_words, fit, predict, query_texts, word_vocab
from weftline.session import by_key, materialize, scratch_path, share
from weftline.sources.corpus import (
    document_groups,
    document_lines,
    group_lines,
    read_documents,
    read_table,
    text_file_lines,
)
from weftline.sources.embeddings import read_embedding_csv, write_embedding_csv

#: The given vectors have 64 values; all else is the default.
CONFIG = WindowConfig(embedding_dim=64)
#: Every word of the vocabulary counts as a class.
ALL_CLASSES = CONFIG
NO_POSITIONS = replace(CONFIG, positional=None)
#: Byte-pair ids are numbers, so the padding is one too.
BPE_CONFIG = replace(CONFIG, pad_token="0")
#: The published setting of the original program.
TRAINING = TrainConfig(workers=32, batch_size=10, averaging_frequency=10, epochs=20, hidden_size=20)
#: Hidden units of the network that is given by a formula.
FORMULA_HIDDEN = 4
#: Scores are compared to this many places.
DIGITS = 6
#: Cells of a gradient are small.
GRADIENT_DIGITS = 8
KEYS = ("doc_id", "group_id", "window_no")


def _joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def _words(spark, folder):
    return document_words(spark, folder, CONFIG)


def _digest(samples: DataFrame, *columns: str) -> DataFrame:
    """Three whole numbers that depend on every value and place of the feature vector.

    They are summed over the array where it is, some rows of an Arrow batch at a time: no row is widened and nothing is
    shuffled. Sums of millionths are exact.
    """

    @F.arrow_udf(DIGEST)
    def digested(features: pa.Array) -> pa.Array:
        return digest_lists(features)

    share(samples.sparkSession, None)
    return samples.select(*columns, digested("features").alias("digest")).select(*columns, "digest.*")


def _digested_samples(spark, folder, config, *columns: str) -> DataFrame:
    """The digest of all training samples, taken in the task that gathers their features while the vectors are gathered."""
    vocab = word_vocab(spark, folder, config)
    rows = training_samples(_words(spark, folder), vocab, config, summary=(digest_matrix, DIGEST))
    if "features" in rows.columns:
        return _digest(rows, *columns)
    return rows.select(*columns, "summary.*")


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    return document_lines(read_documents(spark, folder))


def _write_text_files(spark, folder) -> str:
    """The documents as text files whose path order is the order of doc_id."""
    path = scratch_path(spark, "text")
    read_table(spark, folder, "documents", "doc_id", "text").orderBy("doc_id").select("text").write.text(path)
    return path


def text_file_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return text_file_lines(spark, _write_text_files(spark, folder))


def text_file_groups(spark: SparkSession, folder: str) -> DataFrame:
    lines = text_file_lines(spark, _write_text_files(spark, folder))
    return group_lines(lines, CONFIG.lines_per_group)


def line_groups(spark: SparkSession, folder: str) -> DataFrame:
    return document_groups(read_documents(spark, folder), CONFIG.lines_per_group)


def word_token_rows(spark: SparkSession, folder: str) -> DataFrame:
    return token_occurrences(_words(spark, folder))


def token_strings(spark: SparkSession, folder: str) -> DataFrame:
    strings = tokens_to_string(_words(spark, folder))
    restored = string_to_tokens(strings.withColumn("token_string", F.col("tokens")))
    return restored.select("doc_id", "group_id", "token_string", F.size("tokens").alias("n_tokens"))


def bpe_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe_tokens(line_groups(spark, folder), BpeVocabulary.installed())
    return tokens.select("doc_id", "group_id", F.size("tokens").alias("n_tokens"), _joined("tokens"))


def bpe_piece_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of the pieces of each group's ids; the piece table has the fixed size of the rank file."""
    bpe = BpeVocabulary.installed()
    ids = bpe_tokens(line_groups(spark, folder), bpe).select("doc_id", "group_id", F.explode_outer("tokens").alias("id"))
    sized = ids.join(F.broadcast(bpe.sizes(spark)), "id", "left")
    total = F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("long")
    return sized.groupBy("doc_id", "group_id").agg(total.alias("n_bytes"))


def bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    bpe = BpeVocabulary.installed()
    return decode_bpe(bpe_tokens(line_groups(spark, folder), bpe), bpe)


def bpe_windows(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe_tokens(line_groups(spark, folder), BpeVocabulary.installed())
    windows = pad_windows(sliding_windows(tokens, BPE_CONFIG), BPE_CONFIG)
    return windows.select(*KEYS, _joined("input"), "target")


def bpe_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Windows over byte-pair ids with the indices of their pieces in the word vocabulary."""
    bpe = BpeVocabulary.installed()
    tokens = bpe_tokens(line_groups(spark, folder), bpe)
    vocab = vocab_by_id(word_vocab(spark, folder, CONFIG), bpe.table(spark))
    samples = index_samples(tokens, materialize(vocab, "vocab-by-id"), BPE_CONFIG)
    return samples.select(*KEYS, _joined("input_index"), "target_index")


def bpe_windows_text(spark: SparkSession, folder: str) -> DataFrame:
    """The text of each group, put together again from its byte-pair windows.

    A window that isn't the last adds its first `stride` ids, so what is collected for a group is its own id array. Groups
    are dealt by key before they are sliced: ids are shuffled once, and not the windows.
    """
    bpe = BpeVocabulary.installed()
    tokens = by_key(bpe_tokens(line_groups(spark, folder), bpe), "doc_id", "group_id")
    rows = sliding_windows(tokens, BPE_CONFIG)
    start = F.struct("window_no", F.slice("input", 1, BPE_CONFIG.stride).alias("ids"))
    whole = F.concat("input", F.array("target"))
    groups = rows.groupBy("doc_id", "group_id").agg(
        F.sort_array(F.collect_list(start))["ids"].alias("starts"), F.max_by(whole, "window_no").alias("last")
    )
    before = F.flatten(F.slice("starts", F.lit(1), F.size("starts") - 1))
    return decode_bpe(groups.select("doc_id", "group_id", F.concat(before, "last").alias("tokens")), bpe)


def windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = sliding_windows(_words(spark, folder), CONFIG)
    return rows.select(*KEYS, F.size("input").alias("n_input"), _joined("input"), "target")


def padded_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = pad_windows(sliding_windows(_words(spark, folder), CONFIG), CONFIG)
    return rows.select(*KEYS, F.size("input").alias("n_input"), _joined("input"), "target")


def group_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    return window_counts(_words(spark, folder), CONFIG)


def all_windows(spark: SparkSession, folder: str) -> DataFrame:
    return window_total(_words(spark, folder), CONFIG)


def word_index(spark: SparkSession, folder: str) -> DataFrame:
    return vocab_index(token_counts(_words(spark, folder)))


def vocab_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors of one label are rows with an equal token; the last vec_id wins."""
    rows = read_table(spark, folder, "embeddings", "label", "vec_id", "embedding")
    last = last_row_wins(rows, "label", "vec_id")
    return _digest(last.withColumnRenamed("embedding", "features"), "label", "vec_id")


def embeddings_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_embedding_csv(word_vocab(spark, folder, CONFIG), path, "token_index")
    rows = read_embedding_csv(spark, path, CONFIG.embedding_dim, extra_columns=0, multi_line=True)
    return _digest(vocab_from_csv(rows).withColumnRenamed("vector", "features"), "token", "token_index")


def embedding_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = word_token_rows(spark, folder)
    found = token_vector(rows, word_vocab(spark, folder, CONFIG), CONFIG.embedding_dim)
    return _digest(found.withColumnRenamed("vector", "features"), "doc_id", "group_id", "pos", "token_index")


def target_index(spark: SparkSession, folder: str) -> DataFrame:
    samples = index_samples(_words(spark, folder), word_vocab(spark, folder, CONFIG), ALL_CLASSES)
    return samples.select(*KEYS, _joined("input_index"), "target_index")


def embedded_features(spark: SparkSession, folder: str) -> DataFrame:
    samples = embed_windows(_words(spark, folder), word_vocab(spark, folder, CONFIG), CONFIG)
    return _digest(samples, *KEYS)


def _positional(mode: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        config = replace(CONFIG, positional=mode)
        return _digested_samples(spark, folder, config, *KEYS)

    return query


def positional_features(spark: SparkSession, folder: str) -> DataFrame:
    """Positions added to joined vectors, not gathered ones."""
    samples = embed_windows(_words(spark, folder), word_vocab(spark, folder, CONFIG), CONFIG)
    return _digest(add_positions(samples, CONFIG), *KEYS)


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Each label by its length, its number of ones, and the place of the first one (0: none)."""
    vocab = word_vocab(spark, folder, CONFIG)
    config = with_classes(CONFIG, vocab)
    labels = one_hot_labels(index_samples(_words(spark, folder), vocab, config), config.vocab_size, sparse=True)
    values = F.col("label.values").cast("array<int>")
    ones = F.aggregate(values, F.lit(0), lambda total, x: total + x)
    first = F.try_element_at("label.indices", F.array_position(values, 1).cast("int")) + 1
    place = F.when(ones > 0, first).otherwise(0).cast("long")
    return labels.select(*KEYS, F.col("label.size").alias("n_classes"), ones.alias("n_ones"), place.alias("place"))


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return _digested_samples(spark, folder, CONFIG, *KEYS, "target_index")


def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Sample count, and the shapes of the first sample; no sample but the first is built."""
    words = _words(spark, folder)
    vocab = word_vocab(spark, folder, CONFIG)
    total = window_total(words, CONFIG).scalar()
    first = words.where(F.size("tokens") > 0).orderBy("doc_id", "group_id").limit(1)
    head = training_samples(first, vocab, CONFIG).where(F.col("window_no") == 0)
    labelled = one_hot_labels(head, with_classes(CONFIG, vocab).vocab_size)
    return _digest(labelled.withColumn("n_classes", F.size("label")), *KEYS, "n_classes").withColumn("n_samples", total)


def split_hash(spark: SparkSession, folder: str) -> DataFrame:
    rows = sliding_windows(_words(spark, folder), CONFIG)
    return rows.select(*KEYS, F.when(in_train(*KEYS), "train").otherwise("test").alias("split"))


def split_random(spark: SparkSession, folder: str) -> DataFrame:
    rows = sliding_windows(_words(spark, folder), CONFIG).select(*KEYS)
    train, test = random_split(rows)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def split_random_sides(spark: SparkSession, folder: str) -> DataFrame:
    """The number of sides that each window is on."""
    return split_random(spark, folder).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_sides"))


def _query_windows(spark, folder):
    return query_windows(word_tokens(query_texts(spark, folder)), CONFIG)


def padded_queries(spark: SparkSession, folder: str) -> DataFrame:
    return _query_windows(spark, folder).select("query_id", _joined("input"))


def _scored_queries(spark, folder) -> tuple[DataFrame, DataFrame]:
    vocab = word_vocab(spark, folder, CONFIG)
    rows = index_windows(_query_windows(spark, folder), vocab)
    linear = linear_parameters(spark, vocab, CONFIG)
    return score(rows, linear, NO_POSITIONS, embedding_matrix(vocab, CONFIG)), vocab


def score_linear(spark: SparkSession, folder: str) -> DataFrame:
    scored, _ = _scored_queries(spark, folder)
    rows = scored.select("query_id", F.posexplode("scores").alias("class", "score"))
    return rows.withColumn("score", F.round("score", DIGITS))


def _predicted_queries(spark, folder) -> tuple[DataFrame, DataFrame]:
    vocab = word_vocab(spark, folder, CONFIG)
    rows = index_windows(_query_windows(spark, folder), vocab)
    linear = linear_parameters(spark, vocab, CONFIG)
    predicted = classify(rows, linear, NO_POSITIONS, embedding_matrix(vocab, CONFIG), DIGITS)
    return predicted.select("query_id", "prediction"), vocab


def argmax_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _predicted_queries(spark, folder)[0]


def decoded_predictions(spark: SparkSession, folder: str) -> DataFrame:
    predicted, vocab = _predicted_queries(spark, folder)
    return decode_predictions(predicted, vocab)


def _test_windows(spark, folder) -> tuple[DataFrame, DataFrame]:
    vocab = word_vocab(spark, folder, CONFIG)
    _, test = hash_split(index_samples(_words(spark, folder), vocab, CONFIG), *KEYS)
    return test, vocab


def _evaluated(spark, test: DataFrame, vocab: DataFrame) -> DataFrame:
    """label, prediction: the linear scores of all test windows with a known target."""
    test = test.where(F.col("target_index") >= 0)
    linear = linear_parameters(spark, vocab, CONFIG)
    predicted = classify(test, linear, NO_POSITIONS, embedding_matrix(vocab, CONFIG), DIGITS)
    return predicted.select(F.col("target_index").alias("label"), "prediction")


def eval_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """With the number of test windows that have no label and are left out."""
    test, vocab = _test_windows(spark, folder)
    left_out = test.where(F.col("target_index") < 0).agg(F.count(F.lit(1))).scalar()
    return evaluation.accuracy(_evaluated(spark, test, vocab)).withColumn("n_without_label", left_out)


def eval_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion(_evaluated(spark, *_test_windows(spark, folder)))


def eval_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.class_counts(_evaluated(spark, *_test_windows(spark, folder)))


def eval_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Class counts of the given labels, one read as the prediction of the other."""
    pairs = read_table(spark, folder, "labels", "quality", "toxic")
    return evaluation.class_counts(pairs.toDF("label", "prediction"))


def param_average(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors as the weights of one worker each, averaged per label."""
    vectors = read_table(spark, folder, "embeddings", "label", "vec_id", "embedding")
    rows = vectors.select(
        F.col("vec_id").alias("part"), F.col("label").cast("string").alias("name"), F.lit(0).alias("chunk"),
        F.col("embedding").cast("array<double>").alias("cells"), (F.col("vec_id") % 7 + 1).alias("n"),
    )
    parts = vectors.agg(F.max("vec_id")).first()[0] or 0
    cells = average_chunks(rows, parts + 1, fan_in=64).select(
        F.col("name").cast(vectors.schema["label"].dataType).alias("layer"), F.lit("weight").alias("kind"),
        F.lit(0).alias("i"), F.posexplode("cells").alias("j", "value"),
    )
    return cells.withColumn("value", F.round("value", DIGITS))


_models: dict[tuple[str, str], tuple] = {}


def _trained(spark, folder):
    """The model of a folder and its vocabulary, trained once in a session: its tables are written ones."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _models:
        vocab = word_vocab(spark, folder, CONFIG)
        _models.clear()
        _models[key] = fit(_words(spark, folder), vocab, CONFIG, TRAINING, KEYS), vocab
    return _models[key]


def train_param_avg(spark: SparkSession, folder: str) -> DataFrame:
    """What each epoch went over."""
    epochs = _trained(spark, folder)[0].epochs
    return epochs.select("epoch", "learning_rate", "n_rounds", "n_samples", "n_test", "n_without_label")


def training_epochs(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder)[0].epochs


def training_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The batches of all workers, and whether their loss and gradient norm are positive numbers."""
    metrics = _trained(spark, folder)[0].metrics
    sound = F.col("loss").between(0, 1e6) & F.col("grad_norm").between(0, 1e6)
    return metrics.select("epoch", "round", "worker", "iteration", "n", sound.alias("is_sound"))


def training_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder)[0].metrics


def training_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Test samples of each label in the confusion table of each epoch."""
    cells = _trained(spark, folder)[0].confusions
    return cells.groupBy("epoch", "label").agg(F.sum("n").alias("n"))


def model_params(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the saved model and its moments, by layer and kind."""
    model, _ = _trained(spark, folder)
    cells = parameter_rows(read_model(spark, model.last_epoch_path()))
    return cells.groupBy("layer", "kind").agg(
        F.count("value").alias("n"), F.max("i").alias("max_i"), F.max("j").alias("max_j")
    )


def formula_model(vocab: DataFrame) -> Model:
    """A network whose cells follow from their places, so that other programs can run it too."""
    config = with_classes(CONFIG, vocab)
    i, h = np.arange(config.feature_size)[:, None], np.arange(FORMULA_HIDDEN)
    state = {
        "w0": ((i * 7 + h * 13) % 11 - 5) / 100.0,
        "b0": h / 10.0,
        "w1": np.sin((h[:, None] + 1.0) * (np.arange(config.vocab_size) + 1.0)),
        "b1": np.zeros(config.vocab_size),
    }
    return Model(state, embedding_matrix(vocab, config))


def predict_next_token(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the network that is given by a formula: positions, hidden layer, softmax, argmax, token."""
    vocab = word_vocab(spark, folder, CONFIG)
    return predict(word_tokens(query_texts(spark, folder)), vocab, vocab, formula_model(vocab), CONFIG)


def formula_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """Loss of the network that is given by a formula over the test windows, and its gradient behind the first weights."""
    test, vocab = _test_windows(spark, folder)
    found = mean_gradient(test, formula_model(vocab), with_classes(CONFIG, vocab)).where(F.col("name").isin(LOSS, "b0", "w1", "b1"))
    cells = found.select("name", "chunk", F.posexplode("cells").alias("at", "value"))
    place = (F.col("chunk").cast("long") * CHUNK + F.col("at")).alias("cell")
    return cells.select("name", place, F.round("value", GRADIENT_DIGITS).alias("value"))


def predict_trained(spark: SparkSession, folder: str) -> DataFrame:
    model, vocab = _trained(spark, folder)
    return predict(word_tokens(query_texts(spark, folder)), vocab, vocab, model, CONFIG)


QUERIES = {
    "corpus_lines": corpus_lines,
    "text_file_lines": text_file_line_numbers,
    "text_file_groups": text_file_groups,
    "line_groups": line_groups,
    "word_tokens": word_token_rows,
    "token_strings": token_strings,
    "bpe_token_ids": bpe_token_ids,
    "bpe_piece_bytes": bpe_piece_bytes,
    "bpe_roundtrip": bpe_roundtrip,
    "bpe_windows": bpe_windows,
    "bpe_windows_text": bpe_windows_text,
    "bpe_samples": bpe_samples,
    "sliding_windows": windows,
    "padded_windows": padded_windows,
    "window_counts": group_window_counts,
    "window_total": all_windows,
    "vocab_index": word_index,
    "vocab_dedup": vocab_dedup,
    "embeddings_csv_roundtrip": embeddings_csv_roundtrip,
    "embedding_lookup": embedding_lookup,
    "target_index": target_index,
    "embedded_features": embedded_features,
    "positional_reference": _positional("reference"),
    "positional_standard": _positional("standard"),
    "positional_features": positional_features,
    "one_hot_labels": one_hot,
    "training_samples": samples,
    "dataset_summary": dataset_summary,
    "split_hash": split_hash,
    "split_random": split_random,
    "split_random_sides": split_random_sides,
    "query_windows": padded_queries,
    "score_linear": score_linear,
    "argmax_scores": argmax_scores,
    "decode_predictions": decoded_predictions,
    "eval_accuracy": eval_accuracy,
    "eval_confusion": eval_confusion,
    "eval_class_counts": eval_class_counts,
    "eval_labels": eval_labels,
    "param_average": param_average,
    "train_param_avg": train_param_avg,
    "training_epochs": training_epochs,
    "training_metrics": training_metrics,
    "training_scores": training_scores,
    "training_confusion": training_confusion,
    "model_params": model_params,
    "predict_next_token": predict_next_token,
    "formula_gradient": formula_gradient,
    "predict_trained": predict_trained,
}
