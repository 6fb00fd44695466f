"""Train on text files and an embedding CSV, then predict the next token of some queries."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftline.config import TrainConfig, WindowConfig
from weftline.functions.bpe import BpeVocabulary
from weftline.operators.evaluation import class_counts_of
from weftline.operators.tokens import bpe_tokens
from weftline.plans.pipelines import predict, train_on_files


def main() -> None:
    parser = argparse.ArgumentParser(prog="weftline", description=__doc__)
    parser.add_argument("text", help="path of the text files")
    parser.add_argument("embeddings", help="path of the embedding CSV")
    parser.add_argument("model", help="folder for the model")
    parser.add_argument("--ranks", help="rank file of the tokenizer (default: an installed one)")
    parser.add_argument("--pattern", help="the pattern that splits texts before the merges of the rank file; needed with --ranks")
    parser.add_argument("--resume", help="folder of a saved epoch to go on from; with --epochs 0 only queries are run")
    parser.add_argument("--dim", type=int, default=WindowConfig.embedding_dim)
    parser.add_argument("--window", type=int, default=WindowConfig.window_size)
    parser.add_argument("--stride", type=int, default=WindowConfig.stride)
    parser.add_argument("--vocab-size", type=int, default=None, help="classes; all of the vocabulary if not given")
    parser.add_argument("--pad", default="0", help="byte-pair id that fills short windows")
    parser.add_argument("--workers", type=int, default=TrainConfig.workers)
    parser.add_argument("--batch-size", type=int, default=TrainConfig.batch_size)
    parser.add_argument("--averaging-frequency", type=int, default=TrainConfig.averaging_frequency)
    parser.add_argument("--epochs", type=int, default=TrainConfig.epochs)
    parser.add_argument("--learning-rate", type=float, default=TrainConfig.learning_rate)
    parser.add_argument("--hidden-size", type=int, default=TrainConfig.hidden_size)
    parser.add_argument("--query", action="append", default=[], help="text to continue; may be repeated")
    args = parser.parse_args()
    if bool(args.ranks) != bool(args.pattern):
        parser.error("--ranks and --pattern belong together")

    window = WindowConfig(
        window_size=args.window, stride=args.stride, embedding_dim=args.dim,
        vocab_size=args.vocab_size, pad_token=args.pad,
    )
    config = TrainConfig(
        workers=args.workers, batch_size=args.batch_size, averaging_frequency=args.averaging_frequency,
        epochs=args.epochs, learning_rate=args.learning_rate, hidden_size=args.hidden_size,
    )
    spark = SparkSession.builder.appName("weftline").getOrCreate()
    bpe = BpeVocabulary.from_file(args.ranks, args.pattern) if args.ranks else BpeVocabulary.installed()
    model, vocab, names = train_on_files(spark, args.text, args.embeddings, bpe, window, config, args.model, args.resume)
    model.epochs.orderBy("epoch").show(args.epochs, truncate=False)
    last = model.confusions.where(F.col("epoch") == args.epochs - 1)
    counts = class_counts_of(last)
    counts.orderBy("class").show(counts.count(), truncate=False)
    if args.query:
        queries = spark.createDataFrame(list(enumerate(args.query)), "query_id long, text string")
        predict(bpe_tokens(queries, bpe), vocab, names, model, window).orderBy("query_id").show(len(args.query), truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
