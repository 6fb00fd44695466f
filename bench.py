"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from weftline.operators.features import embed_windows, index_samples, token_vector, training_samples  # noqa: E402
from weftline.operators.tokens import token_occurrences  # noqa: E402
from weftline.config import TrainConfig  # noqa: E402
from weftline.plans.catalog import CONFIG, KEYS, QUERIES  # noqa: E402
from weftline.plans.catalog import TRAINING as PUBLISHED  # noqa: E402
from weftline.plans.pipelines import document_words, fit, word_vocab  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMED = [
    "line_groups", "text_file_groups", "word_tokens", "bpe_token_ids", "sliding_windows", "padded_windows",
    "window_total", "vocab_index", "split_hash", "score_linear", "eval_class_counts", "text_file_lines", "bpe_windows",
    "bpe_samples", "target_index", "predict_next_token",
]
#: Few large rounds, which suit the large tables; the published setting is timed on the small ones.
TRAINING = TrainConfig(workers=8, batch_size=128, averaging_frequency=10, epochs=2, hidden_size=20)


def consume(df) -> float:
    started = time.monotonic()
    df.write.format("noop").mode("overwrite").save()
    return time.monotonic() - started


def timed(function):
    started = time.monotonic()
    return function(), time.monotonic() - started


def run(spark: SparkSession, folder: str) -> dict[str, float]:
    seconds = {}
    for name in NAMED:
        _, seconds[name] = timed(lambda name=name: consume(QUERIES[name](spark, folder)))
    vocab, seconds["word_vocab"] = timed(lambda: word_vocab(spark, folder, CONFIG))
    words = document_words(spark, folder, CONFIG)
    seconds["embedding_lookup"] = consume(token_vector(token_occurrences(words), vocab, CONFIG.embedding_dim))
    seconds["index_samples"] = consume(index_samples(words, vocab, CONFIG))
    seconds["embedded_features"] = consume(embed_windows(words, vocab, CONFIG))
    seconds["training_samples"] = consume(training_samples(words, vocab, CONFIG))
    model, seconds["train_two_epochs"] = timed(lambda: fit(words, vocab, CONFIG, TRAINING, KEYS))
    seconds["train_epoch"] = min(row["seconds"] for row in model.epochs.collect())
    return seconds


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = str(Path(FOLDER).parent / "sf0.001")
    if Path(small).exists():
        run(spark, small)  # compiles the plans, and gives an epoch on a corpus of some thousand lines
        words, vocab = document_words(spark, small, CONFIG), word_vocab(spark, small, CONFIG)
        small_epoch, published = (
            median(row["seconds"] for row in fit(words, vocab, CONFIG, replace(setting, epochs=5), KEYS).epochs.collect())
            for setting in (TRAINING, PUBLISHED)
        )
    else:
        small_epoch = published = None
    seconds = run(spark, FOLDER)
    windows = QUERIES["window_total"](spark, FOLDER).first()["n_windows"]
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()) - seconds["train_epoch"], 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(FOLDER).name.removeprefix("sf"),
        "windows": windows,
        "windows_per_second": round(windows / seconds["sliding_windows"]),
        "samples_per_second": round(windows / seconds["training_samples"]),
        "small_corpus_epoch_seconds": small_epoch and round(small_epoch, 3),
        "small_corpus_epoch_seconds_published_setting": published and round(published, 3),
    }))


if __name__ == "__main__":
    main()
