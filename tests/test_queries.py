"""Every registered query with SQL gives what DuckDB gives, value by value."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from helpers import windows
from weftline.config import TrainConfig, WindowConfig
from weftline.functions.bpe import BpeVocabulary
from weftline.operators.tokens import bpe_tokens
from weftline.plans.pipelines import predict, train_on_files


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def normalized(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_against_sql(spark, duck, folder, name):
    got = normalized(queries()[name](spark, folder).toPandas())
    want = normalized(duck.sql(oracle_sql()[name]).to_arrow_table().to_pandas())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    assert got.equals(want)


@pytest.mark.parametrize("name", sorted(queries().keys() - oracle_sql().keys()))
def test_query_without_sql_has_rows(spark, folder, name):
    assert queries()[name](spark, folder).count() > 0


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["doc_id", "group_id", "window_no", "n_input", "input", "target"]


def test_bpe_samples_against_loops(spark, folder):
    """Indices of the pieces of all byte-pair windows, from the vocabulary of words."""
    bpe = BpeVocabulary.installed()
    pieces = {r["id"]: r["piece"] for r in bpe.table(spark).collect()}
    rank = {r["token"]: r["token_index"] for r in queries()["vocab_index"](spark, folder).where("token_index < 500").collect()}
    indices = {id_: rank.get(piece, -1) for id_, piece in pieces.items()}
    got = {(r["doc_id"], r["group_id"], r["window_no"]): (r["input_index"], r["target_index"])
           for r in queries()["bpe_samples"](spark, folder).collect()}
    want = {}
    for r in queries()["bpe_token_ids"](spark, folder).collect():
        ids = [int(x) for x in r["tokens"].split(" ") if x]
        for k, (window, target) in enumerate(windows(ids, 20, 3)):
            index = [indices[x] for x in window] + [indices[0]] * (20 - len(window))
            label = indices[target]
            want[r["doc_id"], r["group_id"], k] = (" ".join(map(str, index)), label)
    assert got == want


def test_random_split_keeps_every_window(spark, folder):
    rows = queries()["split_random"](spark, folder)
    assert rows.drop("split").distinct().count() == rows.count() == queries()["split_hash"](spark, folder).count()


def test_files_to_prediction(spark, folder, tmp_path):
    """Text files and an embedding CSV to a saved model and predicted tokens."""
    bpe = BpeVocabulary.installed()
    text = spark.read.parquet(f"{folder}/documents.parquet").where("lang = 'en'").select("text")
    text.write.text(str(tmp_path / "text"))
    pieces = ["the", "of", "and", "to", "in", "!", "re", "th"]
    lines = ["word,embeddings,word1,word2,word3,word4"]
    lines += [f"{piece},{';'.join(str((i * j % 5) / 4 - 0.5) for j in range(8))},a,b,c,d" for i, piece in enumerate(pieces)]
    (tmp_path / "vectors.csv").write_text("\n".join(lines) + "\n")
    window = WindowConfig(window_size=6, stride=3, embedding_dim=8, vocab_size=12, pad_token="0")
    config = TrainConfig(workers=4, batch_size=64, averaging_frequency=10, epochs=2, hidden_size=6)
    model, vocab, names = train_on_files(
        spark, str(tmp_path / "text"), str(tmp_path / "vectors.csv"), bpe, window, config, str(tmp_path / "model")
    )
    epochs = model.epochs.orderBy("epoch").collect()
    assert epochs[1]["mean_loss"] < epochs[0]["mean_loss"]
    texts = spark.createDataFrame(list(enumerate(["open harbour", "green lamp", "quiet morning"])), "query_id long, text string")
    rows = predict(bpe_tokens(texts, bpe), vocab, names, model, window).collect()
    assert len(rows) == 3
    assert all(r["token"] == (pieces[r["prediction"]] if r["prediction"] < 8 else "NULL") for r in rows)


def test_groups_of_byte_pair_windows_are_dealt_before_they_are_sliced(spark, folder):
    """The shuffle is below the step that makes windows, so it moves ids and no windows."""
    plan = queries()["bpe_windows_text"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    above, found, below = plan.partition("Generate explode(CASE WHEN")
    assert found and "Exchange" not in above and "Exchange hashpartitioning(doc_id" in below
