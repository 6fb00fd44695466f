import hashlib
import threading
import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import token_frame
from weftline.config import TrainConfig, WindowConfig
from weftline.functions import expansion
from weftline.functions.network import (
    adam_step,
    best_rounded,
    forward,
    gather,
    initial_parameters,
    initial_state,
    loss_and_gradients,
)
from weftline.functions.positional import positional_vector
from weftline.operators import evaluation, scoring
from weftline.operators.averaging import average_chunks, parameter_rows
from weftline.operators.exchange import Average, Layout, SharedFiles, StoredState, assemble, state_table
from weftline.operators.features import add_positions, embedding_matrix, gather_features
from weftline.operators.scoring import (
    classify,
    decode_predictions,
    index_windows,
    linear_parameters,
    predict_index,
    query_windows,
    score,
)
from weftline.operators.split import hash_split, random_split
from weftline.operators.tokens import word_tokens
from weftline.operators import training
from weftline.operators.training import load_model, load_state, plan_rounds, train
from weftline.plans.pipelines import fit, predict

CONFIG = WindowConfig(window_size=2, stride=1, embedding_dim=4, vocab_size=3)


def vocabulary(spark):
    rows = [(f"t{i}", i, [float(i == j) * 2 for j in range(4)]) for i in range(4)]
    return spark.createDataFrame(rows, "token string, token_index long, vector array<float>")


def toy_samples(spark, n=600):
    """The target is the first token."""
    return spark.range(n).select(
        F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("group_id"), F.col("id").alias("window_no"),
        F.array((F.col("id") % 3).cast("int"), (F.col("id") % 4).cast("int")).alias("input_index"),
        (F.col("id") % 3).alias("target_index"),
    )


KEYS = ("doc_id", "group_id", "window_no")


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    parameters = initial_parameters(5, 4, 3, 1)
    x, target = rng.normal(size=(7, 5)), rng.integers(0, 3, 7)
    _, gradients = loss_and_gradients(parameters, x, target)
    for name, value in parameters.items():
        for place in np.ndindex(value.shape):
            losses = []
            for shift in (1e-6, -1e-6):
                moved = {k: v.copy() for k, v in parameters.items()}
                moved[name][place] += shift
                losses.append(loss_and_gradients(moved, x, target)[0])
            assert abs((losses[0] - losses[1]) / 2e-6 - gradients[name][place]) < 1e-6


def test_a_step_makes_few_arrays():
    """A step of Adam changes the state in place, and a gradient needs one matrix of rows x classes besides itself."""
    rng = np.random.default_rng(3)
    state = initial_state(initial_parameters(4, 6, 50_001, 1))
    want = {name: value.copy() for name, value in state.items()}
    x, target = rng.normal(size=(20, 4)), rng.integers(0, 50_001, 20)
    peaks = []
    for step in (1, 2, 3):
        tracemalloc.start()
        _, gradients = loss_and_gradients(state, x, target)
        peaks.append(tracemalloc.get_traced_memory()[1] - sum(g.nbytes for g in gradients.values()))
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        adam_step(state, gradients, 0.01)
        assert tracemalloc.get_traced_memory()[1] - held < 1_000_000
        tracemalloc.stop()
        rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for name, g in gradients.items():
            want[f"{name}.m"] += 0.1 * (g - want[f"{name}.m"])
            want[f"{name}.v"] += 0.001 * (g * g - want[f"{name}.v"])
            want[name] -= rate * want[f"{name}.m"] / (np.sqrt(want[f"{name}.v"]) + 1e-8)
    assert max(peaks) < 1.3 * 8 * 20 * 50_001
    for name in want.keys() - {"t0"}:
        np.testing.assert_allclose(state[name], want[name], rtol=1e-9, atol=1e-12)


def test_xavier_spread():
    weights = initial_parameters(400, 200, 10, 3)["w0"]
    assert abs(weights.std() - np.sqrt(2 / 600)) < 2e-3


def test_loss_falls_and_accuracy_rises(spark):
    config = TrainConfig(workers=4, batch_size=10, averaging_frequency=5, epochs=6, learning_rate=0.05, hidden_size=8)
    model = train(toy_samples(spark), vocabulary(spark), CONFIG, config, toy_samples(spark, 90))
    epochs = model.epochs.orderBy("epoch").collect()
    assert len(epochs) == 6 and all(r["n_samples"] == 600 for r in epochs)
    assert epochs[-1]["mean_loss"] < epochs[0]["mean_loss"] / 3
    assert epochs[-1]["test_accuracy"] == 1.0
    metrics = model.metrics.collect()
    assert {r["epoch"] for r in metrics} == set(range(6)) and all(r["grad_norm"] >= 0 for r in metrics)
    cells = model.confusions.where("epoch = 5").collect()
    assert sum(r["n"] for r in cells) == 90 and all(r["label"] == r["prediction"] for r in cells)
    saved = load_state(spark, model.last_epoch_path())
    assert saved.keys() == model.state.keys()
    assert all(np.array_equal(saved[name], model.state[name]) for name in saved)


def test_one_worker_equals_local_adam(spark):
    config = TrainConfig(workers=1, batch_size=16, averaging_frequency=1000, epochs=1, hidden_size=5)
    samples = toy_samples(spark, 100)
    model = train(samples, vocabulary(spark), CONFIG, config)
    rounds = plan_rounds(samples, config, *KEYS)
    assert rounds.n_rounds == 1
    unit = rounds.of(0).first()
    digests = {k: hashlib.md5(f"{config.seed}-0-0-{k}".encode()).hexdigest() for k in range(100)}
    order = sorted(digests, key=digests.get)
    assert [list(x) for x in unit["input_index"]] == [[k % 3, k % 4] for k in order]
    matrix = embedding_matrix(vocabulary(spark), CONFIG)
    positions = np.array(positional_vector(spark, 2, 4, "standard"), np.float32)
    x = (gather(matrix, np.array(unit["input_index"])) + positions).astype(np.float64)
    target = np.array(unit["target_index"])
    state = initial_state(initial_parameters(8, 5, 3, config.seed))
    for start in range(0, 100, 16):
        _, gradients = loss_and_gradients(state, x[start : start + 16], target[start : start + 16])
        adam_step(state, gradients, config.learning_rate)
    assert state["t0"] == 7
    for name in state:
        np.testing.assert_allclose(model.state[name], state[name], rtol=1e-12, atol=1e-15)


def test_features_and_indices_train_alike(spark):
    config = TrainConfig(workers=2, batch_size=16, averaging_frequency=4, epochs=2, hidden_size=5)
    vocab, samples = vocabulary(spark), toy_samples(spark, 200)
    dense = gather_features(samples, embedding_matrix(vocab, CONFIG), CONFIG)
    first = train(samples, vocab, CONFIG, config)
    second = train(dense, vocab, CONFIG, config)
    assert second.matrix is None
    for name in first.state:
        np.testing.assert_allclose(first.state[name], second.state[name], rtol=1e-12, atol=1e-15)


def test_samples_without_label_are_left_out(spark):
    config = TrainConfig(workers=2, batch_size=16, averaging_frequency=4, epochs=1, hidden_size=3)
    unlabelled = toy_samples(spark, 50).withColumns({"target_index": F.lit(-1).cast("long"), "doc_id": F.lit(1).cast("long")})
    model = train(toy_samples(spark, 60).unionByName(unlabelled), vocabulary(spark), CONFIG, config)
    row = model.epochs.first()
    assert (row["n_samples"], row["n_test"], row["n_without_label"]) == (60, 0, 50)


def test_each_sample_is_in_one_round(spark):
    config = TrainConfig(workers=3, batch_size=5, averaging_frequency=2)
    rounds = plan_rounds(toy_samples(spark), config, *KEYS)
    assert rounds.n_rounds == 20
    units = [u for number in range(20) for u in rounds.of(number).collect()]
    assert len(units) == len({(u["round"], u["worker"]) for u in units}) and {u["worker"] for u in units} == {0, 1, 2}
    assert sum(len(u["target_index"]) for u in units) == 600 and max(len(u["target_index"]) for u in units) < 30
    got = sorted((*x, t) for u in units for x, t in zip(u["input_index"], u["target_index"], strict=True))
    assert got == sorted((*r["input_index"], r["target_index"]) for r in toy_samples(spark).collect())


def test_files_follow_workers_and_not_rounds(spark):
    for frequency in (1, 20):
        config = TrainConfig(workers=3, batch_size=5, averaging_frequency=frequency)
        rounds = plan_rounds(toy_samples(spark), config, *KEYS)
        assert len(rounds.table.inputFiles()) == 3


def test_one_shuffle_places_samples(spark, monkeypatch):
    monkeypatch.setattr(training, "BLOCK_BYTES", 3000)  # two rounds to a block
    config = TrainConfig(workers=3, batch_size=5, averaging_frequency=3)
    held = toy_samples(spark).withColumn("held_out", F.col("window_no") % 5 == 0)
    rounds = plan_rounds(held, config, *KEYS)
    assert (rounds.n_samples, rounds.n_test, rounds.n_rounds, rounds.per_block) == (480, 120, 11, 2)
    assert {r["block"] for r in rounds.table.where("not held_out").select("block").distinct().collect()} == set(range(6))
    sizes = [r["n"] for r in rounds.table.where("held_out").select(F.size("target_index").alias("n")).collect()]
    assert sum(sizes) == 120 and max(sizes) < 45
    plan = rounds.of(3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull" in plan and "PushedFilters" in plan


def test_workers_keep_rounds_bounded(spark):
    """No size is refused: beyond most_rounds an epoch gets more workers."""
    config = TrainConfig(workers=1, batch_size=1, averaging_frequency=1, most_rounds=50)
    assert [config.workers_for(n) for n in (0, 50, 51, 10**15)] == [1, 1, 2, 2 * 10**13]
    rounds = plan_rounds(toy_samples(spark), config, *KEYS)
    assert (rounds.workers, rounds.n_rounds) == (12, 50)
    units = rounds.table.where("NOT held_out").collect()
    assert sum(len(u["target_index"]) for u in units) == 600
    assert {u["worker"] for u in units} <= set(range(12)) and {u["round"] for u in units} <= set(range(50))


@pytest.mark.parametrize("config", [
    TrainConfig(workers=11, batch_size=5, averaging_frequency=2, epochs=2, hidden_size=4),
    TrainConfig(workers=40, batch_size=50, averaging_frequency=10, epochs=1, hidden_size=3),  # some see nothing
])
def test_one_stage_equals_a_job_for_each_round(spark, config):
    samples, vocab = toy_samples(spark), vocabulary(spark)
    one = train(samples, vocab, CONFIG, config, toy_samples(spark, 60), one_stage=True)
    other = train(samples, vocab, CONFIG, config, toy_samples(spark, 60), one_stage=False)
    assert isinstance(one.held, StoredState) and isinstance(other.held, dict)
    for name in other.state:
        np.testing.assert_allclose(one.state[name], other.state[name], rtol=1e-11, atol=1e-14)
    columns = ["epoch", "round", "worker", "iteration", "n"]
    ordered = [m.metrics.orderBy(*columns).collect() for m in (one, other)]
    assert [r[:5] for r in ordered[0]] == [r[:5] for r in ordered[1]]
    np.testing.assert_allclose(*[[r[5:] for r in rows] for rows in ordered], rtol=1e-9)
    cells = [sorted(map(tuple, m.confusions.collect())) for m in (one, other)]
    assert cells[0] == cells[1]


def test_an_epoch_is_a_bounded_number_of_jobs(spark):
    """Jobs don't follow the rounds: 60 rounds of an epoch make as many as 6."""
    counts = []
    for frequency in (1, 10):
        group = f"rounds-{frequency}"
        spark.sparkContext.setJobGroup(group, group)
        config = TrainConfig(workers=2, batch_size=5, averaging_frequency=frequency, epochs=1, hidden_size=2)
        assert train(toy_samples(spark), vocabulary(spark), CONFIG, config).epochs.first()["n_rounds"] == 60 // frequency
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1] < 40


@pytest.mark.parametrize("tasks", [1, 3, 32, 70])
def test_files_average_level_by_level(tmp_path, tasks):
    """Tasks side by side; then one that starts again goes through the means that are there."""
    rng = np.random.default_rng(tasks)
    states, counts = rng.normal(size=(tasks, 101)), rng.integers(0, 4, tasks)
    counts[0] = 2
    found = [[] for _ in range(tasks)]

    def task(k, labels="abc"):
        average = Average(SharedFiles(str(tmp_path)), k, tasks, 101)
        for label in labels:
            found[k].append(average.of(label, 0 if label == "b" else int(counts[k]), states[k]))

    threads = [threading.Thread(target=task, args=(k,)) for k in range(tasks)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert not [p for p in tmp_path.iterdir() if p.name[:1] in "ab" and "-mean-" not in p.name]  # rounds before the last
    task(tasks - 1)
    for k, means in enumerate(found):
        for mean, label in zip(means, "abcabc"):
            want = states[k] if label == "b" else counts @ states / counts.sum()
            np.testing.assert_allclose(mean, want, rtol=1e-12, atol=1e-14)
    assert len(found[-1]) == 6


def test_a_mean_that_appears_late_is_read_again(tmp_path):
    """Another task writes the last piece between a failed look and the test for all pieces."""

    class Late(SharedFiles):
        missed = 0

        def read(self, name, *stretch):
            if "-mean-" in name and self.missed < 8:
                self.missed += 1
                raise FileNotFoundError(name)
            return super().read(name, *stretch)

    files = Late(str(tmp_path))
    state = np.arange(11.0)
    np.testing.assert_array_equal(Average(files, 0, 1, 11).of("0", 3, state), state)
    assert files.missed == 8


def test_layout_and_chunks(spark, monkeypatch):
    from weftline.operators import exchange

    monkeypatch.setattr(exchange, "CHUNK", 7)
    state = initial_state(initial_parameters(5, 4, 3, 2))
    layout = Layout.of_network(5, 4, 3)
    flat = layout.flat(state)
    assert flat.size == layout.size and all(np.array_equal(layout.arrays(flat)[n], state[n]) for n in state)
    rows = [r for low, high in ((0, 10), (10, 11), (11, layout.size)) for r in layout.rows(low, high)]
    assert np.concatenate([flat[r[3] : r[4]] for r in rows]).tolist() == flat.tolist() and max(r[4] - r[3] for r in rows) <= 7
    back = assemble(state_table(spark, state).repartition(3).toArrow())
    assert all(np.array_equal(back[name], state[name]) for name in state)


def test_steps_are_those_that_were_made(spark):
    """Workers make more or fewer batches than the frequency; the mean that is carried on is weighted by samples."""
    config = TrainConfig(workers=3, batch_size=5, averaging_frequency=2, epochs=1, hidden_size=3)
    model = train(toy_samples(spark), vocabulary(spark), CONFIG, config)
    steps = 0
    rows = model.metrics.groupBy("round", "worker").agg(F.count("*").alias("batches"), F.sum("n").alias("n")).collect()
    for number in range(20):
        own = [r for r in rows if r["round"] == number]
        steps += sum(r["batches"] * r["n"] for r in own) / sum(r["n"] for r in own)
    assert sum(r["n"] for r in rows) == 600 and abs(model.state["t0"][0] - steps) < 1e-9


def test_a_saved_epoch_predicts_and_goes_on(spark):
    config = TrainConfig(workers=2, batch_size=16, averaging_frequency=4, epochs=2, hidden_size=5)
    vocab, samples = vocabulary(spark), toy_samples(spark, 200)
    whole = train(samples, vocab, CONFIG, config)
    first = train(samples, vocab, CONFIG, replace(config, epochs=1))
    second = train(samples, vocab, CONFIG, replace(config, epochs=1), state=load_state(spark, first.last_epoch_path()))
    for name in whole.state:
        np.testing.assert_allclose(whole.state[name], second.state[name], rtol=1e-12, atol=1e-15)
    third = train(samples, vocab, CONFIG, replace(config, epochs=1), state=StoredState(first.last_epoch_path()))
    for name in whole.state:
        np.testing.assert_allclose(whole.state[name], third.state[name], rtol=1e-12, atol=1e-15)
    queries = token_frame(spark, [["t1", "t2"], ["t0"], []])
    loaded = load_model(spark, whole.last_epoch_path(), vocab, CONFIG)
    rows = [predict(queries, vocab, vocab, m, CONFIG).collect() for m in (whole, loaded)]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1])) and len(rows[0]) == 3
    with pytest.raises(ValueError, match="other features"):
        train(samples, vocab, replace(CONFIG, vocab_size=4), config, state=loaded.state)
    with pytest.raises(ValueError, match="other features"):
        train(samples, vocab, replace(CONFIG, vocab_size=4), config, state=StoredState(first.last_epoch_path()))


@pytest.mark.parametrize("workers", [2, 8, 64])
def test_workers_share_evenly(spark, workers):
    config = TrainConfig(workers=workers, batch_size=1000, averaging_frequency=10)
    placed = plan_rounds(toy_samples(spark, 6400), config, *KEYS).table
    counts = [r["n"] for r in placed.groupBy("worker").agg(F.sum(F.size("target_index")).alias("n")).collect()]
    assert len(counts) == workers and max(counts) < 2 * 6400 / workers


def test_epochs_may_be_inclusive():
    assert TrainConfig(epochs=20).passes == 20
    assert TrainConfig(epochs=20, inclusive_epochs=True).passes == 21


@pytest.mark.parametrize("fan_in", [2, 3, 256])
def test_chunked_average_is_weighted_by_samples(spark, fan_in):
    rng = np.random.default_rng(5)
    workers = [(rng.normal(size=6), n) for n in (1, 5, 3, 2, 2, 7, 1)]
    chunks = spark.createDataFrame(
        [(k, "w0", c, cells[c * 3 : c * 3 + 3].tolist(), n) for k, (cells, n) in enumerate(workers) for c in (0, 1)],
        "part int, name string, chunk int, cells array<double>, n long",
    )
    rows = average_chunks(chunks, 7, fan_in).collect()
    assert len(rows) == 2
    mean = [x for r in sorted(rows, key=lambda r: r["chunk"]) for x in r["cells"]]
    np.testing.assert_allclose(mean, sum(c * n for c, n in workers) / 21)


def test_model_table_round_trip(spark):
    state = initial_state(initial_parameters(6, 4, 3, 2))
    table = state_table(spark, state)
    back = assemble(table.toArrow())
    assert all(np.array_equal(back[name], state[name]) for name in state)
    rows = {(r["layer"], r["kind"], r["i"], r["j"]): r["value"] for r in parameter_rows(table).collect()}
    assert len(rows) == 3 * (6 * 4 + 4 + 4 * 3 + 3) + 1 and rows[0, "step", 0, 0] == 0
    assert rows[0, "weight", 5, 2] == state["w0"][5, 2] and rows[1, "bias.m", 0, 1] == 0.0


def test_queries_are_cut_and_padded(spark):
    texts = spark.createDataFrame(
        [(0, " ".join(map(str, range(1, 26)))), (1, "this is a short query"), (2, "")], "query_id long, text string"
    )
    config = WindowConfig(pad_token="0")
    rows = {r["query_id"]: list(r["input"]) for r in query_windows(word_tokens(texts), config).collect()}
    assert rows[0] == [str(i) for i in range(1, 21)]
    assert rows[1] == ["this", "is", "a", "short", "query"] + ["0"] * 15
    assert rows[2] == ["0"] * 20


def test_scores_of_features_and_indices_agree(spark):
    vocab = vocabulary(spark)
    windows = query_windows(token_frame(spark, [["t0", "t3"], ["t1"], ["x", "t2", "t1"], []]), CONFIG)
    for limit in (0, None):
        index = index_windows(windows, vocab, limit)
        assert {r["doc_id"]: list(r["input_index"]) for r in index.collect()} == {
            0: [0, 3], 1: [1, -1], 2: [-1, 2], 3: [-1, -1],
        }
    matrix = embedding_matrix(vocab, CONFIG)
    parameters = initial_parameters(8, 5, 3, 11)
    by_index = {r["doc_id"]: list(r["scores"]) for r in score(index, parameters, CONFIG, matrix).collect()}
    dense = gather_features(index, matrix, CONFIG)
    by_features = {r["doc_id"]: list(r["scores"]) for r in score(dense, parameters, CONFIG).collect()}
    assert by_index.keys() == by_features.keys() == {0, 1, 2, 3}
    for key, row in by_index.items():
        np.testing.assert_allclose(row, by_features[key])
        assert abs(sum(row) - 1) < 1e-12
    features = np.array([r["features"] for r in dense.orderBy("doc_id").collect()])
    np.testing.assert_allclose([by_index[k] for k in range(4)], forward(parameters, features), rtol=1e-6)


def test_classes_in_pieces_equal_the_argmax_of_scores(spark, monkeypatch):
    monkeypatch.setattr(scoring, "_SCORE_CELLS", 30)
    vocab = vocabulary(spark)
    matrix, parameters = embedding_matrix(vocab, CONFIG), initial_parameters(8, 5, 3, 11)
    rows = toy_samples(spark, 200).coalesce(1)
    want = predict_index(score(rows, parameters, CONFIG, matrix)).drop("scores")
    assert sorted(map(str, classify(rows, parameters, CONFIG, matrix).collect())) == sorted(map(str, want.collect()))
    nothing = rows.where("window_no < 0")
    assert classify(nothing, parameters, CONFIG, matrix).collect() == []


def test_training_without_any_label(spark):
    config = TrainConfig(workers=2, batch_size=16, averaging_frequency=4, epochs=1, hidden_size=3)
    unlabelled = toy_samples(spark, 50).withColumn("target_index", F.lit(-1).cast("long"))
    model = train(unlabelled, vocabulary(spark), CONFIG, config, unlabelled)
    row = model.epochs.first()
    assert row["n_samples"] == 0 and row["mean_loss"] is None and row["test_accuracy"] is None
    assert model.metrics.count() == 0


def test_linear_scores_pick_the_token_itself(spark):
    vocab = vocabulary(spark)
    config = WindowConfig(window_size=2, stride=1, embedding_dim=4, vocab_size=3, positional=None)
    rows = index_windows(query_windows(token_frame(spark, [["t2"], ["t1", "t1"], ["none"]]), config), vocab)
    scored = score(rows, linear_parameters(spark, vocab, config), config, embedding_matrix(vocab, config))
    assert {r["doc_id"]: r["prediction"] for r in predict_index(scored, 6).collect()} == {0: 2, 1: 1, 2: 0}


def test_argmax_takes_the_first_maximum(spark):
    rows = spark.createDataFrame([([0.1, 0.5, 0.5],), ([2.0],), ([0.3000000001, 0.3000000002],)], "scores array<double>")
    assert [r["prediction"] for r in predict_index(rows).collect()] == [1, 0, 1]
    assert [r["prediction"] for r in predict_index(rows, 6).collect()] == [1, 0, 0]


def test_unknown_index_decodes_to_null_text(spark):
    predictions = spark.createDataFrame([(1, 2), (2, 77)], "query_id long, prediction long")
    rows = decode_predictions(predictions, vocabulary(spark)).collect()
    assert {r["query_id"]: r["token"] for r in rows} == {1: "t2", 2: "NULL"}


PAIRS = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (3, 3), (2, 4)]


def pairs(spark):
    return spark.createDataFrame(PAIRS, "label long, prediction long")


def test_evaluation_against_loops(spark):
    row = evaluation.accuracy(pairs(spark)).first()
    assert (row["n"], row["n_correct"], row["accuracy"]) == (7, 4, 4 / 7)
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluation.confusion(pairs(spark)).collect()}
    assert cells == {p: PAIRS.count(p) for p in set(PAIRS)}
    for r in evaluation.class_counts(pairs(spark)).collect():
        c = r["class"]
        assert r["tp"] == sum(a == c and b == c for a, b in PAIRS)
        assert r["fp"] == sum(a != c and b == c for a, b in PAIRS)
        assert r["fn"] == sum(a == c and b != c for a, b in PAIRS)
        assert r["tn"] == sum(a != c and b != c for a, b in PAIRS)
    assert evaluation.class_counts(pairs(spark)).count() == 5


def test_accuracy_of_nothing(spark):
    row = evaluation.accuracy(pairs(spark).where("label > 9")).first()
    assert row["n"] == 0 and row["accuracy"] is None


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_hash_split_is_stable(spark, parts):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("group_id"))
    train_rows, test_rows = hash_split(rows.repartition(parts), "doc_id", "group_id")
    first, _ = hash_split(rows, "doc_id", "group_id")
    assert set(train_rows.collect()) == set(first.collect())
    assert train_rows.count() + test_rows.count() == 5000
    assert 0.77 < train_rows.count() / 5000 < 0.83


def test_random_split_is_seeded(spark):
    rows = spark.range(2000)
    first, rest = random_split(rows)
    again, _ = random_split(rows)
    assert first.collect() == again.collect()
    assert first.count() + rest.count() == 2000 and 0.75 < first.count() / 2000 < 0.85


def test_random_split_sorts_partitions_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr("weftline.operators.split.SORT_BYTES", 10_000, raising=False)
    rows = spark.range(0, 2000, 1, 1).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("doc.id"), F.array("id").alias("group"))
    sides = random_split(rows)
    sizes = [len(part) for side in sides for part in side.rdd.glom().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 400
    assert sorted(r["group"][0] for side in sides for r in side.collect()) == list(range(2000))
    monkeypatch.setattr("weftline.operators.split.SORT_BYTES", 1 << 20)
    assert random_split(rows)[0].rdd.getNumPartitions() == 1


def test_add_positions_may_be_off(spark):
    frame = spark.createDataFrame([([1.0] * 8,)], "features array<float>")
    config = WindowConfig(window_size=2, embedding_dim=4, positional=None)
    assert add_positions(frame, config).collect() == frame.collect()


def test_beyond_the_bound_features_are_joined_and_predicted(spark):
    """The whole path without a broadcast of the vectors gives the same model and predictions."""
    tokens = token_frame(spark, [[f"t{(i * i + d) % 5}" for i in range(40)] for d in range(3)])
    config = TrainConfig(workers=2, batch_size=8, averaging_frequency=4, epochs=2, hidden_size=4)
    vocab = vocabulary(spark)
    small = fit(tokens, vocab, CONFIG, config, ("doc_id", "window_no"))
    large = fit(tokens, vocab, CONFIG, config, ("doc_id", "window_no"), limit=0)
    assert small.matrix is not None and large.matrix is None
    for name in small.state:
        np.testing.assert_allclose(small.state[name], large.state[name], rtol=1e-12, atol=1e-15)
    queries = token_frame(spark, [["t1", "t2"], ["t0"], ["none", "t3", "t1"], []])
    first = predict(queries, vocab, vocab, small, CONFIG).collect()
    second = predict(queries, vocab, vocab, large, CONFIG).collect()
    assert sorted(map(str, first)) == sorted(map(str, second)) and len(first) == 4


def test_a_quarter_million_classes_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(scoring, "_SCORE_CELLS", 1_000_000)
    n_classes = 250_000
    rng = np.random.default_rng(4)
    parameters = {**initial_parameters(8, 3, n_classes, 5), "b1": rng.normal(size=n_classes)}
    parameters["w1"][:, 200_001] = parameters["w1"][:, 140_007]  # a tie: the first one counts
    parameters["b1"][[140_007, 200_001]] = 30.0
    features = rng.normal(size=(40, 8)).astype(np.float32)
    rows = spark.createDataFrame([(k, f.tolist()) for k, f in enumerate(features)], "id long, features array<float>")
    got = {r["id"]: r["prediction"] for r in classify(rows, parameters, CONFIG).collect()}
    assert got == dict(enumerate(forward(parameters, features.astype(np.float64)).argmax(axis=1)))
    assert 140_007 in got.values() and 200_001 not in got.values()
    sizes = score(rows.coalesce(1), parameters, CONFIG).select(F.size("scores").alias("n")).distinct().collect()
    assert [r["n"] for r in sizes] == [n_classes]


def test_linear_scores_hold_no_wide_matrix(spark):
    """The weights of one position stand for all; rounded scores and their first maximum are those of the wide layer."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 4)).astype(np.float32)
    vectors[[2999, 700]] = vectors[41]  # ties: the first one counts
    vocab = spark.createDataFrame([(f"w{k}", k, v.tolist()) for k, v in enumerate(vectors)], "token string, token_index long, vector array<float>")
    config = WindowConfig(window_size=50, embedding_dim=4, positional=None)
    parameters = linear_parameters(spark, vocab, config)
    assert sum(value.nbytes for value in parameters.values()) < 100_000  # 4.8 MB for every position
    wide = {"w0": np.tile(vectors.T.astype(np.float64), (50, 1)), "b0": np.zeros(3000)}
    x = rng.normal(size=(60, 50, 4)).astype(np.float32)
    x[0], x[1], x[2] = 0, vectors[41], 1e-9 * vectors[41]  # all classes tie, two copies tie, all scores round to nothing
    x[3], x[4, 0, 0] = 1e25 * x[5], np.inf
    x = x.reshape(60, -1)
    with np.errstate(invalid="ignore", over="ignore"):
        want = (x.astype(np.float64) @ wide["w0"]).round(6).argmax(axis=1)
        for tile in (256, 700, 5000):
            assert best_rounded(parameters, x.astype(np.float64), 6, tile).tolist() == want.tolist()
            assert best_rounded(wide, x.astype(np.float64), 6, tile).tolist() == want.tolist()
    rows = spark.createDataFrame([(k, f.tolist()) for k, f in enumerate(x)], "id long, features array<float>")
    got = {r["id"]: r["prediction"] for r in classify(rows, parameters, config, digits=6).collect()}
    assert got == dict(enumerate(want.tolist()))
    scored = {r["id"]: r["scores"] for r in score(rows.where("id <> 4"), parameters, config).collect()}
    np.testing.assert_allclose(scored[7], x[7].astype(np.float64) @ wide["w0"], rtol=1e-9, atol=1e-9)


def test_a_gradient_over_many_classes_takes_few_rows_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(training, "FEATURE_CELLS", 3000)
    sizes = []
    monkeypatch.setattr(training, "pieces", lambda batches, rows: sizes.append(rows) or iter(()))
    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", lambda self, task, schema: list(task([])) or self)
    monkeypatch.setattr(training, "average_chunks", lambda rows, parts: rows)
    training.mean_gradient(toy_samples(spark, 3), training.Model(initial_parameters(8, 2, 1500, 1), np.zeros((4, 4))), replace(CONFIG, vocab_size=1500))
    assert sizes == [2]  # and not 3000 / 8


def test_mean_gradient_is_that_of_all_samples_at_once(spark, monkeypatch):
    monkeypatch.setattr(training, "FEATURE_CELLS", 64)
    vocab, samples = vocabulary(spark), toy_samples(spark, 300).repartition(5)
    state = initial_parameters(8, 5, 3, 11)
    matrix = embedding_matrix(vocab, CONFIG)
    rows = samples.unionByName(toy_samples(spark, 20).withColumn("target_index", F.lit(-1).cast("long")))  # left out
    found = {r["name"]: np.array(r["cells"]) for r in training.mean_gradient(rows, training.Model(state, matrix), CONFIG).collect()}
    positions = np.array(positional_vector(spark, 2, 4, "standard"), np.float32)
    kept = samples.collect()
    x = (gather(matrix, np.array([r["input_index"] for r in kept])) + positions).astype(np.float64)
    loss, gradients = loss_and_gradients(state, x, np.array([r["target_index"] for r in kept]))
    for name, value in {training.LOSS: loss, **gradients}.items():
        np.testing.assert_allclose(found[name], np.ravel(value), rtol=1e-9, atol=1e-12)


def many_classes(units, classes, rows, seed):
    rng = np.random.default_rng(seed)
    state = {"w0": np.eye(units), "b0": np.zeros(units), "w1": rng.uniform(-1, 1, (units, classes)), "b1": rng.normal(size=classes)}
    x = rng.normal(np.linspace(-0.1, 0.6, units), 0.15, (rows, units))
    return state, x, rng.integers(0, classes, rows)


@pytest.mark.parametrize("units", [1, 2, 3, 4])
def test_an_expansion_gives_the_gradients_of_all_scores(monkeypatch, units):
    monkeypatch.setattr(expansion, "SCORE_WORK", 1 << 20)  # also where all scores are less work
    monkeypatch.setattr(expansion, "TERM_CELLS", 4000)
    state, x, target = many_classes(units, 700, 900, units)
    hidden = np.maximum(x, 0.0)
    loss, gradients = loss_and_gradients(state, x, target)
    found, back, w1, b1 = expansion.output_gradients(state["w1"], state["b1"], hidden, target)
    assert abs(found - loss) < 1e-11
    np.testing.assert_allclose(w1, gradients["w1"], rtol=0, atol=1e-13)
    np.testing.assert_allclose(b1, gradients["b1"], rtol=0, atol=1e-13)
    np.testing.assert_allclose(x.T @ (back * (hidden > 0)), gradients["w0"], rtol=0, atol=1e-12)


def test_an_expansion_is_left_where_it_is_more_work():
    state, x, target = many_classes(4, 700, 900, 0)
    assert expansion.output_gradients(state["w1"], state["b1"], np.maximum(x, 0.0), target) is None
    wide, x, target = many_classes(20, 3000, 3000, 0)
    assert expansion.output_gradients(wide["w1"], wide["b1"], np.maximum(x, 0.0), target) is None
    assert expansion.output_gradients(state["w1"] * np.nan, state["b1"], np.abs(x[:, :4]), target % 700) is None


def test_a_gradient_over_many_classes_takes_no_matrix_of_scores(spark, monkeypatch):
    """3,000 samples, 9,000 classes: fewer scores than rows x classes are taken, and the gradient is that of all."""
    state, _, _ = many_classes(2, 9000, 1, 5)
    state["w0"], state["b0"] = np.random.default_rng(1).normal(0, 0.3, (8, 2)), np.full(2, 0.2)
    vocab, samples = vocabulary(spark), toy_samples(spark, 3000).repartition(2)
    matrix, config = embedding_matrix(vocab, CONFIG), replace(CONFIG, vocab_size=9000)
    kept = samples.collect()
    positions = np.array(positional_vector(spark, 2, 4, "standard"), np.float32)
    x = (gather(matrix, np.array([r["input_index"] for r in kept])) + positions).astype(np.float64)
    loss, gradients = loss_and_gradients(state, x, np.array([r["target_index"] for r in kept]))

    def refuse(*args):
        raise AssertionError("all scores were taken")

    monkeypatch.setattr(training, "loss_and_gradients", refuse)
    frame = training.mean_gradient(samples, training.Model(state, matrix), config).orderBy("name", "chunk")
    found = {}
    for r in frame.collect():
        found.setdefault(r["name"], []).extend(r["cells"])
    for name, value in {training.LOSS: np.array([loss]), **gradients}.items():
        np.testing.assert_allclose(found[name], np.ravel(value), rtol=0, atol=1e-11)
