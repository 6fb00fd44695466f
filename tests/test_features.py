import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import positional, token_frame, windows
from weftline.config import WindowConfig
from weftline.functions.digest import SCHEMA, digest_lists, digest_matrix
from weftline.functions.positional import positional_table, positional_vector
from weftline.operators.features import (
    add_positions,
    embed_windows,
    embedding_matrix,
    first_vectors,
    gather_features,
    index_samples,
    one_hot_labels,
    token_index,
    token_vector,
    training_samples,
)
from weftline.operators.lookup import TokenPlaces, heavy_keys, index_tokens, lookup, token_places
from weftline.operators.tokens import token_occurrences
from weftline.operators.vocab import attach_vectors, last_row_wins, token_counts, vocab_by_id, vocab_index

CONFIG = WindowConfig(window_size=4, stride=2, embedding_dim=3, vocab_size=4, segment_windows=2)


def vocabulary(spark, extra=()):
    rows = [(f"t{i}", i, [i + 0.5, -i * 0.25, 1.0 / (i + 1)]) for i in range(6)]
    return spark.createDataFrame([*rows, *extra], "token string, token_index long, vector array<float>")


def lists():
    return [[f"t{(i * i) % 9}" for i in range(n)] for n in (0, 1, 3, 5, 12, 31)]


def by_key(frame, column):
    return {(r["doc_id"], r["window_no"]): r[column] for r in frame.collect()}


@pytest.mark.parametrize("mode", ["standard", "reference"])
@pytest.mark.parametrize("size,dim", [(2, 4), (20, 64), (5, 3), (1, 8), (9, 2)])
def test_positional_vector_equals_the_loop(spark, mode, size, dim):
    vector = positional_vector(spark, size, dim, mode)
    assert len(vector) == size * dim
    np.testing.assert_allclose(vector, positional(size, dim, mode), atol=1e-6)


def test_reference_positions_fill_only_the_start(spark):
    table = positional_table(spark, 20, 128, "reference").where("value <> 0")
    assert table.agg(F.max("j")).first()[0] <= 146


def test_no_positions(spark):
    assert positional_vector(spark, 2, 3, None) == [0.0] * 6


def expected_features(pad=(0.0, 0.0, 0.0)):
    vectors = {f"t{i}": np.array([i + 0.5, -i * 0.25, 1.0 / (i + 1)], np.float32) for i in range(6)}
    out = {}
    for key, tokens in enumerate(lists()):
        for k, (window, target) in enumerate(windows(tokens, 4, 2)):
            parts = [vectors.get(t, np.zeros(3, np.float32)) for t in window]
            parts += [np.array(pad, np.float32)] * (4 - len(window))
            index = int(target[1:])
            out[key, k] = (np.concatenate(parts), index if index < 4 else -1)
    return out


@pytest.mark.parametrize("limit", [None, 0])
def test_embedded_windows(spark, limit):
    frame = embed_windows(token_frame(spark, lists()), vocabulary(spark), CONFIG, limit)
    features, targets = by_key(frame, "features"), by_key(frame, "target_index")
    want = expected_features()
    assert features.keys() == want.keys()
    for key, (vector, target) in want.items():
        np.testing.assert_array_equal(np.array(features[key], np.float32), vector)
        assert targets[key] == target


@pytest.mark.parametrize("limit", [None, 0])
def test_index_samples_gather_to_the_same_features(spark, limit):
    tokens, vocab = token_frame(spark, lists()), vocabulary(spark)
    samples = index_samples(tokens, vocab, CONFIG, limit)
    assert all(len(v) == 4 for v in by_key(samples, "input_index").values())
    gathered = gather_features(samples, embedding_matrix(vocab, CONFIG), CONFIG)
    joined = add_positions(embed_windows(tokens, vocab, CONFIG), CONFIG)
    assert by_key(gathered, "features") == by_key(joined, "features")
    assert by_key(gathered, "target_index") == by_key(joined, "target_index")
    assert by_key(training_samples(tokens, vocab, CONFIG), "features") == by_key(joined, "features")


def test_padding_token_of_the_vocabulary(spark):
    vocab = vocabulary(spark, [("!", 9, [7.0, 8.0, 9.0])])
    config = WindowConfig(window_size=4, stride=2, embedding_dim=3, vocab_size=4, pad_token="!")
    got = by_key(embed_windows(token_frame(spark, lists()), vocab, config), "features")
    want = expected_features(pad=(7.0, 8.0, 9.0))
    assert got == {key: vector.tolist() for key, (vector, _) in want.items()}
    index = by_key(index_samples(token_frame(spark, lists()), vocab, config), "input_index")
    assert index[1, 0] == [9] * 4


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partitioning_does_not_matter(spark, parts):
    frame = embed_windows(token_frame(spark, lists()).repartition(parts), vocabulary(spark), CONFIG)
    assert by_key(frame, "features") == {k: v.tolist() for k, (v, _) in expected_features().items()}


def test_missing_token_has_zeros(spark):
    rows = token_occurrences(token_frame(spark, [["t1", "t99"]]))
    found = {r["token"]: r for r in token_vector(rows, vocabulary(spark), 3).collect()}
    assert found["t99"]["token_index"] == -1 and list(found["t99"]["vector"]) == [0.0] * 3
    assert found["t1"]["token_index"] == 1 and list(found["t1"]["vector"]) == [1.5, -0.25, 0.5]


def test_only_token_arrays_are_shuffled_for_features(spark):
    plan = embed_windows(token_frame(spark, lists()), vocabulary(spark), CONFIG)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("BroadcastExchange") == 1


def test_indices_need_no_shuffle(spark):
    plan = index_samples(token_frame(spark, lists()), vocabulary(spark), CONFIG)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("MapInArrow") == 1


def test_indices_of_null_rows_and_numbers(spark):
    tokens = spark.createDataFrame([(0, None), (1, [5, 7, None, 6]), (2, [])], "doc_id long, tokens array<int>")
    vocab = spark.createDataFrame([(5, 1, [0.0]), (6, 0, [0.0])], "token int, token_index long, vector array<float>")
    rows = index_tokens(tokens, token_places(vocab)).collect()
    assert {r["doc_id"]: list(r["tokens"]) for r in rows} == {0: [], 1: [1, -1, -1, 0], 2: []}
    assert token_places(vocab, limit=0) is None


def test_feature_length_is_checked(spark):
    short = spark.createDataFrame([("t0", 0, [1.0])], "token string, token_index long, vector array<float>")
    with pytest.raises(Exception, match="vector is not of length 3"):
        embed_windows(token_frame(spark, [["t0"] * 5]), short, CONFIG).collect()


def test_one_hot(spark):
    frame = spark.createDataFrame([(0,), (3,), (-1,), (4,)], "target_index long")
    rows = {r["target_index"]: list(r["label"]) for r in one_hot_labels(frame, 4).collect()}
    assert rows == {0: [1, 0, 0, 0], 3: [0, 0, 0, 1], -1: [0] * 4, 4: [0] * 4}


def test_sparse_labels_are_the_dense_ones(spark):
    """Nine million classes: a dense label alone would have 36 MB."""
    frame = spark.createDataFrame([(k,) for k in (-1, 0, 2, 3, 4, None)], "target_index long")
    for r in one_hot_labels(one_hot_labels(frame, 4).withColumnRenamed("label", "dense"), 4, sparse=True).collect():
        cells = [0.0] * r["label"]["size"]
        for place, value in zip(r["label"]["indices"], r["label"]["values"], strict=True):
            cells[place] = value
        assert cells == list(r["dense"])
    many = spark.range(9_000_000 - 1000, 9_000_000 + 1000).withColumnRenamed("id", "target_index")
    labels = one_hot_labels(many, 9_000_000, sparse=True).agg(F.sum(F.size("label.indices")), F.max("label.indices"))
    assert labels.first()[:2] == (1000, [8_999_999])


def skewed(spark):
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 500)).alias("token")
    )


def test_lookup_by_shuffle_equals_broadcast(spark):
    table = spark.createDataFrame([("hot", 1), ("w5", 2), ("w7", 3), ("unused", 4)], "token string, n long")
    small = lookup(skewed(spark), table, "token").collect()
    large = lookup(skewed(spark), table, "token", limit=0).collect()
    assert sorted(map(str, small)) == sorted(map(str, large))
    assert len(large) == 3000


def test_heavy_keys_are_the_frequent_ones(spark):
    assert [r["token"] for r in heavy_keys(skewed(spark), "token", most=10).collect()] == ["hot"]


def test_missing_keys_survive_a_shuffled_lookup(spark):
    rows = spark.createDataFrame([(1, None), (2, "a")], "id long, token string")
    table = spark.createDataFrame([("a", 5)], "token string, token_index long")
    found = {r["id"]: r["token_index"] for r in token_index(rows, table, limit=0).collect()}
    assert found == {1: -1, 2: 5}


def test_vocabulary_order_and_vectors(spark):
    tokens = token_frame(spark, [["b", "a", "b"], ["c", "a", "b", "d"]])
    index = vocab_index(token_counts(tokens))
    assert [(r["token"], r["n"]) for r in index.orderBy("token_index").collect()] == [
        ("b", 3), ("a", 2), ("c", 1), ("d", 1),
    ]
    vectors = spark.createDataFrame([(1, [1.0]), (0, [0.0])], "vec_id long, embedding array<float>")
    rows = attach_vectors(index, vectors).collect()
    assert sorted((r["token"], r["token_index"], list(r["vector"])) for r in rows) == [("a", 1, [1.0]), ("b", 0, [0.0])]


def test_last_row_wins(spark):
    rows = spark.createDataFrame([("x", 0, "old"), ("y", 1, "only"), ("x", 2, "new")], "token string, n long, v string")
    assert sorted(map(tuple, last_row_wins(rows, "token", "n").collect())) == [("x", 2, "new"), ("y", 1, "only")]


def test_vocabulary_by_id_decodes_each_id_once(spark):
    pieces = spark.createDataFrame([(0, "!"), (5, "t1"), (6, "zz"), (7, "t1")], "id int, piece string")
    rows = vocab_by_id(vocabulary(spark), pieces).collect()
    assert sorted((r["token"], r["token_index"]) for r in rows) == [(5, 1), (7, 1)]


def test_beyond_the_bound_no_vector_is_exchanged_for_an_occurrence(spark):
    """Indices are exchanged for occurrences; vectors only for the distinct tokens of a segment."""
    tokens = token_frame(spark, [[f"t{(i * i + d) % 5}" for i in range(300)] for d in range(3)] + [[], ["t1"], ["none"] * 9])
    vocab = spark.createDataFrame(
        [(f"t{i}", i, [float(i + j) for j in range(4)]) for i in range(4)], "token string, token_index long, vector array<float>"
    )
    config = WindowConfig(window_size=3, stride=2, embedding_dim=4)
    small, large = embed_windows(tokens, vocab, config), embed_windows(tokens, vocab, config, limit=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    # Where vectors meet their keys, rows are (segment, distinct index); arrays by position hold indices only.
    assert "array_distinct(" in plan and plan.index("array_distinct(") > plan.index("map_from_entries(")
    assert not [line for line in plan.splitlines() if "collect_list(struct(pos" in line and "vector" in line]


def plain_digest(row):
    micro = [math.floor(np.float64(np.float32(v)) * 1000000 + 0.5) for v in row]
    return len(row), sum(micro), sum((k + 1) * m for k, m in enumerate(micro))


def test_digests_hold_a_part_of_the_batch():
    """Exact for small and large values and mixed sizes, with memory for some rows and not for the batch."""
    rng = np.random.default_rng(2)
    lists = [[], [0.5, -0.25], [1e5] * 3, rng.normal(size=1280).tolist(), (rng.normal(size=1280) * 1e6).tolist(), None, [3.0]]
    found = digest_lists(pa.array(lists, pa.list_(pa.float32()))).to_pylist()
    assert [tuple(r.values()) for r in found] == [plain_digest(row or []) for row in lists]
    wide = pa.FixedSizeListArray.from_arrays(pa.array(rng.normal(size=2_560_000).astype(np.float32)), 1280).cast(pa.list_(pa.float32()))
    tracemalloc.start()
    digests = digest_lists(wide)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5_000_000  # 20 MB for the batch in doubles
    assert tuple(digests[1999].as_py().values()) == plain_digest(wide[1999].as_py())


def test_a_summary_is_that_of_the_features(spark):
    tokens = token_frame(spark, [[f"t{(i * i + d) % 5}" for i in range(40)] for d in range(3)])
    rows = [(f"t{k}", k, [k + 0.5, float(-k), 0.25, 1.0]) for k in range(4)]
    vocab = spark.createDataFrame(rows, "token string, token_index long, vector array<float>")
    config = WindowConfig(window_size=3, embedding_dim=4, vocab_size=4)
    whole = {(r["doc_id"], r["window_no"]): r for r in training_samples(tokens, vocab, config).collect()}
    summed = training_samples(tokens, vocab, config, (digest_matrix, SCHEMA)).collect()
    assert len(summed) == len(whole) and "features" not in summed[0]
    for r in summed:
        same = whole[r["doc_id"], r["window_no"]]
        assert tuple(r["summary"]) == plain_digest(same["features"]) and r["target_index"] == same["target_index"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_token_places_equal_a_map(kind):
    tokens = ["a", "b", "a", "ü😀", "", "ab"]
    places = TokenPlaces(pa.array(tokens), np.arange(6))
    assert places.of(pa.array(["x", "a", None, "", "ab", "b", "ü😀", "abc", "x"], kind).slice(1, 7)).tolist() == [2, -1, 4, 5, 1, 3, -1]
    assert TokenPlaces(pa.array([], pa.string()), np.arange(0)).of(pa.array(["a", None], kind)).tolist() == [-1, -1]
    assert TokenPlaces(pa.array([7, 5, 7], pa.int32()), np.arange(3)).of(pa.array([5, 7, 6, None], pa.int32())).tolist() == [1, 2, -1, -1]


def test_token_places_with_equal_hashes(monkeypatch):
    monkeypatch.setattr("weftline.operators.lookup._hashes", lambda words: np.zeros(len(words), np.uint64))
    assert TokenPlaces(pa.array(["a", "b"]), np.arange(2)).of(pa.array(["b", "a", "c"])).tolist() == [1, 0, -1]
    assert TokenPlaces(pa.array(["a"]), np.arange(1)).of(pa.array(["b", "a", "c"])).tolist() == [-1, 0, -1]


def test_a_worker_makes_no_objects_of_a_vocabulary():
    places = TokenPlaces(pa.array([f"token {i}" for i in range(200_000)]), np.arange(200_000))
    tracemalloc.start()
    assert places.of(pa.array(["token 7", "token 199999", "token"])).tolist() == [7, 199_999, -1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000


@pytest.mark.parametrize("first", [0, 1, 3, 6])
def test_first_vectors_are_gathered_and_the_others_joined(spark, monkeypatch, first):
    """Whatever number of vectors the bound allows for, the rows are the same; those of a whole matrix meet no join."""
    tokens, vocab = token_frame(spark, [*lists(), ["none"] * 9, ["t5", "t0", "t4"] * 4]), vocabulary(spark)
    want = sorted(map(str, embed_windows(tokens, vocab, CONFIG).collect()))
    limit = 0 if not first else 4 * CONFIG.embedding_dim * (first + 1)  # bytes of the matrix with its zero row
    matrix, whole = first_vectors(vocab, CONFIG, limit)
    assert len(matrix) == first + 1 and whole == (first == 6)
    monkeypatch.setattr("weftline.operators.features.FEATURE_CELLS", 60)
    frame = embed_windows(tokens, vocab, CONFIG, limit)
    assert sorted(map(str, frame.collect())) == want
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert ("map_from_entries(" in plan) == (first < 6) and ("MapInArrow" in plan) == (first > 0)


def test_a_repeated_index_is_left_to_the_join(spark):
    vocab = vocabulary(spark, [("t9", 5, [1.0, 2.0, 3.0])])
    assert first_vectors(vocab, CONFIG)[0].shape == (1, 3) and not first_vectors(vocab, CONFIG)[1]


def test_positions_are_added_to_gathered_vectors(spark):
    """Beyond the bound for the table, within it for the bare vectors: rows with positions are those of the join."""
    tokens, vocab = token_frame(spark, [[f"t{(i * i + d) % 9}" for i in range(150)] for d in range(3)]), vocabulary(spark)
    limit = 4 * CONFIG.embedding_dim * 7
    want = add_positions(embed_windows(tokens, vocab, CONFIG), CONFIG)
    frame = add_positions(embed_windows(tokens, vocab, CONFIG, limit), CONFIG)
    assert sorted(map(str, frame.collect())) == sorted(map(str, want.collect()))
    assert "map_from_entries(" not in frame._jdf.queryExecution().optimizedPlan().toString()
