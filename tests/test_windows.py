import pytest
from pyspark.sql import functions as F

from helpers import token_frame, windows
from weftline.config import WindowConfig
from weftline.functions.arrays import window_count
from weftline.operators.windows import (
    pad_windows,
    segment_windows,
    segments,
    sliding_windows,
    window_counts,
    window_total,
)

SHAPES = [(20, 3), (4, 1), (4, 5), (4, 6), (3, 11), (1, 1), (1, 2)]


def lists_for(size, stride):
    edges = {0, 1, 2, size, size + 1, size + 2, size + 1 + stride, 2 * size + stride, 97}
    return [[f"t{i}" for i in range(n)] for n in sorted(edges)]


def rows_of(frame):
    return sorted((r["doc_id"], r["window_no"], list(r["input"]), r["target"]) for r in frame.collect())


def expected(lists, size, stride):
    return sorted(
        (key, k, window, target)
        for key, tokens in enumerate(lists)
        for k, (window, target) in enumerate(windows(tokens, size, stride))
    )


@pytest.mark.parametrize("size,stride", SHAPES)
def test_window_count_is_the_closed_form(spark, size, stride):
    counts = spark.range(90).select("id", window_count(F.col("id"), size, stride).alias("n")).collect()
    assert {r["id"]: r["n"] for r in counts} == {n: len(windows(list(range(n)), size, stride)) for n in range(90)}


@pytest.mark.parametrize("size,stride", SHAPES)
def test_sliding_windows(spark, size, stride):
    lists = lists_for(size, stride)
    config = WindowConfig(window_size=size, stride=stride)
    assert rows_of(sliding_windows(token_frame(spark, lists), config)) == expected(lists, size, stride)


@pytest.mark.parametrize("size,stride", SHAPES)
@pytest.mark.parametrize("per_segment", [1, 3, 64])
def test_segments_give_the_same_windows(spark, size, stride, per_segment):
    lists = lists_for(size, stride)
    config = WindowConfig(window_size=size, stride=stride, segment_windows=per_segment)
    parts = segments(token_frame(spark, lists), config)
    out = segment_windows(parts, config, "tokens").toDF("doc_id", "window_no", "input", "target")
    assert rows_of(out) == expected(lists, size, stride)
    longest = (per_segment - 1) * stride + size + 1
    assert parts.where(F.size("tokens") > longest).count() == 0


def test_padding_fills_the_end(spark):
    config = WindowConfig(window_size=4, stride=2, pad_token="0")
    padded = pad_windows(sliding_windows(token_frame(spark, [["a"], ["a", "b", "c"]]), config), config)
    assert rows_of(padded) == [(0, 0, ["0"] * 4, "a"), (1, 0, ["a", "b", "0", "0"], "c")]


def test_numeric_tokens_keep_their_type(spark):
    config = WindowConfig(window_size=3, stride=2, pad_token="0")
    padded = pad_windows(sliding_windows(token_frame(spark, [[305, 130]], "int"), config), config)
    assert rows_of(padded) == [(0, 0, [305, 0, 0], 130)]


def test_counts_agree_with_the_windows(spark):
    lists = lists_for(20, 3)
    config = WindowConfig()
    frame = token_frame(spark, lists)
    counts = {r["doc_id"]: (r["n_tokens"], r["n_windows"]) for r in window_counts(frame, config).collect()}
    assert counts == {k: (len(t), len(windows(t, 20, 3))) for k, t in enumerate(lists)}
    assert window_total(frame, config).first()[0] == sliding_windows(frame, config).count()


def test_every_token_is_covered(spark):
    config = WindowConfig(window_size=5, stride=6)
    frame = token_frame(spark, [[f"t{i}" for i in range(100)]])
    rows = sliding_windows(frame, config).collect()
    assert {t for r in rows for t in [*r["input"], r["target"]]} == {f"t{i}" for i in range(100)}


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partitioning_does_not_matter(spark, parts):
    lists = lists_for(20, 3)
    out = sliding_windows(token_frame(spark, lists).repartition(parts), WindowConfig())
    assert rows_of(out) == expected(lists, 20, 3)


def test_windows_need_no_shuffle(spark):
    plan = sliding_windows(token_frame(spark, lists_for(20, 3)), WindowConfig())
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_bad_settings_are_refused():
    with pytest.raises(ValueError):
        WindowConfig(stride=0)
    with pytest.raises(ValueError):
        WindowConfig(positional="learned")
