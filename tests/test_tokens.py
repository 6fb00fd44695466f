import base64
import tracemalloc

import pyarrow as pa
import pytest

from helpers import windows
from weftline.config import WindowConfig
from weftline.functions.bpe import BpeVocabulary, _encoding, decode_lists, encode_lists
from weftline.operators.tokens import (
    bpe_tokens,
    decode_bpe,
    string_to_tokens,
    token_occurrences,
    tokens_to_string,
    word_tokens,
)
from weftline.plans.catalog import QUERIES

TEXTS = ["hello world", "  two  spaces ", "", " ", "a\nb c", "naïve Größe 日本語 🙂", "it's 1234 go!"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_words_split_on_the_space_only(spark):
    rows = {r["doc_id"]: list(r["tokens"]) for r in word_tokens(texts(spark)).collect()}
    assert rows == {i: [w for w in t.split(" ") if w] for i, t in enumerate(TEXTS)}
    assert rows[4] == ["a\nb", "c"]


def test_occurrences_and_strings(spark):
    tokens = word_tokens(texts(spark))
    assert token_occurrences(tokens).count() == sum(len([w for w in t.split(" ") if w]) for t in TEXTS)
    back = string_to_tokens(tokens_to_string(tokens))
    assert sorted(map(str, back.collect())) == sorted(map(str, tokens.collect()))


def test_bpe_ids_equal_encoding_each_word(spark):
    bpe = BpeVocabulary.installed()
    encode = _encoding(bpe.data, bpe.pattern).encode_ordinary
    rows = {r["doc_id"]: list(r["tokens"]) for r in bpe_tokens(texts(spark), bpe).collect()}
    assert rows == {i: [id_ for w in t.split(" ") if w for id_ in encode(w)] for i, t in enumerate(TEXTS)}
    assert all(isinstance(id_, int) for ids in rows.values() for id_ in ids)


def test_bpe_decode_restores_multi_byte_text(spark):
    bpe = BpeVocabulary.installed()
    rows = {r["doc_id"]: r["text"] for r in decode_bpe(bpe_tokens(texts(spark), bpe), bpe).collect()}
    assert rows == {i: t.replace(" ", "") for i, t in enumerate(TEXTS)}


def test_piece_table_has_every_id_and_marks_partial_characters(spark):
    table = BpeVocabulary.installed().table(spark)
    assert table.count() == table.select("id").distinct().count() == 50256
    assert table.where("id = 0").first()["piece"] == "!"
    assert table.where("contains(piece, '�')").count() > 0


def test_encode_lists_of_a_sliced_array():
    lists = pa.array([["a"], ["bb", "a"], [], ["ccc"]]).slice(1)
    assert encode_lists(lists, lambda w: [len(w)] * len(w)).to_pylist() == [[2, 2, 1], [], [3, 3, 3]]
    assert encode_lists(lists.slice(1, 1), lambda w: [1]).to_pylist() == [[]]


def test_bpe_windows_query_against_loops(spark, folder):
    bpe = BpeVocabulary.installed()
    encode = _encoding(bpe.data, bpe.pattern).encode_ordinary
    config = WindowConfig()
    got = {(r["doc_id"], r["group_id"], r["window_no"]): (r["input"], r["target"])
           for r in QUERIES["bpe_windows"](spark, folder).collect()}
    want = {}
    for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        lines = row["text"].split("\n")
        for group in range(-(-len(lines) // 10)):
            text = "\n".join(lines[group * 10 : group * 10 + 10])
            ids = [id_ for word in text.split(" ") if word for id_ in encode(word)]
            for k, (window, target) in enumerate(windows(ids, config.window_size, config.stride)):
                padded = window + [0] * (config.window_size - len(window))
                want[row["doc_id"], group, k] = (" ".join(map(str, padded)), target)
    assert got == want


def test_decoding_gathers_pieces_and_replaces_cut_characters():
    data = b"\n".join(base64.b64encode(piece) + b" %d" % rank for rank, piece in enumerate([b"a", b"\xc3", b"\xa9", b"bc"]))
    ids = pa.array([[0, 1, 2], [], [1, 3], [3, 0]], pa.list_(pa.int32()))
    assert decode_lists(ids, data).to_pylist() == ["a\u00e9", "", "\ufffdbc", "bca"]
    assert decode_lists(ids.slice(3), data).to_pylist() == ["bca"]
    with pytest.raises(ValueError):
        decode_lists(pa.array([[4]], pa.list_(pa.int32())), data)


def test_ids_are_gathered_in_pieces():
    """Many words of many ids: what is held beside the result doesn't grow with them."""
    lists = pa.array([["long", "x"] * 500] * 400)
    tracemalloc.start()
    found = encode_lists(lists, lambda word: list(range(len(word) * 4)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == [[*range(16), *range(4)] * 500] * 400
    assert peak < 60_000_000  # the result has 16 MB, codes and ends 5 MB


def test_token_arrays_come_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        BpeVocabulary.installed().encoder(spark)
        assert spark.conf.get(name) == str(4 << 20)
        spark.conf.set(name, 12345)
        BpeVocabulary.installed().decoder(spark)
        assert spark.conf.get(name) == "12345"
    finally:
        spark.conf.set(name, before)
