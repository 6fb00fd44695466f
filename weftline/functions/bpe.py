"""Byte-pair encoding of word arrays with a public rank file."""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import bound_batches, share

# Fixed value: the pattern that splits a text before the merges of the installed rank files.
DEFAULT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words whose ids are gathered at a time.
GATHERED = 1 << 16


def _parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, data.splitlines())}


@lru_cache(maxsize=4)
def _encoding(data: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_parse_ranks(data), special_tokens={})


@lru_cache(maxsize=4)
def _pieces(data: bytes) -> dict[int, bytes]:
    return {rank: piece for piece, rank in _parse_ranks(data).items()}


@lru_cache(maxsize=4)
def _piece_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces in a row, and the start and size of each id (size -1: no such id)."""
    pieces = _pieces(data)
    sizes = np.full(max(pieces, default=-1) + 1, -1, np.int64)
    for rank, piece in pieces.items():
        sizes[rank] = len(piece)
    flat = np.frombuffer(b"".join(pieces[rank] for rank in sorted(pieces)), np.uint8)
    lengths = np.maximum(sizes, 0)
    return flat, np.cumsum(lengths) - lengths, sizes


def decode_lists(ids: pa.Array, data: bytes) -> pa.Array:
    """list<int> to string: the bytes of all pieces are gathered at once; undecodable ones become U+FFFD."""
    flat, starts, sizes = _piece_bytes(data)
    codes = ids.flatten().to_numpy()
    if len(codes) and (codes.min() < 0 or codes.max() >= len(sizes) or (sizes[codes] < 0).any()):
        raise ValueError("an id is not in the rank file")
    ends = np.concatenate([[0], np.cumsum(sizes[codes])]).astype(np.int64)
    content = flat[np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], sizes[codes])]
    bounds = ids.offsets.to_numpy()
    buffers = pa.py_buffer(ends[bounds - bounds[0]]), pa.py_buffer(content)
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, *buffers])
    try:
        return rows.cast(pa.string())
    except pa.ArrowInvalid:  # some row is cut inside a character
        return pa.array([row.decode("utf-8", "replace") for row in rows.to_pylist()], pa.string())


def encode_lists(tokens: pa.Array, encode) -> pa.Array:
    """list<string> to list<int>: each distinct word of the batch is encoded once, and ids are gathered for some words at a time."""
    distinct = tokens.flatten().dictionary_encode()
    pieces, sizes = array("i"), np.empty(len(distinct.dictionary), np.int64)
    for place, word in enumerate(distinct.dictionary):
        ids = encode(word.as_py())
        sizes[place] = len(ids)
        pieces.extend(ids)
    flat = np.frombuffer(pieces, np.int32) if pieces else np.empty(0, np.int32)
    starts = np.cumsum(sizes) - sizes
    codes = distinct.indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])
    out = np.empty(ends[-1], np.int32)
    for low in range(0, len(codes), GATHERED):
        part = codes[low : low + GATHERED]
        begin, end = ends[low], ends[low + len(part)]
        shift = starts[part] - ends[low : low + len(part)]
        out[begin:end] = flat[np.arange(begin, end) + np.repeat(shift, sizes[part])]
    bounds = tokens.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(ends[bounds - bounds[0]], pa.int32()), pa.array(out, pa.int32()))


class BpeVocabulary:
    """A rank file (base64 piece and rank per line) and its split pattern.

    The file has a fixed size of some hundred kilobytes; executors get it by broadcast.
    """

    def __init__(self, data: bytes, pattern: str):
        self.data = data
        self.pattern = pattern

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BpeVocabulary:
        """A rank file and the pattern it was made for: with another one texts get other ids."""
        with open(path, "rb") as ranks:
            return cls(ranks.read(), pattern)

    @classmethod
    def installed(cls) -> BpeVocabulary:
        import public_tokenizers

        return cls.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), DEFAULT_PATTERN)

    def encoder(self, spark: SparkSession):
        shared = share(spark, self.data)
        bound_batches(spark)
        pattern = self.pattern

        @F.arrow_udf("array<int>")
        def encode(tokens: pa.Array) -> pa.Array:
            return encode_lists(tokens, _encoding(shared.value, pattern).encode_ordinary)

        return encode

    def decoder(self, spark: SparkSession):
        shared = share(spark, self.data)
        bound_batches(spark)

        @F.arrow_udf("string")
        def decode(ids: pa.Array) -> pa.Array:
            return decode_lists(ids, shared.value)

        return decode

    def table(self, spark: SparkSession) -> DataFrame:
        """id, piece: the decoding of every id; undecodable bytes become U+FFFD."""
        pieces = _pieces(self.data)
        rows = pa.table(
            {
                "id": pa.array(pieces.keys(), pa.int32()),
                "piece": pa.array([piece.decode("utf-8", "replace") for piece in pieces.values()], pa.string()),
            }
        )
        return spark.createDataFrame(rows)

    def sizes(self, spark: SparkSession) -> DataFrame:
        """id, n_bytes: the length of every piece."""
        pieces = _pieces(self.data)
        ids, lengths = pa.array(pieces.keys(), pa.int32()), pa.array(map(len, pieces.values()), pa.int64())
        return spark.createDataFrame(pa.table({"id": ids, "n_bytes": lengths}))
