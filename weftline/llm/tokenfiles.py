"""Token ids in binary files: one zstandard frame for each document, a shared dictionary, an index of offsets.

A file holds, in this order: the 8 bytes of `MAGIC`, the SHA-256 of the dictionary (32 bytes), the frames, the index
(for each document: doc_id int64, whether it is there uint8, place uint64, bytes uint32, ids uint32), the number of
documents uint64, the place of the index uint64, the width of an id uint8, and `MAGIC` again; all little-endian. The dictionary
lies beside the files under the name of its hash. One document is read with the end of the file, its entry and its frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import record_batch, share, text_slices
from weftline.llm.tokens import encoder
from weftline.session import materialize, scratch_path, shuffle_partitions

MAGIC = b"WEFTTOK1"
INDEX = np.dtype([("doc_id", "<i8"), ("given", "u1"), ("place", "<u8"), ("size", "<u4"), ("count", "<u4")])
_TAIL = "<QQB"
_HEAD = len(MAGIC) + 32

#: The dictionary is trained on so many documents, of at most so many bytes of text each; it changes sizes, never ids.
SAMPLE_DOCUMENTS = 1024
SAMPLE_TEXT_BYTES = 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3

_SLICE = 1 << 20
_READ = 4 << 20


def _open(folder: str):
    """The file system of a folder and its path there; any scheme that Arrow knows."""
    if "://" in folder or folder.startswith("file:"):
        folder = folder.replace("file:///", "/", 1) if folder.startswith("file:///") else folder.removeprefix("file:")
    if "://" in folder:
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


def serialized(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def train_dictionary(documents: DataFrame, text, end_id: int, width: int) -> bytes:
    """A dictionary from the ids of the documents with the smallest hashes of their ids; empty if they don't suffice."""
    short = F.octet_length("text") <= SAMPLE_TEXT_BYTES
    chosen = documents.filter(short & F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = sorted({row[0] for row in chosen.limit(SAMPLE_DOCUMENTS).collect()})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])
        for batch in text_slices(batches, "text", _SLICE):
            flat, bounds = encoder(text.value).encode(batch.column(1), end_id)
            pieces = [serialized(flat[a:b], width) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield record_batch(schema, batch.column(0), pieces)

    sample = documents.filter(F.col("doc_id").isin(ids) & short).select("doc_id", "text")
    rows = sorted(tuple(r) for r in sample.mapInArrow(encode, "doc_id long, data binary").limit(2 * SAMPLE_DOCUMENTS).collect())
    samples = [bytes(data) for _, data in rows]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 4), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_token_files(
    documents: DataFrame, vocabulary: str, end_id: int = 1, folder: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the manifest: path, part, documents, ids, bytes, first_id.

    `documents` has doc_id and text; other columns are not read. A null text is empty and gives the end id alone. A null
    doc_id comes first and stays null; rows that share a doc_id are kept, in the order of their texts' hashes. No rows
    give no file. A task writes under a name of its own attempt and only names in the manifest count, so a repeated
    task leaves at most a file that nothing refers to. `first_id` is the number of ids in all files before.
    """
    spark = documents.sparkSession
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_str(vocabulary).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    text = share(spark, vocabulary)
    folder = folder or scratch_path(spark, "token-files")
    trained = share(spark, train_dictionary(documents, text, end_id, width))
    digest = hashlib.sha256(trained.value).digest()
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/{digest.hex()}.dict") as out:
        out.write(trained.value)
    schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, context = encoder(text.value), TaskContext.get()
        kind = zstandard.ZstdCompressionDict(trained.value) if trained.value else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=kind)
        files, top = _open(folder)
        name = f"part-{context.partitionId():06d}-{context.attemptNumber()}-{uuid.uuid4().hex[:12]}.tok"
        entries, place, total, out = [], _HEAD, 0, None
        for batch in text_slices(batches, "text", _SLICE):
            if out is None:
                out = files.open_output_stream(f"{top}/{name}")
                out.write(MAGIC + digest)
            ids, bounds = codec.encode(batch.column(1), end_id)
            packed = serialized(ids, width)
            index = np.zeros(batch.num_rows, INDEX)
            keys = batch.column(0)
            index["doc_id"] = keys.fill_null(0).to_numpy()
            index["given"] = keys.is_valid().to_numpy(zero_copy_only=False)
            index["count"] = np.diff(bounds)
            frames = [press.compress(packed[a * width : b * width]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            index["size"] = [len(f) for f in frames]
            index["place"] = place + np.cumsum(index["size"], dtype=np.uint64) - index["size"]
            out.write(b"".join(frames))
            place += int(index["size"].sum(dtype=np.int64))
            total += len(ids)
            entries.append(index)
        if out is not None:
            index = np.concatenate(entries)
            out.write(index.tobytes() + struct.pack(_TAIL, len(index), place, width) + MAGIC)
            out.close()
            size = place + index.nbytes + struct.calcsize(_TAIL) + len(MAGIC)
            yield record_batch(schema, [name], [context.partitionId()], [len(index)], [total], [size])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = documents.select("doc_id", "text").repartitionByRange(partitions or shuffle_partitions(spark), *order)
    written = ordered.sortWithinPartitions(*order).mapInArrow(write, "path string, part int, documents long, ids long, bytes long")
    manifest = materialize(written, "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    manifest = manifest.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return manifest.withColumn("path", F.concat(F.lit(folder + "/"), "path"))


@lru_cache(maxsize=2)
def _dictionary(folder: str, digest: str):
    files, top = _open(folder)
    with files.open_input_stream(f"{top}/{digest}.dict") as source:
        data = source.read()
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"the dictionary in {folder} is not the one the files were written with")
    return zstandard.ZstdCompressionDict(data) if data else None


class TokenFile:
    """A file of ids, open for reading."""

    def __init__(self, path: str):
        folder = path.rsplit("/", 1)[0]
        files, place = _open(path)
        self.file = files.open_input_file(place)
        size, tail = self.file.size(), struct.calcsize(_TAIL) + len(MAGIC)
        end = self.file.read_at(tail, size - tail)
        head = self.file.read_at(_HEAD, 0)
        if end[-len(MAGIC) :] != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        count, place, self.width = struct.unpack(_TAIL, end[: -len(MAGIC)])
        self.index = np.frombuffer(self.file.read_at(count * INDEX.itemsize, place), INDEX)
        self.unpress = zstandard.ZstdDecompressor(dict_data=_dictionary(folder, head[len(MAGIC) :].hex()))

    def _ids(self, frame: bytes, count: int) -> np.ndarray:
        data = self.unpress.decompress(frame, max_output_size=max(1, int(count)) * self.width)
        return np.frombuffer(data, "<u2" if self.width == 2 else "<u4").astype("<u4")

    def document(self, number: int) -> np.ndarray:
        """The ids of one document: one read of its frame alone."""
        entry = self.index[number]
        return self._ids(self.file.read_at(int(entry["size"]), int(entry["place"])), entry["count"])

    def runs(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """All documents in order, read in runs of some megabytes: the number of the first one, and their ids."""
        ends = (self.index["place"] + self.index["size"]).astype(np.int64)
        low = 0
        while low < len(self.index):
            base = int(self.index["place"][low])
            high = max(low + 1, int(np.searchsorted(ends, base + _READ, side="right")))
            data = self.file.read_at(int(ends[high - 1]) - base, base)
            yield low, [
                self._ids(data[int(e["place"]) - base : int(e["place"]) - base + int(e["size"])], e["count"])
                for e in self.index[low:high]
            ]
            low = high


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids of all documents: one task for each file; `start` counts the ids before the document."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(path)
                for first, arrays in file.runs():
                    entries = file.index[first : first + len(arrays)]
                    counts = np.array([len(a) for a in arrays], np.int64)
                    ends = start + np.cumsum(counts)
                    keys = pa.array(entries["doc_id"].astype(np.int64), mask=entries["given"] == 0)
                    yield record_batch(schema, keys, ends - counts, counts, [a.tobytes() for a in arrays])
                    start = int(ends[-1])

    files = manifest.select("path", "first_id")
    return files.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, manifest: DataFrame, doc_id: int) -> list[int] | None:
    """The ids of one document, looked up by the index of the files (the first of rows that share the id)."""
    for row in manifest.select("path").orderBy("part").toLocalIterator():
        file = TokenFile(row[0])
        found = np.flatnonzero((file.index["doc_id"] == doc_id) & (file.index["given"] == 1))
        if len(found):
            return file.document(int(found[0])).tolist()
    return None
