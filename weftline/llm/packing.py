"""Bounded-space online packing of token ids into sequences of one length.

Each partition keeps a fixed number of open windows. A piece goes to the window that it fills best; when none has
room, the fullest is closed. What is left open at the end of all partitions is merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import record_batch, share, text_slices
from weftline.llm.tokens import encoder
from weftline.session import fits_broadcast, materialize

CAPACITY = 2048
OPEN_WINDOWS = 16
#: A window that is closed with this much room or more takes the head of the next piece first.
LEAST_CUT = 32
#: Leftover windows that one merging task takes (2,048 ids of 4 bytes each: 32 MB).
MERGE_WINDOWS = 4096

_SLICE = 1 << 20
_ROW_BYTES = 64
_SCHEMA = "part int, seq long, open boolean, doc_id long, start long, length long, doc_tokens long, offset long, ids binary"


class _Packer:
    """The open windows of one partition. A window is its fill and its pieces; a closed one gets the next number."""

    def __init__(self, capacity: int, open_windows: int, least_cut: int):
        self.capacity, self.most, self.least_cut = capacity, open_windows, least_cut
        self.windows: list[list] = []
        self.closed = 0
        self.rows: list[tuple] = []

    def _emit(self, window: list, number: int, is_open: bool) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in window[1]:
            self.rows.append((number, is_open, doc_id, start, len(ids), doc_tokens, offset, ids.tobytes()))
            offset += len(ids)

    def _close(self, window: list) -> None:
        self._emit(window, self.closed, False)
        self.closed += 1

    def _fill(self, window: list, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        window[0] += len(ids)
        window[1].append((doc_id, start, ids, doc_tokens))

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids) >= self.capacity:
            self._close([self.capacity, [(doc_id, start, ids[: self.capacity], doc_tokens)]])
            start, ids = start + self.capacity, ids[self.capacity :]
        while len(ids):
            fitting = [w for w in self.windows if w[0] + len(ids) <= self.capacity]
            if fitting:
                window = max(fitting, key=lambda w: w[0])
                self._fill(window, doc_id, start, ids, doc_tokens)
                if window[0] == self.capacity:
                    self.windows.remove(window)
                    self._close(window)
                return
            if len(self.windows) < self.most:
                self.windows.append([len(ids), [(doc_id, start, ids, doc_tokens)]])
                return
            fullest = max(self.windows, key=lambda w: w[0])
            room = self.capacity - fullest[0]
            if room >= self.least_cut:
                self._fill(fullest, doc_id, start, ids[:room], doc_tokens)
                start, ids = start + room, ids[room:]
            self.windows.remove(fullest)
            self._close(fullest)

    def pour(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        """Fill one window to the brim, cutting pieces: used for merging."""
        while len(ids):
            if not self.windows:
                self.windows.append([0, []])
            room = self.capacity - self.windows[0][0]
            self._fill(self.windows[0], doc_id, start, ids[:room], doc_tokens)
            start, ids = start + room, ids[room:]
            if self.windows[0][0] == self.capacity:
                self._close(self.windows.pop())

    def leave(self) -> None:
        for number, window in enumerate(self.windows):
            self._emit(window, number, True)
        self.windows = []

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        part = TaskContext.get().partitionId()
        columns = list(zip(*self.rows, strict=True)) or [()] * (len(schema) - 1)
        self.rows = []
        return record_batch(schema, [part] * len(columns[0]), *map(list, columns))


_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int64()), ("open", pa.bool_()), ("doc_id", pa.int64()), ("start", pa.int64()),
    ("length", pa.int64()), ("doc_tokens", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def pack(
    documents: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    `documents` has doc_id and text; other columns are not read, whatever their names. A null text is empty and
    gives the end id alone; a null doc_id stays null; each row is a document of its own, also when rows repeat. A
    long text is cut into whole sequences and a rest. No rows give no pieces. `ids` are little-endian unsigned
    32-bit; sequences are numbered from 0 without gaps, and only the last merged one may be far from full. Every
    round of merging is written to the shared folder, so lost executors repeat their own tasks only.
    """
    spark = documents.sparkSession
    text = share(spark, vocabulary)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, codec = _Packer(capacity, open_windows, least_cut), encoder(text.value)
        for batch in text_slices(batches, "text", _SLICE):
            ids, bounds = codec.encode(batch.column(1), end_id)
            for doc_id, low, high in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                packer.add(doc_id, 0, ids[low:high], high - low)
            # Pieces that stay open are copied, or they would hold the whole slice.
            for window in packer.windows:
                window[1][:] = [(d, s, np.array(i) if i.base is ids else i, n) for d, s, i, n in window[1]]
            yield packer.batch(_ARROW)
        packer.leave()
        yield packer.batch(_ARROW)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(capacity, 1, 0)
        for batch in batches:
            columns = [batch.column(_ARROW.get_field_index(n)).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens")]
            for doc_id, start, ids, doc_tokens in zip(*columns, strict=True):
                packer.pour(doc_id, start, np.frombuffer(ids, "<u4"), doc_tokens)
            yield packer.batch(_ARROW)
        packer.leave()
        yield packer.batch(_ARROW)

    packed = documents.select("doc_id", "text").mapInArrow(first, _SCHEMA)
    rounds = [materialize(packed.withColumn("round", F.lit(0)), "packed")]
    while True:
        left = rounds[-1].filter("open")
        windows = left.agg(F.count_if(F.col("offset") == 0)).first()[0]
        if windows <= 1:
            break
        tasks = -(-windows // MERGE_WINDOWS)
        dealt = left.repartition(tasks) if tasks == 1 else left.repartition(tasks, "part")
        merged = dealt.drop("round").sortWithinPartitions("part", "seq", "offset").mapInArrow(merge, _SCHEMA)
        rounds.append(materialize(merged.withColumn("round", F.lit(len(rounds))), "merged"))
    # The single window that stays open in the last round is closed as it is.
    pieces = rounds[-1].withColumn("seq", F.when(F.col("open"), F.lit(None)).otherwise(F.col("seq")))
    for earlier in rounds[:-1]:
        pieces = pieces.unionByName(earlier.filter(~F.col("open")))
    return _numbered(pieces)


def _numbered(pieces: DataFrame) -> DataFrame:
    """Sequence numbers without gaps: those of a task follow on those of the tasks before it."""
    keys = ["round", "part", "open"]
    counts = pieces.groupBy(*keys).agg((F.coalesce(F.max("seq"), F.lit(0)) + 1).alias("_count"))  # one row for each task
    counts = materialize(counts, "pack-counts")
    order = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*keys, F.coalesce(F.sum("_count").over(order), F.lit(0)).alias("_first"))
    if fits_broadcast(counts.count() * _ROW_BYTES):
        first = F.broadcast(first)
    number = F.col("_first") + F.coalesce("seq", F.lit(0))
    return pieces.join(first, keys).select("doc_id", "start", "length", "doc_tokens", number.alias("sequence_id"), "offset", "ids")
