"""Left outer lookup of token occurrences in a token table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import bound_batches, fits_broadcast, materialize, row_bytes, share, table_bytes

#: A key is heavy when it makes up more than 1 / HEAVY_KEYS of all rows, so that fewer
#: than HEAVY_KEYS keys can be heavy.
HEAVY_KEYS = 100_000
#: Bytes of the table rows of all heavy keys; wide rows allow for fewer keys.
HEAVY_BYTES = 64 << 20
#: Words that are hashed at a time.
HASHED = 1 << 14
_BASE = np.uint64(0x2545F4914F6CDD1D)


def lookup(rows: DataFrame, table: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Every row of `rows` once, with the columns of `table` for its key or nulls.

    `table` has unique keys. Its size is measured: a table within the broadcast bound is
    broadcast, so `rows` keeps its partitioning. A larger one is joined by a shuffle, but
    for the rows of heavy keys, which meet the few matching table rows by broadcast.
    """
    size = table_bytes(table)
    if fits_broadcast(size, limit):
        return rows.join(F.broadcast(table), key, "left")
    widest = table.agg(F.max(row_bytes(table))).first()[0] or 1
    most = max(2, min(HEAVY_KEYS, HEAVY_BYTES // widest))
    heavy = F.broadcast(heavy_keys(rows, key, most))
    heavy_table = F.broadcast(table.join(heavy, key, "left_semi"))
    hot = rows.join(heavy, key, "left_semi").join(heavy_table, key, "left")
    tail = rows.join(heavy, key, "left_anti").join(table.hint("merge"), key, "left")
    return hot.unionByName(tail)


def heavy_keys(rows: DataFrame, key: str, most: int = HEAVY_KEYS) -> DataFrame:
    """Keys with more than 1 / most of all rows; counted with map-side combine."""
    counts = materialize(rows.where(F.col(key).isNotNull()).groupBy(key).count(), "key-counts")
    total = counts.agg(F.sum("count")).scalar()
    return counts.where(F.col("count") * most > total).select(key)


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, some words at a time."""
    out = np.empty(len(words), np.uint64)
    for low in range(0, len(words), HASHED):
        part = words.slice(low, HASHED).cast(pa.large_binary())
        _, offsets, data = part.buffers()
        bounds = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
        content = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.empty(0, np.uint8)
        sizes, ends = np.diff(bounds), bounds - bounds[0]
        powers = np.cumprod(np.full(sizes.max(initial=0) + 1, _BASE))
        place = np.arange(len(content)) - np.repeat(ends[:-1], sizes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((content + np.uint64(1)) * powers[place])])
        found = sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(np.uint64)
        found ^= found >> np.uint64(32)
        out[low : low + len(part)] = found * _BASE
    return out


class TokenPlaces:
    """The tokens of a vocabulary with their indices, as flat arrays: no worker makes objects of the tokens.

    Words are found by their hash and then compared; where two tokens have one hash, and for numbers, Arrow finds them.
    """

    def __init__(self, tokens: pa.Array, index: np.ndarray):
        # Of equal tokens the last one counts, and a lookup finds the first.
        self.tokens, self.index, self.hashes = tokens[::-1], np.append(index[::-1], -1).astype(np.int32), None
        if len(tokens) and not tokens.null_count and pa.types.is_string(tokens.type):
            hashes = _hashes(self.tokens)
            self.order = np.argsort(hashes, kind="stable").astype(np.int32)
            hashes = hashes[self.order]
            again = np.flatnonzero(hashes[1:] == hashes[:-1])
            if pc.all(pc.equal(self.tokens.take(self.order[again]), self.tokens.take(self.order[again + 1])), min_count=0).as_py():
                self.hashes = hashes

    def _places(self, words: pa.Array) -> np.ndarray:
        if self.hashes is None or words.type != self.tokens.type:
            found = pc.index_in(words, self.tokens.cast(words.type), skip_nulls=True)
            return found.fill_null(len(self.tokens)).to_numpy()
        at = np.searchsorted(self.hashes, _hashes(words))
        places = self.order[np.minimum(at, len(self.hashes) - 1)]
        same = pc.equal(self.tokens.take(places), words).to_numpy(zero_copy_only=False)
        return np.where(same, places, len(self.tokens))

    def of(self, values: pa.Array) -> np.ndarray:
        """The index of each value, -1 when it is missing."""
        distinct = values.dictionary_encode()
        found = np.append(self.index[self._places(distinct.dictionary)], np.int32(-1))
        return found[distinct.indices.fill_null(len(found) - 1).to_numpy()]


def token_places(vocab: DataFrame, limit: int | None = None) -> TokenPlaces | None:
    """The tokens and indices of a vocabulary, or None beyond the broadcast bound."""
    names = vocab.select("token", "token_index")
    if not fits_broadcast(table_bytes(names), limit):
        return None
    table = names.toArrow()
    return TokenPlaces(table["token"].combine_chunks(), table["token_index"].to_numpy())


def index_tokens(tokens: DataFrame, places: TokenPlaces) -> DataFrame:
    """Replace the tokens of each row by their indices (int), -1 when missing: a narrow plan."""
    shared = share(tokens.sparkSession, places)
    bound_batches(tokens.sparkSession)
    indices = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(f.name, indices if f.name == "tokens" else f.dataType) for f in tokens.schema])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            lists = columns["tokens"]
            bounds = lists.offsets.to_numpy()
            found = pa.array(shared.value.of(lists.flatten()), pa.int32())
            columns["tokens"] = pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), found)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return tokens.mapInArrow(task, schema)
