"""Order MinHash fingerprints of whole texts, sensitive to the order of their parts.

Each k-mer of code points is numbered by its occurrence in the text and hashed to h(x). For each of m independent hash
functions a_j * h(x) modulo 2^32, with fixed random odd a_j, the l numbered k-mers with the smallest values are selected
(of equal values the first in the text). They are put back in the order of the text, and hashed as a tuple. The share of equal
tuples of two texts estimates a likeness that falls with their edit distance, also when only the order changes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import U64, mix, numbers, record_batch, share
from weftline.session import shuffle_partitions

#: Ranges of doc_id for each shuffle partition; neighbours meet within a range.
RANGES_PER_PARTITION = 4
_MOST_RANGES = 20_000
#: k-mers that all functions see at a time.
_BLOCK = 1 << 12


def _place_bits(count: int) -> np.uint64:
    return U64(max(24, int(count).bit_length()))


def _sorted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The high bits of hashes in ascending order with their places in the low bits, and the places."""
    bits = _place_bits(len(hashes))
    order = np.sort((hashes >> bits << bits) | np.arange(len(hashes), dtype=U64))
    return order, (order & ((U64(1) << bits) - U64(1))).astype(np.int64)


@dataclass(frozen=True)
class OrderMinHash:
    """Parameters: k-mer length, selected k-mers, tuples, and the bits that are kept of a tuple's hash (16)."""

    k: int = 8
    select: int = 2
    tuples: int = 64

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The odd factors of the functions, and the weights of a tuple's places."""
        return (numbers(self.tuples, 101) >> U64(32)).astype(np.uint32) | np.uint32(1), numbers(self.select + 1, 303) | U64(1)

    def kmers(self, points: np.ndarray) -> np.ndarray:
        """A 64-bit hash of every k-mer; a text shorter than k is one k-mer, an empty one has none."""
        if not len(points):
            return np.empty(0, U64)
        k, base = min(self.k, len(points)), 0x9E3779B97F4A7C15
        out, power = np.zeros(len(points) - k + 1, U64), 1
        done, wide, width = 0, points.astype(U64) + U64(1), 1
        # Doubling: spans of 1, 2, 4, ... code points; those of the bits of k are put one after the other.
        while True:
            if k & width:
                out = out * U64(pow(base, width, 1 << 64)) + wide[done : done + len(out)]
                done += width
            if width * 2 > k:
                return mix(out + U64(k))
            power = pow(base, width, 1 << 64)
            wide = wide[:-width] * U64(power) + wide[width:]
            width *= 2

    def numbered(self, kmers: np.ndarray) -> np.ndarray:
        """Hashes of k-mers and their occurrence numbers, counted from the start of the text."""
        order, place = _sorted(kmers)
        again = np.flatnonzero((order[1:] ^ order[:-1]) >> _place_bits(len(kmers)) == 0) + 1
        if not len(again):
            return kmers
        new = np.ones(len(kmers), dtype=bool)
        new[again] = False
        starts = np.flatnonzero(new)
        occurrence = again - starts[np.searchsorted(starts, again, side="right") - 1]
        out, at = kmers.copy(), place[again]
        out[at] = mix(kmers[at] ^ (occurrence.astype(U64) * U64(0xD6E8FEB86659FD93)))
        return out

    def selected(self, numbered: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """The places, in the order of the text, of the smallest k-mers of each function."""
        take = min(self.select, len(numbered))
        high, rows = (numbered >> U64(32)).astype(np.uint32), np.arange(len(factors))
        values, places = [], []
        for at in range(0, len(high), _BLOCK):
            table = factors[:, None] * high[at : at + _BLOCK]
            for left in range(min(take, table.shape[1]), 0, -1):
                least = np.argmin(table, axis=1)
                values.append(table[rows, least]), places.append(least + at)
                if left > 1:
                    table[rows, least] = np.iinfo(np.uint32).max
        values, places = np.stack(values, axis=1), np.stack(places, axis=1)
        if places.shape[1] > take:
            best = np.argsort(values, axis=1, kind="stable")[:, :take]
            places = np.take_along_axis(places, best, axis=1)
        return np.sort(places, axis=1)

    def signature(self, text: str, seeds) -> np.ndarray:
        """The hashes of the tuples; an empty text has those of empty tuples."""
        factors, weights = seeds
        numbered = self.numbered(self.kmers(np.frombuffer(text.encode("utf-32-le"), "<u4")))
        if not len(numbered):
            return np.zeros(self.tuples, np.uint16)
        take = min(self.select, len(numbered))
        chosen = self.selected(numbered, factors)
        tuples = np.full(self.tuples, U64(take))
        for j in range(take):
            tuples = mix(tuples * weights[j] + numbered[chosen[:, j]])
        return (tuples >> U64(48)).astype(np.uint16)

    def likeness(self, one: np.ndarray, other: np.ndarray) -> float:
        return float(np.mean(one == other))


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(documents: DataFrame, method: OrderMinHash = OrderMinHash()) -> DataFrame:
    """doc_id, n_chars, fingerprint (hex, 4 digits for each tuple) of every row; one narrow pass.

    `documents` has doc_id and text; other columns are not read. A null text is empty; equal texts have equal
    fingerprints; a null doc_id stays null and repeated rows repeat.
    """
    given = share(documents.sparkSession, method)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = given.value.seeds()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = [_hex(given.value.signature(t, seeds)) for t in texts]
            yield record_batch(schema, batch.column(0), [len(t) for t in texts], prints)

    return documents.select("doc_id", "text").mapInArrow(task, "doc_id long, n_chars long, fingerprint string")


def _ranges(documents: DataFrame, count: int) -> list[int]:
    """Ids that are there and cut all of them into ranges of about equal size, descending; the first is the largest."""
    ids = documents.select(F.col("doc_id").cast("long").alias("id")).filter("id IS NOT NULL")
    shares = [k / count for k in range(count, 0, -1)]
    found = ids.agg(F.percentile_approx("id", shares, 100 * count), F.max("id")).first()
    return sorted({*(found[0] or []), *([] if found[1] is None else [found[1]])}, reverse=True)


def edited_fingerprints(documents: DataFrame, method: OrderMinHash = OrderMinHash()) -> DataFrame:
    """Fingerprints of each text, of an edited text, and likeness to the edited and to the next text.

    The next document has the next smaller doc_id (after the last: the largest); the edited text ends with the first
    half of its length of the next text instead of its own second half. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    `documents` has doc_id and text; other columns are not read. A null text is empty. Null ids come after all
    others; rows that share an id are ordered by a hash of their text. A single row is its own next one. No rows give no
    rows. Two empty texts are fully alike; an empty and another text are not at all.

    Rows are dealt to ranges of doc_id whose largest id is known, so the row that follows a range can be sent
    along with it: one shuffle of the texts, and no task sees more than its ranges.
    """
    spark = documents.sparkSession
    partitions = shuffle_partitions(spark)
    heads = _ranges(documents, min(_MOST_RANGES, RANGES_PER_PARTITION * partitions))
    given = share(spark, (method, np.array(heads[::-1], np.int64)))
    empty = not heads

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row goes to the range of its id; the head of a range also closes the range before."""
        ascending = given.value[1]
        count = max(1, len(ascending))
        schema = pa.schema([("range", pa.int32()), ("ahead", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.string())])
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            ids = keys.fill_null(0).to_numpy()
            valid = keys.is_valid().to_numpy(zero_copy_only=False)
            own = np.where(valid, count - 1 - np.searchsorted(ascending, ids), count - 1).astype(np.int32)
            yield record_batch(schema, own, np.zeros(len(own), bool), keys, texts)
            if empty:
                continue
            head = valid & (ids == ascending[::-1][np.minimum(own, count - 1)])
            rows = pa.array(np.flatnonzero(head))
            before = (own[head] - 1) % count
            yield record_batch(schema, before, np.ones(len(rows), bool), keys.take(rows), texts.take(rows))

    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        method = given.value[0]
        seeds = method.seeds()
        held = None
        first = None  # of a table without ids, all of which is one range
        out: list[tuple] = []

        def pair(one, other) -> None:
            doc_id, text, print_ = one
            half = len(text) // 2
            edited = text[: len(text) - half] + other[1][:half]
            changed = method.signature(edited, seeds)
            digest = hashlib.sha256(edited.encode("utf-8")).hexdigest()
            near = method.likeness(print_, changed), method.likeness(print_, other[2])
            out.append((doc_id, len(text), digest, _hex(print_), _hex(changed), *near))

        for batch in batches:
            for number, ahead, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] != number:
                    held = None
                now = (doc_id, text or "", method.signature(text or "", seeds))
                if held is not None:
                    pair(held[1], now)
                held = None if ahead else (number, now)
                first = first or now
            yield record_batch(schema, *(map(list, zip(*out, strict=True)) if out else [[]] * len(schema)))
            out.clear()
        if empty and held is not None:
            pair(held[1], first)
            yield record_batch(schema, *map(list, zip(*out, strict=True)))

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    dealt = rows.mapInArrow(ranges, "range int, ahead boolean, doc_id long, text string").repartition(partitions, "range")
    ordered = dealt.sortWithinPartitions(
        "range", F.when(F.col("ahead") & (F.col("range") == len(heads) - 1), 1).otherwise(0),
        F.col("doc_id").desc_nulls_last(), "ahead", F.xxhash64("text"),
    )
    return ordered.mapInArrow(
        task,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
