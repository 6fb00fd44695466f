"""Minimax contiguous partition of documents into shards of near equal bytes.

Groups of equal texts are atomic and ordered by a hash of their text. The smallest capacity for which a greedy pass
needs no more shards than asked for is found by binary search, and the groups are cut there. The driver holds totals
of ranges of hashes only, and divides just those ranges in which a cut may fall.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import fresh
from weftline.session import materialize
from weftline.sources.rowindex import number_sorted_rows

SHARDS = 16
#: Ranges of hashes on the first level, and parts of a range on each further one (powers of two).
FIRST_BITS, MORE_BITS = 12, 8
_SIGN = 1 << 63


@dataclass
class Segment:
    """Groups whose hashes begin with the same bits: their number, sum, and largest size."""

    prefix: int
    bits: int
    groups: int
    total: int
    largest: int


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; a null counts as no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_hash(text: Column) -> Column:
    """Equal texts, and null and the empty text, have one hash. Distinct texts that share one are one group."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _prefix(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed.bitwiseXOR(F.lit(-_SIGN)), 64 - bits)


def _totals(groups: DataFrame, bits: int) -> list[Segment]:
    rows = groups.groupBy(_prefix(F.col("hash"), bits).alias("prefix")).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("bytes").alias("total"), F.max("bytes").alias("largest")
    )
    return [Segment(r.prefix, bits, r.groups, r.total, r.largest) for r in rows.collect()]


class _Segments:
    """Ordered segments with the running sum before each."""

    def __init__(self, segments: list[Segment]):
        self.list = sorted(segments, key=lambda s: s.prefix << (64 - s.bits))
        self.before = [0]
        for s in self.list:
            self.before.append(self.before[-1] + s.total)
        self.total = self.before[-1]

    def cut(self, limit: int) -> tuple[int, int, int | None]:
        """Bounds of the last group boundary at or before `limit`, and the segment that leaves it open."""
        if limit >= self.total:
            return self.total, self.total, None
        k = bisect_right(self.before, limit) - 1
        s, start = self.list[k], self.before[k]
        if s.groups == 1 or limit == start:
            return start, start, None
        return max(start, limit - s.largest + 1), limit, k

    def greedy(self, capacity: int, shards: int) -> tuple[bool | None, list[int], set[int]]:
        """Whether the capacity suffices (None: can't tell yet), the least cuts, and the segments to be divided."""
        low = high = 0
        cuts, unsure = [], set()
        for _ in range(shards):
            low, _, k = self.cut(low + capacity)
            _, high, m = self.cut(high + capacity)
            unsure |= {x for x in (k, m) if x is not None}
            if k is None and low < high:  # a cut between two bounds that stand in different segments
                unsure |= {x for x in range(bisect_right(self.before, low) - 1, bisect_right(self.before, high)) if x < len(self.list) and self.list[x].groups > 1}
            cuts.append(low)
        return (True if low >= self.total else None if high >= self.total else False), cuts, unsure


def find_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the first hash of shards 1, 2, ... (as unsigned numbers; 2^64: no rows).

    `groups` has hash and bytes, one row for each group. A segment that leaves a check open is divided by more bits of
    the hash; each pass over the groups returns a bounded number of totals.
    """
    segments = _Segments(_totals(groups, FIRST_BITS))
    if not segments.total:
        return 0, [1 << 64] * (shards - 1)
    low = max(-(-segments.total // shards), max(s.largest for s in segments.list))
    high = -(-segments.total // shards) + max(s.largest for s in segments.list)
    while True:
        least, most = low, high
        while least < most:  # the smallest capacity that may suffice
            middle = (least + most) // 2
            least, most = (middle + 1, most) if segments.greedy(middle, shards)[0] is False else (least, middle)
        low = least
        fits, cuts, unsure = segments.greedy(low, shards)
        if fits and not unsure:
            break
        segments = _divide(groups, segments, unsure)
    starts = []
    for cut in cuts[:-1]:
        k = bisect_right(segments.before, cut) - 1
        s = segments.list[k] if k < len(segments.list) else None
        starts.append(1 << 64 if s is None else s.prefix << (64 - s.bits))
    return low, starts


def _divide(groups: DataFrame, segments: _Segments, chosen: set[int]) -> _Segments:
    bits = min(segments.list[k].bits for k in chosen)
    now = [k for k in chosen if segments.list[k].bits == bits]
    more = min(64, bits + MORE_BITS)
    inside = groups.filter(_prefix(F.col("hash"), bits).isin([segments.list[k].prefix for k in now]))
    kept = [s for k, s in enumerate(segments.list) if k not in set(now)]
    return _Segments(kept + _totals(inside, more))


def shard_of(hashed: Column, starts: list[int]) -> Column:
    """The shard of a hash: the number of shards that start at or before it."""
    place = [F.lit(s - _SIGN) for s in starts if s < 1 << 64]
    return sum(((hashed >= p).cast("int") for p in place), F.lit(0))


def assign_shards(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row.

    `documents` has doc_id and text; other columns are not read. A null text has size 1 and lies with the empty ones; a
    null doc_id is a row like any other; repeated rows each have a slot. With fewer groups than shards some shards
    stay empty; no rows give no rows. Texts are read once; what is sorted and written has a few numbers a row, so a
    group with a third of all rows is spread over many tasks.
    """
    rows = materialize(
        documents.select(
            "doc_id", text_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            text_hash(F.col("text")).alias("hash"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("hash").agg(F.sum("size").alias("bytes")), "shard-groups")
    _, starts = find_cuts(groups, shards)
    sharded = rows.withColumn("shard", shard_of(F.col("hash"), starts))
    ranked = number_sorted_rows(sharded, ["hash", "doc_id", "size"], "rank")
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))  # at most one row for each shard
    slotted = ranked.join(F.broadcast(first), "shard")
    return slotted.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """All columns of the documents as Parquet, a folder for each shard; a row's shard follows from its text alone."""
    hashed = documents.select(text_hash(F.col("text")).alias("hash"), text_size(F.col("text")).alias("size"))
    groups = materialize(hashed.groupBy("hash").agg(F.sum("size").alias("bytes")), "shard-groups")
    _, starts = find_cuts(groups, shards)
    name = fresh(documents, "shard")
    documents.withColumn(name, shard_of(text_hash(F.col("text")), starts)).write.partitionBy(name).parquet(path)
