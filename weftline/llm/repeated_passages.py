"""Repeated passages: distributed prefix doubling over sampled suffixes, then over single positions.

Every byte string of the given length is owned by the place of the smallest hash among its first `window` 16-grams, so
equal strings are owned by places at equal distances. These places are the suffixes that are sorted: first by the name of their
first bytes, then, as (rank, name of as many bytes again) pairs, by twice as many. Spark sorts each round by ranges, tasks
rerank runs of equal pairs, and a suffix goes as soon as it is unique. After the last doubling, suffixes whose
whole stretch (all strings they own) has an equal are settled, and one of each class stays in. Where classes differ
in one rank, their strings are ranked position by position by (rank, name of the whole string).

A name is a 64-bit hash of bytes. Runs that reach over partitions are joined by the first and last row of each
partition, so a passage that a third of all documents share is split like any other rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import _BYTE_VALUES, U64, _power_tables, mix, share, text_bytes, text_slices
from weftline.session import discard, fits_broadcast, scratch_path, shuffle_partitions, table_bytes

#: Sides of measured size up to this are broadcast; larger ones are shuffled.
BROADCAST_BYTES = 16 << 20
_GRAM = 16
_BLOCK = 1 << 19
_PLACE_BITS = 20
_COUNTER_BITS = 33
_RUN_BITS = 40
_ROWS = 1 << 16


@dataclass(frozen=True)
class RepeatedPassages:
    """Bytes of a string that must not repeat, and starts of 16-grams among which its owner is chosen."""

    length: int = 400
    window: int = 192

    def __post_init__(self):
        if self.window + _GRAM + 1 >= self.length or self.window < 1:
            raise ValueError("a string must be longer than the window of its owner")

    @property
    def base(self) -> int:
        """Bytes of the first names; twice as many lie behind the owner in every string."""
        return (self.length - self.window) // 2


class _Names:
    """Names of stretches of a piece of bytes, from sums of its prefixes."""

    def __init__(self, piece: np.ndarray):
        forward, self.backward = _power_tables(len(piece) + 1)
        self.sums = np.zeros(len(piece) + 1, U64)
        np.cumsum(_BYTE_VALUES[piece] * forward[:-1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.backward[begin] + (end - begin).astype(U64))


def _least_of(values: np.ndarray, window: int) -> np.ndarray:
    """The minimum of each `window` neighbours."""
    width = 1
    while 2 * width <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _owners(data: np.ndarray, offsets: np.ndarray, method: RepeatedPassages) -> Iterator[tuple]:
    """document, first, count, skip and names (three) of the owners in blocks of texts.

    An owner at first + skip owns the strings that begin at first ... first + count - 1, in bytes of the slice.
    """
    length, window, base = method.length, method.window, method.base
    change = np.zeros(len(data) + 1, np.int8)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(change, offsets[long], 1)
    np.add.at(change, offsets[long + 1] - length + 1, -1)
    valid = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    for low in range(0, len(data), _BLOCK):
        starts = np.flatnonzero(valid[low : low + _BLOCK])
        if not len(starts):
            continue
        piece = data[low : low + int(starts[-1]) + length]
        names = _Names(piece)
        places = np.arange(len(piece) + 1 - _GRAM)
        grams = names.of(places, places + _GRAM)
        grams &= ~U64((1 << _PLACE_BITS) - 1)
        grams |= places.astype(U64)
        owner = (_least_of(grams, window)[starts] & U64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        count = np.diff(np.append(begin, len(starts)))
        first, at = starts[begin], owner[begin]
        skip = at - first
        whole = names.of(first, first + count - 1 + length) + (skip << 10).astype(U64) * _BYTE_VALUES[7]
        document = np.searchsorted(offsets, first + low, side="right") - 1
        yield document, first + low, count, skip, names.of(at, at + base), names.of(at + base, at + 2 * base), mix(whole)


_SAMPLED = "num long, k binary, place long, name long, next long, whole long, first long, count int, many boolean, until long"


def _sampled(texts: DataFrame, method: RepeatedPassages) -> DataFrame:
    """Rows of three kinds: a document (k, place), an owner (name, ...), a stretch that is known to repeat (first, until)."""
    given = share(texts.sparkSession, method)
    schema = pa.schema([
        ("num", pa.int64()), ("k", pa.binary()), ("place", pa.int64()), ("name", pa.int64()), ("next", pa.int64()),
        ("whole", pa.int64()), ("first", pa.int64()), ("count", pa.int32()), ("many", pa.bool_()), ("until", pa.int64()),
    ])

    def rows(**columns) -> pa.RecordBatch:
        size = len(columns["num"])
        arrays = [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema]
        return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        method, number = given.value, TaskContext.get().partitionId() << _COUNTER_BITS
        for batch in text_slices(batches, "text"):
            data, offsets = text_bytes(batch.column(2))
            long = np.flatnonzero(np.diff(offsets) >= method.length)
            if len(long):
                taken = pa.array(long)
                yield rows(num=number + long, k=batch.column(0).take(taken), place=batch.column(1).take(taken))
            for document, first, count, _, *names in _owners(data, offsets, method):
                inside = first - offsets[document]
                class_name = mix(mix(mix(names[0]) ^ names[1]) ^ names[2])
                _, index, inverse, size = np.unique(class_name, return_index=True, return_inverse=True, return_counts=True)
                name, following, whole = (x[index].view(np.int64) for x in names)
                yield rows(
                    num=number + document[index], name=name, next=following, whole=whole, first=inside[index],
                    count=count[index].astype(np.int32), many=size > 1,
                )
                again = np.flatnonzero(size[inverse] > 1)
                if len(again):
                    begin, end, owner = inside[again], (inside + count - 1 + method.length)[again], document[again]
                    fresh = np.append(True, (owner[1:] != owner[:-1]) | (begin[1:] > end[:-1]))
                    heads = np.flatnonzero(fresh)
                    tails = np.append(heads[1:], len(begin)) - 1
                    yield rows(num=number + owner[heads], first=begin[heads], until=end[tails])
            number += batch.num_rows

    return texts.select("k", "place", "text").mapInArrow(task, _SAMPLED)


def _reranked(rows: DataFrame, pair: list[str], rest: list[str], carried: list[str], scratch: _Scratch) -> DataFrame:
    """Sort by `pair` and then `rest`, give equal pairs one rank, and drop the rows whose pair is unique.

    Adds rank, same (whether another row has equal pair and rest) and lead (whether it is the first of these).
    All columns of `pair` and `rest` are longs without nulls. Ties are sorted by the carried columns num and first, so
    that a run can reach over partitions.
    """
    keys = pair + rest
    ordered = [*keys, *(c for c in ("num", "first") if c not in keys)]
    kinds = {f.name: f.dataType for f in rows.schema}
    out = T.StructType([T.StructField(c, kinds[c]) for c in carried] + [
        T.StructField("rank", T.LongType()), T.StructField("part", T.LongType()), T.StructField("edge", T.IntegerType()),
        *(T.StructField(f"like_{c}", T.BooleanType()) for c in ("last", "next")),
        *(T.StructField(f"same_{c}", T.BooleanType()) for c in ("last", "next")),
        *(T.StructField(f"key{k}", T.LongType()) for k in range(len(keys))),
    ])
    n_keys, n_pair = len(keys), len(pair)

    def equal(columns: list[np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c[1:] == c[:-1] for c in columns])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        number = run = 0  # of the first row that waits, and of the first row of its run
        like_last = same_last = False

        def ready(table: pa.RecordBatch, columns: list[np.ndarray], size: int, last: bool):
            nonlocal number, run, like_last, same_last
            like, same = equal(columns[:n_pair]), equal(columns)
            like_next, same_next = (np.append(x, False)[:size] for x in (like, same))
            like_before = np.append(like_last, like)[:size]
            same_before = np.append(same_last, same)[:size]
            numbers = number + np.arange(size)
            runs = np.maximum.accumulate(np.where(like_before, run, numbers))
            edge = np.zeros(size, np.int32)
            if number == 0:
                edge[0] += 1
            if last:
                edge[-1] += 2
            keep = np.flatnonzero(like_before | like_next | (edge > 0))
            arrays = [table.column(table.schema.get_field_index(c)).take(pa.array(keep)) for c in carried]
            arrays += [pa.array((part << _RUN_BITS) + runs[keep]), pa.array(np.full(len(keep), part)), pa.array(edge[keep])]
            arrays += [pa.array(x[keep]) for x in (like_before, like_next, same_before, same_next)]
            arrays += [pa.array(c[:size][keep], mask=edge[keep] == 0) for c in columns]
            if not last:
                like_last, same_last = bool(like[size - 1]), bool(same[size - 1])
            number, run = number + size, int(runs[-1])
            return pa.RecordBatch.from_arrays(arrays, names=out.names)

        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                table = batch.slice(low, _ROWS)
                if held is not None:
                    table = pa.Table.from_batches([held, table]).combine_chunks().to_batches()[0]
                held = table.slice(table.num_rows - 1)
                if table.num_rows > 1:
                    columns = [table.column(k).to_numpy() for k in range(n_keys)]
                    yield ready(table, columns, table.num_rows - 1, False)
        if held is not None:
            yield ready(held, [held.column(k).to_numpy() for k in range(n_keys)], 1, True)

    names = keys + [c for c in dict.fromkeys([*carried, "num", "first"]) if c not in keys]
    dealt = rows.select(*names).repartitionByRange(shuffle_partitions(rows.sparkSession), *ordered).sortWithinPartitions(*ordered)
    ranked = scratch.write(dealt.mapInArrow(task, out), "ranks")
    # The first and the last row of each partition tell which runs go on in the next one.
    ends = ranked.filter("edge > 0").orderBy("part", "edge", "rank").collect()  # two rows for each partition
    firsts = {r["part"]: r for r in ends if r["edge"] in (1, 3)}
    lasts = {r["part"]: r for r in ends if r["edge"] in (2, 3)}
    fixes, before, rank_before = [], None, None
    parts = sorted(firsts)
    key = lambda r, n: tuple(r[f"key{k}"] for k in range(n))
    joined: dict[tuple[int, int], list] = {}
    for p in parts:
        one, other = firsts[p], lasts[p]
        rank_other = other["rank"]
        if before is not None and key(before, n_pair) == key(one, n_pair):
            fixes.append((one["rank"], rank_before))
            if other["rank"] == one["rank"]:
                rank_other = rank_before
            whole = key(before, n_keys) == key(one, n_keys)
            joined.setdefault((before["part"], 2), [False] * 4)[1::2] = [True, whole]
            joined.setdefault((p, 1), [False] * 4)[0::2] = [True, whole]
        before, rank_before = other, rank_other
    spark = rows.sparkSession
    moved = spark.createDataFrame(fixes, "rank long, moved long")
    # A row that is both first and last of its partition has both sides.
    flags = [(p, side, *v) for (p, side), v in joined.items()]
    sides = spark.createDataFrame(flags, "part long, side int, a boolean, b boolean, c boolean, d boolean")
    merged = sides.groupBy("part", "side").agg(*[F.max(c).alias(c) for c in "abcd"])
    one, two = (
        merged.filter(F.col("side") == s).select(F.col("part").alias(f"part{s}"), *[F.col(c).alias(f"{c}{s}") for c in "abcd"]) for s in (1, 2)
    )
    edge = F.col("edge")
    fixed = ranked.join(F.broadcast(moved), "rank", "left")
    fixed = fixed.join(F.broadcast(one), (F.col("part") == F.col("part1")) & edge.isin(1, 3), "left")
    fixed = fixed.join(F.broadcast(two), (F.col("part") == F.col("part2")) & edge.isin(2, 3), "left")

    def either(name: str, letter: str) -> F.Column:
        return F.col(name) | F.coalesce(f"{letter}1", F.lit(False)) | F.coalesce(f"{letter}2", F.lit(False))

    repeated = either("like_last", "a") | either("like_next", "b")
    same_last = either("same_last", "c")
    return fixed.filter(repeated).select(
        *carried, F.coalesce("moved", "rank").alias("rank"), (same_last | either("same_next", "d")).alias("same"), (~same_last).alias("lead")
    )


class _Scratch:
    """Tables between the rounds; each is deleted when the rounds that read it are done."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, label))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def discard(self, keep: int = 0) -> None:
        """Delete all tables but the last ones."""
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            discard(self.spark, path)
        self.paths = self.paths[len(gone) :]


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    return left.join(F.broadcast(right) if fits_broadcast(table_bytes(right), BROADCAST_BYTES) else right, on, how)


def _positions(texts: DataFrame, due: DataFrame, method: RepeatedPassages) -> DataFrame:
    """rank, name, num, first, settled of each string (of the whole length) that the owners of `due` own."""
    given = share(texts.sparkSession, method)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = given.value.length
        for batch in text_slices(batches, "text"):
            data, offsets = text_bytes(batch.column(0))
            numbers = batch.column(1).to_pylist()
            for k, owners in enumerate(batch.column(2).to_pylist()):
                out: list[list[np.ndarray]] = [[], [], [], []]
                for owner in owners:
                    first, count = owner["first"], owner["count"]
                    begin = offsets[k] + first
                    places = np.arange(count)
                    out[0].append(np.full(count, owner["rank"]))
                    out[1].append(_Names(data[begin : begin + count - 1 + length]).of(places, places + length).view(np.int64))
                    out[2].append(first + places)
                    out[3].append(np.full(count, owner["settled"]))
                rank, name, first, settled = (np.concatenate(x) for x in out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rank), pa.array(name), pa.array(np.full(len(rank), numbers[k])), pa.array(first), pa.array(settled)],
                    names=["rank", "name", "num", "first", "settled"],
                )

    owners = F.collect_list(F.struct("rank", "first", "count", "settled")).alias("owners")  # those of one document
    listed = due.groupBy("k", "place", "num").agg(owners)
    return _joined(texts, listed, ["k", "place"]).select("text", "num", "owners").mapInArrow(
        task, "rank long, name long, num long, first long, settled boolean"
    )


def _spans(stretches: DataFrame) -> DataFrame:
    """num, begins, ends: the union of the stretches (num, first, until) of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, begins, ends, out = None, [], [], ([], [], [])

        def close():
            if number is not None:
                for column, value in zip(out, (number, begins, ends), strict=True):
                    column.append(value)

        def flush():
            made = pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64()))],
                names=["num", "begins", "ends"],
            )
            for column in out:
                column.clear()
            return made

        for batch in batches:
            num, first, until = (c.to_numpy() for c in batch.columns)
            # Within a batch, neighbours that touch are merged before the loop.
            if not len(num):
                continue
            shift = np.cumsum(np.append(0, num[1:] != num[:-1])) * (int(until.max()) + 1)  # documents don't overlap
            fresh = np.append(True, (first + shift)[1:] > np.maximum.accumulate(until + shift)[:-1])
            heads = np.flatnonzero(fresh)
            reach = np.maximum.reduceat(until, heads)
            for n, low, high in zip(num[heads].tolist(), first[heads].tolist(), reach.tolist(), strict=True):
                if n != number:
                    close()
                    number, begins, ends = n, [low], [high]
                elif low <= ends[-1]:
                    ends[-1] = max(ends[-1], high)
                else:
                    begins.append(low), ends.append(high)
            yield flush()
        close()
        yield flush()

    dealt = stretches.repartition(shuffle_partitions(stretches.sparkSession), "num").sortWithinPartitions("num", "first")
    return dealt.mapInArrow(task, "num long, begins array<long>, ends array<long>")


def _found(texts: DataFrame, method: RepeatedPassages, scratch: _Scratch) -> DataFrame:
    """k, begins, ends of the texts with repeated strings."""
    until = (F.col("first") + F.col("count") - 1 + method.length).alias("until")
    table = scratch.write(_sampled(texts, method), "suffixes")
    owners = table.filter("name IS NOT NULL")
    carried = ["num", "first", "count", "many"]
    ranked = _reranked(owners, ["name"], [], [*carried, "next", "whole"], scratch)
    ranked = scratch.write(_reranked(ranked, ["rank", "next"], ["whole"], carried, scratch), "suffix-ranks")
    settled = (F.col("same") | F.col("many")).alias("settled")
    classes = ranked.filter("lead").select("rank", "num", "first", "count", settled)
    open_ranks = classes.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.min("settled").alias("all")).filter("n > 1 AND NOT all")
    due = scratch.write(_joined(classes, scratch.write(open_ranks.select("rank"), "open-ranks"), ["rank"]), "open-suffixes")
    documents = table.filter("k IS NOT NULL").select("num", "k", "place")
    located = scratch.write(_joined(documents, due, ["num"]), "located-suffixes")
    positions = scratch.write(_positions(texts, located, method), "positions")
    single = _reranked(positions, ["rank", "name"], [], ["num", "first", "settled"], scratch)
    stretches = (
        table.filter("until IS NOT NULL").select("num", "first", "until")
        .union(ranked.filter(settled).select("num", "first", until))
        .union(single.filter("NOT settled").select("num", "first", (F.col("first") + method.length).alias("until")))
    )
    spans = scratch.write(_spans(stretches), "document-spans")
    # Documents of equal texts have equal spans.
    return scratch.write(_joined(documents, spans, ["num"]).select("k", "begins", "ends").dropDuplicates(["k"]), "text-spans")


def remove_repeats(documents: DataFrame, method: RepeatedPassages = RepeatedPassages()) -> DataFrame:
    """doc_id, n_bytes, begins, ends, kept: the runs of bytes that repeated strings cover, and the rest of the text (binary).

    A string of `length` bytes that starts at two places, of one or two documents, is removed at both. `documents` has
    doc_id, handed on as it is (nulls and repeated ids too), and text; other columns are not read. A null or empty text
    has no bytes; texts shorter than `length` stay whole. A text that occurs twice, repeated rows included, is removed
    wherever it has `length` bytes. No rows give no rows. Long texts are used whole, in blocks. A cut may part the bytes of a
    character, so kept is binary.
    """
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(text))
    texts = documents.select("doc_id", text.alias("text"), digest.alias("k")).withColumn("place", F.xxhash64("k", "doc_id"))
    scratch = _Scratch(spark)
    spans = _found(texts, method, scratch)
    scratch.discard(keep=1)
    out = T.StructType([
        T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("begins", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("kept", T.BinaryType()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            data, offsets = text_bytes(batch.column(1))
            content = memoryview(data.tobytes())
            kept = []
            spans = [c.to_pylist() for c in batch.columns[2:4]]
            for k, (begins, ends) in enumerate(zip(*spans, strict=True)):
                whole = content[offsets[k] : offsets[k + 1]]
                if begins is None:
                    kept.append(bytes(whole))
                else:
                    kept.append(b"".join(whole[a:b] for a, b in zip([0, *ends], [*begins, len(whole)], strict=True)))
                    continue
                spans[0][k] = spans[1][k] = []
            lists = [pa.array(c, pa.list_(pa.int64())) for c in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), *lists, pa.array(kept, pa.binary())], names=out.names)

    return _joined(texts.select("doc_id", "text", "k"), spans, ["k"], "left").select("doc_id", "text", "begins", "ends").mapInArrow(task, out)
