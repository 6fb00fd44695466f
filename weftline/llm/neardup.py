"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact check, connected components.

Texts with equal shingle sets are one class, so copies never meet in pairs. Bands of MinHash values put classes into
buckets. In a bucket a few pivots at a time are compared with the members that are not yet connected to them, until
all members have been pivots or are connected. This is done in blocks of bounded size, from which only plausible pairs come
out. Signatures are compared in batches; a pair goes when the posterior probability of a similarity at or above the
threshold falls below the chosen miss probability. The rest is checked on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import LOWER, U64, fresh, mix, numbers, record_batch, share, span_hashes, text_bytes, text_slices, word_spans
from weftline.session import fits_broadcast, materialize, shuffle_partitions, table_bytes

#: Sides of measured size up to this are broadcast; larger ones are shuffled.
BROADCAST_BYTES = 16 << 20
#: Times more pivots a bucket in each round; pivots and members of a bucket that are compared in one block.
MORE_PIVOTS = 16
PIVOT_BLOCK, MEMBER_BLOCK = 256, 2048
#: Blocks that the others of one node are dealt to when pairs are compared.
NODE_BLOCKS = 1024
#: Most bits of the marks by which rows are left out before a join shuffles the others; bits of one row of marks (Spark's bitmaps).
MARK_BITS, _MAP_BITS = 1 << 27, 1 << 15
_CHUNK = 1 << 15


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters: words in a shingle, similarity in percent, MinHash values, compared batch, miss probability, recall at the threshold."""

    words: int = 5
    percent: int = 85
    hashes: int = 512
    batch: int = 32
    miss: float = 1e-5
    recall: float = 0.9999

    def rows(self) -> int:
        """Values in a band: the most for which a pair at the threshold shares a band with the given probability."""
        t = self.percent / 100
        found = [r for r in range(1, 33) if 1 - (1 - t**r) ** (self.hashes // r) >= self.recall]
        return max(found, default=1)

    def least_matches(self) -> list[tuple[int, int]]:
        """Compared values and the matches below which a pair goes: P(similarity >= t | matches) < miss, uniform prior."""
        t, out = self.percent / 100, []
        for n in range(self.batch, self.hashes + 1, self.batch):
            below, least = 0.0, 0
            for m in range(n + 1):
                below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if below >= self.miss:
                    break
                least = m + 1
            out.append((n, least))
        return out


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle has are one, none give none."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    weights = numbers(words, 77) | U64(1)
    out = []
    joined = np.zeros(max(0, len(hashes) - words + 1), U64)
    for j in range(words):
        joined += hashes[j : j + len(joined)] * weights[j]
    joined = mix(joined)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= words:
            out.append(np.unique(joined[low : high - words + 1]))
        elif high > low:
            short = np.sum(hashes[low:high] * weights[: high - low], dtype=U64) + U64(high - low)
            out.append(mix(np.array([short])))
        else:
            out.append(np.empty(0, U64))
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    """16 bytes that equal sets share."""
    one, two = np.sum(mix(shingles), dtype=U64), np.sum(mix(shingles ^ U64(0x5851F42D4C957F2D)), dtype=U64)
    return mix(np.array([one, two + U64(len(shingles))])).astype(">u8").tobytes()


def min_hashes(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """The signature of a set: 16 bits of the least value of each hash function."""
    add = (numbers(hashes, 7) >> U64(32)).astype(np.uint32)
    multiply = (numbers(hashes, 8) >> U64(32)).astype(np.uint32) | np.uint32(1)
    small = (shingles >> U64(32)).astype(np.uint32)
    step = max(1, _CHUNK * 4 // len(add))
    out = np.full(len(add), 0xFFFFFFFF, np.uint32)
    for low in range(0, len(small), step):
        values = (small[None, low : low + step] ^ add[:, None]) * multiply[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out & np.uint32(0xFFFF)


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a written side: broadcast if its measured size allows, else shuffled, where Spark splits hot keys."""
    return left.join(F.broadcast(right) if fits_broadcast(table_bytes(right), BROADCAST_BYTES) else right, on, how)


def _picked(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose key is in a written table of distinct keys.

    Keys of measured size are broadcast. Otherwise only their marks are, at places in a bitmap of bounded size, and the join
    moves no rows but those at a marked place.
    """
    if fits_broadcast(table_bytes(keys), BROADCAST_BYTES):
        return rows.join(F.broadcast(keys), [on])
    bits = min(MARK_BITS, max(_MAP_BITS, 1 << (64 * keys.count()).bit_length()))
    place, number, marks = fresh(rows, "place"), fresh(rows, "number"), fresh(rows, "marks")
    at = F.pmod(F.xxhash64(on), F.lit(bits)).cast("long")
    marked = keys.select(at.alias(place)).groupBy(F.shiftright(place, 15).alias(number))
    marked = marked.agg(F.bitmap_construct_agg(F.col(place) % _MAP_BITS).alias(marks))
    byte = F.substring(marks, (F.shiftright(F.col(place) % _MAP_BITS, 3) + 1).cast("int"), F.lit(1))
    seen = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col(place) % 8).cast("int")) == 1
    likely = rows.withColumn(place, at).withColumn(number, F.shiftright(place, 15)).join(F.broadcast(marked), [number]).filter(seen)
    return likely.select(*rows.columns).join(keys, [on])


def _sketches(documents: DataFrame, method: NearDuplicates) -> DataFrame:
    given = share(documents.sparkSession, method)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        method = given.value
        rows = method.rows()
        n_bands = method.hashes // rows
        weights, seeds = numbers(rows, 9) | U64(1), numbers(n_bands, 10)
        for batch in text_slices(batches, "text"):
            nodes, bands, sizes = [], [], []
            for shingles in shingle_sets(batch.column(1), method.words):
                sizes.append(len(shingles))
                if not len(shingles):
                    nodes.append(None), bands.append(None)
                    continue
                values = min_hashes(shingles, method.hashes)
                grouped = values[: n_bands * rows].reshape(n_bands, rows).astype(U64)
                nodes.append(set_digest(shingles))
                bands.append(mix((grouped * weights).sum(axis=1, dtype=U64) ^ seeds).astype(np.int64))
            yield record_batch(schema, batch.column(0), sizes, nodes, bands)

    kind = "doc_id long, n_shingles long, node binary, bands array<long>"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, kind)


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """bucket, band, node of the buckets that hold at least two classes."""
    members = classes.select(F.posexplode("bands").alias("band", "bucket"), "node")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    return materialize(_picked(members, materialize(shared, "shared-buckets"), "bucket"), "bucket-members")


class _Verifier:
    """Checks pairs of classes: first on signatures, then on whole shingle sets.

    Both are made again from the texts of the classes that share a bucket; only their bands are kept and moved for all.
    """

    def __init__(self, documents: DataFrame, classes: DataFrame, members: DataFrame, method: NearDuplicates):
        self.method = method
        needed = materialize(members.select("node").distinct(), "needed-nodes")
        ids = materialize(_joined(classes.select("node", "doc_id"), needed, ["node"]).select("doc_id").distinct(), "needed-documents")
        given = share(documents.sparkSession, method)
        schema = pa.schema([("node", pa.binary()), ("signature", pa.binary()), ("shingles", pa.binary())])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            method = given.value
            for batch in text_slices(batches, "text"):
                sets = [s for s in shingle_sets(batch.column(0), method.words) if len(s)]
                signatures = [min_hashes(s, method.hashes).astype("<u2").tobytes() for s in sets]
                yield record_batch(schema, [set_digest(s) for s in sets], signatures, [s.astype("<u8").tobytes() for s in sets])

        texts = _picked(documents.select(F.col("doc_id").cast("long"), "text"), ids, "doc_id")
        made = materialize(texts.select("text").mapInArrow(task, "node binary, signature binary, shingles binary"), "shingle-sets")
        self.sets = made.select("node", "shingles")
        # Rows that share a doc_id may make a node more than once.
        self.signatures = materialize(made.groupBy("node").agg(F.first("signature").alias("signature")), "signatures")

    def plausible(self, members: DataFrame, pivots: DataFrame) -> DataFrame:
        """one, other: the pairs of a pivot and a later member of its block with another root that the signatures don't rule out.

        Both have bucket, band, mine and theirs (the blocks), node and root. A pair that shares several buckets is
        compared in the one of its first band only, where it is due as well.
        """
        given = share(members.sparkSession, (self.method, self.method.least_matches()))
        schema = pa.schema([("one", pa.binary()), ("other", pa.binary())])

        def compare(band: int, rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
            method, rule = given.value
            per_band = method.rows()
            others = [r for r in rows if not r[0]]
            if not others:
                return
            signatures = np.frombuffer(b"".join(r[3] for r in others), "<u2").reshape(len(others), -1)
            nodes = np.array([r[1] for r in others], object)
            roots = np.array([r[2] for r in others], object)
            for _, node, root, signature in (r for r in rows if r[0]):
                alive = np.flatnonzero((nodes > node) & (roots != root))
                one = np.frombuffer(signature, "<u2")
                alive = alive[_plausible(one, signatures[alive], rule)]
                if len(alive) and band:
                    same = signatures[alive, : band * per_band] == one[: band * per_band]
                    alive = alive[~same.reshape(len(alive), band, per_band).all(axis=2).any(axis=1)]
                yield from ((node, other) for other in nodes[alive])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = None, []
            for batch in batches:
                out: list[tuple[bytes, bytes]] = []
                for bucket, band, mine, theirs, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (bucket, mine, theirs) != held:
                        if held is not None:
                            out += compare(last, rows)
                        held, last, rows = (bucket, mine, theirs), band, []
                    rows.append(tuple(row))
                yield record_batch(schema, [a for a, _ in out], [b for _, b in out])
            if held is not None:
                out = list(compare(last, rows))
                yield record_batch(schema, [a for a, _ in out], [b for _, b in out])

        keys = ["bucket", "band", "mine", "theirs"]
        rows = members.select(*keys, F.lit(False).alias("pivot"), "node", "root").union(
            pivots.select(*keys, F.lit(True).alias("pivot"), "node", "root")
        )
        signed = _joined(rows, self.signatures, ["node"])
        signed = signed.select(*keys, "pivot", "node", "root", "signature")
        dealt = signed.repartition(shuffle_partitions(signed.sparkSession), "bucket", "mine", "theirs")
        return dealt.sortWithinPartitions("bucket", "mine", "theirs").mapInArrow(task, "one binary, other binary")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (one, other) that the signatures don't rule out."""
        rule = self.method.least_matches()

        def test(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
            return _plausible(one, np.stack(others), rule)

        return _compared(materialize(pairs, "pairs"), self.signatures, "signature", "<u2", test)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (one, other) at or above the threshold, each by its whole sets, and each once."""
        percent = self.method.percent

        def test(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
            common = np.array([np.isin(other, one, assume_unique=True).sum() for other in others])
            size = np.array([len(other) for other in others])
            return 100 * common >= percent * (len(one) + size - common)

        return _compared(materialize(pairs.distinct(), "plausible-pairs"), self.sets, "shingles", "<i8", test)


def _plausible(one: np.ndarray, others: np.ndarray, rule: list[tuple[int, int]]) -> np.ndarray:
    """Which signatures stay after all batches: a pair goes at the first one with too few matches."""
    alive, matches, before = np.arange(len(others)), np.zeros(len(others), np.int64), 0
    for n, least in rule:
        matches = matches + (others[alive, before:n] == one[before:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, before = alive[keep], matches[keep], n
        if not len(alive):
            break
    out = np.zeros(len(others), bool)
    out[alive] = True
    return out


def _compared(pairs: DataFrame, table: DataFrame, column: str, kind: str, test) -> DataFrame:
    """The pairs (one, other; distinct, a written table) whose values (node, a column of bytes) pass a test.

    The others of a node are dealt to blocks by their hash, and the value of the node goes once to each of its blocks, so a
    node with very many others is many groups, and a row carries one value, not two.
    """
    spark = pairs.sparkSession
    schema = pa.schema([("one", pa.binary()), ("other", pa.binary())])
    share(spark, None)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, value = None, None
        for batch in batches:
            ones, blocks, others, values = (c.to_pylist() for c in batch.columns)
            out, low = [], 0
            while low < len(ones):
                if others[low] is None:  # the node itself comes before its others
                    held, value = (ones[low], blocks[low]), np.frombuffer(values[low], kind)
                    low += 1
                    continue
                high = low
                while high < len(ones) and (ones[high], blocks[high]) == held and others[high] is not None:
                    high += 1
                if high == low:
                    raise ValueError("a pair without the value of its node")
                passed = test(value, [np.frombuffer(v, kind) for v in values[low:high]])
                out += [(held[0], others[low + k]) for k in np.flatnonzero(passed)]
                low = high
            yield record_batch(schema, [a for a, _ in out], [b for _, b in out])

    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("other"), F.lit(NODE_BLOCKS)).cast("int"))
    right = _joined(dealt, table.withColumnRenamed("node", "other"), ["other"]).select("one", "block", "other", column)
    left = _joined(dealt.select("one", "block").distinct(), table.withColumnRenamed("node", "one"), ["one"])
    left = left.select("one", "block", F.lit(None).cast("binary").alias("other"), column)
    rows = left.union(right).repartition(shuffle_partitions(spark), "one", "block")
    return rows.sortWithinPartitions("one", "block", F.asc_nulls_first("other")).mapInArrow(task, "one binary, other binary")


def components(edges: DataFrame) -> DataFrame:
    """node, root of all nodes of the edges (one, other; a written table without loops): the smallest node that can be reached.

    Each round every node takes its smallest neighbour, takes that one's choice, and the edges are contracted; at
    least half of the nodes that still have edges go. All tables of a round are written, none comes to the driver.
    """
    labels = None
    while True:
        both = edges.union(edges.select(F.col("other").alias("one"), F.col("one").alias("other")))
        choice = both.groupBy("one").agg(F.min("other").alias("least"))
        choice = materialize(choice.select(F.col("one").alias("node"), F.least("one", "least").alias("root")), "choices")
        onward = choice.select(F.col("node").alias("root"), F.col("root").alias("further"))
        choice = materialize(_joined(choice, onward, ["root"]).select("node", F.col("further").alias("root")), "choices")
        if labels is None:
            labels = choice
        else:
            step = choice.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = _joined(labels, step, ["root"], "left").select("node", F.coalesce("next", "root").alias("root"))
            labels = materialize(labels, "labels")
        ends = [choice.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("one", "other")]
        contracted = _joined(_joined(edges, ends[0], ["one"]), ends[1], ["other"])
        contracted = contracted.select(
            F.least("one_root", "other_root").alias("one"), F.greatest("one_root", "other_root").alias("other")
        )
        edges = materialize(contracted.filter("one != other").distinct(), "edges")
        if edges.isEmpty():
            return labels


def _merge(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots of all members after new links between nodes."""
    ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("one", "other")]
    edges = _joined(_joined(links, ends[0], ["one"]), ends[1], ["other"])
    edges = edges.select(F.least("one_root", "other_root").alias("one"), F.greatest("one_root", "other_root").alias("other"))
    edges = materialize(edges.filter("one != other").distinct(), "root-edges")
    if edges.isEmpty():
        return roots
    new = components(edges).select(F.col("node").alias("root"), F.col("root").alias("next"))
    merged = _joined(roots, new, ["root"], "left").select("node", F.coalesce("next", "root").alias("root"))
    return materialize(merged, "roots")


def _place(node: str) -> F.Column:
    """A node as a number from 0 to 1, even since nodes are digests."""
    return F.conv(F.hex(F.substring(node, 1, 6)), 16, 10).cast("double") / float(1 << 48)


def _block(node: str, most: F.Column, size: int) -> tuple[F.Column, F.Column]:
    """The number of blocks of about `size` rows among `most`, and the block of a node."""
    blocks = F.greatest(F.lit(1), F.ceil(most / size)).cast("int")
    return blocks, F.pmod(F.xxhash64(node), blocks).cast("int")


def _connected(members: DataFrame, verifier: _Verifier) -> DataFrame:
    """node, root of the members of shared buckets."""
    roots = materialize(members.select("node").distinct().select("node", F.col("node").alias("root")), "roots")
    # One pivot for each member first: it connects most members of large groups at the price of one check each.
    least = members.groupBy("bucket").agg(F.min("node").alias("one"))
    stars = members.join(least, ["bucket"]).filter("node > one").groupBy("node").agg(F.min("one").alias("one"))
    stars = verifier.likely(stars.select("one", F.col("node").alias("other")))
    roots = _merge(roots, materialize(verifier.links(stars), "links"))
    left, pivots = members, 1
    while True:
        rooted = materialize(_joined(left, roots, ["node"]), "rooted")
        ahead = rooted.groupBy("bucket").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"), F.min(_place("node")).alias("next")
        )
        mixed = materialize(ahead.filter("low != high").select("bucket", "n", "next"), "mixed-buckets")
        if mixed.isEmpty():
            return roots
        # The next pivots of a bucket: its least member, and those up to a place that holds about `pivots` of them.
        until = F.greatest("next", F.col("next") + (1 - F.col("next")) * (pivots - 1) / F.col("n"))
        rest = materialize(_joined(rooted, mixed.select("bucket", "n", until.alias("until")), ["bucket"]), "mixed-members")
        n_theirs, theirs = _block("node", F.least(F.col("n"), F.lit(pivots)), PIVOT_BLOCK)
        n_mine, mine = _block("node", F.col("n"), MEMBER_BLOCK)
        every = [F.explode(F.sequence(F.lit(0), n - 1)) for n in (n_theirs, n_mine)]
        others = rest.select("*", every[0].alias("theirs")).withColumn("mine", mine)
        chosen = rest.filter(_place("node") <= F.col("until")).withColumn("theirs", theirs)
        pairs = verifier.plausible(others, chosen.select("*", every[1].alias("mine")))
        roots = _merge(roots, materialize(verifier.links(pairs), "links"))
        left = rest.filter(_place("node") > F.col("until")).select("bucket", "band", "node")
        pivots *= MORE_PIVOTS


def near_duplicates(documents: DataFrame, method: NearDuplicates = NearDuplicates()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    `documents` has doc_id and text; other columns are not read. A null, empty or blank text has no shingles and is
    linked with nothing. A null doc_id is linked with nothing, has no component_id and is kept. Rows that share a doc_id get
    one answer each, by their own text. Equal texts are linked; no rows give no rows. Long texts are used whole.
    """
    sketches = materialize(_sketches(documents, method), "sketches")
    known = sketches.filter("node IS NOT NULL AND doc_id IS NOT NULL")
    classes = materialize(
        known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")), "classes"
    )
    members = _shared_buckets(classes)
    owner = classes.select("node", F.col("doc_id").alias("component_id"))
    if not members.isEmpty():
        roots = _connected(members, _Verifier(documents, classes, members, method))
        owned = _joined(roots, owner.join(roots.select("node"), ["node"]), ["node"])
        first = materialize(owned.groupBy("root").agg(F.min("component_id").alias("least")), "component-firsts")
        linked = materialize(_joined(roots, first, ["root"]).select("node", "least"), "linked")
        owner = _joined(owner, linked, ["node"], "left").select("node", F.coalesce("least", "component_id").alias("component_id"))
    rows = sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    found = rows.join(materialize(owner, "owners"), ["node"], "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_first(documents: DataFrame, method: NearDuplicates = NearDuplicates()) -> DataFrame:
    """The rows, with all their columns, of one document of each group: that with the smallest doc_id.

    Rows without a doc_id stay, and so do rows that share the doc_id that stays.
    """
    found = near_duplicates(documents, method).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    name = fresh(documents, "kept_id")
    kept = materialize(found, "kept-documents").withColumnRenamed("doc_id", name)
    joined = documents.join(
        F.broadcast(kept) if fits_broadcast(table_bytes(kept), BROADCAST_BYTES) else kept,
        F.col("doc_id").cast("long") == F.col(name), "left",
    )
    return joined.filter(F.col(name).isNotNull() | F.col("doc_id").isNull()).drop(name)
