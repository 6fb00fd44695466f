"""Operators whose results follow from a plain computation: tokens, packing, files, shards, fingerprints, duplicates."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import fingerprints, neardup
from weftline.llm.fingerprints import OrderMinHash, edited_fingerprints
from weftline.llm.neardup import NearDuplicates, components, near_duplicates
from weftline.llm.packing import pack
from weftline.llm.sharding import assign_shards, find_cuts, write_shards
from weftline.llm.tokenfiles import read_document, read_token_files, write_token_files
from weftline.session import materialize


def key(value):
    return (value is not None, value if value is not None else 0)


@pytest.fixture(scope="module")
def ids(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("capacity,windows,cut", [(64, 4, 8), (2048, 16, 32), (1, 1, 0)])
def test_packing_holds_each_id_once(spark, odd, vocabulary, ids, capacity, windows, cut):
    docs = odd.filter("doc_id IS NULL OR doc_id <> 106") if capacity == 1 else odd
    pieces = pack(docs, vocabulary, 1, capacity, windows, cut).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        documents[p.doc_id, p.doc_tokens].append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at and len(p.ids) == 4 * p.length
            at += p.length
        assert at <= capacity
    total = 0
    for row in docs.collect():
        want = ids(row.text)
        total += len(want)
        own = sorted(documents[row.doc_id, len(want)], key=lambda p: p.start)
        joined = np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist()
        assert sorted(joined) == sorted(want * (len(joined) // len(want)))  # rows with one id may repeat
    assert sum(p.length for p in pieces) == total
    fill = sum(p.length for p in pieces) / (capacity * len(sequences))
    assert fill > 0.9


def test_empty_tables(spark, none, vocabulary, tmp_path):
    assert pack(none, vocabulary).count() == 0
    assert read_token_files(write_token_files(none, vocabulary, folder=str(tmp_path))).count() == 0
    assert assign_shards(none).count() == 0
    assert edited_fingerprints(none).count() == 0
    assert near_duplicates(none).count() == 0


def test_token_files_round_trip(spark, odd, vocabulary, ids, tmp_path):
    manifest = write_token_files(odd, vocabulary, folder=str(tmp_path), partitions=3).cache()
    rows = sorted(read_token_files(manifest).collect(), key=lambda r: r.start)
    given = odd.withColumn("h", F.xxhash64("text")).collect()
    given = sorted(given, key=lambda r: (key(r.doc_id), r.h))
    start = 0
    for row, one in zip(rows, given, strict=True):
        want = ids(one.text)
        assert (row.doc_id, row.start, row.n_tokens) == (one.doc_id, start, len(want))
        assert np.frombuffer(row.ids, "<u4").tolist() == want
        start += len(want)
    assert read_document(spark, manifest, 103) == ids("Über straße ñ 😀")
    assert read_document(spark, manifest, 9999) is None


def plain_cuts(sizes, shards):
    def needed(capacity):
        count, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return shards + 1
            count, room = (count, room - s) if s <= room else (count + 1, capacity - s)
        return count

    return next(c for c in range(1, sum(sizes) + 1) if needed(c) <= shards)


@pytest.mark.parametrize("shards", [1, 2, 5, 16, 90])
def test_shards_have_the_least_capacity(spark, odd, clashing, shards, tmp_path):
    rows = assign_shards(clashing, shards).collect()
    assert len(rows) == odd.count()
    groups, slots, sizes = defaultdict(int), defaultdict(list), defaultdict(int)
    hashed = odd.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("b"))
    for h, b in hashed.collect():
        groups[h] += b
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < shards
    best = plain_cuts([groups[h] for h in sorted(groups)], shards)
    assert max(sizes.values()) == best
    table = materialize(hashed.groupBy(F.col("h").alias("hash")).agg(F.sum("b").alias("bytes")), "test-groups")
    assert find_cuts(table, shards)[0] == best


def test_written_shards_keep_all_columns(spark, odd, tmp_path):
    write_shards(odd, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and set(odd.columns) < set(back.columns)


def test_edited_texts_are_those_of_neighbours(odd, clashing, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGES_PER_PARTITION", 2)
    method = OrderMinHash()
    rows = edited_fingerprints(clashing).collect()
    given = odd.withColumn("h", F.xxhash64("text")).collect()
    given = sorted(given, key=lambda r: (-key(r.doc_id)[0], -(r.doc_id or 0), r.h))
    want = []
    for k, one in enumerate(given):
        text, other = one.text or "", given[(k + 1) % len(given)].text or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        a, b, c = (method.signature(t, method.seeds()) for t in (text, edited, other))
        want.append((one.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), method.likeness(a, b), method.likeness(a, c)))
    found = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_numbered_kmers_follow_their_definition():
    method = OrderMinHash(k=3, tuples=256)
    for text in ("abcabcabcabc", "aaaaaaa", "ab", "xyz"):
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        kmers = method.kmers(points)
        numbered = method.numbered(kmers)
        names = [text[i : i + 3] for i in range(len(kmers))]
        pairs = [(n, names[:i].count(n)) for i, n in enumerate(names)]
        assert len(set(numbered.tolist())) == len(set(pairs))
        assert len(set(kmers.tolist())) == len(set(names))
    seeds = method.seeds()
    blocks = ["".join(chr(97 + int(c)) for c in row) for row in np.random.default_rng(1).integers(0, 26, (200, 9))]
    one, two = "".join(blocks), "".join(reversed(blocks))  # the same k-mers but for those across blocks, in another order
    assert method.likeness(method.signature(one, seeds), method.signature(one[:-8], seeds)) > 0.8
    assert method.likeness(method.signature(one, seeds), method.signature(two, seeds)) < 0.3


def plain_mix(x):
    full = (1 << 64) - 1
    x = (x + 0x9E3779B97F4A7C15) & full
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & full
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & full
    return x ^ x >> 31


@pytest.mark.parametrize("select", [1, 2, 3])
def test_signatures_by_plain_loops(monkeypatch, select):
    monkeypatch.setattr(fingerprints, "_BLOCK", 7)
    method = OrderMinHash(k=4, select=select, tuples=24)
    factors, weights = ([int(x) for x in part] for part in method.seeds())
    for text in ("", "a", "abcd", "abcde", "abababababababab", "so it goes, and so it went, and so it goes", "aaaaaaaaaaaa"):
        hashes = [int(x) for x in method.numbered(method.kmers(np.frombuffer(text.encode("utf-32-le"), "<u4")))]
        want = []
        for factor in factors:
            ranked = sorted(range(len(hashes)), key=lambda i: ((hashes[i] >> 32) * factor % (1 << 32), i))
            chosen = sorted(ranked[:select])
            tuple_ = len(chosen)
            for weight, place in zip(weights, chosen, strict=False):
                tuple_ = plain_mix((tuple_ * weight + hashes[place]) % (1 << 64))
            want.append(tuple_ >> 48 if hashes else 0)
        assert method.signature(text, method.seeds()).tolist() == want


def test_functions_are_independent_on_short_texts():
    """The spread of the likeness of short texts is that of as many independent draws."""
    method, rng, found = OrderMinHash(), np.random.default_rng(4), []
    for _ in range(300):
        one = "".join(chr(97 + int(c)) for c in rng.integers(0, 9, 60))
        other = one[:30] + "".join(chr(97 + int(c)) for c in rng.integers(0, 9, 8)) + one[38:]
        found.append(method.likeness(method.signature(one, method.seeds()), method.signature(other, method.seeds())))
    share = np.mean(found)
    assert 0.1 < share < 0.6 and np.std(found) < 1.2 * np.sqrt(share * (1 - share) / method.tuples)


def plain_groups(rows, percent, words=5):
    import re

    sets = {}
    for doc_id, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        shingles = [tuple(found[k : k + words]) for k in range(len(found) - words + 1)] or ([tuple(found)] if found else [])
        sets[doc_id] = set(shingles)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_all_pairs(spark, percent):
    rng = np.random.default_rng(percent)
    rows, n = [], 0
    for group in range(12):
        base = [f"w{rng.integers(4000)}" for _ in range(int(rng.integers(5, 120)))]
        for _ in range(int(rng.integers(1, 25))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = f"x{rng.integers(9)}"
            rows.append((n, " ".join(copy).title() if n % 3 else " ".join(copy)))
            n += 1
    want = plain_groups(rows, percent)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for r in near_duplicates(table, NearDuplicates(percent=percent)).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_odd_rows(odd, clashing):
    rows = near_duplicates(clashing).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[100].n_shingles == by[101].n_shingles == by[102].n_shingles == 0
    assert all(by[d].component_id == d and by[d].kept for d in (100, 101, 102))
    assert by[105].component_id == by[104].component_id != 105 and not by[105].kept
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    kept = neardup.keep_first(clashing)
    assert kept.columns == clashing.columns and kept.filter("doc_id = 105").count() == 0


def test_components_of_a_long_path(spark):
    nodes = [f"{(k * 37) % 101:03d}".encode() for k in range(101)]
    edges = [(min(a, b), max(a, b)) for a, b in zip(nodes[:-1], nodes[1:], strict=True)] + [(b"900", b"901")]
    table = materialize(spark.createDataFrame(edges, "one binary, other binary"), "test-edges")
    roots = {bytes(r.node): bytes(r.root) for r in components(table).collect()}
    assert roots == {**{n: b"000" for n in nodes}, b"900": b"900", b"901": b"900"}


def test_bayes_bound_never_prunes_clear_links():
    for n, least in NearDuplicates().least_matches():
        assert 0 < least < 0.85 * n


def test_pairs_are_compared_in_blocks_of_a_hot_node(spark, tmp_path, monkeypatch):
    """A node with very many others is many groups; each pair is tested once, on signatures as on sets."""
    monkeypatch.setattr(neardup, "NODE_BLOCKS", 7)
    values = {bytes([k]): np.arange(k, k + 20 + k % 3, dtype="<u8") for k in range(200)}
    table = spark.createDataFrame([(k, v.tobytes()) for k, v in values.items()], "node binary, shingles binary")
    pairs = [(bytes([0]), bytes([k])) for k in range(1, 200)] + [(bytes([9]), bytes([10])), (bytes([9]), bytes([150]))]

    def test(one, others):
        return np.array([len(np.intersect1d(one, o)) >= 10 for o in others])

    frame = spark.createDataFrame(pairs, "one binary, other binary").repartition(5)
    found = neardup._compared(frame, table, "shingles", "<u8", test).collect()
    want = [(a, b) for a, b in pairs if len(np.intersect1d(values[a], values[b])) >= 10]
    assert sorted((bytes(r["one"]), bytes(r["other"])) for r in found) == sorted(want)


def test_signatures_rule_pairs_out_in_batches():
    method = NearDuplicates()
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 16, method.hashes).astype(np.uint16)
    others = np.stack([np.where(rng.random(method.hashes) < share, one, one ^ 1) for share in (1.0, 0.95, 0.85, 0.5, 0.1)])
    assert neardup._plausible(one, others, method.least_matches()).tolist() == [True, True, True, False, False]


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15])
def test_rows_are_picked_by_marks_before_the_join(spark, monkeypatch, capsys, bits):
    """With keys too large to broadcast, the join moves few rows without a key, and the same rows come out."""
    monkeypatch.setattr(neardup, "MARK_BITS", bits)
    rows = spark.range(-30_000, 30_000).selectExpr("id AS doc_id", "CAST(id % 7 AS string) AS place")
    rows = rows.union(spark.sql("SELECT CAST(null AS bigint), 'x'")).union(rows.filter("doc_id = 5"))
    keys = materialize(spark.range(-30_000, 30_000).filter("pmod(id, 50) = 5 OR id = -29999").toDF("doc_id"), "test-keys")
    plain = neardup._picked(rows, keys, "doc_id").collect()
    monkeypatch.setattr(neardup, "BROADCAST_BYTES", 0)
    picked = neardup._picked(rows, keys, "doc_id")
    assert picked.columns == ["doc_id", "place"]
    assert sorted(picked.collect()) == sorted(plain) and len(plain) == 1202
    capsys.readouterr()
    picked.explain()
    assert "bitmap_construct_agg" in capsys.readouterr().out


def test_duplicates_write_little_of_texts_without_any(spark):
    """Scratch tables of texts that share no bucket hold their bands, not their signatures."""
    from pathlib import Path

    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{w}" for w in rng.integers(10_000, 99_999, 300))) for k in range(400)]
    table = materialize(spark.createDataFrame(rows, "doc_id long, text string"), "test-documents")
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "weftline"
    before = set(folder.iterdir())
    assert near_duplicates(table).filter("kept").count() == 400
    written = sum(f.stat().st_size for d in set(folder.iterdir()) - before for f in d.glob("*.parquet"))
    assert written < 0.6 * sum(len(text) for _, text in rows)


@pytest.mark.parametrize("broadcast", [0, 16 << 20])
def test_near_duplicates_shuffled_and_broadcast(spark, monkeypatch, broadcast):
    """Repeated ids with one or several texts, null ids and families of texts, with and without broadcasts."""
    rng, rows = np.random.default_rng(8), []
    for k in range(90):
        words = [f"w{(k // 6) * 100 + j}" for j in range(60)]
        for _ in range(int(rng.integers(0, 3))):
            words[int(rng.integers(60))] = f"x{rng.integers(50)}"
        rows.append((k, " ".join(words)))
    want = plain_groups(rows, 85)
    extra = [rows[9], rows[9], (None, rows[9][1])]
    monkeypatch.setattr(neardup, "BROADCAST_BYTES", broadcast)
    found = near_duplicates(spark.createDataFrame(rows + extra, "doc_id long, text string").repartition(4)).collect()
    assert len(found) == 93
    for r in found:
        assert r.doc_id is None or (r.n_shingles, r.component_id) == want[r.doc_id]
