"""Repeated passages and periodic runs against plain loops."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import prose

from weftline.llm.periodic_runs import Grammar, Planted, collapse_runs, find_runs
from weftline.llm.queries import op11_repeated_passages, op12_periodic_runs
from weftline.llm.repeated_passages import RepeatedPassages, remove_repeats


def plain_repeats(rows, length):
    """(doc_id, bytes, runs that go, rest) by counting every string."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])))
    return sorted(out, key=repr)


def found_repeats(frame, method):
    rows = [
        (r["doc_id"], r["n_bytes"], sum(e - b for b, e in zip(r["begins"], r["ends"])), len(r["begins"]), bytes(r["kept"]))
        for r in remove_repeats(frame, method).collect()
    ]
    return sorted(rows, key=repr)


def test_repeats_of_a_whole_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, n, gone, spans, kept in plain_repeats(rows, 400)]
    assert sorted([tuple(r) for r in op11_repeated_passages(spark, folder).collect()], key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("length, window", [(60, 30), (40, 8)])
def test_repeats_of_odd_rows(spark, odd, clashing, length, window):
    method = RepeatedPassages(length, window)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = plain_repeats(rows, length)
    assert found_repeats(odd, method) == want
    assert found_repeats(clashing, method) == want
    assert remove_repeats(odd.limit(0), method).count() == 0


def test_repeats_within_texts_and_in_hot_passages(spark):
    rng = np.random.default_rng(5)
    passage = prose(4, 30)
    rows = [(k, f"{prose(k, 9)} {rng.integers(10**9)} {passage if k % 3 else ''} {prose(k + 50, 11)} {k}") for k in range(240)]
    rows += [(900, "-" * 5000), (901, "=" * 700 + "-" * 90 + "=" * 200), (902, "ab" * 900), (903, "é" * 300), (904, passage[:-1])]
    rows += [(905, prose(1, 2) + "-" * 100), (None, passage), (7, rows[7][1]), (906, "x".join(map(str, range(900))))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found_repeats(frame, RepeatedPassages(100, 50)) == plain_repeats(rows, 100)


def test_a_long_text_in_blocks(spark):
    rng = np.random.default_rng(6)
    text = "".join(map(chr, rng.integers(97, 123, 1_300_000)))
    text = text + text[500_000:540_000]
    (row,) = remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert list(zip(row["begins"], row["ends"])) == [(500_000, 540_000), (1_300_000, 1_340_000)]


def plain_runs(words, shortest=12):
    """All runs by trying every period at every place: start, length, period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(shortest, 2 * q):
                found[start, length] = min(q, found.get((start, length), q))
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_a_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").filter("n_chars < 9000").collect()
    found = {r["doc_id"]: tuple(r) for r in op12_periodic_runs(spark, folder).collect()}
    assert sum(r[1] > 0 for r in found.values()) > 10
    assert all(found[r["doc_id"]] == plain_row(r["doc_id"], r["text"]) for r in rows)
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_runs_of_odd_rows(odd, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for frame in (odd, clashing):
        found = collapse_runs(frame).collect()
        assert len(found) == len(rows)
        for row in found:
            texts = [(t or "").encode().split() for i, t in rows if i == row["doc_id"]]
            if max(map(len, texts)) < 2000:
                assert [tuple(r) for r in row["runs"]] in [plain_runs(w) for w in texts]
    assert collapse_runs(odd.limit(0), Planted()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    rng = np.random.default_rng(seed)
    for _ in range(30):
        documents = []
        for _ in range(rng.integers(1, 7)):
            n = int(rng.integers(0, 70))
            words = rng.integers(0, rng.integers(1, 4), n)
            if n > 10 and rng.random() < 0.5:
                p, a = int(rng.integers(1, n // 2)), int(rng.integers(0, n))
                words = np.concatenate([words[:a], words[a + np.arange(n - a) % p % (n - a)]])
            documents.append(words)
        first = np.concatenate([[0], np.cumsum([len(w) for w in documents])]).astype(np.int64)
        found = find_runs(np.concatenate(documents), first)
        want = [(k, *r) for k, w in enumerate(documents) for r in plain_runs(w.tolist())]
        assert [tuple(r) for r in found.tolist()] == want


def test_extensions_of_the_grammar():
    rng = np.random.default_rng(3)
    for words in (rng.integers(0, 3, 400), np.zeros(300, np.int64), np.arange(300) % 5, np.repeat(np.arange(40), 9) % 3):
        grammar, n = Grammar(words), len(words)
        one = rng.integers(0, n - 1, 500)
        other = one + 1 + rng.integers(0, n, 500) % (n - one - 1 + (one == n - 1))
        right, left = grammar.extension(one, other), grammar.extension(n - one, n - other, mirrored=True)
        for i, j, r, b in zip(one, other, right, left):
            assert r == next((k for k in range(n - j) if words[i + k] != words[j + k]), n - j)
            assert b == next((k for k in range(i) if words[i - 1 - k] != words[j - 1 - k]), i)
