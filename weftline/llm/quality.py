"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A document is counts of byte-class pairs and of terms for repetition, capitals and length. The labelled sample gives
term weights and a truncated singular basis; every document is projected, and its cosines with all labelled vectors are
computed exactly, in blocks. The labels of the nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import record_batch, share, span_hashes, text_bytes, text_slices, word_spans

_PAIR_BINS = 1024
_STEPS = 12
_MEASURES = 5
TERMS = _PAIR_BINS + _MEASURES * _STEPS
_BLOCK = 512


@dataclass(frozen=True)
class NeighbourVote:
    """Parameters: labelled rows at most (the sample), dimensions, neighbours, least score of label 1, weight of the measures."""

    labelled: int = 4096
    dimensions: int = 64
    neighbours: int = 15
    threshold: float = 0.7
    measures: float = 0.3


def _classes() -> np.ndarray:
    """64 classes of bytes: the small letters, all capitals, all digits, white space, single marks, the rest."""
    table = np.full(256, 63, np.int64)
    table[0x61:0x7B] = np.arange(26)
    table[0x41:0x5B] = 26
    table[0x30:0x3A] = 27
    table[0x20], table[0x0A] = 28, 29
    marks = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    table[marks] = 30 + np.arange(len(marks)) % 32
    return table


def _steps(share_: np.ndarray) -> np.ndarray:
    return np.minimum((share_ * _STEPS).astype(np.int64), _STEPS - 1)


def term_matrix(texts: pa.Array, weight: float) -> np.ndarray:
    """One row of terms for each text: square roots of relative counts; an empty text has the terms of its measures only."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(n), sizes)
    classes = _classes()[data]
    pairs = (classes[:-1] * 64 + classes[1:]) * 40503 >> 3 & (_PAIR_BINS - 1)
    same = rows[:-1] == rows[1:]
    counts = np.bincount(rows[:-1][same] * _PAIR_BINS + pairs[same], minlength=n * _PAIR_BINS).reshape(n, _PAIR_BINS)
    out = np.zeros((n, TERMS), np.float32)
    out[:, :_PAIR_BINS] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    starts, ends, first = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(hashes), np.int64)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    beside = np.zeros(len(hashes), np.int64)
    beside[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    total = np.maximum(words, 1)
    capitals = np.bincount(rows, weights=classes == 26, minlength=n) / np.maximum(sizes, 1)
    marks = np.bincount(rows, weights=(classes >= 30) & (classes < 63), minlength=n) / np.maximum(sizes, 1)
    measures = [
        np.bincount(owner[order], weights=again, minlength=n) / total,
        np.bincount(owner, weights=beside, minlength=n) / total,
        capitals,
        np.minimum(marks * 3, 1),
        np.minimum(np.log2(words + 1) / 16, 1),
    ]
    for k, measure in enumerate(measures):
        out[np.arange(n), _PAIR_BINS + k * _STEPS + _steps(measure)] = weight
    return out


#: Units of weighted terms, and of the basis and unit vectors: products of TERMS of them stay below 2^53.
_TERM_UNITS = float(1 << 18)
_UNITS = float(1 << 20)


@dataclass
class Voter:
    """A fitted model of bounded size: term weights, basis, labelled unit vectors and their labels."""

    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    method: NeighbourVote

    @classmethod
    def fit(cls, terms: np.ndarray, labels: np.ndarray, method: NeighbourVote) -> Voter:
        weights = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))).astype(np.float32) + 1
        weighted = terms * weights
        d = min(method.dimensions, *terms.shape) if len(terms) else 0
        basis = np.zeros((terms.shape[1], d), np.float32)
        if d:
            # Randomized range finder with two power steps, from a fixed seed.
            q = np.random.default_rng(7).standard_normal((terms.shape[1], min(d + 16, len(terms)))).astype(np.float32)
            for _ in range(3):
                q, _ = np.linalg.qr(weighted.T @ (weighted @ q))
            _, _, v = np.linalg.svd(weighted @ q, full_matrices=False)
            basis = (q @ v.T)[:, :d].astype(np.float32)
        model = cls(weights, basis, np.zeros((0, d)), labels.astype(np.float32), method)
        model.vectors = model.project(terms)
        return model

    def project(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors in whole units of 2^-20.

        Factors are rounded to whole units before each product, so sums are exact in double precision and a row has the
        same vector wherever it stands in a block.
        """
        weighted = np.rint(terms.astype(np.float64) * self.weights * _TERM_UNITS)
        out = weighted @ np.rint(self.basis.astype(np.float64) * _UNITS)
        return np.rint(out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12) * _UNITS)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """The share of label 1 among the nearest, weighted by similarity; their mean label where nothing is similar."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(terms), prior)
        k = min(self.method.neighbours, len(self.labels))
        for low in range(0, len(terms) if k else 0, _BLOCK):
            near = (self.project(terms[low : low + _BLOCK]) @ self.vectors.T).astype(np.int64)
            # Of equal similarities the first labelled rows count.
            keys = near * len(self.labels) - np.arange(len(self.labels))
            best = np.argpartition(keys, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(near, best, axis=1).astype(np.float64), 0)
            total = weight.sum(axis=1)
            votes = (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1)
            out[low : low + _BLOCK] = np.where(total > 0, np.clip(votes, 0, 1), prior)
        return out


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id has no label and isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text, label of at most `limit` documents, those with the smallest hashes of their ids.

    `labels` has doc_id and the named label (0 or 1); rows with a null in either are left out. Of several labels of a
    document the smallest counts; of several texts, the one with the smallest hash. The sample is of bounded size.
    """
    one = labels.groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    best = rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text")).alias("row"))
    return best.select("doc_id", "row.text", "row.label")


def fit(documents: DataFrame, labels: DataFrame, method: NeighbourVote = NeighbourVote()) -> Voter:
    """Learn from the labels that are not held out, on a sample of bounded size."""
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("terms", pa.binary())])
    weight = method.measures

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            terms = term_matrix(batch.column(1), weight).astype(np.float16)
            yield record_batch(schema, batch.column(0), batch.column(2), [row.tobytes() for row in terms])

    share(documents.sparkSession, None)
    sample = labelled_sample(documents, labels.filter(~is_held_out(F.col("doc_id"))), "quality", method.labelled)
    rows = sorted(tuple(r) for r in sample.mapInArrow(task, "doc_id long, label int, terms binary").collect())
    terms = np.frombuffer(b"".join(bytes(r[2]) for r in rows), np.float16).reshape(-1, TERMS).astype(np.float32)
    return Voter.fit(terms, np.array([r[1] for r in rows], np.float32), method)


def score(documents: DataFrame, voter: Voter) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; one narrow pass.

    `documents` has doc_id and text; other columns are not read, and doc_id is no input of a score. A null text is
    empty; an empty text is scored by its measures alone; equal texts have equal scores; repeated rows repeat and a null
    doc_id stays null. Without labelled rows every score is 0.5. No rows give no rows. Long texts are counted whole.
    """
    model = share(documents.sparkSession, voter)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter = model.value
        for batch in text_slices(batches, "text"):
            scores = voter.scores(term_matrix(batch.column(1), voter.method.measures))
            yield record_batch(schema, batch.column(0), pa.array(scores))

    found = documents.select("doc_id", "text").mapInArrow(task, "doc_id long, score double")
    return found.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= voter.method.threshold, 1).otherwise(0).alias("predicted"),
    )
