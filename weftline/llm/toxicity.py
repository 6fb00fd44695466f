"""Toxic documents by a chain of linear classifiers.

Categories are groups of toxic labelled documents that use the same words, and toxicity itself comes last. Each
classifier sees word features and the probabilities of the categories before it; in training these are out-of-fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import IS_SPACE, LOWER, U64, fresh, mix, record_batch, share, span_hashes, text_bytes, text_slices, word_spans
from weftline.llm.quality import labelled_sample
from weftline.session import materialize

_BITS = 18
#: Bytes of the beginnings of words that are features beside whole words.
_PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Chain:
    """Parameters: labelled rows at most (the sample), categories, folds, features, steps, penalty, least probability of a rejection."""

    labelled: int = 4096
    categories: int = 4
    folds: int = 5
    features: int = 384
    steps: int = 150
    penalty: float = 3e-5
    threshold: float = 0.3

    def choose(self, positive: np.ndarray, negative: np.ndarray, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of all features from the numbers of documents with them, and the chosen ones, the strongest first."""
        odds = np.log((positive + 0.5) / (toxic + 1)) - np.log((negative + 0.5) / (clean + 1))
        # Evidence: the log odds times the square root of how often the feature is seen.
        evidence = np.where(positive + negative >= 3, np.abs(odds) * np.sqrt(positive + negative), 0)
        chosen = np.argsort(-evidence, kind="stable")[: self.features]
        return odds, chosen[evidence[chosen] > 0]


def _is_mark() -> np.ndarray:
    table = IS_SPACE.copy()
    table[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
    return table


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words and of their first bytes, in a row, and the text of each. Marks divide words."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    data = np.where(_is_mark()[data], np.uint8(0x20), data)
    starts, ends, first = word_spans(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    bins, owners = [span_hashes(data, starts, ends)], [owner]
    for size in _PREFIXES:
        long = ends - starts > size
        bins.append(mix(span_hashes(data, starts[long], starts[long] + size) + U64(size)))
        owners.append(owner[long])
    return (np.concatenate(bins) >> U64(64 - _BITS)).astype(np.int64), np.concatenate(owners)


def _counted(bins: np.ndarray, owner: np.ndarray, place: np.ndarray, n: int, width: int, times: np.ndarray | None = None) -> np.ndarray:
    """log(1 + count) of the chosen features; each stands once, or so many times as given."""
    column = place[bins]
    known = column >= 0
    weights = None if times is None else times[known]
    counts = np.bincount(owner[known] * width + column[known], weights, minlength=n * width).reshape(n, width)
    return np.log1p(counts).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _linear(x: np.ndarray, y: np.ndarray, steps: int, penalty: float) -> np.ndarray:
    """Logistic regression by accelerated gradient steps on columns of equal spread; the last weight is the constant."""
    spread = np.maximum(x.std(axis=0), 1e-3).astype(np.float32)
    x = np.hstack([x / spread, np.ones((len(x), 1), np.float32)])
    top = np.ones(x.shape[1], np.float32)
    for _ in range(12):  # power steps: the largest curvature sets the rate
        top = x.T @ (x @ (top / np.linalg.norm(top)))
    rate = np.float32(3 / (np.linalg.norm(top) / len(x) + 4 * penalty))
    w = np.zeros(x.shape[1], np.float32)
    v = w.copy()
    for k in range(steps):
        gradient = x.T @ ((_sigmoid(x @ v) - y) / len(y)) + np.float32(penalty) * v
        gradient[-1] -= penalty * v[-1]
        step = v - rate * gradient
        v = step + np.float32(k / (k + 3)) * (step - w)
        w = step
    w[:-1] /= spread
    return w


@dataclass
class ToxicityChain:
    """A fitted chain of bounded size: the column of each hashed feature (-1: none), and the weights of each category."""

    place: np.ndarray
    width: int
    weights: list[np.ndarray]
    method: Chain

    @classmethod
    def fit(cls, features: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, keys: np.ndarray, method: Chain) -> ToxicityChain:
        """`features`: the hashed features of each document, each once, and their counts; folds follow from `keys`."""
        positive, negative = np.zeros(1 << _BITS), np.zeros(1 << _BITS)
        for (own, _), label in zip(features, toxic.tolist(), strict=True):
            (positive if label == 1 else negative)[own] += 1
        odds, chosen = method.choose(positive, negative, toxic.sum(), (1 - toxic).sum())
        place = np.full(1 << _BITS, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        x = np.zeros((len(features), len(chosen)), np.float32)
        for row, (own, times) in zip(x, features, strict=True):
            row += _counted(own, np.zeros(len(own), np.int64), place, 1, len(chosen), times)[0]
        groups = cls._groups(x * np.maximum(odds[chosen], 0), toxic, method.categories)
        targets = [(groups == c).astype(np.float32) for c in range(method.categories)] + [toxic.astype(np.float32)]
        fold, weights = keys % method.folds, []
        for target in targets:
            held = np.zeros(len(x), np.float32)
            for f in range(method.folds):
                train = fold != f
                if train.any() and (~train).any():
                    w = _linear(x[train], target[train], method.steps, method.penalty)
                    held[~train] = _sigmoid(x[~train] @ w[:-1] + w[-1])
            weights.append(_linear(x, target, method.steps, method.penalty) if len(x) else np.zeros(x.shape[1] + 1, np.float32))
            x = np.hstack([x, _logit(held)[:, None].astype(np.float32)])
        return cls(place, len(chosen), weights, method)

    @staticmethod
    def _groups(x: np.ndarray, toxic: np.ndarray, k: int) -> np.ndarray:
        """Groups of toxic documents by the cosine of their features (-1: not toxic), from spread first centres."""
        out = np.full(len(x), -1)
        rows = np.flatnonzero(toxic == 1)
        if not len(rows) or not x.shape[1]:
            return out
        unit = x[rows] / np.maximum(np.linalg.norm(x[rows], axis=1, keepdims=True), 1e-9)
        centres = [unit.mean(axis=0)]
        for _ in range(k):
            far = np.max([unit @ c for c in centres], axis=0)
            centres.append(unit[np.argmin(far)])
        centres = np.array(centres[1:])
        for _ in range(10):
            near = np.argmax(unit @ centres.T, axis=1)
            centres = np.array([unit[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(k)])
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        out[rows] = near
        return out

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """One row for each text: the categories in the order of the chain, toxicity last."""
        n = len(texts)
        if not self.width:
            constant = self.weights[-1][-1] if self.weights else 0.0
            return np.tile(_sigmoid(np.array([w[-1] for w in self.weights] or [constant])), (n, 1))
        x = _counted(*word_features(texts), self.place, n, self.width)
        for w in self.weights:
            p = _sigmoid(x @ w[:-1] + w[-1])
            x = np.hstack([x, _logit(p)[:, None].astype(np.float32)])
        return _sigmoid(x[:, self.width :])


def fit(documents: DataFrame, labels: DataFrame, method: Chain = Chain()) -> ToxicityChain:
    """Learn from a sample of labelled documents of bounded size.

    Documents with each feature are counted in Spark; the driver gets these counts, at most one row for each hashed
    feature, and of each document the chosen features alone, however long its text is.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            bins, owner = word_features(batch.column(1))
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.arange(batch.num_rows + 1))
            sets = [np.unique(bins[order[a:b]], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield record_batch(schema, batch.column(0), batch.column(2), [values.astype(np.int32) for values, _ in sets], [counts for _, counts in sets])

    share(documents.sparkSession, None)
    sample = labelled_sample(documents, labels, "toxic", method.labelled)
    counted = sample.mapInArrow(task, "doc_id long, label int, features array<int>, counts array<long>")
    counted = materialize(counted, "toxicity-features")
    toxic, clean = counted.agg(F.coalesce(F.sum("label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("label")), F.lit(0))).first()
    seen = counted.select("label", F.explode("features").alias("feature")).groupBy("feature")
    seen = seen.agg(F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("label") != 1).alias("negative")).toArrow()
    sides = np.zeros((2, 1 << _BITS))
    sides[:, seen.column("feature").to_numpy()] = seen.column("positive").to_numpy(), seen.column("negative").to_numpy()
    _, chosen = method.choose(*sides, toxic, clean)
    pairs = F.filter(F.arrays_zip("features", "counts"), lambda pair: pair["features"].isin(chosen.tolist()))
    kept = counted.select("doc_id", "label", pairs.alias("pairs"))
    table = kept.select("doc_id", "label", "pairs.features", "pairs.counts").toArrow().sort_by("doc_id")
    columns = [table.column(k).combine_chunks().to_numpy(zero_copy_only=False) if len(table) else [] for k in (2, 3)]
    features = [(np.asarray(f), np.asarray(c)) for f, c in zip(*columns, strict=True)]
    keys = np.array([abs(int(i)) * 2654435761 % (1 << 32) >> 8 for i in table.column(0).to_pylist()], np.int64)
    return ToxicityChain.fit(features, np.array(table.column(1).to_pylist(), np.int64), keys, method)


def names(method: Chain) -> list[str]:
    return [f"category_{c}" for c in range(method.categories)] + ["toxicity"]


def score(documents: DataFrame, chain: ToxicityChain) -> DataFrame:
    """doc_id, category_0, ..., toxicity, kept of every row; one narrow pass.

    `documents` has doc_id and text; other columns are not read. A null or empty text has no features and gets the
    constants of the chain; repeated rows repeat; a null doc_id stays null; no rows give no rows. Long texts are
    counted whole. Without labelled rows every probability is 0.5 or less and all are kept.
    """
    model = share(documents.sparkSession, chain)
    columns = names(chain.method)
    schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.float64()) for c in columns])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = model.value.probabilities(batch.column(1)).astype(np.float64)
            yield record_batch(schema, batch.column(0), *(pa.array(found[:, k]) for k in range(len(columns))))

    kind = ", ".join(["doc_id long", *(f"{c} double" for c in columns)])
    found = documents.select("doc_id", "text").mapInArrow(task, kind)
    return found.withColumn("kept", F.col("toxicity") <= chain.method.threshold)


def keep_clean(documents: DataFrame, chain: ToxicityChain) -> DataFrame:
    """The rows, with all their columns, that the chain does not reject; a null text is kept."""
    model = share(documents.sparkSession, chain)
    name = fresh(documents, "toxicity")

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [model.value.probabilities(b.column(0))[:, -1].astype(np.float64) for b in text_slices(iter([batch]), "text")]
        return pa.array(np.concatenate([*parts, np.empty(0)]))

    scored = documents.withColumn(name, toxicity(F.col("text")))
    return scored.filter(F.col(name) <= chain.method.threshold).drop(name)
