"""Votes of neighbours against plain loops, and features of toxicity against plain counts."""

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import toxicity
from weftline.llm.quality import NeighbourVote, Voter, term_matrix
from weftline.llm.toxicity import Chain, ToxicityChain, word_features

rng = np.random.default_rng(8)
TEXTS = ["".join(chr(int(c)) for c in rng.integers(32, 126, int(rng.integers(1, 400)))) for _ in range(90)] + ["", "a", "a"]


@pytest.fixture(scope="module")
def voter():
    method = NeighbourVote(dimensions=8, neighbours=5)
    labelled = TEXTS[:50] + TEXTS[:10]  # ties: vectors that stand twice, with another label
    labels = np.array([k % 3 == 0 for k in range(60)], np.float32)
    return Voter.fit(term_matrix(pa.array(labelled), method.measures), labels, method)


def test_votes_by_plain_loops(voter):
    terms = term_matrix(pa.array(TEXTS), voter.method.measures)
    vectors = [[int(x) for x in row] for row in voter.vectors]
    for own, score in zip(voter.project(terms), voter.scores(terms), strict=True):
        own = [int(x) for x in own]
        near = [sum(a * b for a, b in zip(own, other, strict=True)) for other in vectors]
        best = sorted(range(len(near)), key=lambda k: (-near[k], k))[: voter.method.neighbours]
        total = sum(max(near[k], 0) for k in best)
        want = sum(max(near[k], 0) * int(voter.labels[k]) for k in best) / total if total else float(voter.labels.mean())
        assert abs(score - want) < 1e-12


def test_equal_texts_have_equal_scores_in_any_block(voter):
    def scores(texts):
        return voter.scores(term_matrix(pa.array(texts), voter.method.measures)).tolist()

    together = scores(TEXTS * 13)  # several blocks
    assert together == together[: len(TEXTS)] * 13
    assert together[: len(TEXTS)] == [scores([t])[0] for t in TEXTS]
    order = rng.permutation(len(TEXTS)).tolist()
    assert scores([TEXTS[k] for k in order]) == [together[k] for k in order]


def test_vectors_have_length_one_and_keep_cosines(voter):
    vectors = voter.project(term_matrix(pa.array(TEXTS[:20]), voter.method.measures)) / (1 << 20)
    assert np.allclose(np.linalg.norm(vectors, axis=1), 1, atol=1e-5)


def test_features_are_chosen_by_counts_of_all_labelled_documents(spark, monkeypatch):
    """Only the chosen features reach the driver, and they are those of a count over whole texts."""
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 300 if k % 2 else 60, 40 + 3000 * (k == 7))) for k in range(60)]
    method, seen = Chain(features=24), []
    plain = ToxicityChain.fit.__func__

    def fit(cls, features, toxic, keys, method):
        seen.append(features)
        return plain(cls, features, toxic, keys, method)

    monkeypatch.setattr(ToxicityChain, "fit", classmethod(fit))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chain = toxicity.fit(documents, spark.createDataFrame([(k, 1 - k % 2) for k in range(60)], "doc_id long, toxic int"), method)
    counts: dict[int, list[int]] = {}
    for k, text in enumerate(texts):
        for feature in set(word_features(pa.array([text]))[0].tolist()):
            counts.setdefault(feature, [0, 0])[k % 2] += 1
    def evidence(feature):
        bad, good = counts[feature]
        return abs(np.log((bad + 0.5) / 31) - np.log((good + 0.5) / 31)) * (bad + good) ** 0.5 if bad + good >= 3 else 0

    want = sorted((f for f in counts if evidence(f) > 0), key=lambda f: (-evidence(f), f))[:24]
    assert np.flatnonzero(chain.place >= 0).tolist() == sorted(want)
    assert all(set(own.tolist()) <= set(want) for own, _ in seen[0])
