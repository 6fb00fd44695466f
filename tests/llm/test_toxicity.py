"""Training and scoring of toxicity count words alike."""

import numpy as np
import pyarrow as pa

from weftline.llm import toxicity
from weftline.llm.toxicity import Chain, ToxicityChain, _counted, word_features


def test_training_counts_words_as_scoring_does(spark, monkeypatch):
    texts = [f"plain words of old maps {'far ' * (20 * (k % 3))}" if k % 2 else f"bad words of old men {'far ' * k} {k}" for k in range(40)]
    seen = []
    plain = ToxicityChain.fit.__func__

    def fit(cls, features, toxic, keys, method):
        chain = plain(cls, features, toxic, keys, method)
        seen.append((features, chain))
        return chain

    monkeypatch.setattr(ToxicityChain, "fit", classmethod(fit))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    toxicity.fit(documents, spark.createDataFrame([(k, 1 - k % 2) for k in range(40)], "doc_id long, toxic int"), Chain())
    ((features, chain),) = seen
    scored = _counted(*word_features(pa.array(texts)), chain.place, 40, chain.width)
    trained = [_counted(own, np.zeros(len(own), np.int64), chain.place, 1, chain.width, times)[0] for own, times in features]
    assert np.allclose(scored, trained) and scored.max() > np.log(9)
