import public_tokenizers
import pytest
from pyspark.sql import types as T

from weftline.llm.tokens import vocabulary_text

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
WORDS = "the quick brown fox jumps over a lazy dog while seven wise men look at old maps of far lands and talk".split()


@pytest.fixture(scope="session")
def vocabulary():
    return vocabulary_text(public_tokenizers.path("word_bpe_49k.json"))


def prose(seed, words=40):
    return " ".join(WORDS[(seed * 7 + k * k + 3 * k) % len(WORDS)] for k in range(words))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and blank texts, a long one, ties, repeated rows, and many short ones."""
    rows = [(k, prose(k, 5 + k % 30), "en", "a", None) for k in range(60)]
    rows += [(100, None, None, None, None), (101, "", "en", None, 0), (102, " \n\t ", "en", "a", 3), (103, "Über straße ñ 😀", "de", "a", 1)]
    rows += [(104, prose(3, 33), "en", "a", 1), (105, prose(3, 33), "en", "b", 1), (106, prose(9, 30_000), "en", "a", 1)]
    rows += [(7, prose(7, 12), "en", "a", None), (None, prose(11, 16), "en", "a", None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like those that operators work with."""
    names = ["node", "bucket", "kept_id", "toxicity", "contaminated", "redacted", "shard", "hash", "rank", "range", "Toxicity_"]
    return odd.selectExpr("*", *[f"doc_id AS {n}" for n in names])
