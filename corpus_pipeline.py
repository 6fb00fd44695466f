"""A corpus pipeline of five stages: toxicity, near duplicates, decontamination, secrets, packing.

Each stage is a function of (spark, docs, sf_dir). Its result is written and read again as the docs of the next one. All
but the last return the columns of docs, whatever they are, for the rows that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontamination, secret_scan, toxicity
from weftline.llm.neardup import NearDuplicates, keep_first
from weftline.llm.packing import pack
from weftline.llm.queries import VOCABULARY
from weftline.llm.tokens import vocabulary_text
from weftline.session import materialize
from weftline.sources.corpus import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier chain does not reject; it learns from the labels of the table."""
    chain = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of documents linked at a similarity of 0.8 or more."""
    return keep_first(docs, NearDuplicates(percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark; n_chars is that of the new text."""
    words = secret_scan.dictionary(vocabulary_text(VOCABULARY))
    forest = secret_scan.fit(secret_scan.labelled_findings(docs, words), planted=secret_scan.planted_rows(words))
    redacted = secret_scan.redact(docs, forest, words)
    if "n_chars" not in docs.columns:
        return redacted
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return redacted.withColumn("n_chars", length).select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2,048 ids."""
    return pack(docs, vocabulary_text(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_documents),
]

#: SQL can express neither the classifiers nor banded alignment; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder: the packed pieces, whose ids are in the column `ids`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
