"""Registered queries of the operators: each takes (spark, folder), runs over whole tables, and digests real results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontamination, quality, secret_scan, toxicity
from weftline.llm.extraction import extract
from weftline.llm.fingerprints import edited_fingerprints
from weftline.llm.neardup import near_duplicates
from weftline.llm.packing import pack
from weftline.llm.periodic_runs import Planted, collapse_runs
from weftline.llm.repeated_passages import remove_repeats
from weftline.llm.sharding import assign_shards
from weftline.llm.tokenfiles import read_token_files, write_token_files
from weftline.llm.tokens import vocabulary_text
from weftline.llm.whitening import whiten
from weftline.sources.corpus import read_table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    words = secret_scan.dictionary(vocabulary_text(VOCABULARY))
    forest = secret_scan.fit(secret_scan.labelled_findings(documents, words), planted=secret_scan.planted_rows(words))
    return secret_scan.scan(documents, forest, words)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(read_table(spark, folder, "documents"), vocabulary_text(VOCABULARY))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = assign_shards(read_table(spark, folder, "documents"))
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return quality.score(documents, quality.fit(documents, read_table(spark, folder, "labels")))


def op6_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(read_table(spark, folder, "pages"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_passages(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, read_table(spark, folder, "labels")))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = write_token_files(read_table(spark, folder, "documents"), vocabulary_text(VOCABULARY))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(read_table(spark, folder, "documents"))
    removed = F.expr("aggregate(zip_with(begins, ends, (b, e) -> e - b), 0L, (total, size) -> total + size)")
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("begins").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all runs, and of the longest one (of these the first, then that of the smallest period)."""
    found = collapse_runs(read_table(spark, folder, "documents"), Planted())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("longest", F.array_max(ranked))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read_table(spark, folder, "embeddings"))


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_secret_scan": op2_secret_scan,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_extraction": op6_extraction,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
    "op11_repeated_passages": op11_repeated_passages,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}

_NEAR_DUPLICATES = r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS one, b.doc_id AS other
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT one, other FROM links UNION ALL SELECT other, one FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT r.doc_id, e.other FROM reached r JOIN edges e ON r.other = e.one),
firsts AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN firsts USING (doc_id)"""

#: The other operators use tokenizers, hashes or models that SQL has no form for; the tests compare them with plain versions.
ORACLE: dict[str, str] = {"op7_near_duplicates": _NEAR_DUPLICATES}
