"""A corpus cleaning pipeline over the documents table, from raw texts to packed token sequences.

Each stage works on all that the one before it kept, is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm import decontamination, packing, queries, simhash, substring, toxicity
from tripkit.session import materialize


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3, learned from the labels that are not held out."""
    labels = queries.read(spark, sf_dir, "labels").where(~queries.held_out())
    scored = toxicity.score(docs, toxicity.learn(docs, labels), score_column="_score")
    return scored.where("_score < 0.3").select(*docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of SimHash links: fingerprints of three-word shingles that differ in at most two bits."""
    queries.ship(spark)
    return simhash.one_of_each(docs, shingle=3).select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without any window of 35 words that occurs elsewhere; n_chars follows the text."""
    queries.ship(spark)
    kept = substring.without_repeated_windows(docs, window=35)
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("bigint")))


def remove_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.without_items(docs, queries.read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids and places in sequences of 4096 tokens."""
    queries.ship(spark)
    return packing.pack_documents(docs, queries.WORD_TOKENIZER, end_id=1, capacity=4096)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash near-dedup", remove_near_copies),
    ("substring dedup", remove_repeated_passages),
    ("benchmark decontamination", remove_test_items),
    ("best-fit packing", pack_sequences),
]

#: Fitted scores, fingerprints and tokens have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = queries.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}
