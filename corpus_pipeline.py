"""A corpus made ready for training: language, near copies, repeated passages, secrets,
packing. Each stage takes what the stage before it kept, reread from Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import langid, ngram_join, packing, queries, secrets, substrings
from lexmill.llm.common import small_batches, table
from lexmill.session import checkpoint_root

# The near-copy stage: five words, similarity of 0.8 or more.
SHINGLE, SIMILARITY = 5, 0.8


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    small_batches(spark)
    model = langid.train(docs.where(queries.not_held_out(langid.FOLDS, langid.HELD_OUT)))
    found = langid.predict(docs, model, "_lang_pred", "_lang_score")
    return found.where(F.col("_lang_pred") != langid.UNKNOWN).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; documents
    without words are linked with nothing and stay."""
    small_batches(spark)
    return ngram_join.representatives(docs, SHINGLE, SIMILARITY)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds are taken out of the text."""
    small_batches(spark)
    return _sized(substrings.dedup(docs).select(*docs.columns))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _sized(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences."""
    small_batches(spark)
    import public_tokenizers

    found = packing.pieces(
        docs, queries.tokenizer_file("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )
    return packing.pack(found)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("secret_scans", secret_scans),
    ("packing", packed),
]

ORACLE_SQL = None  # SQL cannot express the language model; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
