"""Registry and shared inputs of the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.tokens import byte_ranks, encode
from lexmill.session import written
from lexmill.sources.readers import read_corpus, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` gives the same rows when run on the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table given as one Parquet file or as a folder of them."""
    return read_corpus(spark, f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for work on their texts."""
    return spread(table(spark, folder, "documents"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages"))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents under the column names of a crawl table. The stored character count
    stands in for the token count, so statistics need not read the texts."""
    return table(spark, folder, "documents").select(
        "doc_id",
        "text",
        F.col("lang").alias("language"),
        F.col("source").alias("file"),
        F.col("n_chars").alias("token_count"),
    )


def tokenized(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with byte tokens."""
    docs = documents(spark, folder).select("doc_id", "source", "text")
    return encode(docs, byte_ranks()).drop("text")


def token_table(spark: SparkSession, folder: str) -> DataFrame:
    """The token table as written by the tokenising job, for jobs that read it more
    than once."""
    made = tokenized(spark, folder).withColumn("token_count", F.size("tokens"))
    return written(made, "token-table")


def hexed(tokens) -> Column:
    """Byte tokens as one hexadecimal string, for comparison."""
    digits = F.split(F.lit(",".join(f"{b:02X}" for b in range(256))), ",")
    return F.array_join(F.transform(tokens, lambda i: F.get(digits, i)), "")


# Page-like noise put into the documents by plain replacements, so that every rule for
# page text has work to do. The check applies the same replacements.
NOISE = (
    ("tion", "ti-\non"),
    (". ", ".\n\nPage 12 of 240\x0c\nPage 7\n"),
    (", ", " [1, 2],\n"),
    (" the ", " the[3] DRAFT \t "),
    (" de ", " de\u00ad\u200b Confidential see http://a.b/c?d=1&e=~f#top x "),
    (" on ", " on foo.bar@ex-a.co.uk "),
    (" in ", " in [4]x All Rights Reserved "),
    ("\u00e9", "e\u0301"),
)


def noisy(text: str = "text") -> Column:
    column = F.col(text)
    for old, new in NOISE:
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


def noisy_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(
        "doc_id", "source", noisy().alias("text")
    )
