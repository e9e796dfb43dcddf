"""Word vocabularies: building, encoding, decoding, unknown words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators import blocks
from lexmill.operators.indexing import ordered_index
from lexmill.operators.lookups import fits_broadcast, lookup
from lexmill.session import written


def token_counts(df: DataFrame, text: str = "text", delimiters: str = P.DELIMITERS_V2):
    return (
        df.select(F.explode(X.split_punct(text, delimiters)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def distinct_tokens(df: DataFrame, text: str = "text", delimiters: str = P.DELIMITERS_V2):
    return df.select(F.explode(X.split_punct(text, delimiters)).alias("token")).distinct()


def build_vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """Sorted distinct tokens numbered from 0, then the special tokens.

    A special token that occurs in the corpus keeps only its later number; its place
    in the sort order stays unused. Both parts come from one written table.
    """
    indexed = ordered_index(distinct_tokens(df, text), "token", index="id")
    return append_specials(indexed)


def append_specials(indexed: DataFrame) -> DataFrame:
    """Add the special tokens behind ``indexed`` (token, id)."""
    specials = F.array(
        *[
            F.struct(F.lit(t).alias("token"), F.lit(i).alias("place"))
            for i, t in enumerate(P.SPECIAL_TOKENS)
        ]
    )
    tail = (
        indexed.agg(F.count(F.lit(1)).alias("_n"))
        .select("_n", F.inline(specials))
        .select("token", (F.col("_n") + F.col("place")).alias("id"))
    )
    words = indexed.where(~F.col("token").isin(*P.SPECIAL_TOKENS)).select("token", "id")
    return words.unionByName(tail)


def _resolved(df: DataFrame, key: str, values: Column, vocabulary: DataFrame, name: str) -> DataFrame:
    """Values of every text with what the vocabulary says of them, in one pass over the
    texts, spread by key.

    A vocabulary measured small is broadcast: ``_key``, ``_null``, the value under ``name`` and its
    place ``_at``; a null or empty array has one row without a value. Beside a larger one the texts lie in
    blocks (``operators.blocks``), and every block sends each distinct value once."""
    if fits_broadcast(vocabulary):
        taken = df.repartition(key).select(F.col(key).alias("_key"), values.alias("_values"))
        each = taken.select("_key", F.col("_values").isNull().alias("_null"), F.posexplode_outer("_values").alias("_at", name))
        return each.join(F.broadcast(vocabulary), name, "left")
    ordered = df.repartition(key).sortWithinPartitions(key)
    entries = blocks.cut(ordered.select(F.col(key).alias("_key"), values.alias("_values")), name)
    # Rows without a value match nothing; dealt by block, or they would all go to one task.
    none = F.xxhash64("_block").bitwiseOR(F.lit(1))
    dealt = entries.withColumn("_deal", F.when(F.col(name).isNull(), none).otherwise(0))
    # Always 0, but from the row: a literal would leave the join's keys.
    known = vocabulary.withColumn("_deal", F.pmod(F.xxhash64(name), F.lit(1).cast("bigint")))
    return dealt.join(known, [name, "_deal"], "left").drop("_deal")


def _gather(df: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Values of a document back at their places: one row per document, as the input had.
    Rows that share a key are one document, with the values of each place side by side."""
    if "_block" in df.columns:
        return blocks.put_back(df, value).select(F.col("_key").alias(key), F.col("_list").alias(output))
    entry = F.when(F.col("_at").isNotNull(), F.struct(F.col("_at").alias("at"), value))
    # The partial arrays are built before the shuffle.
    gathered = df.groupBy("_key").agg(F.collect_list(entry).alias("_list"), F.bool_or("_null").alias("_n"))
    back = F.array_sort("_list").getField(value)
    return gathered.select(F.col("_key").alias(key), F.when(~F.col("_n"), back).alias(output))


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unknown: str = "unk",
    delimiters: str | None = None,
    output: str = "ids",
) -> DataFrame:
    """Word ids of every text, ``key`` being unique.

    ``unknown="unk"`` maps words outside the vocabulary to the unknown-word id,
    ``unknown="error"`` fails on them. The splitter follows the same choice unless
    ``delimiters`` is given.
    """
    if unknown not in ("unk", "error"):
        raise ValueError(f"unknown policy: {unknown}")
    strict = unknown == "error"
    delimiters = delimiters or (P.DELIMITERS_V1 if strict else P.DELIMITERS_V2)
    found = _resolved(df, key, X.split_punct(text, delimiters), vocabulary, "token")
    if strict:
        fallback = F.raise_error(F.concat(F.lit("unknown token: "), F.col("token")))
        fallback = fallback.cast("bigint")
    else:
        fallback = (
            vocabulary.where(F.col("token") == P.UNKNOWN).agg(F.max("id")).scalar()
        )
    missing = F.col("token").isNotNull() & F.col("id").isNull()
    resolved = F.when(missing, fallback).otherwise(F.col("id"))
    return _gather(found.withColumn("id", resolved), key, "id", output)


def decode(
    df: DataFrame,
    vocabulary: DataFrame,
    key: str = "doc_id",
    ids: str = "ids",
    tight: str = P.TIGHT_MARKS_V2,
    output: str = "text",
) -> DataFrame:
    """Words joined by blanks, then blanks before punctuation removed."""
    found = _resolved(df, key, F.col(ids), vocabulary, "id")
    failed = F.raise_error(F.concat(F.lit("unknown id: "), F.col("id"))).cast("string")
    missing = F.col("id").isNotNull() & F.col("token").isNull()
    found = found.withColumn("token", F.when(missing, failed).otherwise(F.col("token")))
    tokens = _gather(found, key, "token", "_tokens")
    return tokens.select(key, tighten(F.array_join("_tokens", " "), tight).alias(output))


def tighten(text, tight: str = P.TIGHT_MARKS_V2) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(column, tight, "$1")


def unknown_tokens(
    df: DataFrame, vocabulary: DataFrame, text: str = "text", delimiters: str = P.DELIMITERS_V1
) -> DataFrame:
    """Words outside the vocabulary with their counts; counted before the join, so
    each word takes part in it once."""
    counted = token_counts(df, text, delimiters)
    return counted.join(vocabulary.select("token"), "token", "left_anti")


def known_documents(
    df: DataFrame,
    vocabulary: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    delimiters: str = P.DELIMITERS_V1,
) -> DataFrame:
    """Rows whose words are all in the vocabulary (those strict encoding accepts)."""
    unknown = written(unknown_tokens(df, vocabulary, text, delimiters).select("token"))
    found = F.array_distinct(X.split_punct(text, delimiters))
    pairs = df.select(F.col(key).alias("_key"), F.explode(found).alias("token"))
    hits = lookup(pairs, unknown.withColumn("_hit", F.lit(True)), ["token"]).where("_hit")
    bad = hits.select(F.col("_key").alias(key)).distinct()
    return df.join(bad, key, "left_anti")


def join_texts(
    df: DataFrame,
    key: str,
    order: str,
    text: str = "text",
    separator: str = f" {P.END_OF_TEXT} ",
    rows_per_part: int | None = None,
) -> DataFrame:
    """Texts of a key joined in order, one row per key. Null texts are left out; texts of
    equal order are sorted.

    A joined text is one value and must fit in a task. Where keys may be larger,
    ``rows_per_part`` returns a key in several rows, ``part`` 0, 1, ..., whose texts
    joined by the separator are the whole; ``order`` then numbers the texts from 0.
    """
    by = [key]
    if rows_per_part is not None:
        by.append(F.floor(F.col(order) / rows_per_part).alias("part"))
    placed = F.struct(F.col(order).alias("_at"), F.col(text).alias("_t"))
    ordered = F.array_sort(F.collect_list(placed)).getField("_t")
    return (
        df.where(F.col(text).isNotNull())
        .groupBy(*by)
        .agg(F.array_join(ordered, separator).alias(text))
    )


def concat_pages(df: DataFrame, key: str, order: str, text: str = "text", **parts):
    """Page texts of a document in page order, one per line."""
    return join_texts(df, key, order, text, "\n", **parts)
