"""Projections, filters, formatting."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog.registry import corpus, documents, hexed, query, table, tokenized
from lexmill.functions import arrays as A
from lexmill.functions import text as X
from lexmill.operators import examples, stats, tokens


@query("resolve_text_column", "SELECT doc_id, text AS chosen FROM documents")
def resolve_text_column(spark, folder):
    docs = documents(spark, folder)
    return docs.select("doc_id", F.col(stats.resolve_text_column(docs.columns)).alias("chosen"))


@query("filter_source", "SELECT doc_id, source, text FROM documents WHERE source = 'src3'")
def filter_source(spark, folder):
    return documents(spark, folder).select("doc_id", "source", "text").where("source = 'src3'")


@query(
    "filter_min_tokens",
    """
    SELECT doc_id, octet_length(encode(text)) AS token_count FROM documents
    WHERE octet_length(encode(text)) >= 1024
    """,
)
def filter_min_tokens(spark, folder):
    long = examples.filter_min_tokens(tokenized(spark, folder), 1024)
    return long.select("doc_id", tokens.token_count().alias("token_count"))


@query("preview_fixed", "SELECT doc_id, left(text, 200) || '...' AS preview FROM documents")
def preview_fixed(spark, folder):
    return documents(spark, folder).select("doc_id", X.preview("text").alias("preview"))


@query(
    "preview_truncated",
    """
    SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 500) || '...'
      WHEN length(text) = 0 THEN '(empty)' ELSE text END AS preview
    FROM (SELECT doc_id, text FROM documents UNION ALL
          SELECT -1 - doc_id, left(text, n_chars % 700) FROM documents)
    """,
)
def preview_truncated(spark, folder):
    docs = documents(spark, folder)
    cut = F.substr(F.col("text"), F.lit(1), (F.col("n_chars") % 700).cast("int"))
    shorter = docs.select((-1 - F.col("doc_id")).alias("doc_id"), cut.alias("text"))
    both = docs.select("doc_id", "text").unionByName(shorter)
    return both.select("doc_id", X.preview_truncated("text").alias("preview"))


@query(
    "annotate_tokens",
    """
    SELECT doc_id, octet_length(encode(text)) AS sequence_length, 50257 AS vocab_size,
           'gpt2' AS tokenizer FROM documents
    """,
)
def annotate_tokens(spark, folder):
    noted = tokens.annotate(tokenized(spark, folder), "tokens")
    return noted.select("doc_id", "sequence_length", "vocab_size", "tokenizer")


@query("optional_column", "SELECT doc_id, lang, NULL::VARCHAR AS language FROM documents")
def optional_column(spark, folder):
    docs = documents(spark, folder)
    return docs.select(
        "doc_id", stats.optional_column(docs, "lang"), stats.optional_column(docs, "language")
    )


@query(
    "clip_tokens",
    "SELECT doc_id, left(hex(encode(text)), 4000) AS tokens FROM documents",
)
def clip_tokens(spark, folder):
    docs = tokenized(spark, folder)
    return docs.select("doc_id", hexed(A.clip("tokens", 2000)).alias("tokens"))


@query("slice_text_offset", "SELECT doc_id, substring(text, 51) AS text FROM documents")
def slice_text_offset(spark, folder):
    return documents(spark, folder).select("doc_id", X.skip_prefix("text", 50).alias("text"))


@query("first_rows", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def first_rows(spark, folder):
    docs = documents(spark, folder).select("doc_id", "lang", "source", "n_chars")
    return stats.first_rows(docs, "doc_id")


@query("fetch_n", "SELECT doc_id, text FROM documents ORDER BY doc_id DESC LIMIT 10")
def fetch_n(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return docs.orderBy(F.desc("doc_id")).limit(10)


@query(
    "concat_tables",
    "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark",
)
def concat_tables(spark, folder):
    docs = documents(spark, folder).select(F.col("doc_id").alias("id"), "text")
    other = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    return docs.unionByName(other)


@query(
    "pct",
    """
    SELECT file, n, round(n::double / sum(n) OVER () * 100, 6) AS pct
    FROM (SELECT source AS file, count(*) AS n FROM documents GROUP BY source)
    """,
)
def pct(spark, folder):
    counted = corpus(spark, folder).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select("file", "n", F.round(X.percent("n", total), 6).alias("pct"))


@query(
    "format_change",
    """
    SELECT doc_id, printf('%+d', n) AS change, format('{:,}', n_chars) AS n_chars
    FROM (SELECT doc_id, n_chars, length(trim(text)) - octet_length(encode(text)) AS n
          FROM documents)
    """,
)
def format_change(spark, folder):
    change = F.length(F.trim("text")) - F.octet_length("text")
    return documents(spark, folder).select(
        "doc_id",
        X.format_change(change).alias("change"),
        X.format_count("n_chars").alias("n_chars"),
    )


@query(
    "pad_right",
    "SELECT doc_id, rpad(hex(encode(text)), 8192, '0') AS tokens FROM documents",
)
def pad_right(spark, folder):
    docs = tokenized(spark, folder)
    return docs.select("doc_id", hexed(A.pad_right("tokens", 4096)).alias("tokens"))


@query(
    "roll_left",
    "SELECT doc_id, substring(hex(encode(text)), 3) || '00' AS tokens FROM documents",
)
def roll_left(spark, folder):
    docs = tokenized(spark, folder)
    return docs.select("doc_id", hexed(A.roll_left("tokens")).alias("tokens"))
