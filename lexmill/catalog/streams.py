"""Streaming jobs run over the files present, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import hexed, query
from lexmill.catalog.statistics import STATS
from lexmill.operators import tokens
from lexmill.operators.tokens import byte_ranks
from lexmill.streaming import jobs


def _stream(spark, folder, name="documents"):
    # As a pattern, the path may name one file or a folder of files.
    path = f"{folder}/{name}[.]parquet"
    return jobs.read_stream(spark, path, jobs.SCHEMAS[name])


@query(
    "stream_token_stats",
    f"SELECT lang AS language, {STATS} FROM documents GROUP BY lang",
)
def stream_token_stats(spark, folder):
    stream = _stream(spark, folder).select(
        F.col("lang").alias("language"), F.col("n_chars").alias("token_count")
    )
    running = jobs.stream_token_stats(stream, "language")
    final = jobs.run_state(running, *jobs.fresh_paths(spark, "stream-stats"))
    return final.withColumn("mean_tokens", F.round("mean_tokens", 6))


@query(
    "stream_clean_tokenize",
    f"""
    SELECT doc_id, hex(encode(t)) AS tokens, octet_length(encode(t)) AS token_count
    FROM (SELECT doc_id, {S.clean_pdf('text')} AS t FROM documents)
    """,
)
def stream_clean_tokenize(spark, folder):
    ranks = byte_ranks()
    done = jobs.run_spread(
        _stream(spark, folder).select("doc_id", "text"),
        lambda batch: jobs.stream_clean_tokenize(batch, ranks),
        *jobs.fresh_paths(spark, "stream-tokens"),
    )
    return done.select("doc_id", hexed("tokens").alias("tokens"), "token_count")


@query(
    "stream_windows",
    """
    SELECT doc_id, x, substr(x, 3) || '00' AS y FROM
      (SELECT doc_id, rpad(hex(encode(text)), 512, '0') AS x FROM documents)
    """,
)
def stream_windows(spark, folder):
    encoded = tokens.encode(_stream(spark, folder).select("doc_id", "text"), byte_ranks())
    stream = jobs.stream_windows(encoded, 256)
    done = jobs.run_to_table(stream, *jobs.fresh_paths(spark, "stream-windows"))
    return done.select("doc_id", hexed("x").alias("x"), hexed("y").alias("y"))


@query(
    "stream_progress",
    """
    SELECT source AS src_file, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_tokens
    FROM documents GROUP BY source
    """,
)
def stream_progress(spark, folder):
    stream = _stream(spark, folder).select(
        F.col("source").alias("src_file"), F.col("n_chars").alias("token_count")
    )
    log = jobs.stream_progress(stream, *jobs.fresh_paths(spark, "stream-progress"))
    return log.groupBy("src_file").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_tokens").alias("n_tokens")
    )
