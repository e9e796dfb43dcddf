"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog.registry import corpus, documents, query
from lexmill.operators import stats

STATS = """count(*) AS n_rows, sum(n_chars)::BIGINT AS total_tokens, min(n_chars) AS min_tokens,
           max(n_chars) AS max_tokens, round(avg(n_chars), 6) AS mean_tokens"""


def _six(df):
    return df.withColumn("mean_tokens", F.round("mean_tokens", 6))


@query("corpus_token_stats", f"SELECT {STATS} FROM documents")
def corpus_token_stats(spark, folder):
    return _six(stats.token_stats(corpus(spark, folder)))


@query("file_token_stats", f"SELECT source AS file, {STATS} FROM documents GROUP BY source")
def file_token_stats(spark, folder):
    return _six(stats.token_stats(corpus(spark, folder), "file"))


@query(
    "file_and_total_stats",
    f"""
    SELECT source AS file, grouping(source)::INTEGER AS is_total, {STATS}
    FROM documents GROUP BY ROLLUP (source)
    """,
)
def file_and_total_stats(spark, folder):
    return _six(stats.token_stats_with_total(corpus(spark, folder), "file"))


@query("weighted_mean_merge", f"SELECT {STATS} FROM documents")
def weighted_mean_merge(spark, folder):
    parts = stats.token_stats(corpus(spark, folder), "file", "language")
    return _six(stats.merge_token_stats(parts))


@query(
    "language_distribution",
    """
    SELECT lang AS language, count(*) AS cnt,
           round(count(*)::double / (SELECT count(*) FROM documents) * 100, 6) AS pct
    FROM documents GROUP BY lang ORDER BY cnt DESC, lang LIMIT 10
    """,
)
def language_distribution(spark, folder):
    shares = stats.category_shares(corpus(spark, folder), "language")
    return shares.withColumn("pct", F.round("pct", 6))


def _bins(df):
    return df.withColumn("bin_start", F.round("bin_start", 6))


def bins_sql(low: str, high: str, rel: str) -> str:
    """(bin, n) of ``rel``, a relation with n_chars and the bounds."""
    step = f"(({high} - {low}) / 100)"
    return f"""
      SELECT b - (n_chars < {low} + b * {step})::INTEGER
               + (n_chars >= {low} + (b + 1) * {step} AND b < 99)::INTEGER AS bin, count(*) AS n
      FROM (SELECT *, least(floor((n_chars - {low}) / ({high} - {low}) * 100)::BIGINT, 99) AS b
            FROM {rel}) GROUP BY 1
    """


EDGES = """
    e AS (SELECT min(n_chars)::double AS lo, max(n_chars)::double AS hi FROM documents),
    r AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
                 CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM e)
"""
FULL = bins_sql("lo", "hi", "documents, r")
ZOOM = bins_sql("0.0::double", "2000.0::double", "documents").replace(
    "FROM documents)", "FROM documents WHERE n_chars BETWEEN 0 AND 2000)"
)


@query(
    "length_histogram",
    f"""
    WITH {EDGES}, c AS ({FULL})
    SELECT t.b AS bin, round(lo + t.b * ((hi - lo) / 100), 6) AS bin_start, coalesce(n, 0) AS cnt
    FROM range(100) t(b) CROSS JOIN r LEFT JOIN c ON c.bin = t.b
    """,
)
def length_histogram(spark, folder):
    return _bins(stats.length_histogram(corpus(spark, folder)))


@query(
    "length_histogram_zoom",
    f"""
    WITH c AS ({ZOOM})
    SELECT t.b AS bin, t.b * 20.0::double AS bin_start, coalesce(n, 0) AS cnt
    FROM range(100) t(b) LEFT JOIN c ON c.bin = t.b
    """,
)
def length_histogram_zoom(spark, folder):
    return _bins(stats.length_histogram(corpus(spark, folder), bounds=(0, 2000)))


def _describe_sql(rows: str) -> str:
    return f"""
    WITH f AS (SELECT doc_id, n_chars FROM documents {rows}),
    l AS (SELECT 'doc_id' AS "column", doc_id::double AS v FROM f
          UNION ALL SELECT 'n_chars', n_chars::double FROM f)
    SELECT "column", count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
           min(v) AS min, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50,
           quantile_cont(v, 0.75) AS q75, max(v) AS max
    FROM l GROUP BY "column"
    """


def _described(df):
    return df.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query("numeric_describe", _describe_sql("ORDER BY doc_id LIMIT 5"))
def numeric_describe(spark, folder):
    return _described(stats.describe_numeric(documents(spark, folder), "doc_id"))


@query("numeric_describe_all", _describe_sql(""))
def numeric_describe_all(spark, folder):
    return _described(stats.describe_numeric(documents(spark, folder), n=None))
