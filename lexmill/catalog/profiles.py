"""Text profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import documents, noisy, query, table
from lexmill.catalog.registry import pages as web_pages
from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators import cleaning, profile
from lexmill.operators.profile import METRICS

FLOATS = {"avg_word_length"}


def _rounded(df, *keys):
    columns = [F.round(m, 6).alias(m) if m in FLOATS else F.col(m) for m in METRICS]
    return df.select(*keys, *columns)


def metrics_sql(text: str) -> str:
    return ", ".join(
        f"round({e}, 6) AS {m}" if m in FLOATS else f"{e} AS {m}"
        for m, e in S.metrics(text).items()
    )


@query(
    "words",
    f"SELECT doc_id, len({S.words('text')}) AS n, array_to_string({S.words('text')}, ' ') AS words "
    "FROM documents",
)
def words(spark, folder):
    found = documents(spark, folder).select("doc_id", X.words("text").alias("w"))
    return found.select("doc_id", F.size("w").alias("n"), F.array_join("w", " ").alias("words"))


@query(
    "sentences",
    f"""
    SELECT doc_id, len(s) AS n, array_to_string(s, '|') AS sentences
    FROM (SELECT doc_id, string_split_regex(text, {S.q(P.SENTENCE_END)}) AS s FROM documents)
    """,
)
def sentences(spark, folder):
    found = documents(spark, folder).select("doc_id", X.sentences("text").alias("s"))
    return found.select("doc_id", F.size("s").alias("n"), F.array_join("s", "|").alias("sentences"))


def _split_sql(delimiters: str) -> str:
    tokens = S.split_punct("text", delimiters)
    return (
        "SELECT doc_id, len(t) AS n, array_to_string(t, ' ') AS tokens "
        f"FROM (SELECT doc_id, {tokens} AS t FROM documents)"
    )


def _split(spark, folder, delimiters):
    found = documents(spark, folder).select(
        "doc_id", X.split_punct("text", delimiters).alias("t")
    )
    return found.select("doc_id", F.size("t").alias("n"), F.array_join("t", " ").alias("tokens"))


@query("split_punct_v1", _split_sql(P.DELIMITERS_V1))
def split_punct_v1(spark, folder):
    return _split(spark, folder, P.DELIMITERS_V1)


@query("split_punct_v2", _split_sql(P.DELIMITERS_V2))
def split_punct_v2(spark, folder):
    return _split(spark, folder, P.DELIMITERS_V2)


@query(
    "count_matches",
    f"""
    SELECT page_id, {S.count('html', P.TAG)} AS html_tags, {S.count('html', P.WS)} AS spaces,
           {S.count('html', 'page=' + P.D)} AS page_marks
    FROM pages
    """,
)
def count_matches(spark, folder):
    return web_pages(spark, folder).select(
        "page_id",
        X.count_matches(X.upto_last("html", ">"), P.TAG).alias("html_tags"),
        X.count_chars("html", P.SPACES).alias("spaces"),
        X.count_matches("html", "page=" + P.D).alias("page_marks"),
    )


@query(
    "text_metrics",
    f"SELECT doc_id, {metrics_sql('text')} FROM "
    f"(SELECT doc_id, {S.noisy()} AS text FROM documents)",
)
def text_metrics(spark, folder):
    docs = documents(spark, folder).select("doc_id", noisy().alias("text"))
    return _rounded(profile.text_metrics(docs), "doc_id")


@query(
    "html_metrics",
    f"SELECT page_id, {metrics_sql('html')} FROM pages",
)
def html_metrics(spark, folder):
    pages = web_pages(spark, folder)
    return _rounded(profile.text_metrics(pages, "html", ("page_id",)), "page_id")


def group_metrics_sql(rel: str, group: str, digits: int = 6) -> str:
    """Metrics of a relation (group, text), the group taken as one unit."""
    m = S.metrics("text")
    return f"""
    WITH base AS ({rel}),
    layout AS (
      SELECT {group}, sum({m['char_count']})::BIGINT AS char_count,
             (sum({S.count('text', P.SENTENCE_END)}) + 1)::BIGINT AS sent_count,
             sum({m['whitespace_count']})::BIGINT AS whitespace_count,
             sum({m['newline_count']})::BIGINT AS newline_count,
             sum({m['html_tags']})::BIGINT AS html_tags,
             sum({m['page_numbers']})::BIGINT AS page_numbers
      FROM base GROUP BY ALL),
    w AS (SELECT {group}, unnest({S.words('text')}) AS word FROM base),
    vocab AS (
      SELECT {group}, count(*) AS word_count, count(DISTINCT word) AS vocab_size,
             sum(length(word))::double / count(*) AS avg_word_length
      FROM w GROUP BY ALL)
    SELECT {group}, char_count, coalesce(word_count, 0) AS word_count, sent_count,
           round(coalesce(avg_word_length, 0), {digits}) AS avg_word_length,
           coalesce(vocab_size, 0) AS vocab_size, whitespace_count, newline_count,
           html_tags, page_numbers
    FROM layout LEFT JOIN vocab USING ({group})
    """


@query("text_metrics_by_group", group_metrics_sql("SELECT source, text FROM documents", "source"))
def text_metrics_by_group(spark, folder):
    return _rounded(profile.metrics_by_group(documents(spark, folder), "source"), "source")


def top_sql(items: str, keys: str, k: int = 10) -> str:
    """Top items of ``items``, a query giving (keys, ord, list)."""
    partition = f"PARTITION BY {keys}" if keys else ""
    prefix = f"{keys}, " if keys else ""
    return f"""
    WITH lists AS ({items}),
    occ AS (SELECT {prefix}ord, unnest(list) AS item, generate_subscripts(list, 1) AS pos FROM lists),
    counted AS (SELECT {prefix}item, count(*) AS cnt, min((ord, pos)) AS f FROM occ GROUP BY ALL),
    ranked AS (SELECT {prefix}row_number() OVER ({partition} ORDER BY cnt DESC, f) AS rank,
               item, cnt FROM counted)
    SELECT {prefix}rank::INTEGER AS rank, item, cnt FROM ranked WHERE rank <= {k}
    """


def _word_items(keys: str) -> str:
    return f"SELECT {keys}, doc_id AS ord, {S.words('text')} AS list FROM documents"


@query("word_frequency_top", top_sql(_word_items("doc_id"), "doc_id"))
def word_frequency_top(spark, folder):
    return profile.top_words_per_text(documents(spark, folder))


@query("topk_per_group", top_sql(_word_items("source"), "source"))
def topk_per_group(spark, folder):
    counted = profile.word_occurrences(documents(spark, folder), ["source"], "text", "doc_id")
    return profile.top_k(counted, ["source"])


@query(
    "special_char_top",
    top_sql(
        f"SELECT source, doc_id AS ord, regexp_extract_all(text, {S.q(P.SPECIAL_CHAR)}) AS list "
        "FROM documents",
        "source",
    ),
)
def special_char_top(spark, folder):
    counted = profile.special_char_occurrences(
        documents(spark, folder), ["source"], "text", "doc_id"
    )
    return profile.top_k(counted, ["source"])


@query(
    "corpus_vocabulary_size",
    f"""
    SELECT 'words' AS kind, count(DISTINCT item) AS vocab_size
    FROM (SELECT unnest({S.words('text')}) AS item FROM documents)
    UNION ALL
    SELECT 'tokens', count(DISTINCT item)
    FROM (SELECT unnest({S.split_punct('text')}) AS item FROM documents)
    """,
)
def corpus_vocabulary_size(spark, folder):
    docs = documents(spark, folder)
    by_word = profile.vocabulary_size(docs)
    by_token = profile.vocabulary_size(docs, items=X.split_punct("text"))
    return by_word.select(F.lit("words").alias("kind"), "vocab_size").unionByName(
        by_token.select(F.lit("tokens").alias("kind"), "vocab_size")
    )


def _long_sql(raw: str, clean: str, key: str, rel: str) -> str:
    """Raw and clean metrics of a relation (key, raw, clean), in long form."""
    first, second = S.metrics(raw), S.metrics(clean)
    rows = ", ".join(
        f"{{'metric': '{m}', 'raw': ({first[m]})::double, 'clean': ({second[m]})::double}}"
        for m in METRICS
    )
    return f"""
    SELECT {key}, r.metric AS metric, round(r.raw, 6) AS raw, round(r.clean, 6) AS clean,
           round(r.clean - r.raw, 6) AS change
    FROM (SELECT {key}, unnest([{rows}]) AS r FROM {rel})
    """


def _six(df, key):
    return df.select(key, "metric", *[F.round(c, 6).alias(c) for c in ("raw", "clean", "change")])


_PDF = f"(SELECT doc_id, text, {S.clean_pdf('text')} AS clean FROM documents)"


@query("compare_raw_clean", _long_sql("text", "clean", "doc_id", _PDF))
def compare_raw_clean(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    raw = profile.text_metrics(docs)
    cleaned = cleaning.clean_pdf(docs).select("doc_id", "clean")
    clean = profile.text_metrics(cleaned, "clean")
    return _six(profile.compare_metrics(raw, clean), "doc_id")


_HTML = f"(SELECT page_id, html, {S.clean_web('html')} AS clean FROM pages)"


@query("compare_columns", _long_sql("html", "clean", "page_id", _HTML))
def compare_columns(spark, folder):
    pages = web_pages(spark, folder).select("page_id", "html")
    both = cleaning.clean_web(pages)
    return _six(profile.compare_columns(both, "html", "clean", "page_id"), "page_id")
