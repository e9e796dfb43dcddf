"""Reports composed of several operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.examples import BATCH, CLIPPED, L, STRIDE
from lexmill.catalog.profiles import group_metrics_sql, top_sql
from lexmill.catalog.registry import corpus, documents, query, table, token_table
from lexmill.catalog.registry import pages as web_pages
from lexmill.catalog.scoring import model_sql, pairs_sql
from lexmill.catalog.statistics import EDGES, FULL, ZOOM
from lexmill.functions import patterns as P
from lexmill.operators import cleaning
from lexmill.operators.profile import METRICS
from lexmill.operators.tokens import byte_ranks
from lexmill.plans import reports
from lexmill.session import written


def summary(spark, folder):
    prepared = reports.prepare_sources(
        web_pages(spark, folder), table(spark, folder, "conversations"), byte_ranks()
    )
    return reports.prep_summary(prepared)


query(
    "prep_summary",
    f"""
    WITH pdf AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
                 FROM conversations GROUP BY conv_id),
    t AS (SELECT 'web' AS source, page_id AS id, {S.clean_web('html')} AS clean FROM pages
          UNION ALL SELECT 'pdf', conv_id, {S.clean_pdf('text')} FROM pdf)
    SELECT source, count(*) AS n_sequences, (SELECT count(*) FROM t) AS total_sequences,
           octet_length(encode(arg_min(clean, id))) AS sequence_length,
           50257 AS vocab_size, 'gpt2' AS tokenizer
    FROM t GROUP BY source
    """,
)(summary)


def _stages(df, keys, raw, clean):
    entries = F.array(
        F.struct(F.lit("raw").alias("stage"), F.col(raw).alias("text")),
        F.struct(F.lit("clean").alias("stage"), F.col(clean).alias("text")),
    )
    return df.select(*keys, F.inline(entries))


def _raw_and_clean(spark, folder):
    """Raw and clean texts of both kinds of source, written once for all readers."""
    pages = cleaning.clean_web(web_pages(spark, folder), "html", "clean").select(
        F.lit("web").alias("source"), F.col("page_id").alias("id"), "html", "clean"
    )
    docs = cleaning.clean_pdf(documents(spark, folder), "text", "clean").select(
        F.lit("pdf").alias("source"), F.col("doc_id").alias("id"), "text", "clean"
    )
    both = _stages(pages, ("source", "id"), "html", "clean").unionByName(
        _stages(docs, ("source", "id"), "text", "clean")
    )
    return written(both, "raw-and-clean")


_BOTH = f"""
    SELECT 'web' AS source, 'raw' AS stage, page_id AS id, html AS text FROM pages
    UNION ALL SELECT 'web', 'clean', page_id, {S.clean_web('html')} FROM pages
    UNION ALL SELECT 'pdf', 'raw', doc_id, text FROM documents
    UNION ALL SELECT 'pdf', 'clean', doc_id, {S.clean_pdf('text')} FROM documents
"""
_UNIT = f"SELECT source || '/' || stage AS unit, id, text FROM ({_BOTH})"


def _top(kind: str, items: str) -> str:
    ranked = top_sql(f"SELECT unit, id AS ord, {items} AS list FROM ({_UNIT})", "unit")
    return f"SELECT unit, '{kind}' AS kind, rank, item, cnt::double AS value FROM ({ranked})"


_METRIC_ROWS = ", ".join(f"{{'item': '{m}', 'value': {m}::double}}" for m in METRICS)

_SPECIALS = f"regexp_extract_all(text, {S.q(P.SPECIAL_CHAR)})"


@query(
    "pattern_report",
    f"""
    WITH g AS (SELECT unit, r.item AS item, r.value AS value FROM
      (SELECT unit, unnest([{_METRIC_ROWS}]) AS r FROM ({group_metrics_sql(_UNIT, 'unit', 15)})))
    SELECT unit, 'metric' AS kind, 0 AS rank, item, round(value, 6) AS value FROM g
    UNION ALL SELECT split_part(r.unit, '/', 1) || '/change', 'metric', 0, r.item, round(c.value - r.value, 6)
    FROM g r JOIN g c ON c.item = r.item AND r.unit LIKE '%/raw'
      AND c.unit = split_part(r.unit, '/', 1) || '/clean'
    UNION ALL {_top('word', S.words('text'))}
    UNION ALL {_top('char', _SPECIALS)}
    """,
)
def pattern_report(spark, folder):
    report = reports.pattern_report(_raw_and_clean(spark, folder), "source", "id")
    return report.select(
        F.concat_ws("/", "source", "stage").alias("unit"),
        "kind", "rank", "item", F.round("value", 6).alias("value"),
    )


_STATS = """[{'measure': 'rows', 'value': count(*)::double},
             {'measure': 'tokens', 'value': sum(n_chars)::double},
             {'measure': 'min', 'value': min(n_chars)::double},
             {'measure': 'max', 'value': max(n_chars)::double},
             {'measure': 'mean', 'value': avg(n_chars)::double}]"""


@query(
    "corpus_report",
    f"""
    WITH s AS (SELECT coalesce(source, '(all)') AS item, {_STATS} AS m
               FROM documents GROUP BY ROLLUP (source)),
    g AS (SELECT lang AS item, [{{'measure': 'count', 'value': count(*)::double}},
            {{'measure': 'percent',
              'value': count(*)::double / (SELECT count(*) FROM documents) * 100}}] AS m
          FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 10),
    {EDGES}, h AS ({FULL}), z AS ({ZOOM}),
    rep AS (
      SELECT 'tokens' AS section, item, unnest(m) AS m FROM s
      UNION ALL SELECT 'language', item, unnest(m) FROM g
      UNION ALL SELECT 'histogram', b::VARCHAR, {{'measure': 'count', 'value': coalesce(n, 0)::double}}
        FROM range(100) t(b) LEFT JOIN h ON h.bin = b
      UNION ALL SELECT 'histogram_zoom', b::VARCHAR,
        {{'measure': 'count', 'value': coalesce(n, 0)::double}}
        FROM range(100) t(b) LEFT JOIN z ON z.bin = b)
    SELECT section, item, m.measure AS measure, round(m.value, 6) AS value, NULL AS note FROM rep
    UNION ALL
    SELECT 'sample', item, unnest(['file', 'language', 'token_count', 'preview']), NULL,
           unnest([source, lang, n_chars::VARCHAR, left(text, 200) || '...'])
    FROM (SELECT *, row_number() OVER (ORDER BY doc_id)::VARCHAR AS item FROM documents WHERE source = (
            SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY md5(source || '-42') LIMIT 1)
          ORDER BY doc_id LIMIT 5)
    """,
)
def corpus_report(spark, folder):
    report = reports.corpus_report(corpus(spark, folder), order="doc_id")
    return report.withColumn("value", F.round("value", 6))


@query(
    "training_examples",
    f"""
    WITH {CLIPPED},
    k AS (SELECT doc_id, start, md5(doc_id || '-' || start || '-123') AS k1,
                 md5(doc_id || '-' || start || '-124') AS k2 FROM win),
    s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY k1) <=
            floor((SELECT count(*) FROM k) * 0.9::double) THEN 'train' ELSE 'val' END AS split
          FROM k),
    i AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY k2) - 1 AS idx FROM s)
    SELECT doc_id, start, split, idx, idx // {BATCH} AS batch_id FROM i
    WHERE split = 'val'
       OR idx // {BATCH} < (SELECT count(*) FROM s WHERE split = 'train') // {BATCH}
    """,
)
def training_examples(spark, folder):
    made = reports.training_examples(
        token_table(spark, folder), L, STRIDE, BATCH, n=F.col("token_count")
    )
    return made.select("doc_id", "start", "split", "idx", "batch_id")


@query(
    "perplexity_report",
    f"""
    WITH {pairs_sql(_BOTH, 'source, stage, id')}, {model_sql("stage = 'raw'")},
    p AS (SELECT source, stage, exp(-sum(p.n * logp) / sum(p.n)) AS ppl
          FROM pairs p JOIN model m USING (a, b) GROUP BY ALL)
    SELECT r.source, round(r.ppl, 4) AS raw_ppl, round(c.ppl, 4) AS clean_ppl,
           round((r.ppl - c.ppl) / r.ppl * 100, 4) AS improvement
    FROM p r JOIN p c ON r.source = c.source AND r.stage = 'raw' AND c.stage = 'clean'
    """,
)
def perplexity_report(spark, folder):
    report = reports.perplexity_report(_raw_and_clean(spark, folder), "source")
    return report.select(
        "source", *[F.round(c, 4).alias(c) for c in ("raw_ppl", "clean_ppl", "improvement")]
    )
