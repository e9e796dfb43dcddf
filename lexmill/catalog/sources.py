"""Scans, sources and sinks."""

from __future__ import annotations

import io
import lzma
import tarfile

import pandas as pd
from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import documents, hexed, query, table, tokenized
from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators import stats, vocab
from lexmill.session import scratch_path
from lexmill.sources import readers, writers


@query("scan_corpus", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_corpus(spark, folder):
    return readers.read_corpus(spark, f"{folder}/documents.parquet")


@query("scan_pruned", "SELECT n_chars FROM documents")
def scan_pruned(spark, folder):
    return readers.read_corpus(spark, f"{folder}/documents.parquet", ["n_chars"])


def _measure(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": frame["doc_id"], "n": frame["text"].str.len()})


@query("scan_batches", "SELECT doc_id, length(text) AS n FROM documents")
def scan_batches(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return readers.in_batches(docs, _measure, "doc_id bigint, n bigint", batch_rows=100)


@query(
    "table_profile",
    """
    SELECT (row_number() OVER ()) - 1 AS ordinal, column_name AS "column",
           CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS type,
           (SELECT count(*) FROM documents) AS n_rows
    FROM (DESCRIBE SELECT * FROM documents)
    """,
)
def table_profile(spark, folder):
    return stats.table_profile(documents(spark, folder))


@query(
    "read_whole_text",
    "SELECT source, sum(length(text) + 1)::BIGINT AS n_chars FROM documents GROUP BY source",
)
def read_whole_text(spark, folder):
    path = scratch_path(spark, "texts")
    documents(spark, folder).select("source", "text").write.partitionBy("source").text(path)
    files = readers.read_whole_text(spark, path)
    source = F.regexp_extract("path", "/source=([^/]+)/", 1)
    return files.groupBy(source.alias("source")).agg(F.sum(F.length("text")).alias("n_chars"))


@query(
    "write_text",
    f"""
    SELECT source, stage, file, text, count(*) AS n, any_value(n_files) AS n_files FROM (
      SELECT source, 'raw' AS stage, 0 AS file, text, 1 AS n_files FROM documents
      UNION ALL
      SELECT source, 'clean', 0, {S.strip("text")}, 1 FROM documents
    ) GROUP BY source, stage, file, text
    """,
)
def write_text(spark, folder):
    docs = documents(spark, folder)
    stages = F.array(
        F.struct(F.lit("raw").alias("stage"), F.col("text").alias("body")),
        F.struct(F.lit("clean").alias("stage"), X.strip("text").alias("body")),
    )
    path = scratch_path(spark, "staged")
    writers.write_text(docs.select("source", F.inline(stages)), path, "body")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    counted = files.groupBy("source", "stage").agg(F.count(F.lit(1)).cast("int").alias("n_files"))
    back = writers.read_text(spark, path).groupBy("source", "stage", "file", "text").agg(F.count(F.lit(1)).alias("n"))
    return back.join(F.broadcast(counted), ["source", "stage"])


@query(
    "write_tokens",
    """
    SELECT source AS src_file, doc_id, octet_length(encode(text)) AS token_count,
           hex(encode(text)) AS tokens FROM documents
    """,
)
def write_tokens(spark, folder):
    path = scratch_path(spark, "tokens")
    table_ = tokenized(spark, folder).withColumnRenamed("source", "src_file")
    table_ = table_.withColumn("token_count", F.size("tokens"))
    writers.write_tokens(table_, path, by_file=True)
    back = spark.read.schema(table_.schema).parquet(path)
    return back.select("src_file", "doc_id", "token_count", hexed("tokens").alias("tokens"))


@query("pages_source", "SELECT page_id, url, html FROM pages")
def pages_source(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url", "html")


@query(
    "concat_pages",
    """
    SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
    FROM conversations GROUP BY conv_id
    """,
)
def concat_pages(spark, folder):
    return vocab.concat_pages(table(spark, folder, "conversations"), "conv_id", "turn")


@query(
    "missing_source_default",
    f"""
    SELECT d.doc_id, coalesce(c.text, {S.q(P.MISSING_TEXT)}) AS text
    FROM documents d LEFT JOIN conversations c ON c.conv_id = d.doc_id
    """,
)
def missing_source_default(spark, folder):
    found = table(spark, folder, "conversations")
    found = found.select(F.col("conv_id").alias("doc_id"), "text")
    return readers.fill_missing(documents(spark, folder).select("doc_id"), found, "doc_id")


@query("sql_source", "SELECT text FROM documents WHERE lang = 'en'")
def sql_source(spark, folder):
    documents(spark, folder).createOrReplaceTempView("lexmill_data")
    return readers.read_sql(spark, "SELECT text FROM lexmill_data WHERE lang = 'en'")


@query("discover_table", "SELECT text FROM documents")
def discover_table(spark, folder):
    table(spark, folder, "nation").createOrReplaceTempView("lexmill_found_a")
    documents(spark, folder).createOrReplaceTempView("lexmill_found_b")
    return readers.discover_text_table(spark, "lexmill_found_*")


def _tar(members: list[tuple[str, bytes]]) -> bytes:
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w") as archive:
        for name, body in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(body)
            archive.addfile(entry, io.BytesIO(body))
    return packed.getvalue()


def _pack(frames):
    """Documents of a batch as archives of up to 50 texts, to be expanded again."""
    for frame in frames:
        contents = []
        for start in range(0, len(frame), 50):
            rows = frame.iloc[start : start + 50]
            members = [
                (f"{row.doc_id}.txt", row.text.encode("utf-8")) for row in rows.itertuples()
            ]
            inner = lzma.compress(_tar(members + [("notes.md", b"left out")]), preset=0)
            contents.append(_tar([("part.xz", inner), ("index.json", b"{}")]))
        yield pd.DataFrame({"content": contents})


@query(
    "archive_expand",
    "SELECT 'part.xz/' || doc_id || '.txt' AS path, "
    + S.strip(S.rr("text", P.NEWLINES_3, "\n\n"))
    + " AS text FROM (SELECT doc_id, replace(text, '. ', '.' || repeat(chr(10), 4)) AS text "
    "FROM documents)",
)
def archive_expand(spark, folder):
    gaps = F.replace("text", F.lit(". "), F.lit(".\n\n\n\n"))
    docs = documents(spark, folder).select("doc_id", gaps.alias("text"))
    return readers.expand_archives(docs.mapInPandas(_pack, "content binary"))


@query(
    "sample_files_seeded",
    """
    SELECT source FROM (SELECT DISTINCT source FROM documents)
    ORDER BY md5(source || '-42') LIMIT 5
    """,
)
def sample_files_seeded(spark, folder):
    return readers.sample_files(documents(spark, folder), 5, 42, "source")


@query(
    "random_file",
    """
    SELECT source FROM (SELECT DISTINCT source FROM documents)
    ORDER BY md5(source || '-7') LIMIT 1
    """,
)
def random_file(spark, folder):
    return readers.sample_files(documents(spark, folder), 1, 7, "source")


@query("pattern_filter_files", "SELECT page_id, url FROM pages WHERE url LIKE 'http%/en/%'")
def pattern_filter_files(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return readers.matching_path(pages, "http*/en/*", "url")


_EXTENSIONS = (("en", ".txt"), ("de", ".xz"), ("fr", ".parquet"))


@query(
    "filter_extension",
    """
    SELECT doc_id, path FROM (
      SELECT doc_id, source || '/' || doc_id || CASE lang WHEN 'en' THEN '.txt'
        WHEN 'de' THEN '.xz' WHEN 'fr' THEN '.parquet' ELSE '.json' END AS path
      FROM documents)
    WHERE path LIKE '%.txt' OR path LIKE '%.xz'
    """,
)
def filter_extension(spark, folder):
    ending = F.lit(".json")
    for lang, extension in _EXTENSIONS:
        ending = F.when(F.col("lang") == lang, extension).otherwise(ending)
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), ending)
    named = documents(spark, folder).select("doc_id", path.alias("path"))
    return readers.with_extension(named, ".txt", ".xz")


@query("list_corpus_files", "SELECT 'documents.parquet' AS file, count(*) AS n_rows FROM documents")
def list_corpus_files(spark, folder):
    """Files of the corpus with their rows."""
    files = readers.with_file_name(table(spark, folder, "documents"), "file")
    return files.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
