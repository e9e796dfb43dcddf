"""Byte-pair tokens, with the table of the 256 bytes as ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import documents, hexed, query, table, tokenized
from lexmill.functions import patterns as P
from lexmill.operators import tokens, vocab

SPECIALS = {P.END_OF_TEXT: 256}


@query("bpe_encode", "SELECT doc_id, hex(encode(text)) AS tokens FROM documents")
def bpe_encode(spark, folder):
    docs = tokenized(spark, folder)
    return docs.select("doc_id", hexed("tokens").alias("tokens"))


_JOINED = f"""
    (SELECT conv_id, count(*) AS n,
            string_agg(text, {S.q(f' {P.END_OF_TEXT} ')} ORDER BY turn) AS text
     FROM conversations GROUP BY conv_id)
"""


def _joined(spark, folder):
    return vocab.join_texts(table(spark, folder, "conversations"), "conv_id", "turn")


@query(
    "bpe_encode_special",
    f"""
    SELECT conv_id, octet_length(encode(text)) - 13 * (n - 1) + (n - 1) AS n_allowed,
           octet_length(encode(text)) AS n_as_text, n - 1 AS n_special
    FROM {_JOINED}
    """,
)
def bpe_encode_special(spark, folder):
    ranks = tokens.byte_ranks()
    joined = _joined(spark, folder)
    both = tokens.encode(joined, ranks, "text", "allowed", "allow", SPECIALS)
    both = tokens.encode(both, ranks, "text", "plain", "text", SPECIALS)
    special = F.size(F.filter("allowed", lambda i: i == SPECIALS[P.END_OF_TEXT]))
    return both.select(
        "conv_id",
        F.size("allowed").alias("n_allowed"),
        F.size("plain").alias("n_as_text"),
        special.alias("n_special"),
    )


@query("bpe_decode", f"SELECT conv_id, text FROM {_JOINED}")
def bpe_decode(spark, folder):
    ranks = tokens.byte_ranks()
    specials = {P.END_OF_TEXT: 2_000_000_000}
    encoded = tokens.encode(_joined(spark, folder), ranks, policy="allow", specials=specials)
    decoded = tokens.decode(encoded.drop("text"), ranks, specials=specials)
    return decoded.select("conv_id", "text")


@query("token_count", "SELECT doc_id, octet_length(encode(text)) AS token_count FROM documents")
def token_count(spark, folder):
    docs = tokenized(spark, folder)
    return docs.select("doc_id", tokens.token_count().alias("token_count"))


@query(
    "tokenize_corpus",
    """
    SELECT doc_id, hex(encode(text)) AS tokens, octet_length(encode(text)) AS token_count
    FROM documents
    """,
)
def tokenize_corpus(spark, folder):
    done = tokens.tokenize_corpus(documents(spark, folder), tokens.byte_ranks())
    return done.select("doc_id", hexed("tokens").alias("tokens"), "token_count")


@query(
    "token_summary",
    """
    SELECT source, count(*) AS n_sequences, (SELECT count(*) FROM documents) AS total_sequences,
           octet_length(encode(arg_min(text, doc_id))) AS sequence_length,
           50257 AS vocab_size, 'gpt2' AS tokenizer
    FROM documents GROUP BY source
    """,
)
def token_summary(spark, folder):
    noted = tokens.annotate(tokenized(spark, folder), "tokens")
    return tokens.token_summary(noted, "doc_id")


# A text with a special token in it fails under the default policy.
@query(
    "file_success_report",
    f"""
    SELECT conv_id, count(*) AS n_texts, count(*) FILTER (WHERE n > 1) AS n_failed,
           bool_and(n = 1) AS ok FROM {_JOINED} GROUP BY conv_id
    """,
)
def file_success_report(spark, folder):
    done = tokens.encode_reported(
        _joined(spark, folder), tokens.byte_ranks(), specials=SPECIALS
    )
    return tokens.file_report(done, "conv_id")


@query(
    "success_summary",
    f"""
    SELECT count(*) FILTER (WHERE ok) AS n_ok, count(*) AS n_files,
           NULL::double AS seconds_per_file
    FROM (SELECT conv_id, bool_and(n = 1) AS ok FROM {_JOINED} GROUP BY conv_id)
    """,
)
def success_summary(spark, folder):
    done = tokens.encode_reported(
        _joined(spark, folder), tokens.byte_ranks(), specials=SPECIALS
    )
    return tokens.success_summary(tokens.file_report(done, "conv_id"))
