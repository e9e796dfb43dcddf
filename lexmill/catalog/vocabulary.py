"""Word vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import documents, query, table
from lexmill.functions import arrays as A
from lexmill.functions import patterns as P
from lexmill.operators import vocab
from lexmill.operators.indexing import ordered_index

_SPECIALS = ", ".join(f"({S.q(t)}, {i})" for i, t in enumerate(P.SPECIAL_TOKENS))

VOCAB = f"""
    toks AS (SELECT DISTINCT unnest({S.split_punct('text')}) AS token FROM documents),
    ranked AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM toks),
    specials AS (SELECT * FROM (VALUES {_SPECIALS}) s(token, place)),
    vocab AS (
      SELECT token, id FROM ranked WHERE token NOT IN (SELECT token FROM specials)
      UNION ALL SELECT token, (SELECT count(*) FROM toks) + place FROM specials)
"""


def _occurrences(rel: str, key: str, delimiters: str = P.DELIMITERS_V2) -> str:
    tokens = S.split_punct("text", delimiters)
    return (
        f"occ AS (SELECT {key}, unnest(t) AS token, generate_subscripts(t, 1) AS pos "
        f"FROM (SELECT {key}, {tokens} AS t FROM {rel}))"
    )


def _build(spark, folder):
    return vocab.build_vocabulary(documents(spark, folder))


@query("build_vocabulary", f"WITH {VOCAB} SELECT token, id FROM vocab")
def build_vocabulary(spark, folder):
    return _build(spark, folder)


@query("vocab_ids", f"WITH {VOCAB} SELECT token, id FROM ranked")
def vocab_ids(spark, folder):
    return ordered_index(vocab.distinct_tokens(documents(spark, folder)), "token", index="id")


@query("distinct_tokens", f"WITH {VOCAB} SELECT token FROM toks")
def distinct_tokens(spark, folder):
    return vocab.distinct_tokens(documents(spark, folder))


@query(
    "append_specials",
    f"""
    WITH specials AS (SELECT * FROM (VALUES {_SPECIALS}) s(token, place)),
    ranked AS (SELECT lang AS token, row_number() OVER (ORDER BY lang) - 1 AS id
               FROM (SELECT DISTINCT lang FROM documents))
    SELECT token, id FROM ranked
    UNION ALL SELECT token, (SELECT count(*) FROM ranked) + place FROM specials
    """,
)
def append_specials(spark, folder):
    names = documents(spark, folder).select(F.col("lang").alias("token")).distinct()
    return vocab.append_specials(ordered_index(names, "token", index="id"))


def _strict_texts(spark, folder, vocabulary):
    """Turns of conversations whose words the documents all have."""
    turns = table(spark, folder, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("turn_key"), "text"
    )
    return vocab.known_documents(turns, vocabulary, "turn_key")


_TURNS = "(SELECT concat_ws('/', conv_id, turn) AS turn_key, text FROM conversations)"
_KNOWN = f"""
    {_occurrences(_TURNS, 'turn_key', P.DELIMITERS_V1)},
    bad AS (SELECT DISTINCT turn_key FROM occ WHERE token NOT IN (SELECT token FROM vocab)),
    known AS (SELECT * FROM {_TURNS} WHERE turn_key NOT IN (SELECT turn_key FROM bad))
"""


@query("in_vocab_docs", f"WITH {VOCAB}, {_KNOWN} SELECT turn_key, text FROM known")
def in_vocab_docs(spark, folder):
    return _strict_texts(spark, folder, _build(spark, folder))


@query(
    "vocab_encode_strict",
    f"""
    WITH {VOCAB}, {_KNOWN}
    SELECT turn_key, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids
    FROM occ JOIN known USING (turn_key) JOIN vocab USING (token) GROUP BY turn_key
    """,
)
def vocab_encode_strict(spark, folder):
    vocabulary = _build(spark, folder)
    texts = _strict_texts(spark, folder, vocabulary)
    encoded = vocab.encode(texts, vocabulary, "turn_key", unknown="error")
    return encoded.select("turn_key", A.joined("ids").alias("ids"))


_UNK = f"(SELECT id FROM vocab WHERE token = {S.q(P.UNKNOWN)})"


@query(
    "vocab_encode_unk",
    f"""
    WITH {VOCAB}, {_occurrences('benchmark', 'item_id')}
    SELECT item_id, string_agg(coalesce(id, {_UNK})::VARCHAR, ' ' ORDER BY pos) AS ids
    FROM occ LEFT JOIN vocab USING (token) GROUP BY item_id
    """,
)
def vocab_encode_unk(spark, folder):
    encoded = vocab.encode(
        table(spark, folder, "benchmark"), _build(spark, folder), "item_id"
    )
    return encoded.select("item_id", A.joined("ids").alias("ids"))


@query(
    "vocab_encode_corpus",
    f"""
    WITH {VOCAB}, {_occurrences('documents', 'doc_id')}
    SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids
    FROM occ JOIN vocab USING (token) GROUP BY doc_id
    """,
)
def vocab_encode_corpus(spark, folder):
    docs = documents(spark, folder)
    encoded = vocab.encode(docs, _build(spark, folder))
    return encoded.select("doc_id", A.joined("ids").alias("ids"))


@query(
    "oov_tokens",
    f"""
    WITH {VOCAB}, {_occurrences('conversations', 'conv_id', P.DELIMITERS_V1)}
    SELECT token, count(*) AS cnt FROM occ
    WHERE token NOT IN (SELECT token FROM vocab) GROUP BY token
    """,
)
def oov_tokens(spark, folder):
    talks = table(spark, folder, "conversations")
    return vocab.unknown_tokens(talks, _build(spark, folder))


@query(
    "vocab_decode",
    f"""
    WITH {VOCAB}, {_occurrences('documents', 'doc_id')}
    SELECT doc_id, {S.rr("string_agg(token, ' ' ORDER BY pos)",
                         P.TIGHT_MARKS_V2, chr(92) + '1')} AS text
    FROM occ GROUP BY doc_id
    """,
)
def vocab_decode(spark, folder):
    vocabulary = _build(spark, folder)
    encoded = vocab.encode(documents(spark, folder), vocabulary)
    return vocab.decode(encoded, vocabulary)


@query(
    "join_texts_sep",
    f"""
    SELECT conv_id, string_agg(text, {S.q(f' {P.END_OF_TEXT} ')} ORDER BY turn) AS text
    FROM conversations GROUP BY conv_id
    """,
)
def join_texts_sep(spark, folder):
    return vocab.join_texts(table(spark, folder, "conversations"), "conv_id", "turn")
