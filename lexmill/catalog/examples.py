"""Training examples over byte tokens (one token is two hexadecimal digits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog.registry import documents, hexed, query, token_table, tokenized
from lexmill.operators import examples

L, STRIDE, BATCH = 256, 128, 8

HEX = "h AS (SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents)"
STRICT = f"""
    {HEX}, starts AS (SELECT doc_id, h, unnest(range(0, n - {L}, {STRIDE})) AS start
                      FROM h WHERE n > {L}),
    win AS (SELECT doc_id, start, substr(h, 2 * start + 1, 2 * {L}) AS x,
                   substr(h, 2 * start + 3, 2 * {L}) AS y FROM starts)
"""
CLIPPED = f"""
    {HEX}, starts AS (SELECT doc_id, h, n, unnest(range(0, n - {L} + 1, {STRIDE})) AS start
                      FROM h WHERE n >= {L}),
    win AS (SELECT doc_id, start, substr(h, 2 * start + 1, 2 * {L}) AS x,
                   substr(h, 2 * start + 3, 2 * {L}) AS y, start + {L} = n AS target_short FROM starts)
"""


def _sizes(spark, folder):
    """Documents with their byte-token count; the tokens themselves are not needed."""
    return documents(spark, folder).select(
        "doc_id", "source", F.octet_length("text").alias("n")
    )


@query("windows_strict", f"WITH {STRICT} SELECT doc_id, start, x, y FROM win")
def windows_strict(spark, folder):
    cut = examples.windows_strict(tokenized(spark, folder), L, STRIDE)
    return cut.select("doc_id", "start", hexed("x").alias("x"), hexed("y").alias("y"))


@query("windows_clipped", f"WITH {CLIPPED} SELECT doc_id, start, x, y, target_short FROM win")
def windows_clipped(spark, folder):
    cut = examples.windows_clipped(tokenized(spark, folder), L, STRIDE)
    return cut.select(
        "doc_id", "start", hexed("x").alias("x"), hexed("y").alias("y"), "target_short"
    )


_PADDED = f"""
    {HEX}, pad AS (SELECT doc_id, rpad(h, 2 * {L}, '0') AS x, least(n, {L}) AS n_valid FROM h)
"""


@query(
    "windows_padded",
    f"WITH {_PADDED} SELECT doc_id, x, substr(x, 3) || '00' AS y, n_valid FROM pad",
)
def windows_padded(spark, folder):
    cut = examples.windows_padded(tokenized(spark, folder), L)
    return cut.select("doc_id", hexed("x").alias("x"), hexed("y").alias("y"), "n_valid")


@query(
    "context_target_pairs",
    f"""
    WITH {HEX}, k AS (SELECT doc_id, h, unnest(range(1, least(4, n - 1) + 1)) AS n FROM h)
    SELECT doc_id, n, left(h, 2 * n) AS context, substr(h, 2 * n + 1, 2) AS target FROM k
    """,
)
def context_target_pairs(spark, folder):
    pairs = examples.context_pairs(tokenized(spark, folder), 4)
    return pairs.select(
        "doc_id", "n", hexed("context").alias("context"),
        F.lpad(F.hex("target"), 2, "0").alias("target"),
    )


@query(
    "exact_examples",
    f"""
    SELECT sum(CASE WHEN n > {L} THEN ceil((n - {L}) / {STRIDE}) ELSE 0 END)::BIGINT AS strict,
           sum(CASE WHEN n >= {L} THEN (n - {L}) // {STRIDE} + 1 ELSE 0 END)::BIGINT AS clipped
    FROM (SELECT octet_length(encode(text)) AS n FROM documents)
    """,
)
def exact_examples(spark, folder):
    return examples.exact_examples(_sizes(spark, folder), L, STRIDE, F.col("n"))


@query(
    "estimate_examples",
    f"""
    WITH e AS (SELECT source, doc_id, octet_length(encode(text)) AS whole FROM documents),
    s AS (SELECT source, doc_id, least(whole, 2000) AS n FROM e),
    w AS (SELECT source, doc_id, CASE WHEN n >= {L} THEN (n - {L}) // {STRIDE} + 1 ELSE 0 END AS w
          FROM s),
    f AS (SELECT min(source) AS f FROM w),
    c AS (SELECT sum(w) AS w FROM (SELECT w FROM w, f WHERE source = f ORDER BY doc_id LIMIT 50))
    SELECT (c.w * ceil((SELECT count(*) FROM w, f WHERE source = f) / 50)
            * (SELECT count(DISTINCT source) FROM w))::BIGINT AS estimated,
           (SELECT sum(CASE WHEN whole >= {L} THEN (whole - {L}) // {STRIDE} + 1 ELSE 0 END)
            FROM e)::BIGINT AS exact
    FROM c
    """,
)
def estimate_examples(spark, folder):
    return examples.estimate_examples(
        _sizes(spark, folder), L, STRIDE, "doc_id", "source", n=F.col("n")
    )


@query(
    "batch_assign",
    f"""
    WITH {STRICT}, i AS (SELECT *, row_number() OVER (ORDER BY doc_id, start) - 1 AS idx FROM win)
    SELECT doc_id, start, idx, idx // {BATCH} AS batch_id, x FROM i
    WHERE idx // {BATCH} < (SELECT count(*) FROM win) // {BATCH}
    """,
)
def batch_assign(spark, folder):
    batched = examples.batch_windows(
        token_table(spark, folder), L, STRIDE, BATCH, drop_last=True, n=F.col("token_count")
    )
    return batched.select("doc_id", "start", "idx", "batch_id", hexed("x").alias("x"))


@query(
    "batch_assign_shuffled",
    f"""
    WITH {STRICT}, i AS (SELECT *, row_number() OVER (
        ORDER BY md5(doc_id || '-' || start || '-123')) - 1 AS idx FROM win)
    SELECT doc_id, start, idx, idx // {BATCH} AS batch_id, x FROM i
    """,
)
def batch_assign_shuffled(spark, folder):
    tokens = token_table(spark, folder)
    cut = examples.windows_strict(tokens, L, STRIDE)
    starts = examples.window_starts(tokens, L, STRIDE, n=F.col("token_count"))
    batched = examples.batch_shuffled(
        cut, "doc_id", "start", batch_size=BATCH, candidates=starts
    )
    return batched.select("doc_id", "start", "idx", "batch_id", hexed("x").alias("x"))


EPOCHS = 3


@query(
    "tokens_seen",
    f"""
    WITH {STRICT}, i AS (SELECT *, row_number() OVER (ORDER BY doc_id, start) - 1 AS idx FROM win),
    s AS (SELECT epoch, idx // {BATCH} AS pos, count(*) * {L} AS n FROM i, range({EPOCHS}) t(epoch) GROUP BY ALL),
    r AS (SELECT epoch::INTEGER AS epoch, row_number() OVER (ORDER BY epoch, pos) - 1 AS step,
                 sum(n) OVER (ORDER BY epoch, pos)::BIGINT AS tokens_seen FROM s)
    SELECT epoch, step, tokens_seen FROM r WHERE step % 5 = 0
    """,
)
def tokens_seen(spark, folder):
    steps = examples.window_steps(_sizes(spark, folder), L, STRIDE, BATCH, F.col("n"))
    return examples.tokens_seen(steps, 5, step_bucket=1000, n_epochs=EPOCHS)


@query(
    "pad_batch_matrix",
    f"""
    WITH {_PADDED}, i AS (SELECT *, row_number() OVER (ORDER BY md5(doc_id || '-123')) - 1 AS idx
                          FROM pad)
    SELECT idx // {BATCH} AS batch_id, count(*) AS n_rows, string_agg(x, '|' ORDER BY idx) AS matrix
    FROM i GROUP BY ALL
    """,
)
def pad_batch_matrix(spark, folder):
    tokens = token_table(spark, folder)
    cut = examples.windows_padded(tokens, L)
    batched = examples.batch_shuffled(cut, "doc_id", batch_size=BATCH, candidates=tokens)
    stacked = examples.batch_matrix(batched)
    rows = F.transform("matrix", hexed)
    return stacked.select("batch_id", "n_rows", F.array_join(rows, "|").alias("matrix"))


# -- order and split ---------------------------------------------------------


@query("shuffle", "SELECT doc_id, source, n_chars FROM documents")
def shuffle(spark, folder):
    docs = documents(spark, folder).select("doc_id", "source", "n_chars")
    return examples.shuffle(docs, "doc_id", seed=123)


_SPLIT = """
    SELECT doc_id, CASE WHEN idx < floor((SELECT count(*) FROM documents) * 0.9::double)
                   THEN 'train' ELSE 'val' END AS split
    FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || '-123')) - 1 AS idx
          FROM documents)
"""


@query("split_random", _SPLIT)
def split_random(spark, folder):
    return examples.split_exact(documents(spark, folder).select("doc_id"), "doc_id")


@query(
    "split_prefix",
    """
    SELECT doc_id, left(text, k) AS train, substring(text, k + 1) AS val
    FROM (SELECT doc_id, text, floor(length(text) * 0.9::double)::INTEGER AS k FROM documents)
    """,
)
def split_prefix(spark, folder):
    return examples.split_prefix(documents(spark, folder))


@query(
    "epoch_expand",
    """
    SELECT doc_id, epoch::INTEGER AS epoch, md5(epoch || '-' || doc_id || '-123') AS order_key
    FROM documents, range(3) t(epoch)
    """,
)
def epoch_expand(spark, folder):
    return examples.epochs(documents(spark, folder).select("doc_id"), "doc_id", n_epochs=3)


@query(
    "split_fast",
    """
    SELECT doc_id, CASE WHEN ('0x' || left(md5(doc_id || '-123'), 8))::BIGINT % 10 < 9
                   THEN 'train' ELSE 'val' END AS split
    FROM documents
    """,
)
def split_fast(spark, folder):
    return examples.split_fast(documents(spark, folder).select("doc_id"), "doc_id")
