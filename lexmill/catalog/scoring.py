"""Bigram model, perplexity, loss."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import documents, query
from lexmill.functions.udfs import by_pieces
from lexmill.operators import cleaning, scoring
from lexmill.session import written


def pairs_sql(rel: str, keys: str) -> str:
    """Counted word pairs of a relation (keys, text)."""
    return f"""
    lists AS (SELECT {keys}, {S.words('text')} AS w FROM ({rel})),
    spots AS (SELECT {keys}, w, unnest(range(1, len(w))) AS i FROM lists),
    pairs AS (SELECT {keys}, w[i] AS a, w[i + 1] AS b, count(*) AS n FROM spots GROUP BY ALL)
    """


def model_sql(learn: str = "true") -> str:
    return f"""
    counts AS (SELECT a, b, sum(CASE WHEN {learn} THEN n ELSE 0 END)::BIGINT AS n
               FROM pairs GROUP BY ALL),
    firsts AS (SELECT a, sum(n) AS n_a FROM counts GROUP BY a),
    size AS (SELECT count(*) AS v FROM (SELECT a FROM counts WHERE n > 0
                                        UNION SELECT b FROM counts WHERE n > 0)),
    model AS (SELECT a, b, n, ln((n + 1)::double / (n_a + v)) AS logp
              FROM counts JOIN firsts USING (a), size)
    """


_DOCS = f"{pairs_sql('SELECT doc_id, text FROM documents', 'doc_id')}, {model_sql()}"
_SCORED = f"{_DOCS}, scored AS (SELECT p.*, logp FROM pairs p JOIN model m USING (a, b))"


def _model(df, text="text", learn=None, number=None):
    return scoring.bigram_model(scoring.pair_counts(df, text, learn=learn, number=number))


def _scored(docs):
    return scoring.score_texts(docs, _model(docs), ["doc_id"])


@query("ngram_logprob", f"WITH {_DOCS} SELECT a, b, n, round(logp, 6) AS logp FROM model")
def ngram_logprob(spark, folder):
    return _model(documents(spark, folder)).withColumn("logp", F.round("logp", 6))


@query(
    "perplexity",
    f"""
    WITH {_SCORED}
    SELECT doc_id, round(exp(-sum(n * logp) / sum(n)), 4) AS perplexity
    FROM documents LEFT JOIN scored USING (doc_id) GROUP BY doc_id
    """,
)
def perplexity(spark, folder):
    docs = documents(spark, folder)
    scored = scoring.perplexity(_scored(docs), ["doc_id"], docs)
    return scored.withColumn("perplexity", F.round("perplexity", 4))


@query(
    "mean_batch_loss",
    f"""
    WITH {_SCORED},
    l AS (SELECT doc_id // 10 AS batch_id, -sum(n * logp) / sum(n) AS loss
          FROM scored GROUP BY ALL)
    SELECT 'all' AS batches, round(avg(loss), 6) AS mean_loss FROM l
    UNION ALL SELECT 'first 5', round(avg(loss), 6) FROM l WHERE batch_id < 5
    """,
)
def mean_batch_loss(spark, folder):
    scored = written(_scored(documents(spark, folder)), "scored")  # read once per part
    scored = scored.withColumn("batch_id", F.floor(F.col("doc_id") / 10))
    parts = [
        scoring.mean_batch_loss(scored, k).select(
            F.lit(name).alias("batches"), F.round("mean_loss", 6).alias("mean_loss")
        )
        for name, k in (("all", None), ("first 5", 5))
    ]
    return parts[0].unionByName(parts[1])


_STAGES = f"""
    SELECT doc_id, 'raw' AS stage, text FROM documents
    UNION ALL SELECT doc_id, 'clean', {S.clean_pdf('text')} FROM documents
"""


@query(
    "perplexity_improvement",
    f"""
    WITH {pairs_sql(_STAGES, 'doc_id, stage')}, {model_sql("stage = 'raw'")},
    p AS (SELECT doc_id, stage, exp(-sum(p.n * logp) / sum(p.n)) AS ppl
          FROM pairs p JOIN model m USING (a, b) GROUP BY ALL)
    SELECT d.doc_id, round(r.ppl, 4) AS raw_ppl, round(c.ppl, 4) AS clean_ppl,
           round((r.ppl - c.ppl) / r.ppl * 100, 4) AS improvement
    FROM documents d LEFT JOIN p r ON r.doc_id = d.doc_id AND r.stage = 'raw'
    LEFT JOIN p c ON c.doc_id = d.doc_id AND c.stage = 'clean'
    """,
)
def perplexity_improvement(spark, folder):
    docs = cleaning.clean_pdf(documents(spark, folder).select("doc_id", "text"))
    stages = F.array(
        F.struct(F.lit("raw").alias("stage"), F.col("text").alias("t")),
        F.struct(F.lit("clean").alias("stage"), F.col("clean").alias("t")),
    )
    both = docs.select("doc_id", F.inline(stages))
    both = written(both.withColumn("number", F.monotonically_increasing_id()), "raw-and-clean", "zstd")
    model = _model(both, "t", F.col("stage") == "raw", "number")
    scored = written(scoring.score_texts(both, model, ["doc_id", "stage"], "t", number="number"), "scored")
    raw, clean = (
        scoring.perplexity(scored.where(F.col("stage") == s), ["doc_id"], docs)
        for s in ("raw", "clean")
    )
    gained = scoring.improvement(raw, clean, "doc_id")
    return gained.select(
        "doc_id", *[F.round(c, 4).alias(c) for c in ("raw_ppl", "clean_ppl", "improvement")]
    )


@query(
    "user_scorer",
    "SELECT doc_id, CASE WHEN length(text) > 1 THEN 2.0::double END AS perplexity FROM documents",
)
def user_scorer(spark, folder):
    """A user's scorer in place of the model: here every character is a coin toss."""
    @by_pieces("array<double>")
    def coin(texts: pa.Array) -> pa.Array:
        return pa.array([[-0.6931471805599453] * (len(t or "") - 1) for t in texts.to_pylist()])

    docs = documents(spark, folder).select("doc_id", "text")
    scored = scoring.text_log_probs(docs, coin)
    found = scoring.perplexity(scored, ["doc_id"])
    return found.withColumn("perplexity", F.round("perplexity", 6))
