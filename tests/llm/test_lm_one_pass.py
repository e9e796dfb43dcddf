"""The head of a vocabulary, and one reading of the texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lexmill.llm import lm_score


def test_frequent_words_are_bounded(spark, monkeypatch):
    counts = [0, 1, 1, 1, 2, 63, 64, 65, 127, 128, 1000, 1001, 10**6, 2**40]
    vocabulary = spark.createDataFrame([(b"w%d" % i, c, 0.0) for i, c in enumerate(counts)], "word binary, c long, lm double")
    for bound in range(len(counts) + 1):
        monkeypatch.setattr(lm_score, "HEAD_WORDS", bound)
        found = sorted(r.c for r in lm_score.frequent(vocabulary).collect())
        assert len(found) <= bound and found == sorted(counts)[len(counts) - len(found):]
    assert lm_score.frequent(vocabulary.limit(0)).count() == 0


def test_words_outside_the_head_score_alike(spark, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["one two three", "two three four four", "", None, "seven " * 50 + "x" * 60, "one two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learn = F.col("doc_id") != 2

    def scores():
        rows = lm_score.score(docs, path, learn).collect()
        return {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in rows}

    whole = scores()
    monkeypatch.setattr(lm_score, "HEAD_WORDS", 1)
    assert scores() == whole and len(whole) == len(texts)
    plan = lm_score.score(docs, path, learn)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
