"""What several readers need is computed once."""

from __future__ import annotations

import pytest

from lexmill.catalog import QUERIES
from lexmill.operators import scoring


@pytest.fixture
def folder(spark, tmp_path):
    docs = [(i, f"a b c{i} a b. the page {i}", "en", "s", 20) for i in range(8)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    pages = spark.createDataFrame([(1, "u", "<p>a b</p> a b c")], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["mean_batch_loss", "perplexity_improvement", "perplexity_report"])
def test_pairs_are_scored_once(spark, folder, name):
    """Both parts of the result read the written scores; no pair is looked up for each of them."""
    made = QUERIES[name](spark, folder)
    assert made.count() > 0
    assert "xxhash64" not in _plan(made) and "Generate" not in _plan(made)


def test_metrics_are_measured_once(spark, folder):
    made = QUERIES["pattern_report"](spark, folder)
    assert _plan(made).count("regexp_extract_all") <= 1 and made.count() > 0  # the special characters


def test_rows_of_frequent_first_words_are_not_shuffled(texts):
    model = scoring.bigram_model(scoring.pair_counts(texts("a b a c", "a d")))
    assert "LeftAnti" in _plan(model)
    assert sorted((r.a, r.b, r.n) for r in model.collect()) == [("a", "b", 1), ("a", "c", 1), ("a", "d", 1), ("b", "a", 1)]
