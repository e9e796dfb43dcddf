"""What a plan must not lose: shuffles stay few, hot keys stay small."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexmill.operators import cleaning, examples, lookups, profile, scoring, stats, tokens


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "docs")
    spark.range(20).select(
        F.col("id").alias("doc_id"),
        F.lit("s").alias("source"),
        F.lit("some text, some words").alias("text"),
        F.array(F.lit(1), F.lit(2), F.lit(3)).alias("tokens"),
        F.lit(21).alias("n_chars"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_work_has_no_shuffle(docs):
    narrow = [
        cleaning.clean_pdf(docs),
        cleaning.clean_web(docs, "text"),
        profile.text_metrics(docs),
        profile.top_words_per_text(docs),
        profile.compare_columns(docs.withColumn("clean", F.upper("text")), "text", "clean"),
        tokens.encode(docs, tokens.byte_ranks()),
        examples.windows_strict(docs, 2, 1),
        examples.windows_padded(docs, 2),
        examples.split_fast(docs, "doc_id"),
        examples.epochs(docs, "doc_id", n_epochs=2),
    ]
    for df in narrow:
        assert "Exchange" not in plan(df)


def test_exact_split_leaves_rows_where_they_lie(docs):
    outer = plan(examples.split_exact(docs, "doc_id")).split("Subquery")[0]
    assert "Exchange" not in outer


def test_only_needed_columns_are_read(docs):
    assert "ReadSchema: struct<n_chars:int>" in plan(stats.token_stats(docs, count="n_chars"))
    read = plan(examples.window_starts(docs, 2, 1, n=F.col("n_chars")))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:int>" in read


def test_steps_are_counted_from_sizes(docs, spark):
    query = docs.select(F.col("n_chars").alias("n"))
    steps = examples.tokens_seen(examples.window_steps(query, 2, 1, 4, F.col("n")), 1)
    assert "FileScan" not in plan(steps)  # only their number is left


def test_top_words_of_groups_are_cut_before_the_shuffle(docs):
    counted = profile.word_occurrences(docs, ["source"], "text", "doc_id")
    text = plan(profile.top_k(counted, ["source"]))
    assert "Partial" in text and "WindowGroupLimit" in text
    assert "SortAggregate" not in text


def test_unmeasured_tables_are_not_broadcast(spark, docs):
    right = docs.select("source").distinct().withColumn("v", F.lit(1))
    joined = lookups.lookup(docs.select("source", "doc_id"), right, ["source"], broadcast=False)
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in text  # the head, at most 1,024 rows
    assert "GlobalLimit 1024" in text


def test_pairs_are_combined_before_the_shuffle(docs, monkeypatch):
    monkeypatch.setattr(scoring, "written", lambda df, name="": df)
    text = plan(scoring.pair_counts(docs))
    assert text.count("Exchange") == 1
    assert "partial_sum" in text.split("Exchange")[1]


def test_texts_are_read_once_to_be_scored(docs, monkeypatch):
    monkeypatch.setattr(scoring, "written", lambda df, name="": df)
    model = docs.sparkSession.createDataFrame([("a", "b", 1, -0.5)], "a string, b string, n long, logp double")
    text = plan(scoring.score_texts(docs, model, ["doc_id"]))
    assert text.count("FileScan") == 1
