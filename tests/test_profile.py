from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import column
from lexmill.functions import text as X
from lexmill.operators import profile, stats
from lexmill.plans import reports


def test_text_metrics(texts):
    df = texts("Hi. You? <b>hi</b>\nPage 3", "", None)
    rows = {r.id: r for r in profile.text_metrics(df, keep=("id",)).collect()}
    first = rows[0].asDict()
    assert first == {
        "id": 0, "char_count": 25, "word_count": 7, "sent_count": 3,
        "avg_word_length": 14 / 7, "vocab_size": 5, "whitespace_count": 4,
        "newline_count": 1, "html_tags": 2, "page_numbers": 1,
    }
    assert rows[1].sent_count == 1 and rows[1].avg_word_length == 0.0
    assert all(v is None for k, v in rows[2].asDict().items() if k != "id")


def test_group_of_one_equals_text(spark):
    df = spark.createDataFrame([(1, "g", "a b. B c!\n<x>")], "id long, g string, text string")
    one = profile.text_metrics(df, keep=("g",)).collect()[0].asDict()
    group = profile.metrics_by_group(df, "g").collect()[0].asDict()
    assert one == group


def test_ties_by_first_appearance(texts):
    counted = profile.word_occurrences(texts("b a b a c"), ["id"], "text", "id")
    rows = sorted(profile.top_k(counted, ["id"]).collect(), key=lambda r: r["rank"])
    assert [(r["item"], r["cnt"]) for r in rows] == [("b", 2), ("a", 2), ("c", 1)]
    total = profile.top_k(profile.word_occurrences(texts("c a", "a c"), [], "text", "id"), [], 1)
    assert total.collect()[0]["item"] == "c"


def test_special_chars(texts):
    counted = profile.special_char_occurrences(texts("a!b?c! _€"), ["id"], "text", "id")
    rows = sorted(profile.top_k(counted, ["id"]).collect(), key=lambda r: r["rank"])
    assert [(r["item"], r["cnt"]) for r in rows] == [("!", 2), ("?", 1), ("€", 1)]


def test_both_comparisons_agree(spark):
    df = spark.createDataFrame([(1, "A  b.\n", "a b.")], "doc_id long, raw string, clean string")
    by_join = profile.compare_metrics(
        profile.text_metrics(df, "raw"), profile.text_metrics(df, "clean")
    )
    in_row = profile.compare_columns(df, "raw", "clean")
    assert sorted(by_join.collect()) == sorted(in_row.collect())
    change = {r.metric: r.change for r in in_row.collect()}
    assert change["char_count"] == -2.0 and change["newline_count"] == -1.0


def test_histogram(spark):
    def bins(values, **options):
        df = spark.createDataFrame([(v,) for v in values], "token_count long")
        rows = stats.length_histogram(df, **options).collect()
        assert len(rows) == 100
        return {r["bin"]: r["cnt"] for r in rows if r["cnt"]}

    assert bins(range(101)) == {**{b: 1 for b in range(99)}, 99: 2}
    assert bins([0, 2000, 2001], bounds=(0, 2000)) == {0: 1, 99: 1}
    assert bins([7, 7, 7]) == {50: 3}


def test_statistics(spark):
    df = spark.createDataFrame(
        [("a", "en", 3), ("a", "de", 5), ("b", "en", 4)],
        "file string, language string, token_count long",
    )
    total = stats.token_stats(df).collect()[0]
    assert tuple(total) == (3, 12, 3, 5, 4.0)
    rolled = {r.file: r for r in stats.token_stats_with_total(df, "file").collect()}
    assert rolled[None].is_total == 1 and rolled["a"].mean_tokens == 4.0
    merged = stats.merge_token_stats(stats.token_stats(df, "file")).collect()[0]
    assert tuple(merged) == tuple(total)
    empty = stats.merge_token_stats(stats.token_stats(df, "file").where("false")).collect()[0]
    assert empty.mean_tokens is None
    shares = stats.category_shares(df, "language", 1).collect()
    assert [(r.language, r.cnt, round(r.pct, 4)) for r in shares] == [("en", 2, 66.6667)]


def test_columns(spark):
    assert stats.resolve_text_column(["id", "RawText", "text"]) == "RawText"
    assert stats.text_like_columns(["id", "Content", "text"]) == ["Content", "text"]
    try:
        stats.resolve_text_column(["id"])
        raise AssertionError("no error")
    except ValueError:
        pass


def test_formats(spark):
    df = spark.range(1).select(
        X.format_change(F.lit(3)).alias("a"),
        X.format_change(F.lit(-1.5), 2).alias("b"),
        X.format_count(F.lit(1234567)).alias("c"),
        X.percent(F.lit(1), F.lit(8)).alias("d"),
    )
    assert tuple(df.first()) == ("+3", "-1.50", "1,234,567", 12.5)


def test_vocabulary_size(texts):
    df = texts("a b", "B c")
    assert profile.vocabulary_size(df).first().vocab_size == 3
    assert profile.vocabulary_size(df, approximate=True).first().vocab_size == 3
    assert column(df.select("id", F.size(X.words("text")).alias("n")), "n") == [2, 2]


def test_top_words_are_counted_in_the_row(texts):
    df = texts("b a b a c", "", None, "x", "z y " * 50_000 + "z")
    rows = profile.top_words_per_text(df, "id", k=2).collect()
    found = [(r.id, r["rank"], r.item, r.cnt) for r in sorted(rows, key=lambda r: (r.id, r["rank"]))]
    assert found == [(0, 1, "b", 2), (0, 2, "a", 2), (3, 1, "x", 1), (4, 1, "z", 50_001), (4, 2, "y", 50_000)]


def test_quantiles_of_all_rows(spark):
    draw = random.Random(8)
    values = [draw.choice([1.5, 1.5, draw.gauss(0, 1e6), draw.random() * 1e-9, -7.0]) for _ in range(999)]
    rows = [(v, i % 3, None) for i, v in enumerate(values)] + [(None, 5, None)]
    df = spark.createDataFrame(rows, "v double, `odd.name` int, empty long").repartition(7)
    found = {r.column: r for r in stats.describe_numeric(df, n=None).collect()}
    for name, own in (("v", values), ("odd.name", [r[1] for r in rows])):
        cuts = np.quantile(own, [0.25, 0.5, 0.75])
        assert np.allclose([found[name].q25, found[name].q50, found[name].q75], cuts, rtol=1e-12)
        assert found[name].n == len(own) and found[name]["max"] == max(own)
    assert found["empty"].n == 0 and found["empty"].q50 is None
    assert {r.column: r.n for r in stats.describe_numeric(df.limit(0), n=None).collect()} == {}
    assert {r.column: r.n for r in stats.describe_numeric(df, "v", n=2).collect()} == {"v": 1, "odd.name": 2, "empty": 0}


def test_pattern_report_has_changes(spark):
    rows = [("s", "raw", "a b. c", 1), ("s", "clean", "a b", 1), ("t", "raw", "x", 2), (None, "raw", "p q", 3), (None, "clean", "p", 3)]
    both = spark.createDataFrame(rows, "source string, stage string, text string, id long")
    report = [r for r in reports.pattern_report(both, "source", "id").collect() if r.stage == "change"]
    found = {(r.source, r.item): r.value for r in report}
    assert {k[0] for k in found} == {"s", None} and len(report) == 2 * len(profile.METRICS)
    assert found["s", "char_count"] == -3.0 and found["s", "word_count"] == -1.0 and found[None, "vocab_size"] == -1.0


def test_sample_documents(spark):
    rows = [(i, f"f{i % 2}", "x" * 300, "en", 7) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, file string, text string, language string, token_count long")
    found = reports.sample_documents(df, "doc_id").collect()
    assert {r.item for r in found} == set("12345") and {r.measure for r in found} == {"file", "language", "token_count", "preview"}
    assert {r.note for r in found if r.measure == "preview"} == {"x" * 200 + "..."}
    assert len({r.note for r in found if r.measure == "file"}) == 1
    assert reports.sample_documents(df.limit(0), "doc_id").count() == 0
