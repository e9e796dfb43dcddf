"""Pairs that tell where they stand: texts are scored from the counts alone."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill.catalog import QUERIES
from lexmill.catalog import scoring as catalog
from lexmill.operators import blocks, scoring

SCHEMA = "doc_id long, stage string, t string"


def numbered(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("number", F.monotonically_increasing_id())


def brute(rows):
    """Per key the number of predictions and their mean, learnt from raw texts, in plain Python."""
    lists = [((i, s), re.findall(r"\w+", (t or "").lower())) for i, s, t in rows]
    pairs = Counter(p for (_, s), w in lists if s == "raw" for p in zip(w, w[1:]))
    firsts = Counter(a for (a, _), n in pairs.items() for _ in range(n))
    size = len({x for p in pairs for x in p})
    logs = defaultdict(list)
    for key, w in lists:
        for p in zip(w, w[1:]):
            logs[key].append(math.log((pairs[p] + 1) / (firsts[p[0]] + size)))
    return {key: (len(found), sum(found) / len(found)) for key, found in logs.items()}


def sample():
    draw = random.Random(7)
    word = lambda: draw.choice(["the"] * 6 + ["of", "B\u00e9", "x_1"] + list("abcdef"))
    rows = []
    for i in range(60):
        text = " ".join(word() for _ in range(draw.randint(0, 40)))
        rows += [(i, "raw", text), (i, "clean", text.replace("the", "").replace("a", "z"))]
    rows += [(100, "raw", "the " * 2000), (100, "clean", ""), (101, "raw", None), (101, None, "a b"), (102, "clean", "x")]
    return rows + rows[:6] + [(None, "raw", "a b the"), (None, "raw", "the of"), (None, None, "q q")]


@pytest.mark.parametrize("pairs, apart", [(1, 1 << 15), (50, 1 << 15), (1 << 22, 4), (1 << 22, 1 << 15)])
def test_scores_do_not_depend_on_the_blocks(spark, monkeypatch, pairs, apart):
    monkeypatch.setattr(blocks, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", apart)
    monkeypatch.setattr(blocks, "BATCH_PAIRS", 5)
    df = scoring.written(numbered(spark, sample()))
    learn = F.col("stage") == "raw"
    counts = scoring.pair_counts(df, "t", learn=learn, number="number")
    plain = scoring.pair_counts(df, "t", learn=learn)
    rows = lambda found: sorted((r.a, r.b, r.n) for r in found.collect())
    assert rows(counts.where("first")) == rows(plain)
    model = scoring.bigram_model(counts)
    logs = lambda found: sorted((r.a, r.b, r.n, round(r.logp, 9)) for r in found.collect())
    assert logs(model.where("first")) == logs(scoring.bigram_model(plain))
    scored = scoring.score_texts(df, model, ["doc_id", "stage"], "t", number="number").collect()
    expected = brute(sample())
    assert {(r.doc_id, r.stage): r.n for r in scored} == {k: n for k, (n, _) in expected.items()}
    assert all(math.isclose(r.logp, expected[r.doc_id, r.stage][1]) for r in scored)


def test_first_words_only(spark):
    df = numbered(spark, [(1, "raw", "a b c d"), (2, "raw", "a b")])
    counts = scoring.pair_counts(df, "t", max_length=3, number="number").where("first")
    assert sorted((r.a, r.b, r.n) for r in counts.collect()) == [("a", "b", 2), ("b", "c", 1)]


def test_texts_without_pairs(spark):
    for rows in ([], [(1, "raw", None), (2, "raw", None)], [(1, "raw", "x"), (2, "clean", "")]):
        df = numbered(spark, rows)
        counts = scoring.pair_counts(df, "t", learn=F.col("stage") == "raw", number="number")
        assert counts.count() == 0
        scored = scoring.score_texts(df, scoring.bigram_model(counts), ["doc_id"], "t", number="number")
        assert scored.count() == 0


def test_groups_and_places_exclude_each_other(spark):
    with pytest.raises(ValueError):
        scoring.pair_counts(numbered(spark, []), "t", by=["stage"], number="number")


def test_a_pair_leaves_a_block_once(spark):
    df = spark.createDataFrame([(i, "raw", "a b c " * 20) for i in range(300)], SCHEMA).coalesce(1)
    df = df.withColumn("number", F.monotonically_increasing_id())
    held = df.select(F.col("number").alias("_number"), F.lit(True).alias("_learn"), F.split("t", " +").alias("_values"))
    cut = blocks.cut_pairs(held.withColumn("_values", F.array_remove("_values", "")))
    assert sorted((r.pair, len(r["at"])) for r in cut.collect()) == [("a b", 6000), ("b c", 6000), ("c a", 5700)]


def test_improvement_moves_no_row_for_each_pair_of_a_text(spark, tmp_path, monkeypatch):
    """Neither is the model written a second time to be looked up, nor are texts read again to be scored."""
    docs = spark.createDataFrame([(i, "a b c " * 100) for i in range(40)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows, plans = {}, []

    def noted(df, name="table", compression=None, write=catalog.written):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        found = write(df, name, compression)
        rows[name] = found.count()
        return found

    monkeypatch.setattr(scoring, "written", noted)
    monkeypatch.setattr(catalog, "written", noted)
    assert QUERIES["perplexity_improvement"](spark, str(tmp_path)).where("raw_ppl > 1").count() == 40
    assert set(rows) == {"raw-and-clean", "pair-counts", "first-words", "scored"}
    assert rows["pair-counts"] <= 3 * spark.sparkContext.defaultParallelism
    scored = dict(plans)["scored"]
    assert "xxhash64" not in scored and "regexp" not in scored
