from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.operators import lookups, scoring
from lexmill.plans import reports


def model_of(df, **options):
    return scoring.bigram_model(scoring.pair_counts(df, **options))


def test_bigram_model(texts):
    counts = scoring.pair_counts(texts("a b a b", "A c", "x", None))
    assert {(r.a, r.b): r.n for r in counts.collect()} == {("a", "b"): 2, ("b", "a"): 1, ("a", "c"): 1}
    model = {(r.a, r.b): r for r in scoring.bigram_model(counts).collect()}
    assert math.isclose(model["a", "b"].logp, math.log(3 / (3 + 3)))
    assert math.isclose(model["b", "a"].logp, math.log(2 / (1 + 3)))
    assert math.isclose(model["a", "c"].logp, math.log(2 / (3 + 3)))


def test_first_words_only(texts):
    counts = scoring.pair_counts(texts("a b c d"), max_length=3)
    assert sorted((r.a, r.b) for r in counts.collect()) == [("a", "b"), ("b", "c")]
    df = texts("a b c d e")
    assert scoring.score_texts(df, model_of(df), ["id"], max_length=3).first().n == 2


def brute(samples, learn=None):
    """Mean log-probability of every text of two words or more, counted in plain Python."""
    lists = {i: re.findall(r"\w+", t.lower()) for i, t in enumerate(samples) if t}
    learnt = [w for i, w in lists.items() if learn is None or learn(i)]
    pairs = Counter(p for w in learnt for p in zip(w, w[1:]))
    firsts = Counter(a for (a, b), n in pairs.items() for _ in range(n))
    size = len({x for p in pairs for x in p})
    found = {}
    for i, w in lists.items():
        logs = [math.log((pairs[p] + 1) / (firsts[p[0]] + size)) for p in zip(w, w[1:])]
        if logs:
            found[i] = (len(logs), sum(logs) / len(logs))
    return found


@pytest.mark.parametrize("head", [0, 2, 1024])
def test_scores_do_not_depend_on_the_head(texts, monkeypatch, head):
    draw = random.Random(4)
    samples = [" ".join(draw.choice(["the"] * 6 + list("abcdef")) for _ in range(draw.randint(0, 60))) for _ in range(80)]
    samples += [None, "", "x", "the " * 3000]
    monkeypatch.setattr(lookups, "HEAD_ROWS", head)
    monkeypatch.setattr(scoring, "lookup_once", lambda *a: lookups.lookup_once(*a, head_rows=head))
    df = texts(*samples)
    for learn, told in ((None, None), (F.col("id") % 2 == 0, lambda i: i % 2 == 0)):
        found = scoring.score_texts(df, model_of(df, learn=learn), ["id"]).collect()
        expected = brute(samples, told)
        assert {r.id: r.n for r in found} == {i: n for i, (n, _) in expected.items()}
        assert all(math.isclose(r.logp, expected[r.id][1]) for r in found)


def test_pairs_the_model_lacks_are_left_out(texts):
    model = model_of(texts("a b a b"))
    found = {r.id: r for r in scoring.score_texts(texts("a b z", "z z"), model, ["id"]).collect()}
    assert set(found) == {0} and found[0].n == 1


def test_groups_are_few(texts, monkeypatch):
    monkeypatch.setattr(scoring, "MOST_GROUPS", 2)
    with pytest.raises(ValueError):
        scoring.pair_counts(texts("a b", "b a", "a a"), by=["id"])
    assert scoring.pair_counts(texts(), by=["id"]).count() == 0


def test_groups_are_scored_from_the_counts(spark):
    rows = [(g, t) for g in ("x", "y", None) for t in ("a b a b", "b c", "a a a", None, "z")]
    df = spark.createDataFrame(rows + [("y", "b c b c")], "g string, text string")
    groups = scoring.perplexity(scoring.score_groups(model_of(df, by=["g"]), ["g"]), ["g"])
    each = scoring.score_texts(df.withColumn("i", F.monotonically_increasing_id()), model_of(df), ["g", "i"])
    texts_ = scoring.perplexity(each, ["g"])
    found, expected = ({r.g: r.perplexity for r in f.collect()} for f in (groups, texts_))
    assert found.keys() == expected.keys() == {"x", "y", None}
    assert all(math.isclose(found[g], expected[g]) for g in found)


def test_every_text_has_a_row(texts):
    df = texts("a b a b", "x", None)
    scored = scoring.score_texts(df, model_of(df), ["id"])
    found = {r.id: r.perplexity for r in scoring.perplexity(scored, ["id"], df).collect()}
    assert found[0] > 1 and found[1] is None and found[2] is None and len(found) == 3
    none = F.lit(None).cast("array<double>")
    given = scoring.text_log_probs(df, lambda t: F.when(t != "x", F.array(F.lit(-1.0))).otherwise(none), keys=("id",))
    found = {r.id: r.perplexity for r in scoring.perplexity(given, ["id"]).collect()}
    assert math.isclose(found[0], math.e) and found[1] is None and found[2] is None


def test_perplexity_of_coin_tosses(spark):
    rows = [(1, 1, math.log(0.5))] * 7
    df = spark.createDataFrame(rows, "doc_id long, n long, logp double")
    assert math.isclose(scoring.perplexity(df, ["doc_id"]).first().perplexity, 2.0)


def test_improvement(spark):
    frame = lambda p: spark.createDataFrame([("s", p)], "source string, perplexity double")
    assert scoring.improvement(frame(4.0), frame(3.0), "source").first().improvement == 25.0


def test_mean_batch_loss(spark):
    rows = [(b, 1, -float(b + 1)) for b in range(3)]
    df = spark.createDataFrame(rows, "batch_id long, n long, logp double")
    assert scoring.mean_batch_loss(df, 2).first().mean_loss == 1.5
    assert scoring.mean_batch_loss(df).first().mean_loss == 2.0
    assert scoring.mean_batch_loss(df, 9).first().mean_loss == 2.0
    assert math.isnan(scoring.mean_batch_loss(df.where("false")).first().mean_loss)


def test_report_learns_from_raw_texts_only(spark):
    rows = [(1, "s", "raw", "a b a b"), (1, "s", "clean", "a b a z")]
    both = spark.createDataFrame(rows, "id long, source string, stage string, text string")
    row = reports.perplexity_report(both, "source").first()
    ab, ba, az = math.log(3 / 4), math.log(2 / 3), math.log(1 / 4)
    assert math.isclose(row.raw_ppl, math.exp(-(2 * ab + ba) / 3))
    assert math.isclose(row.clean_ppl, math.exp(-(ab + ba + az) / 3))
    assert both.where(F.col("stage") == "raw").count() == 1
