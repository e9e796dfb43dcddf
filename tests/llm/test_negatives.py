"""Hard negatives against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string, _l string"


def brute(rows, every=5):
    fine = {}
    for i, v, label in sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) and abs(x) * 256 < 2**31 for x in v):
            fine.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    found = set()
    for a, (label, v) in fine.items():
        if a % every:
            continue
        scores = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in fine.items() if i != a}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if fine[i][0] == label][:5]:
            s = scores[p]
            fits = [i for i in order if fine[i][0] != label and 50 * s <= 100 * scores[i] <= 95 * s]
            found |= {(a, p, rank, i, s, scores[i]) for rank, i in enumerate(fits[:3], 1)}
    return found


def run(spark, rows, every=5):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return {tuple(r) for r in negatives.mine(df, F.col("id") % every == 0).collect()}


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(negatives, "BUCKET", 64)
    monkeypatch.setattr(negatives, "ANCHORS", 40)


@pytest.mark.parametrize("kind", ["normal", "clusters", "lengths", "copies"])
def test_against_all_products(spark, small, kind):
    draw = np.random.default_rng(7)
    v = draw.normal(0, 0.3, (600, 12))
    if kind == "clusters":
        v = draw.normal(0, 1, (6, 12))[draw.integers(0, 6, 600)] + draw.normal(0, 0.05, (600, 12))
    if kind == "lengths":
        v *= np.exp(draw.normal(0, 2, (600, 1)))
    if kind == "copies":
        v[:250] = v[0]
    rows = [(i, x.tolist(), int(draw.integers(0, 4))) for i, x in enumerate(v)]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [
        (0, [1.0, 0.5], 1), (5, [0.5, 1.0], 1), (1, [0.9, 0.4], 2), (2, [0.9, 0.4], 2), (1, [0.9, 0.4], 2),
        (3, None, 1), (4, [1.0, None], 1), (6, [math.nan, 1.0], 1), (7, [math.inf, 1.0], 2), (8, [1.0, 1.0], None),
        (None, [1.0, 1.0], 1), (9, [0.0, 0.0], 2), (10, [0.0, 0.0], 1), (11, [1e200, 1.0], 1), (12, [0.7], 2),
        (13, [0.6, 0.3, 5.0], 2), (14, [], 2), (15, [-1.0, -1.0], 1), (16, [1e-300, 0.4], 2),
    ]
    assert run(spark, rows) == brute(rows)
    big = [(i, [(-1.0) ** i * 8e6, 7e6 - i], i % 2) for i in range(12)]
    found = run(spark, big)
    assert {f for f in found if max(map(abs, f[4:])) < 2**62} == {f for f in brute(big) if max(map(abs, f[4:])) < 2**62}
    assert run(spark, []) == set()
    assert run(spark, rows[:1]) == set()


def test_narrow_ranges_hold_all_rows(spark):
    """Every row that reaches a threshold is a candidate; close ones are found without the whole bucket."""
    draw = np.random.default_rng(2)
    middles = draw.normal(0, 1, (40, 16))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    v = np.floor(256 * (middles[draw.integers(0, 40, 2000)] + draw.normal(0, 0.002, (2000, 16))))
    bucket = negatives.Bucket(np.arange(2000), np.zeros(2000, int), list(v), 16)
    anchors = negatives.Anchors(np.arange(50), np.zeros(50, int), list(v[:50]))
    scores = negatives.exact(anchors.v, bucket.v)
    best = scores.max(axis=1)
    for least, most in ((best * 0.995, 5), (best * 0.5, 50), (np.zeros(50), 50), (best + 1.0, 50), (best * 2.0, 0)):
        rows, whole = {a: set() for a in range(50)}, 0
        for some, found in negatives.candidates(anchors, bucket, least):
            for a in some:
                rows[a] |= set(range(2000)) if found is None else set(found.tolist())
                whole += found is None
        assert all(set(np.flatnonzero(scores[a] >= least[a])) <= rows[a] for a in range(50))
        assert whole <= most
