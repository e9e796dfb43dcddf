"""Graph building and search go on until they have settled."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import neighbours


def _points(spark, v):
    codes = neighbours._packed(v.astype(np.float64))
    return spark.createDataFrame([(i, bytearray(c.tobytes())) for i, c in enumerate(codes)], "id long, code binary")


def test_graph_from_a_poor_start(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PROJECTIONS", 3)
    monkeypatch.setattr(neighbours, "BLOCK", 12)
    v = np.random.default_rng(1).standard_normal((1500, 8))
    points = neighbours.written(_points(spark, v), "points")
    found = {}
    for r in neighbours.build(points, 10).collect():
        found.setdefault(r.a, set()).add(r.b)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = u @ u.T
    np.fill_diagonal(sims, -9)
    best = np.argsort(-sims, axis=1)[:, :10]
    assert np.mean([len(found[i] & set(best[i].tolist())) / 10 for i in range(1500)]) > 0.9


def test_search_along_a_chain(spark, monkeypatch):
    """Points on an arc, each linked with the next one only: many hops from the only entry."""
    monkeypatch.setattr(neighbours, "ENTRIES", 1)
    at = np.linspace(0, 1.5, 30)
    v = np.stack([np.cos(at), np.sin(at)], 1)
    points = _points(spark, v)
    graph = spark.createDataFrame([(i, i + 1, 1.0) for i in range(29)], "a long, b long, sim float")
    queries = points.where("id in (0, 29)").selectExpr("id query", "code query_code", "cast(null as long) own")
    found = {(r.query, r.point) for r in neighbours.search(queries, points, graph).collect()}
    assert {(0, 0), (29, 29)} <= found


def test_a_graph_that_does_not_settle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MOST_ROUNDS", 1)
    monkeypatch.setattr(neighbours, "PROJECTIONS", 2)
    monkeypatch.setattr(neighbours, "BLOCK", 12)
    v = np.random.default_rng(1).standard_normal((300, 8))
    with pytest.raises(RuntimeError):
        neighbours.build(_points(spark, v), 10)


def test_extreme_vectors(spark):
    """Vectors whose products overflow or vanish count by their direction."""
    rows = [(0, [1.0, 0.0]), (1, [1e-200, 0.0]), (2, [1e200, 1e200]), (3, [1e-45, 2e-45]), (4, [5e-324, 0.0]),
            (5, [-1.7e308, 0.0]), (None, [1.0, 0.0]), (6, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") == 0, 5).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [1, 4, 2, 3, 5]
    assert [round(r.score, 12) for r in found] == [1.0, 1.0, round(0.5**0.5, 12), round(0.2**0.5, 12), -1.0]
