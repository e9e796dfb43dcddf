"""Rows under a null or repeated id lose only the words that they themselves copy."""

from __future__ import annotations

from lexmill.llm import substrings, suffixes

FIRST = " ".join(f"first{i}" for i in range(45))
CLEAN = " ".join(f"clean{i}" for i in range(60))
OTHER = " ".join(f"other{i}" for i in range(60))
ROWS = [(1, FIRST), (None, FIRST), (None, CLEAN), (None, FIRST), (7, OTHER), (7, FIRST + " " + "tail"), (8, None)]


def test_substrings_by_row(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = sorted(((r.doc_id or 99, r.text or "") for r in substrings.dedup(docs).collect()))
    assert found == sorted([(1, FIRST), (99, ""), (99, ""), (99, CLEAN), (7, OTHER), (7, "tail"), (8, "")])


def test_suffixes_by_row(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = sorted(((r.doc_id or 99, bytes(r.kept).decode()) for r in suffixes.dedup(docs).collect()))
    assert found == sorted([(1, FIRST), (99, ""), (99, ""), (99, CLEAN), (7, OTHER), (7, " tail"), (8, "")])
