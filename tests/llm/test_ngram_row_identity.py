"""Rows under a null or repeated id are linked, kept and dropped each by its own text."""

from __future__ import annotations

from collections import Counter

from lexmill.llm import ngram_join


def words(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def test_null_ids_of_which_one_is_a_copy(spark):
    near = words("a", 39) + " end"
    rows = [(None, words("a")), (None, near), (None, words("b")), (3, words("c")), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(r.text for r in ngram_join.representatives(docs, 5, 0.8).collect())
    assert kept[words("a")] + kept[near] == 1 and sum(kept.values()) == 4
    assert kept[words("b")] == kept[words("c")] == kept[None] == 1


def test_equal_rows_without_id_are_one(spark):
    docs = spark.createDataFrame([(None, words("a")), (None, words("a")), (None, words("b"))], "doc_id long, text string")
    assert sorted(r.text for r in ngram_join.representatives(docs, 5, 0.8).collect()) == [words("a"), words("b")]


def test_groups_do_not_meet_through_a_shared_id(spark):
    """Two documents that resemble two texts of one id stay in two groups."""
    for shared in (None,):
        rows = [(shared, words("a")), (shared, words("b")), (1, words("a", 39) + " end"), (2, words("b", 39) + " end")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = {r.doc: r.component_id for r in ngram_join.link(docs, 5, 80).collect() if r.doc in (1, 2)}
        assert found == {1: 1, 2: 2}
        assert sorted(r.doc_id for r in ngram_join.representatives(docs, 5, 0.8).collect()) == [1, 2]
