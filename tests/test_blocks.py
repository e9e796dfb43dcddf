from __future__ import annotations

from pyspark.sql import functions as F

from conftest import column
from lexmill.functions import text as X
from lexmill.operators import blocks, vocab


def test_a_block_sends_each_word_once(texts, monkeypatch):
    vocabulary = vocab.build_vocabulary(texts("a b ,"))
    monkeypatch.setattr(vocab, "fits_broadcast", lambda right: False)
    df = texts(*["a , b a"] * 200)
    found = vocab._resolved(df, "id", X.split_punct("text"), vocabulary, "token")
    assert found.count() <= 4 * 4  # three words and the row of places, in four partitions at most
    assert column(vocab.encode(df, vocabulary, "id"), "ids") == [[1, 0, 2, 1]] * 200


def test_repeated_and_null_keys_as_beside_a_small_vocabulary(spark, monkeypatch):
    rows = [(1, "a b"), (1, "b q b"), (2, None), (2, "a"), (None, "b"), (None, "a a"), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    vocabulary = vocab.build_vocabulary(spark.createDataFrame([("a b",)], "text string"))
    order = lambda found: sorted(map(tuple, found.collect()), key=str)
    small = vocab.encode(df, vocabulary, "id")
    expected = order(small), order(vocab.decode(small, vocabulary, "id"))
    monkeypatch.setattr(vocab, "fits_broadcast", lambda right: False)
    for size in (1, 4, 1 << 19):
        monkeypatch.setattr(blocks, "BLOCK_VALUES", size)
        large = vocab.encode(df, vocabulary, "id")
        assert (order(large), order(vocab.decode(large, vocabulary, "id"))) == expected


def test_null_values_keep_their_places(spark):
    rows = [(1, ["b", None, "b"]), (2, []), (3, None), (4, [None])]
    df = spark.createDataFrame(rows, "_key long, _values array<string>").repartition(1).sortWithinPartitions("_key")
    cut = blocks.cut(df, "v")
    back = blocks.put_back(cut.withColumn("w", F.upper("v")), "w")
    assert column(back, "_list", "_key") == [["B", None, "B"], [], None, [None]]
