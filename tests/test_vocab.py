from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import column
from lexmill.functions import arrays as A
from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators import lookups, vocab
from lexmill.operators.indexing import ordered_index, running_before


def as_dict(vocabulary):
    return {r.token: r.id for r in vocabulary.collect()}


def test_splitters(texts):
    expected = "Hello|,|world|.|Is|this|--|a|test|?".split("|")
    df = texts("Hello, world. Is this-- a test?", "a:b;c", "a---b - c")
    one = column(df.select("id", X.split_punct("text", P.DELIMITERS_V1).alias("t")), "t")
    two = column(df.select("id", X.split_punct("text").alias("t")), "t")
    assert one[0] == two[0] == expected
    assert one[1] == ["a:b;c"] and two[1] == ["a", ":", "b", ";", "c"]
    assert two[2] == ["a", "--", "-b", "-", "c"]


def test_build(texts):
    assert as_dict(vocab.build_vocabulary(texts("b a"))) == {
        "a": 0, "b": 1, "<|endoftext|>": 2, "<|unk|>": 3, "[PAD]": 4, "[BOS]": 5, "[EOS]": 6,
    }
    with_special = as_dict(vocab.build_vocabulary(texts("b <|endoftext|> a")))
    assert with_special == {
        "a": 1, "b": 2, "<|endoftext|>": 3, "<|unk|>": 4, "[PAD]": 5, "[BOS]": 6, "[EOS]": 7,
    }


def test_encode_decode(texts):
    vocabulary = vocab.build_vocabulary(texts("a ( b , c <|endoftext|>"))
    ids = as_dict(vocabulary)
    df = texts("a ( b , c", "", None, "zz a <|endoftext|>")
    encoded = vocab.encode(df, vocabulary, "id")
    assert column(encoded, "ids") == [
        [ids["a"], ids["("], ids["b"], ids[","], ids["c"]], [], None,
        [ids["<|unk|>"], ids["a"], ids["<|endoftext|>"]],
    ]
    decoded = vocab.decode(encoded, vocabulary, "id")
    assert column(decoded, "text") == ["a( b, c", "", None, "<|unk|> a <|endoftext|>"]


def test_large_vocabulary_gives_the_same_rows(texts, monkeypatch):
    df = texts("a b, a b. c", "b " * 50, "", None, "q a")
    vocabulary = vocab.build_vocabulary(texts("a b c , ."))
    small = vocab.encode(df, vocabulary, "id")
    expected = column(small, "ids"), column(vocab.decode(small, vocabulary, "id"), "text")
    monkeypatch.setattr(vocab, "fits_broadcast", lambda right: False)
    large = vocab.encode(df, vocabulary, "id")
    found = column(large, "ids"), column(vocab.decode(large, vocabulary, "id"), "text")
    assert found == expected


def test_places(spark):
    rows = [(0, ["b", "a", "b", None, "a", None]), (1, []), (2, None), (3, ["x"] * 3)]
    df = spark.createDataFrame(rows, "id long, v array<string>").select("id", A.places("v").alias("p"))
    found = [p if p is None else [(e.value, e["at"]) for e in p] for p in column(df, "p")]
    assert found == [[(None, [3, 5]), ("a", [1, 4]), ("b", [0, 2])], [], None, [("x", [0, 1, 2])]]
    back = df.select("id", A.put_back("p", "value").alias("v"))
    assert column(back, "v") == [r[1] for r in rows]


def test_a_long_text_is_encoded_in_one_pass(spark, tmp_path, monkeypatch):
    """Beside a vocabulary that is not broadcast, texts are read once and only their
    distinct words are shuffled."""
    path = str(tmp_path / "docs")
    rows = [(1, "a b , " * 100_000), (2, None), (3, ""), (4, "b")] + [(i, None) for i in range(5, 60)]
    spark.createDataFrame(rows, "id long, text string").write.parquet(path)
    vocabulary = vocab.build_vocabulary(spark.createDataFrame([("a b ,",)], "text string"))
    monkeypatch.setattr(vocab, "fits_broadcast", lambda right: False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        encoded = vocab.encode(spark.read.parquet(path), vocabulary, "id")
        plan = encoded._jdf.queryExecution().executedPlan().toString()
        outer = "\n".join(line for line in plan.splitlines() if "/ranges-" not in line)
        assert outer.count("/docs]") == 1 and "BroadcastHashJoin [token" not in plan
        found = {r.id: r.ids for r in encoded.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    ids = as_dict(vocabulary)
    assert found[1] == [ids["a"], ids["b"], ids[","]] * 100_000
    assert found[2] is None and found[3] == [] and found[4] == [ids["b"]] and len(found) == 59


def test_strict_encoding(texts):
    vocabulary = vocab.build_vocabulary(texts("a b"))
    assert column(vocab.encode(texts("b a"), vocabulary, "id", unknown="error"), "ids") == [[1, 0]]
    with pytest.raises(Exception, match="unknown token: c"):
        vocab.encode(texts("a c"), vocabulary, "id", unknown="error").collect()
    with pytest.raises(ValueError):
        vocab.encode(texts("a"), vocabulary, "id", unknown="skip")


def test_unknown(texts):
    vocabulary = vocab.build_vocabulary(texts("a b"))
    df = texts("a x x", "b a", "y")
    unknown = {r.token: r.cnt for r in vocab.unknown_tokens(df, vocabulary).collect()}
    assert unknown == {"x": 2, "y": 1}
    assert column(vocab.known_documents(df, vocabulary, "id"), "id") == [1]


def test_join_texts_in_parts(spark):
    rows = [(1, i, f"t{i}") for i in range(5)] + [(2, 0, "x"), (2, 1, None)]
    df = spark.createDataFrame(rows, "k long, i long, text string")
    whole = {r.k: r.text for r in vocab.join_texts(df, "k", "i", separator="|").collect()}
    assert whole == {1: "t0|t1|t2|t3|t4", 2: "x"}
    many = spark.range(3000).select(F.lit(7).alias("k"), (F.col("id") * 10).alias("i"), F.lit("y").alias("text"))
    assert [len(r.text) for r in vocab.join_texts(many, "k", "i", separator="").collect()] == [3000]
    parts = vocab.join_texts(df, "k", "i", separator="|", rows_per_part=2).where("k = 1")
    assert column(parts, "text", "part") == ["t0|t1", "t2|t3", "t4"]
    assert vocab.concat_pages(df.where("k = 1"), "k", "i").first().text == "t0\nt1\nt2\nt3\nt4"


def test_lookup_plans_agree(spark):
    """One key holds most rows; every way of joining gives the same rows."""
    left = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id"
    )
    right = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    right = right.unionByName(spark.sql("SELECT 'hot' AS k, -1L AS v"))
    small = sorted(lookups.lookup(left, right, ["k"]).collect())
    split = sorted(lookups.lookup(left, right, ["k"], head_rows=2, broadcast=False).collect())
    counted = right.withColumn("f", F.when(F.col("k") == "hot", 9).otherwise(1))
    known = lookups.lookup(left, counted, ["k"], 2, False, "f")
    assert small == split == sorted(known.select("k", "id", "v").collect())
    assert len(small) == 2000
    assert lookups.fits_broadcast(right) and not lookups.fits_broadcast(right, rows=10)
    assert not lookups.fits_broadcast(right, size=100)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_order_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(2).alias("v"))
    expected = {k: i for i, k in enumerate(sorted(r.k for r in df.collect()))}
    spread = df.repartition(partitions)
    assert {r.k: r.idx for r in ordered_index(spread, "k").collect()} == expected
    sums = running_before(spread, "v", "k", output="s").collect()
    assert {r.k: r.s for r in sums} == {k: 2 * i for k, i in expected.items()}
