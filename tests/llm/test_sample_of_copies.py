"""The bound of the learnt sample is one of different texts, however often each is repeated."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.llm import langid, quality


def test_sample_counts_texts_not_rows(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("copied text "), (F.col("id") % 100).cast("string")).alias("text"), F.lit("aa").alias("lang"))
    other = spark.range(60).select(F.concat(F.lit("other text "), F.col("id").cast("string")).alias("text"), F.lit("bb").alias("lang"))
    found = langid.sample(rows.unionByName(other), "text", "lang", 150).collect()
    assert len({r._t for r in found if r._l == "aa"}) == 100 and len({r._t for r in found if r._l == "bb"}) == 60
    assert len(found) == 160
    few = langid.sample(rows.unionByName(other), "text", "lang", 40).collect()
    assert sorted(r._l for r in few) == ["aa"] * 40 + ["bb"] * 40


def test_quality_learns_a_class_of_copies(spark):
    """A class of few texts with very many copies each is learnt, so bad texts are not kept."""
    bad = spark.range(4_000).select(
        "id", F.concat_ws(" ", *[F.concat(F.lit(f"junk{i}x"), (F.col("id") % 4).cast("string")) for i in range(12)]).alias("text"))
    good = spark.range(4_000, 4_040).select(
        "id", F.concat_ws(" ", *[F.concat(F.lit(f"fine{i}y"), F.col("id").cast("string")) for i in range(12)]).alias("text"))
    docs = bad.unionByName(good).withColumnRenamed("id", "doc_id")
    labels = docs.select("doc_id", (F.col("doc_id") >= 4_000).cast("int").alias("quality"))
    found = quality.score(docs, quality.train(docs, labels, per_class=20)).groupBy((F.col("doc_id") >= 4_000).alias("good")).agg(
        F.max("probability").alias("most")).collect()
    assert {r.good: r.most for r in found}[False] < 0.5
