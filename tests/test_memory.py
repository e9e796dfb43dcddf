"""Arrow functions hold a bounded part of a batch at a time."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from lexmill.functions import udfs
from lexmill.operators import scoring, tokens
from lexmill.sources import readers

MB = 1 << 20


def _longest(made, texts) -> int:
    """Texts in the largest result that an Arrow function hands over for one batch."""
    parts = list(made.func(iter([texts])))
    assert sum(map(len, parts)) == len(texts)
    return max(map(len, parts))


def test_pieces_hold_every_text_once():
    texts = pa.array(["ab", None, "", "x" * 10, "cd", "e", None])
    cut = [p.to_pylist() for p in udfs.pieces(texts, 4)]
    assert cut == [["ab", None, "", "x" * 10], ["cd", "e", None]]
    assert list(udfs.pieces(pa.array([], pa.string()))) == []


def test_batches_are_encoded_in_pieces(spark):
    texts = pa.array(["é" * 50_000 + "é&amp;"] * 100)  # 10 MB
    for report in (False, True):
        made = tokens._encoder(spark, tokens.byte_ranks(), {}, "text", report)
        assert _longest(made, texts) <= 12
    for made in (udfs.nfc, udfs.unescape, udfs.parsed_html_text):
        assert _longest(made, texts) <= 12


def test_scorer_by_pieces(spark):
    @udfs.by_pieces("array<double>")
    def held(texts: pa.Array) -> pa.Array:
        return pa.array([[float(texts.nbytes)]] * len(texts))

    df = spark.range(64).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 200_000).alias("text"))
    found = scoring.text_log_probs(df, held).agg(F.count("logp").alias("n"), F.max("logp").alias("most")).first()
    assert found.n == 64 and found.most < 2 * MB


def test_frames_of_a_few_rows_are_cut_before_they_are_made(spark):
    df = spark.createDataFrame([(i, None if i == 3 else "t" * i, b"x", 0.5) for i in range(10)],
                               "id long, t string, b binary, x double").coalesce(1)

    def measured(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": frame["t"].str.len(), "id": frame["id"]})

    made = readers.in_batches(df, measured, "id long, n int", 4)
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, made.collect())) == [(i, None if i == 3 else i) for i in range(10)]
    by_place = readers.in_batches(df, lambda f: pd.DataFrame({0: f["id"], 1: f["id"]}), "a long, b long", 4)
    assert sorted(map(tuple, by_place.collect())) == [(i, i) for i in range(10)]
    none = readers.in_batches(df, lambda f: f[f["id"] > 100][["id"]], "id long", 4)
    assert none.collect() == []
    dated = spark.sql("SELECT timestamp'2020-01-02 03:04:05' AS t")
    assert readers.in_batches(dated, lambda f: f, "t timestamp", 1).collect() == dated.collect()
