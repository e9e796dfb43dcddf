from __future__ import annotations

import base64

import pytest
from pyspark.sql import functions as F

from conftest import column
from lexmill.operators import tokens
from lexmill.plans import reports

RANKS = {**tokens.byte_ranks(), b"th": 256, b"the": 257}
EOT = {"<|endoftext|>": 258}


def test_merges(texts):
    df = tokens.encode(texts("the the", "", None), RANKS)
    assert column(df, "tokens") == [[257, 32, 257], [], None]
    counted = df.select("id", tokens.token_count().alias("n"))
    assert column(counted, "n") == [3, 0, None]


def test_policies(texts):
    df = texts("the<|endoftext|>")
    allowed = tokens.encode(df, RANKS, policy="allow", specials=EOT)
    assert column(allowed, "tokens") == [[257, 258]]
    plain = column(tokens.encode(df, RANKS, policy="text", specials=EOT), "tokens")[0]
    assert plain[:4] == [257, 60, 124, 101]
    with pytest.raises(Exception, match="disallowed special token"):
        tokens.encode(df, RANKS, policy="error", specials=EOT).collect()
    with pytest.raises(ValueError):
        tokens.encode(df, RANKS, policy="other")


def test_round_trip(texts):
    samples = ["the café \U0001f600", "", "  then\n", None, "<|endoftext|>the"]
    encoded = tokens.encode(texts(*samples), RANKS, policy="allow", specials=EOT)
    decoded = tokens.decode(encoded.drop("text"), RANKS, specials=EOT)
    assert column(decoded, "text") == samples


def test_decode_unknown_id(token_rows):
    with pytest.raises(Exception, match="unknown token id"):
        tokens.decode(token_rows([999]), RANKS).collect()


def test_long_texts(texts):
    samples = ["a" * 200_000, " " * 200_000, "ab " * 100_000]
    encoded = tokens.encode(texts(*samples), tokens.byte_ranks())
    assert column(encoded.select("id", F.size("tokens").alias("n")), "n") == [
        200_000, 200_000, 300_000,
    ]


def test_report(spark):
    df = spark.createDataFrame(
        [("f1", "the"), ("f1", "<|endoftext|>"), ("f2", "the")], "file string, text string"
    )
    done = tokens.encode_reported(df, RANKS, specials=EOT)
    assert {(r.text, r.tokens is None, r.error) for r in done.collect()} == {
        ("the", False, None), ("<|endoftext|>", True, "ValueError"),
    }
    files = tokens.file_report(done, "file")
    assert {r.file: (r.n_texts, r.n_failed, r.ok) for r in files.collect()} == {
        "f1": (2, 1, False), "f2": (1, 0, True),
    }
    assert tuple(tokens.success_summary(files, 3.0).first()) == (1, 2, 1.5)
    assert tuple(tokens.success_summary(files.where("false"), 3.0).first()) == (0, 0, None)


def test_rank_file(spark, tmp_path):
    lines = [f"{base64.b64encode(t).decode()} {r}" for t, r in RANKS.items()]
    (tmp_path / "x.ranks").write_text("\n".join(lines) + "\n")
    assert tokens.load_ranks(spark, str(tmp_path)) == RANKS


def test_tokenize_corpus_finds_the_column(spark):
    df = spark.createDataFrame([(7, "the")], "doc_id long, full_text string")
    row = tokens.tokenize_corpus(df, RANKS).first()
    assert (row.doc_id, row.tokens, row.token_count) == (7, [257], 1)


def test_summary_of_prepared_sources(spark):
    pages = spark.createDataFrame([(1, "<p>the</p>")], "page_id long, html string")
    talk = spark.createDataFrame(
        [(5, 0, "Page 1"), (5, 1, "the"), (6, 0, "a")], "conv_id long, turn long, text string"
    )
    prepared = reports.prepare_sources(pages, talk, RANKS)
    found = {r.source: tuple(r) for r in reports.prep_summary(prepared).collect()}
    assert found == {
        "web": ("web", 1, 3, 1, 50257, "gpt2"),
        "pdf": ("pdf", 2, 3, 1, 50257, "gpt2"),
    }


def test_rank_file_with_a_token_twice(spark, tmp_path):
    (tmp_path / "twice").write_text("YQ== 0\nYg== 1\nYQ== 2\n")
    with pytest.raises(ValueError, match="twice"):
        tokens.load_ranks(spark, str(tmp_path))


def test_far_ids_are_decoded(spark):
    specials = {"<|far|>": 2_000_000_000, "<|near|>": 300}
    ranks = tokens.byte_ranks()
    df = spark.createDataFrame([(0, [97, 2_000_000_000, 98, 300]), (1, []), (2, None)], "id long, tokens array<int>")
    assert column(tokens.decode(df, ranks, specials=specials), "text") == ["a<|far|>b<|near|>", "", None]
    for wrong in (299, 1_999_999_999, -1):
        bad = spark.createDataFrame([(0, [wrong])], "id long, tokens array<int>")
        with pytest.raises(Exception, match="unknown token id"):
            tokens.decode(bad, ranks, specials=specials).collect()
    with pytest.raises(ValueError):
        tokens.decode(df, ranks, specials={str(i): 10**6 + i for i in range(tokens.MAX_FAR + 1)})
