"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lexmill.llm import spelling


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words: dict) -> dict:
    found, form = {}, {}
    for w, n in words.items():
        others = [(-m, o) for o, m in words.items() if near(w, o)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n else None
        found[w] = [n, len(others), form[w], words.get(form[w])]
    for w in words:
        end = w
        while form[end]:
            end = form[end]
        found[w].append(end)
    return {w: tuple(v) for w, v in found.items()}


def result(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_against_all_pairs(spark):
    draw = random.Random(5)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 6))): draw.randint(1, 40) for _ in range(500)}
    words |= {"aaaa": 3, "aaaaa": 3, "aaaaaa": 50}  # runs of equal characters, ties
    given = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.variants(given)) == brute(words)


def test_long_chain(spark):
    words = {"a" * i: 2**i for i in range(1, 30)}
    found = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found == brute(words) and found["a"][4] == "a" * 29


def test_all_characters_of_one_place(spark):
    letters = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]
    words = {f"br{c}wn": 3 for c in letters} | {"brwn": 4}
    found = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert all(v[1] == len(words) - 1 for v in found.values())


def test_edges(spark):
    rows = [("abcde", 3, "x"), ("abcde", 3, "y"), (None, 9, "z"), ("abcdf\u0001", 3, "z"), ("", 3, None), ("b", 1, None)]
    found = result(spelling.variants(spark.createDataFrame(rows, "word string, n long, root string")))
    assert found == {
        "abcde": (6, 0, None, None, "abcde"), "abcdf\u0001": (3, 0, None, None, "abcdf\u0001"),
        "": (3, 1, None, None, ""), "b": (1, 1, "", 3, ""),
    }
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_runs(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "Ab-cÉ×1éÿĀz " + "Q" * 100_000, 0)], "doc_id long, text string, n long")
    found = [r.run for r in spelling.runs(docs).collect()]
    assert found == ["ab", "cÉ×", "éÿ", "z", "q" * 100_000]
    words = docs.select(F.explode(F.array(*[F.lit(w) for w in ("abcd", "abcde", "vwxyz")])).alias("w"))
    assert {tuple(r) for r in spelling.counted(words, F.col("w")).collect()} == {("abcde", 3), ("vwxyz", 3)}
    assert spelling.counted(words.union(words.limit(0)), F.col("w"), 5, 4).count() == 0
