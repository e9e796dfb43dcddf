from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import column
from lexmill.functions import arrays as A
from lexmill.operators import examples as E
from lexmill.plans import reports


def tokens_of(n):
    return list(range(n))


def test_strict_and_clipped(token_rows):
    df = token_rows(tokens_of(10), tokens_of(4), [], None)
    strict = E.windows_strict(df, 4, 2).collect()
    assert [r.start for r in strict] == [0, 2, 4]
    assert all(r.y == [i + 1 for i in r.x] for r in strict)
    clipped = E.windows_clipped(df, 4, 2).where("doc_id = 0").collect()
    assert [r.start for r in clipped] == [0, 2, 4, 6]
    assert len(clipped[-1].y) == 3 and clipped[-1].target_short
    four = E.windows_clipped(df, 4, 2).where("doc_id = 1").collect()
    assert [(r.x, r.y) for r in four] == [([0, 1, 2, 3], [1, 2, 3])]
    assert E.windows_clipped(df, 4, 2, drop_short=True).count() == 3
    assert E.windows_clipped(df, 4, 2, max_tokens=6).where("doc_id = 0").count() == 2


@pytest.mark.parametrize("length, stride", [(4, 4), (4, 1), (128, 32), (8, 2)])
def test_counts_without_windows(token_rows, length, stride):
    df = token_rows(*[tokens_of(n) for n in (0, 3, 4, 5, 8, 9, 127, 128, 129, 300)])
    exact = E.exact_examples(df, length, stride).first()
    assert exact.strict == E.windows_strict(df, length, stride).count()
    assert exact.clipped == E.windows_clipped(df, length, stride).count()
    for policy, cut in (
        ("strict", E.windows_strict(df, length, stride)),
        ("clipped", E.windows_clipped(df, length, stride)),
    ):
        starts = E.window_starts(df, length, stride, policy)
        assert sorted(starts.collect()) == sorted(cut.select("doc_id", "start").collect())


def test_padded(token_rows):
    rows = E.windows_padded(token_rows([5, 6, 7]), 5).first()
    assert (rows.x, rows.y, rows.n_valid) == ([5, 6, 7, 0, 0], [6, 7, 0, 0, 0], 3)
    rows = E.windows_padded(token_rows([1, 2, 3, 4, 5, 6]), 4).first()
    assert (rows.x, rows.y, rows.n_valid) == ([1, 2, 3, 4], [2, 3, 4, 0], 4)


def test_arrays(token_rows):
    df = token_rows([1, 2, 3], [], None).select(
        "doc_id", A.roll_left("tokens").alias("r"), A.clip("tokens", 2).alias("c")
    )
    assert column(df, "r", "doc_id") == [[2, 3, 0], [], None]
    assert column(df, "c", "doc_id") == [[1, 2], [], None]


def test_context_pairs(token_rows):
    rows = E.context_pairs(token_rows([10, 11, 12, 13, 14]), 4).collect()
    assert [(r.context, r.target) for r in rows] == [
        ([10], 11), ([10, 11], 12), ([10, 11, 12], 13), ([10, 11, 12, 13], 14),
    ]
    assert E.context_pairs(token_rows([1], []), 4).count() == 0


def test_estimate(token_rows):
    df = token_rows(tokens_of(2000), tokens_of(50))
    row = E.estimate_examples(df, 100, 50, "doc_id").first()
    assert row.estimated == 39 and row.exact == 39


def test_batches(token_rows):
    df = token_rows(tokens_of(9), tokens_of(5), tokens_of(4))  # 5 + 1 strict windows of 4
    sizes = lambda d: [r["n"] for r in d.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n")).orderBy("batch_id").collect()]
    assert sizes(E.batch_windows(df, 4, 1, 4)) == [4, 2]
    assert sizes(E.batch_windows(df, 4, 1, 4, drop_last=True)) == [4]
    ordered = E.windows_in_order(df, 4, 1).orderBy("idx").collect()
    assert [(r.idx, r.doc_id, r.start) for r in ordered] == [
        (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 1, 0),
    ]


def test_shuffled_batches(spark):
    df = spark.range(10)
    batched = E.batch_shuffled(df, "id", batch_size=4)
    assert sorted(r.idx for r in batched.collect()) == list(range(10))
    assert E.batch_shuffled(df, "id", batch_size=4, drop_last=True).count() == 8
    by = df.withColumn("g", F.col("id") % 2)
    grouped = E.batch_shuffled(by, "id", batch_size=2, by=("g",), drop_last=F.col("g") == 0)
    assert {r.g: r["count"] for r in grouped.groupBy("g").count().collect()} == {0: 4, 1: 5}


def test_matrix(token_rows):
    df = E.windows_padded(token_rows([1], [2, 3], [4]), 2)
    stacked = E.batch_matrix(E.batch_shuffled(df, "doc_id", batch_size=2)).collect()
    assert sorted(r.n_rows for r in stacked) == [1, 2]
    assert all(len(x) == 2 for r in stacked for x in r.matrix)


def test_tokens_seen(spark):
    steps = spark.range(12).select(F.col("id").alias("step"), F.lit(8).alias("n_tokens"))
    for bucket in (3, 100):
        seen = E.tokens_seen(steps, 5, step_bucket=bucket).orderBy("step").collect()
        assert [tuple(r) for r in seen] == [(0, 8), (5, 48), (10, 88)]


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_split_sizes_and_stability(spark, partitions):
    df = spark.range(1003)
    expected = {r.id for r in E.split_exact(df, "id").where("split = 'train'").collect()}
    split = E.split_exact(df.repartition(partitions), "id")
    train = {r.id for r in split.where("split = 'train'").collect()}
    assert train == expected and len(train) == 902
    assert split.count() == 1003
    order = [r.id for r in E.shuffle(df.repartition(partitions), "id", seed=1).collect()]
    assert order == [r.id for r in E.shuffle(df, "id", seed=1).collect()]
    fast = E.split_fast(df.repartition(partitions), "id").where("split = 'train'")
    assert {r.id for r in fast.collect()} == {
        r.id for r in E.split_fast(df, "id").where("split = 'train'").collect()
    }


def test_split_everything_or_nothing(spark):
    df = spark.range(7)
    assert E.split_exact(df, "id", share=1.0).where("split = 'train'").count() == 7
    assert E.split_exact(df, "id", share=0.0).where("split = 'val'").count() == 7


def test_split_prefix(texts):
    row = E.split_prefix(texts("abcdefghijk"), keep=("id",)).first()
    assert (row.train, row.val) == ("abcdefghi", "jk")


def test_epochs(spark):
    rows = E.epochs(spark.range(5), "id", n_epochs=3).collect()
    assert len(rows) == 15 and len({r.order_key for r in rows}) == 15


def test_training_examples(token_rows):
    df = token_rows(*[tokens_of(n) for n in range(0, 60, 3)])
    total = E.windows_clipped(df, 8, 4).count()
    made = reports.training_examples(df, 8, 4, 4)
    sizes = {r.split: r["count"] for r in made.groupBy("split").count().collect()}
    train = int(0.9 * total)
    assert sizes == {"train": train // 4 * 4, "val": total - train}
    assert made.select("doc_id", "start").distinct().count() == made.count()


def test_exact_count_of_a_long_text(spark):
    df = spark.createDataFrame([(0, list(range(5000)))], "doc_id long, tokens array<int>")
    assert E.estimate_examples(df, 100, 50, "doc_id").first().exact == 99


def test_tokens_seen_over_epochs(spark):
    """Steps of 4 examples of 3 tokens, counted on over the epochs, against a plain loop."""
    sizes = [10, 3, 0, 7, 25, 4]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n long")
    windows = sum(len(range(0, max(n - 3, 0), 2)) for n in sizes)
    for drop_last in (False, True):
        batches = [min(4, windows - i) for i in range(0, windows, 4)]
        batches = [b for b in batches if b == 4 or not drop_last]
        expected, seen, step = [], 0, -1
        for epoch in range(3):
            for size in batches:
                seen, step = seen + size * 3, step + 1
                if step % 2 == 0:
                    expected.append((epoch, step, seen))
        steps = E.window_steps(df, 3, 2, 4, F.col("n"), drop_last=drop_last)
        found = E.tokens_seen(steps, 2, step_bucket=2, n_epochs=3)
        assert sorted(map(tuple, found.collect())) == expected
    none = E.window_steps(df.limit(0), 3, 2, 4, F.col("n"))
    assert E.tokens_seen(none, 2).count() == 0
