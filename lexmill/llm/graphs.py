"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import written

PART_ROWS = 200_000  # links that a task of a round takes at least


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node reachable, for every node that has a link.

    Each round takes the least label among a node and its neighbours, then the label of
    that label, so paths shrink by more than half; it ends when no label changes. Labels are
    written each round, which cuts the lineage and outlives lost executors. Rounds on few links
    would be mostly tasks without rows, so the number of links bounds the tasks of a round.
    """
    there = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    parts = 1 + 2 * links.count() // PART_ROWS
    both = written(
        there.union(there.select("other", "node")).where("node <> other").distinct().coalesce(parts), "links"
    )
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("component"))
        .coalesce(parts),
        "labels",
    )
    while True:
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        nearest = labels.join(seen, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("next")
        )
        jumped = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        after = written(
            nearest.join(jumped, "next", "left").select(
                "node", "was", F.least("next", F.coalesce("far", "next")).alias("component")
            ).coalesce(parts),
            "labels",
        )
        done = after.where("was <> component").isEmpty()
        labels = after.select("node", "component")
        if done:
            return labels
