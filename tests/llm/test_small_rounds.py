"""Rounds on few rows are few tasks and few jobs, however many partitions a shuffle has."""

import pytest
from pyspark.sql import functions as F

from lexmill.llm.common import bitmap
from lexmill.llm.graphs import components


@pytest.fixture
def many_partitions(spark):
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_components_of_few_links_are_few_tasks(spark, many_partitions):
    links = [(i, i + 1) for i in range(50)] + [(100 + i, 200) for i in range(60)] + [(300, 300), (None, 7)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert len(found.inputFiles()) == 1
    rows = {r.node: r.component for r in found.collect() if r.node is not None}
    assert rows == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(60)}, 200: 100}


def test_a_bitmap_is_collected_in_few_jobs(spark, many_partitions):
    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    context = spark.sparkContext
    context.setJobGroup("bitmap-jobs", "")
    try:
        bits = bitmap(keys, "k", 24)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("bitmap-jobs")) < 10
    values = keys.toPandas()["k"].to_numpy()
    assert bits.has(values.view("uint64")).all() and not bits.has((values + 12345678901234567).view("uint64")).all()
