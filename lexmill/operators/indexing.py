"""Global order without a single-task window.

Ranks are taken inside buckets and shifted by the bucket's offset. Only the bucket
table (one row per bucket) is ever ordered as a whole, and its size does not depend
on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import written

HASH_DIGITS = 4


def order_key(*keys, seed: int) -> Column:
    """Reproducible random order: a digest of the row's key and a seed."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("-", *[p.cast("string") for p in parts], F.lit(str(seed))))


def _offsets(sizes: DataFrame, bucket: str, value: str) -> DataFrame:
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        bucket, F.coalesce(F.sum(value).over(before), F.lit(0)).alias("_before")
    )


def hash_index(
    df: DataFrame,
    key: str,
    index: str = "idx",
    by: tuple[str, ...] = (),
    candidates: DataFrame | None = None,
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Position of every row in the order of ``key``, a hexadecimal digest, and the
    number of rows ``n_total``; both within each value of ``by`` (a few values).

    The first digits of a digest split the rows evenly whatever the data looks like:
    at most ``16 ** digits`` buckets, which also bounds the broadcast offset table.
    ``candidates`` may give the same keys more cheaply for counting.
    """
    bucket = F.substring(key, 1, digits)
    counted = df if candidates is None else candidates
    sizes = counted.groupBy(*by, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("n_total"),
    )
    rank = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(key))
    return (
        df.withColumn("_bucket", bucket)
        .withColumn("_rank", rank)
        .join(F.broadcast(offsets), [*by, "_bucket"])
        .withColumn(index, F.col("_before") + F.col("_rank") - 1)
        .drop("_bucket", "_rank", "_before")
    )


def hash_cutoff(
    df: DataFrame, key: str, share: float, digits: int = HASH_DIGITS
) -> DataFrame:
    """One row ``cutoff``: the digest at position ``floor(share * rows)`` (from 0) in
    digest order; no row where that is past the end.

    Counting buckets finds the one that holds the position; only that bucket's
    digests, one part in 65,536 of them, are ranked.
    """
    keys = df.select(F.col(key).alias("_key"), F.substring(key, 1, digits).alias("_bucket"))
    sizes = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy()
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_at", F.floor(F.sum("_n").over(whole) * F.lit(float(share))))
        .where("_before <= _at and _at < _before + _n")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    return (
        keys.join(F.broadcast(ends), "_bucket")
        .withColumn("_rank", rank)
        .where("_rank = _at - _before + 1")
        .select(F.col("_key").alias("cutoff"))
    )


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in global order, each knowing its range partition and its place there.

    Written to the checkpoint folder: the ranges come from sampling, so both readers
    below must see the very same ones, also when an executor is lost in between.
    """
    return written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "ranges",
    )


def ordered_index(df: DataFrame, *order: str, index: str = "idx") -> DataFrame:
    """Dense position from 0 in sort order, for any distribution of keys."""
    ranged = _ranged(df, list(order))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return (
        ranged.join(F.broadcast(_offsets(sizes, "_part", "_n")), "_part")
        .withColumn(index, F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )


def running_before(df: DataFrame, value: str, *order: str, output: str) -> DataFrame:
    """Sum of ``value`` over all rows that come earlier in the order."""
    ranged = _ranged(df, list(order))
    sizes = ranged.groupBy("_part").agg(F.sum(value).alias("_n"))
    here = (
        Window.partitionBy("_part")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumn("_here", F.coalesce(F.sum(value).over(here), F.lit(0)))
        .join(F.broadcast(_offsets(sizes, "_part", "_n")), "_part")
        .withColumn(output, F.col("_before") + F.col("_here"))
        .drop("_part", "_place", "_here", "_before")
    )
