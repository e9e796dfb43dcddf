"""Look-up joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD_ROWS = 1024
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Measure a table: true if its rows and its text stay under the bounds."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    found = (
        df.select(width.cast("long").alias("_w"))
        .limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_w"), F.lit(0)).alias("w"))
        .first()
    )
    return found.n <= rows and found.w <= size


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    head_rows: int = HEAD_ROWS,
    broadcast: bool | None = None,
    frequency: str | None = None,
) -> DataFrame:
    """Left outer join of many rows with a table holding each key once.

    A right side measured small is broadcast. Otherwise the ``head_rows`` most
    frequent keys of the left side are looked up first and broadcast, so rows with
    those keys are never shuffled; in what is left for the shuffle join no key can
    hold more than one part in ``head_rows`` of the rows. ``frequency`` names a column
    of the right side that tells how many left rows have the key, which spares
    counting them.
    """
    if broadcast is None:
        broadcast = fits_broadcast(right)
    if broadcast:
        small = right if frequency is None else right.drop(frequency)
        return left.join(F.broadcast(small), keys, "left")
    if frequency is not None:
        known = right.orderBy(F.desc(frequency), *keys).limit(head_rows).drop(frequency)
        head, right = known.select(*keys), right.drop(frequency)
    else:
        head = (
            left.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), *keys)
            .limit(head_rows)
            .select(*keys)
        )
        known = head.join(right, keys, "left")
    hot = left.join(F.broadcast(known), keys, "inner")
    cold = left.join(F.broadcast(head), keys, "left_anti").join(right, keys, "left")
    return hot.unionByName(cold)


def lookup_once(
    left: DataFrame, right: DataFrame, keys: list[str], frequency: str, value: str,
    deal_by: list[str], head_rows: int = HEAD_ROWS,
) -> DataFrame:
    """As ``lookup``, but in one pass over ``left``: adds ``value``, which must not be null in
    ``right``.

    The ``head_rows`` most frequent keys are looked up by broadcast. Rows they answered then
    take another key, a digest of ``deal_by``, into the shuffle join, where they lie
    evenly and what they may find does not count; so again no key can be hot there."""
    head = right.orderBy(F.desc(frequency), *keys).limit(head_rows).select(*keys, F.col(value).alias("_hot"))
    asked = left.join(F.broadcast(head), keys, "left")
    dealt = asked.withColumns({
        f"_k{i}": F.when(F.col("_hot").isNull(), F.col(k)).otherwise(
            F.xxhash64(F.lit(i), *deal_by).cast(left.schema[k].dataType)
        )
        for i, k in enumerate(keys)
    })
    rest = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_cold"))
    joined = dealt.join(rest, [f"_k{i}" for i in range(len(keys))], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.withColumn(value, found).drop("_hot", "_cold", *[f"_k{i}" for i in range(len(keys))])
