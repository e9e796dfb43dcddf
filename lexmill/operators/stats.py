"""Corpus statistics: token counts, languages, histograms, samples, table profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lexmill.functions import text as X
from lexmill.operators.indexing import order_key, running_before


def resolve_text_column(columns: list[str]) -> str:
    """The first column whose lower-cased name contains ``text``."""
    for name in columns:
        if "text" in name.lower():
            return name
    raise ValueError(f"no text column among {columns}")


def text_like_columns(columns: list[str]) -> list[str]:
    """All columns whose name contains ``text`` or ``content``."""
    return [c for c in columns if "text" in c.lower() or "content" in c.lower()]


def optional_column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def _token_stats(count: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(count).alias("total_tokens"),
        F.min(count).alias("min_tokens"),
        F.max(count).alias("max_tokens"),
        F.avg(count).alias("mean_tokens"),
    ]


def token_stats(df: DataFrame, *keys: str, count: str = "token_count") -> DataFrame:
    """Rows and sum, minimum, maximum and mean of the token count; the mean of no
    rows is null."""
    return df.groupBy(*keys).agg(*_token_stats(count))


def token_stats_with_total(df: DataFrame, key: str, count: str = "token_count") -> DataFrame:
    """Statistics per key and, in the row with ``is_total = 1``, over all keys."""
    return df.rollup(key).agg(
        F.grouping(key).cast("int").alias("is_total"), *_token_stats(count)
    )


def merge_token_stats(parts: DataFrame, *keys: str) -> DataFrame:
    """Merge partial statistics; the mean is the sum of sums over the sum of rows."""
    rows, tokens = F.sum("n_rows"), F.sum("total_tokens")
    return parts.groupBy(*keys).agg(
        rows.alias("n_rows"),
        tokens.alias("total_tokens"),
        F.min("min_tokens").alias("min_tokens"),
        F.max("max_tokens").alias("max_tokens"),
        F.when(rows > 0, tokens / rows).alias("mean_tokens"),
    )


def category_shares(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values with count and percentage of all rows."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    total = counted.agg(F.sum("cnt")).scalar()
    return (
        counted.where(F.col(column).isNotNull())
        .select(column, "cnt", X.percent("cnt", total).alias("pct"))
        .orderBy(F.desc("cnt"), column)
        .limit(k)
    )


def length_histogram(
    df: DataFrame,
    count: str = "token_count",
    bins: int = 100,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width bins over the data's own range, or over fixed ``bounds`` with
    values outside left out. The last bin includes its upper edge; a range of width
    zero is widened by one half on both sides. Empty bins are present."""
    values = df.select(F.col(count).cast("double").alias("v")).where("v is not null")
    if bounds:
        low, high = (F.lit(float(b)) for b in bounds)
        values = values.where((F.col("v") >= low) & (F.col("v") <= high))
    else:
        edges = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
        flat = edges["lo"] == edges["hi"]
        half = F.when(flat, F.lit(0.5)).otherwise(F.lit(0.0))
        low, high = edges["lo"] - half, edges["hi"] + half
    step = (high - low) / bins
    last = bins - 1
    guess = F.least(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(last))
    # The division may land next to an edge on its wrong side: compare with the edges.
    below = F.col("v") < low + F.col("b") * step
    above = (F.col("v") >= low + (F.col("b") + 1) * step) & (F.col("b") < last)
    place = F.col("b") - F.when(below, 1).otherwise(0) + F.when(above, 1).otherwise(0)
    counted = (
        values.withColumn("b", guess)
        .select(place.alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * step).alias("bin_start"),
            F.coalesce("n", F.lit(0)).alias("cnt"),
        )
    )


def first_rows(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


QUARTILES = ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))


def _long_numbers(df: DataFrame) -> DataFrame:
    """Values (``column``, ``v``) of all numeric columns."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if not names:
        raise ValueError("no numeric column")
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in names]
    return df.select(F.inline(F.array(*entries)))


def quantiles(values: DataFrame, wanted: tuple[tuple[float, str], ...] = QUARTILES) -> DataFrame:
    """Exact quantiles of ``v`` per ``column``, interpolated; nulls are left out, NaN is largest.

    Equal values are counted first. Distinct values are then put in order by ranges, and
    running counts tell which of them holds a rank. No task holds more than one range, and no
    value is hot."""
    counted = values.where("v is not null").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = running_before(counted, "n", "column", "v", output="before")
    sizes = placed.groupBy("column").agg(F.min("before").alias("_first"), F.sum("n").alias("_n"))
    ranked = placed.join(F.broadcast(sizes), "column")  # a row per column of the table
    at = F.col("before") - F.col("_first")

    def value_of(rank: Column) -> Column:
        return F.max(F.when((at <= rank) & (rank < at + F.col("n")), F.col("v")))

    def quantile(q: float) -> Column:
        place = (F.col("_n") - 1) * F.lit(q)
        low = F.floor(place)
        share = F.max(place - low)
        first, second = value_of(low), value_of(F.ceil(place))
        return F.when(share == 0, first).otherwise(first + (second - first) * share)

    return ranked.groupBy("column").agg(*[quantile(q).alias(name) for q, name in wanted])


def describe_numeric(df: DataFrame, *order: str, n: int | None = 5) -> DataFrame:
    """count, mean, std, min, quartiles and max of the numeric columns, one row per
    column; quartiles are exact and interpolated. Of the first ``n`` rows, or of all (``None``)."""
    values = _long_numbers(df if n is None else first_rows(df, *order, n=n))
    summed = values.groupBy("column").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    # Without any value a column has no quartiles.
    found = summed.join(quantiles(values), "column", "left")
    return found.select("column", "n", "mean", "std", "min", *[name for _, name in QUARTILES], "max")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, type and the table's row count."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(fields))


def seeded_sample(df: DataFrame, column: str, k: int, seed: int = 42) -> DataFrame:
    """``k`` distinct values (file names, say) in a reproducible random order."""
    return (
        df.select(column)
        .distinct()
        .withColumn("_key", order_key(column, seed=seed))
        .orderBy("_key")
        .limit(k)
        .drop("_key")
    )
