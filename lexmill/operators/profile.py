"""Text profiles: counts per text and per group, frequent items, raw against clean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lexmill.functions import arrays as A
from lexmill.functions import patterns as P
from lexmill.functions import text as X

# The nine compared metrics, in report order.
METRICS = (
    "char_count", "word_count", "sent_count", "avg_word_length", "vocab_size",
    "whitespace_count", "newline_count", "html_tags", "page_numbers",
)


def _layout_counts(text: str) -> dict[str, Column]:
    """Counts that need no word list."""
    return {
        "char_count": F.length(text),
        "sent_count": X.count_matches(text, P.SENTENCE_END) + 1,
        "whitespace_count": X.count_chars(text, P.SPACES),
        "newline_count": X.count_chars(text, "\n"),
        "html_tags": X.count_matches(X.upto_last(text, ">"), P.TAG),
        "page_numbers": X.count_matches(text, P.PAGE_MARK),
    }


def text_metrics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)):
    """The nine metrics of every text, in one projection and without a shuffle."""
    n_words = F.size("_words")
    letters = F.length(F.array_join("_words", ""))
    measured = {
        **_layout_counts(text),
        "word_count": n_words,
        "avg_word_length": F.when(n_words > 0, letters / n_words).when(n_words == 0, F.lit(0.0)),
        "vocab_size": F.size(F.array_distinct("_words")),
    }
    counted = df.select(*keep, text, X.words(text).alias("_words"))
    return counted.select(
        *keep,
        *[
            F.when(F.col(text).isNotNull(), measured[m]).alias(m)
            for m in METRICS
        ],
    )


def word_occurrences(df: DataFrame, keys: list[str], text: str, order: str) -> DataFrame:
    """One row per key and word: count and place of the first occurrence, ``order``
    telling the texts of a key apart."""
    return _occurrences(df, keys, X.words(text), order)


def special_char_occurrences(
    df: DataFrame, keys: list[str], text: str, order: str
) -> DataFrame:
    return _occurrences(df, keys, X.special_chars(text), order)


def _occurrences(df: DataFrame, keys: list[str], items: Column, order: str) -> DataFrame:
    needed = dict.fromkeys([*keys, order])
    exploded = df.select(*needed, F.posexplode(items).alias("_pos", "item"))
    if order in keys:
        place = F.col("_pos")
    elif isinstance(df.schema[order].dataType, IntegralType):
        # Both parts in one number, so that Spark can aggregate by hashing.
        high = F.col(order).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)")
        place = high + F.col("_pos")
    else:
        place = F.struct(order, "_pos")
    return exploded.groupBy(*keys, "item").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(place).alias("first_seen")
    )


def top_k(counted: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """Most frequent items per key, ties by first appearance.

    Spark keeps the best ``k`` per key on every map task before the shuffle, so a key
    with very many items sends only ``k`` rows per task to its reducer.
    """
    order = [F.desc("cnt"), F.asc("first_seen")]
    if not keys:
        # The sort key leads to one bounded heap per task, merged at the end.
        best = counted.orderBy(*order).limit(k)
        ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    else:
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = counted.withColumn("rank", F.row_number().over(window)).where(
            F.col("rank") <= k
        )
    return ranked.select(*keys, "rank", "item", "cnt")


def top_words_per_text(
    df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 10
) -> DataFrame:
    """Most common words of every text, ties by first appearance.

    Counted inside each row: words are sorted with their places, and a run of equal words is
    its count and first place. Nothing is shuffled, and texts need no unique key.
    """
    counted = F.transform(
        A.places(X.words(text)),
        lambda w: F.struct(
            (-F.size(w["at"])).alias("less"), w["at"][0].alias("first"), w["value"].alias("item")
        ),
    )
    best = df.select(key, F.posexplode(F.slice(F.sort_array(counted), 1, k)).alias("_pos", "_w"))
    return best.select(
        key, (F.col("_pos") + 1).alias("rank"), "_w.item", (-F.col("_w.less")).cast("long").alias("cnt")
    )


def metrics_by_group(
    df: DataFrame, group: str, text: str = "text", counted: DataFrame | None = None
) -> DataFrame:
    """The nine metrics of a group's texts taken as one unit.

    Words are counted per (group, word) before anything is gathered per group; ``counted``
    gives these counts (``group``, ``item``, ``cnt``) where they are at hand, and spares
    reading the texts a second time for them.
    """
    layout = _layout_counts(text)
    runs = layout.pop("sent_count") - 1
    sums = df.groupBy(group).agg(
        *[F.sum(column).alias(name) for name, column in layout.items()],
        (F.sum(runs) + 1).alias("sent_count"),
    )
    if counted is None:
        counted = (
            df.select(group, F.explode(X.words(text)).alias("item"))
            .groupBy(group, "item")
            .agg(F.count(F.lit(1)).alias("cnt"))
        )
    vocabulary = counted.groupBy(group).agg(
        F.sum("cnt").alias("word_count"),
        F.count(F.lit(1)).alias("vocab_size"),
        (F.sum(F.col("cnt") * F.length("item")) / F.sum("cnt")).alias("avg_word_length"),
    )
    joined = sums.join(vocabulary, group, "left")
    return joined.select(
        group, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in METRICS]
    )


def vocabulary_size(
    df: DataFrame, text: str = "text", approximate: bool = False, items: Column | None = None
) -> DataFrame:
    """Number of distinct words (or of other ``items``) in the corpus."""
    exploded = df.select(F.explode(X.words(text) if items is None else items).alias("item"))
    count = F.approx_count_distinct if approximate else F.count_distinct
    return exploded.agg(count("item").alias("vocab_size"))


def _long_form(*keys: str) -> list[Column]:
    entries = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"raw_{m}").cast("double").alias("raw"),
            F.col(f"clean_{m}").cast("double").alias("clean"),
            (F.col(f"clean_{m}") - F.col(f"raw_{m}")).cast("double").alias("change"),
        )
        for m in METRICS
    ]
    return [*keys, F.inline(F.array(*entries))]


def compare_metrics(raw: DataFrame, clean: DataFrame, key: str = "doc_id") -> DataFrame:
    """Metric by metric: raw value, clean value and change, matched by key."""
    left = raw.select(key, *[F.col(m).alias(f"raw_{m}") for m in METRICS])
    right = clean.select(key, *[F.col(m).alias(f"clean_{m}") for m in METRICS])
    return left.join(right, key).select(*_long_form(key))


def compare_columns(df: DataFrame, raw: str, clean: str, key: str = "doc_id") -> DataFrame:
    """The same comparison for two texts of one row: no join, no shuffle."""
    first = text_metrics(df, raw, (key, clean))
    for m in METRICS:
        first = first.withColumnRenamed(m, f"raw_{m}")
    second = text_metrics(first, clean, (key, *[f"raw_{m}" for m in METRICS]))
    for m in METRICS:
        second = second.withColumnRenamed(m, f"clean_{m}")
    return second.select(*_long_form(key))
