"""Loss and perplexity from token log-probabilities.

The model is an add-one bigram model counted by Spark; a table of other
log-probabilities can take its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import blocks
from lexmill.operators.lookups import lookup, lookup_once
from lexmill.session import written


PAIR_KEY = ["h1", "h2"]
HEAD_WORDS = 200_000  # first words with most pairs, looked up where the counts lie
MOST_GROUPS = 256  # each is a column of the counts
PLACED_PARTS = 8  # placed pairs take this much more room in memory than their texts on disk


def _words(text: str, max_length: int | None) -> Column:
    words = X.words(text)
    return words if max_length is None else F.slice(words, 1, max_length)


def _pair_key(a, b) -> list[Column]:
    """128 bits that stand for a word pair, so that pairs of texts travel without words."""
    return [F.xxhash64(a, b).alias("h1"), F.xxhash64(F.lit(1), b, a).alias("h2")]


def _each_pair(words: Column) -> Column:
    """Pairs of neighbouring words as an array of (a, b)."""
    last = F.greatest(F.size("_w") - 1, F.lit(0))
    return F.arrays_zip(F.slice(words, F.lit(1), last).alias("a"), F.slice(words, F.lit(2), last).alias("b"))


def pair_counts(
    df: DataFrame, text: str = "text", max_length: int | None = None, learn: Column | None = None,
    by: list[str] | None = None, number: str | None = None,
) -> DataFrame:
    """Word pairs ``(a, b)`` of all texts, over whole texts or their first ``max_length`` words, and
    ``n``, how often the texts have them in which ``learn`` holds. Pairs only to be scored get a
    count of zero. The first word of a text is never predicted.

    With ``by``, at most ``MOST_GROUPS`` values, ``groups`` lists per value how often (``n``) its texts
    have the pair, so that groups are scored from the counts alone. Pairs are combined where the
    texts lie; no pair of a single text is kept.

    With ``number``, a column that numbers the texts (different longs that ascend where texts lie together),
    pairs also tell where they stand, so that texts are scored from the counts alone: a pair has a row for
    each block of texts that has it, all with the same ``n``, one of them with ``first``; ``base`` and ``at``
    give the number of the text of every occurrence (``operators.blocks.cut_pairs``).
    """
    told = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    by = by or []
    if number is not None:
        if by:
            raise ValueError("counts are kept by group or by text, not both")
        return _placed_counts(df, _words(text, max_length), told, number)
    held = df.select(*by, told.alias("_learn"), _words(text, max_length).alias("_w"))
    pairs = held.select(*by, "_learn", F.inline(_each_pair(F.col("_w"))).alias("a", "b"))
    learnt = F.sum(F.col("_learn").cast("long"))
    if not by:
        return written(pairs.groupBy("a", "b").agg(learnt.alias("n")), "pair-counts")
    values = df.select(*by).distinct().limit(MOST_GROUPS + 1).collect()
    if len(values) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups; score texts instead")
    schema = df.select(*by).schema

    def same(row) -> Column:
        return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(row[c])) for c in by])

    counts = pairs.groupBy("a", "b").agg(
        learnt.alias("n"), *[F.count_if(same(row)).alias(f"_g{i}") for i, row in enumerate(values)]
    )

    def entry(row, n: Column) -> Column:
        return F.struct(*[F.lit(row and row[c]).cast(schema[c].dataType).alias(c) for c in by], n.alias("n"))

    entries = [entry(row, F.col(f"_g{i}")) for i, row in enumerate(values)] or [entry(None, F.lit(0).cast("long"))]
    listed = F.filter(F.array(*entries), lambda g: g["n"] > 0)
    return written(counts.select("a", "b", "n", listed.alias("groups")), "pair-counts")


def _placed_counts(df: DataFrame, words: Column, told: Column, number: str) -> DataFrame:
    """A block has a pair once, so no pair has more rows than there are blocks, however hot it is."""
    held = df.select(F.col(number).alias("_number"), told.alias("_learn"), words.alias("_values"))
    parts = df.rdd.getNumPartitions() * PLACED_PARTS
    dealt = blocks.cut_pairs(held).repartition(parts, "pair")
    pair = Window.partitionBy("pair")
    learnt = F.size(F.filter("at", lambda i: i >= 0))
    counts = dealt.select(
        F.substring_index("pair", " ", 1).alias("a"), F.substring_index("pair", " ", -1).alias("b"),
        F.sum(learnt).over(pair).alias("n"), "base",
        F.transform("at", lambda i: F.when(i < 0, F.bitwise_not(i)).otherwise(i)).alias("at"),
        (F.col("base") == F.min("base").over(pair)).alias("first"),
    )
    return written(counts, "pair-counts", "zstd")


def bigram_model(counts: DataFrame) -> DataFrame:
    """``counts`` with ``logp``: ln((count(a, b) + 1) / (count(a, .) + V)), V the number of learnt words."""
    pairs = counts.where("first") if "first" in counts.columns else counts
    firsts = pairs.groupBy("a").agg(F.sum("n").alias("n_a"), F.count(F.lit(1)).alias("n_seconds"))
    firsts = written(firsts, "first-words")
    words = firsts.where("n_a > 0").select(F.col("a").alias("w")).union(pairs.where("n > 0").select("b"))
    size = words.agg(F.count_distinct("w")).scalar()
    # The first words are as many as the vocabulary: never broadcast whole. The counts are
    # written, so reading them twice costs less than to shuffle what the head answers.
    joined = lookup(counts, firsts, ["a"], HEAD_WORDS, broadcast=False, frequency="n_seconds")
    return joined.withColumn("logp", F.log((F.col("n") + 1) / (F.col("n_a") + size))).drop("n_a")


def score_texts(
    df: DataFrame, model: DataFrame, keys: list[str], text: str = "text", max_length: int | None = None,
    number: str | None = None,
) -> DataFrame:
    """Per text (``keys``) of two words or more: ``n`` predictions and their mean ``logp``.

    Texts are read once; their pairs leave them as digests, and each is looked up once. Pairs
    the model does not have are left out of both figures. With ``number`` the model is of the
    ``pair_counts`` of the same texts with the same ``number``: where their pairs stand is in its rows, so
    texts are not read and no pair is looked up again."""
    if number is not None:
        return _score_placed(df, model, keys, number)
    held = df.select(*keys, _words(text, max_length).alias("_w"))
    each = held.select(*keys, F.inline(_each_pair(F.col("_w"))).alias("_a", "_b"))
    pairs = each.select(*keys, *_pair_key("_a", "_b"))
    known = written(model.select(*_pair_key("a", "b"), "logp", F.col("n").alias("_times")), "pair-model")
    scored = lookup_once(pairs, known, PAIR_KEY, "_times", "logp", [*keys, *PAIR_KEY])
    known_pairs = scored.where(F.col("logp").isNotNull())
    return known_pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("logp").alias("logp"))


def _score_placed(df: DataFrame, model: DataFrame, keys: list[str], number: str) -> DataFrame:
    each = model.where(F.col("logp").isNotNull()).select("base", "logp", F.explode("at").alias("_at"))
    # A task has pairs of nearly all texts and sends a row for each of these: no more tasks than cores.
    few = each.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    sums = few.groupBy((F.col("base") + F.col("_at")).alias("_number")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("logp").alias("_sum")
    )
    named = sums.join(df.select(*keys, F.col(number).alias("_number")), "_number")
    total = F.sum("_n")
    return named.groupBy(*keys).agg(total.alias("n"), (F.sum("_sum") / total).alias("logp"))


def score_groups(model: DataFrame, keys: list[str]) -> DataFrame:
    """As ``score_texts`` for the groups of ``pair_counts``: their counts are in the model's rows."""
    each = model.where(F.col("logp").isNotNull()).select("logp", F.inline("groups"))
    return each.select(*keys, "n", "logp")


def _mean_logp() -> Column:
    """Mean over the predictions of a group; null without any."""
    return F.sum(F.col("n") * F.col("logp")) / F.nullif(F.sum("n"), F.lit(0))


def perplexity(scored: DataFrame, keys: list[str], texts: DataFrame | None = None) -> DataFrame:
    """exp of the mean negative log-likelihood over ``n`` predictions per row.

    A text of fewer than two words has no predictions and so no row in ``scored``.
    With ``texts`` every text of that table gets a row, null where nothing is predicted."""
    found = scored.groupBy(*keys).agg(F.exp(-_mean_logp()).alias("perplexity"))
    if texts is None:
        return found
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    held = texts.select(*keys).alias("t").join(found.alias("p"), same, "left")
    return held.select(*[F.col(f"t.{k}") for k in keys], "perplexity")


def improvement(raw: DataFrame, clean: DataFrame, key: str) -> DataFrame:
    """Raw and clean perplexity side by side, and the gain in percent of raw."""
    left = raw.select(key, F.col("perplexity").alias("raw_ppl"))
    right = clean.select(key, F.col("perplexity").alias("clean_ppl"))
    gain = X.percent(F.col("raw_ppl") - F.col("clean_ppl"), "raw_ppl")
    return left.join(right, key).withColumn("improvement", gain)


def mean_batch_loss(scored: DataFrame, batches: int | None = None) -> DataFrame:
    """Mean of the batch losses over the first ``batches`` batches (all by default,
    and never more than there are); NaN without any batch."""
    per_batch = scored.groupBy("batch_id").agg((-_mean_logp()).alias("loss"))
    if batches is not None:
        per_batch = per_batch.where(F.col("batch_id") < batches)
    return per_batch.agg(F.coalesce(F.avg("loss"), F.lit(float("nan"))).alias("mean_loss"))


def text_log_probs(df: DataFrame, scorer, text: str = "text", keys=("doc_id",)) -> DataFrame:
    """Apply a user's scorer, an Arrow or pandas function from text to an array of
    log-probabilities; one row per predicted token, ready for ``perplexity``. A text
    without predictions has one row of ``n`` 0. The scorer sees null texts too. ``udfs.by_pieces``
    makes one whose memory does not follow the batch."""
    return df.select(
        *keys, F.posexplode_outer(scorer(F.col(text))).alias("pos", "logp")
    ).withColumn("n", F.col("pos").isNotNull().cast("int"))
