"""Training examples: windows over token arrays, splits, shuffles, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import arrays as A
from lexmill.operators.indexing import hash_cutoff, hash_index, order_key, running_before

STEP_BUCKET = 100_000


def filter_min_tokens(df: DataFrame, length: int, tokens: str = "tokens") -> DataFrame:
    return df.where(F.size(tokens) >= length)


def window_count(
    n: Column, length: int, stride: int, policy: str = "strict", max_tokens: int | None = None
) -> Column:
    """Number of windows of a text with ``n`` tokens, without making them."""
    if policy == "strict":
        return F.when(n > length, F.ceil((n - length) / stride)).otherwise(0).cast("long")
    if max_tokens is not None:
        n = F.least(n, F.lit(max_tokens))
    count = F.floor((n - length) / stride) + 1
    return F.when(n >= length, count).otherwise(0).cast("long")


def window_starts(
    df: DataFrame, length: int, stride: int, policy: str = "strict",
    keep: tuple[str, ...] = ("doc_id",), n: Column | None = None, max_tokens: int | None = None,
) -> DataFrame:
    """Only where the windows start; from token counts alone if ``n`` gives them."""
    n = F.size("tokens") if n is None else n
    count = window_count(n, length, stride, policy, max_tokens)
    places = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1))
    starts = df.select(*keep, F.explode(places).alias("start"))
    return starts.withColumn("start", (F.col("start") * stride).cast("int"))


def _cut(df: DataFrame, keep, length: int, stride: int, policy: str, tokens: str) -> DataFrame:
    """Slices are taken row by row behind the explode, in the same generated code: the
    windows of a long text never exist at the same time."""
    n = F.size(tokens)
    starts = window_starts(df, length, stride, policy, (*keep, tokens), n)
    begin = F.col("start")
    return starts.select(
        *keep,
        "start",
        F.slice(tokens, begin + 1, F.lit(length)).alias("x"),
        F.slice(tokens, begin + 2, F.lit(length)).alias("y"),
    )


def windows_strict(
    df: DataFrame, length: int, stride: int, keep: tuple[str, ...] = ("doc_id",),
    tokens: str = "tokens",
) -> DataFrame:
    """Input windows with always complete targets; texts of up to ``length`` tokens
    give none."""
    return _cut(df, keep, length, stride, "strict", tokens)


def windows_clipped(
    df: DataFrame, length: int, stride: int, max_tokens: int | None = None,
    keep: tuple[str, ...] = ("doc_id",), tokens: str = "tokens", drop_short: bool = False,
) -> DataFrame:
    """Windows over the first ``max_tokens`` tokens (all by default). The last target
    may lack its final token: ``target_short``; ``drop_short`` leaves those out."""
    if max_tokens is not None:
        df = df.withColumn(tokens, A.clip(tokens, max_tokens))
    cut = _cut(df, keep, length, stride, "clipped", tokens)
    cut = cut.withColumn("target_short", F.size("y") < length)
    return cut.where(~F.col("target_short")) if drop_short else cut


def windows_padded(
    df: DataFrame, length: int, keep: tuple[str, ...] = ("doc_id",), tokens: str = "tokens"
) -> DataFrame:
    """One example per text: first ``length`` tokens or zero-padded; the target is the
    input moved left. ``n_valid`` tells padding from the real token 0."""
    valid = F.least(F.size(tokens), F.lit(length))
    return df.select(
        *keep, A.pad_right(tokens, length).alias("x"), valid.alias("n_valid")
    ).withColumn("y", A.roll_left("x"))


def context_pairs(
    df: DataFrame, k: int, keep: tuple[str, ...] = ("doc_id",), tokens: str = "tokens"
) -> DataFrame:
    """Growing contexts of 1..k tokens, each with the token that follows."""
    last = F.least(F.lit(k), F.size(tokens) - 1)
    lengths = F.when(last >= 1, F.sequence(F.lit(1), last))
    spread = df.select(*keep, tokens, F.explode(lengths).alias("n"))
    return spread.select(
        *keep,
        "n",
        F.slice(tokens, F.lit(1), F.col("n")).alias("context"),
        F.element_at(tokens, F.col("n") + 1).alias("target"),
    )


# -- counting ----------------------------------------------------------------


def exact_examples(
    df: DataFrame, length: int, stride: int, n: Column | None = None
) -> DataFrame:
    """Exact number of windows under both policies."""
    n = F.size("tokens") if n is None else n
    return df.agg(
        F.sum(window_count(n, length, stride)).alias("strict"),
        F.sum(window_count(n, length, stride, "clipped")).alias("clipped"),
    )


def estimate_examples(
    df: DataFrame, length: int, stride: int, order: str, file: str | None = None,
    chunk: int = 50, max_tokens: int = 2000, n: Column | None = None,
) -> DataFrame:
    """Extrapolated window count: windows of the first chunk of the first file, times
    the chunks of that file, times the files; ``max_tokens`` of a text count for it. Next
    to it the exact count, of whole texts."""
    n = F.size("tokens") if n is None else n
    name = F.lit("") if file is None else F.col(file)
    sized = df.select(name.alias("f"), F.col(order).alias("o"),
                      window_count(n, length, stride, "clipped", max_tokens).alias("w"),
                      window_count(n, length, stride, "clipped").alias("whole"))
    per_file = sized.groupBy("f").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("whole").alias("whole")
    )
    overall = per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("whole").alias("exact"),
        F.min_by("n_rows", "f").alias("first_rows"),
        F.min("f").alias("first_file"),
    )
    first_file = per_file.agg(F.min("f")).scalar()
    sample = (
        sized.where(F.col("f") == first_file).orderBy("o").limit(chunk)
        .agg(F.coalesce(F.sum("w"), F.lit(0)))
    )
    chunks = F.ceil(F.col("first_rows") / chunk)
    return overall.select(
        (sample.scalar() * chunks * F.col("files")).cast("long").alias("estimated"),
        F.col("exact"),
    )


# -- order, split, batch -----------------------------------------------------


def shuffle(df: DataFrame, *keys: str, seed: int) -> DataFrame:
    """A reproducible random order, independent of the partitioning."""
    return df.withColumn("_key", order_key(*keys, seed=seed)).orderBy("_key").drop("_key")


def split_exact(
    df: DataFrame, *keys: str, share: float = 0.9, seed: int = 123, output: str = "split",
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Random split with exact sizes ``int(share * n)`` and the rest.

    The digest at the cut position is found first, from the keys alone (given by
    ``candidates`` if they can be had more cheaply); then every row is assigned by
    comparing its own digest, where it lies, without a shuffle.
    """
    key = order_key(*keys, seed=seed)
    keyed = (df if candidates is None else candidates).select(key.alias("_key"))
    cutoff = hash_cutoff(keyed, "_key", share).agg(F.min("cutoff")).scalar()
    train = cutoff.isNull() | (key < cutoff)
    return df.withColumn(output, F.when(train, F.lit("train")).otherwise(F.lit("val")))


def split_fast(
    df: DataFrame, *keys: str, tenths: int = 9, seed: int = 123, output: str = "split"
) -> DataFrame:
    """Random split by hash in one pass; sizes are right on average only."""
    digits = F.conv(F.substring(order_key(*keys, seed=seed), 1, 8), 16, 10).cast("bigint")
    draw = digits % 10
    return df.withColumn(
        output, F.when(draw < tenths, F.lit("train")).otherwise(F.lit("val"))
    )


def split_prefix(
    df: DataFrame, text: str = "text", share: float = 0.9, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The first share of each text's characters and the remainder."""
    k = F.floor(F.length(text) * F.lit(float(share))).cast("int")
    return df.select(
        *keep,
        F.substr(F.col(text), F.lit(1), k).alias("train"),
        F.substr(F.col(text), k + 1).alias("val"),
    )


def epochs(df: DataFrame, *keys: str, n_epochs: int, seed: int = 123) -> DataFrame:
    """Every example once per epoch, with that epoch's shuffle key."""
    visits = F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1)))
    expanded = df.withColumn("epoch", visits)
    return expanded.withColumn("order_key", order_key("epoch", *keys, seed=seed))


def windows_in_order(
    df: DataFrame, length: int, stride: int, key: str = "doc_id", tokens: str = "tokens",
    n: Column | None = None,
) -> DataFrame:
    """Strict windows with their position ``idx`` in (key, start) order. Positions
    come from window counts per text, so only (key, count) pairs are sorted. ``n`` tells a
    text's number of tokens where the table has it, and spares reading the tokens for it."""
    counts = df.select(key, window_count(F.size(tokens) if n is None else n, length, stride).alias("_c"))
    firsts = running_before(counts.where("_c > 0"), "_c", key, output="_first").select(key, "_first")
    cut = windows_strict(df.join(firsts, key), length, stride, (key, "_first"), tokens)
    place = (F.col("start") / stride).cast("long")
    return cut.withColumn("idx", F.col("_first") + place).drop("_first")


def batch_ids(
    df: DataFrame, batch_size: int, total: Column, drop_last: bool | Column = False
) -> DataFrame:
    """Batches of consecutive positions ``idx``; the incomplete last one may go."""
    batched = df.withColumn("batch_id", F.floor(F.col("idx") / batch_size))
    if drop_last is False:
        return batched
    whole = F.col("batch_id") < F.floor(total / batch_size)
    return batched.where(whole if drop_last is True else whole | ~drop_last)


def batch_windows(
    df: DataFrame, length: int, stride: int, batch_size: int, drop_last: bool = False,
    key: str = "doc_id", tokens: str = "tokens", n: Column | None = None,
) -> DataFrame:
    """Windows in order, in batches."""
    total = df.agg(F.sum(window_count(F.size(tokens) if n is None else n, length, stride))).scalar()
    indexed = windows_in_order(df, length, stride, key, tokens, n)
    return batch_ids(indexed, batch_size, total, drop_last)


def batch_shuffled(
    df: DataFrame, *keys: str, batch_size: int, seed: int = 123,
    drop_last: bool | Column = False, by: tuple[str, ...] = (),
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Examples in a reproducible random order, in batches, within each ``by``."""
    key = order_key(*keys, seed=seed)
    if candidates is not None:
        candidates = candidates.withColumn("_key", key)
    indexed = hash_index(df.withColumn("_key", key), "_key", by=by, candidates=candidates)
    batched = batch_ids(indexed, batch_size, F.col("n_total"), drop_last)
    return batched.drop("_key", "n_total")


def batch_matrix(df: DataFrame, x: str = "x") -> DataFrame:
    """One row per batch: its equal-length inputs stacked in order. A group holds one
    batch, so its size is fixed by the batch size."""
    placed = F.array_sort(F.collect_list(F.struct("idx", x)))
    return df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), placed.getField(x).alias("matrix")
    )


def step_sizes(batched: DataFrame, x: str = "x") -> DataFrame:
    """Input tokens per step (batch)."""
    return batched.groupBy(F.col("batch_id").alias("step")).agg(
        F.sum(F.size(x)).alias("n_tokens")
    )


def window_steps(
    df: DataFrame, length: int, stride: int, batch_size: int, n: Column | None = None,
    policy: str = "strict", drop_last: bool = False,
) -> DataFrame:
    """Input tokens per step of an epoch, from the texts' sizes ``n`` alone: no window is cut.
    Every window has ``length`` input tokens, so only the last batch differs."""
    count = window_count(F.size("tokens") if n is None else n, length, stride, policy)
    windows = df.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).first().n
    steps = windows // batch_size if drop_last else -(-windows // batch_size)
    step = F.col("id")
    held = F.least(F.lit(batch_size).cast("long"), F.lit(windows) - step * batch_size)
    return df.sparkSession.range(steps).select(step.alias("step"), (held * length).alias("n_tokens"))


def tokens_seen(
    steps: DataFrame, eval_freq: int, step_bucket: int = STEP_BUCKET, n_epochs: int | None = None
) -> DataFrame:
    """Running total of tokens, kept where ``step`` is a multiple of ``eval_freq``. With ``n_epochs``
    the steps are counted on over so many epochs, and ``epoch`` (from 0) tells which.

    Steps of an epoch are dense, so fixed step ranges bound every window partition; range
    totals are summed in a table with one row per range. Every epoch has the same steps, so its
    totals are the first epoch's, moved on by whole epochs.
    """
    ranged = steps.withColumn("_range", F.floor(F.col("step") / step_bucket))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("n_tokens").alias("_n"))
    offsets = totals.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    here = (
        Window.partitionBy("_range")
        .orderBy("step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    epoch = steps.agg(F.count(F.lit(1)).alias("steps"), F.sum("n_tokens").alias("tokens"))
    whole = epoch.select(F.struct("steps", "tokens")).scalar()
    visits = F.explode(F.sequence(F.lit(0), F.lit((n_epochs or 1) - 1)))
    first = ranged.withColumn("_here", F.sum("n_tokens").over(here)).join(offsets, "_range")
    total = (
        first.withColumn("epoch", visits)
        .select(
            "epoch", (F.col("epoch") * whole["steps"] + F.col("step")).alias("step"),
            (F.col("epoch") * whole["tokens"] + F.col("_before") + F.col("_here")).alias("tokens_seen"),
        )
        .where(F.col("step") % eval_freq == 0)
    )
    return total.drop("epoch") if n_epochs is None else total
