"""Reports made of several operators."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import cleaning, examples, profile, scoring, stats, tokens, vocab
from lexmill.session import written


def prepare_sources(
    pages: DataFrame, page_texts: DataFrame, ranks: dict[bytes, int],
    page_key: str = "page_id", doc_key: str = "conv_id", order: str = "turn",
) -> DataFrame:
    """Web pages and paged documents, cleaned and tokenised, in one table."""
    web = cleaning.clean_web(pages, "html", "clean").select(
        F.lit("web").alias("source"), F.col(page_key).alias("id"), "clean"
    )
    joined = vocab.concat_pages(page_texts, doc_key, order)
    pdf = cleaning.clean_pdf(joined, "text", "clean").select(
        F.lit("pdf").alias("source"), F.col(doc_key).alias("id"), "clean"
    )
    encoded = tokens.encode(web.unionByName(pdf), ranks, "clean", "token_ids")
    return tokens.annotate(encoded.drop("clean"))


def prep_summary(prepared: DataFrame) -> DataFrame:
    """Sequences per source and in total, with the first sequence of each source."""
    return tokens.token_summary(prepared, "id")


def pattern_report(both: DataFrame, group: str, order: str, k: int = 10) -> DataFrame:
    """Profile of raw and clean texts per group, in long form.

    ``both`` has the columns (group, stage, text, order). Rows: every metric, the most common
    words and the most common special characters of each stage; and, as stage ``change``, what
    cleaning changed of every metric, where a group has both stages.

    Words are split and counted once, for metrics and for ranking.
    """
    keys = [group, "stage"]
    words = written(profile.word_occurrences(both, keys, "text", order), "word-counts")
    unit = F.struct(*keys).alias("_unit")
    metrics = profile.metrics_by_group(
        both.withColumn("_unit", unit), "_unit", counted=words.select(unit, "item", "cnt")
    ).select("_unit.*", *profile.METRICS)
    metrics = written(metrics, "metrics")  # a row per group, read three times
    raw, clean = (metrics.where(F.col("stage") == s).alias(s) for s in ("raw", "clean"))
    same = F.col(f"raw.{group}").eqNullSafe(F.col(f"clean.{group}"))
    change = raw.join(clean, same).select(
        F.col(f"raw.{group}").alias(group), F.lit("change").alias("stage"),
        *[(F.col(f"clean.{m}") - F.col(f"raw.{m}")).alias(m) for m in profile.METRICS],
    )
    long = F.array(
        *[
            F.struct(F.lit(m).alias("item"), F.col(m).cast("double").alias("value"))
            for m in profile.METRICS
        ]
    )
    measured = metrics.unionByName(change).select(
        *keys, F.lit("metric").alias("kind"), F.lit(0).alias("rank"), F.inline(long)
    )

    def top(counted: DataFrame, kind: str) -> DataFrame:
        return profile.top_k(counted, keys, k).select(
            *keys, F.lit(kind).alias("kind"), "rank", "item",
            F.col("cnt").cast("double").alias("value"),
        )

    marks = top(profile.special_char_occurrences(both, keys, "text", order), "char")
    return measured.unionByName(top(words, "word")).unionByName(marks)


def sample_documents(
    df: DataFrame, order: str, file: str = "file", n: int = 5, seed: int = 42, length: int = 200,
    columns: tuple[str, ...] = ("url", "language", "language_score", "token_count"), text: str = "text",
) -> DataFrame:
    """The first ``n`` documents of a file picked by seed: (``item``, ``measure``, ``note``), with those of
    ``columns`` that the table has and the beginning of the text."""
    picked = stats.seeded_sample(df, file, 1, seed).agg(F.min(file)).scalar()
    rows = stats.first_rows(df.where(F.col(file).eqNullSafe(picked)), order, n=n)
    place = F.row_number().over(Window.orderBy(order))  # of n rows
    notes = [(c, F.col(c).cast("string")) for c in (file, *columns) if c in df.columns]
    notes.append(("preview", X.preview(text, length)))
    entries = F.array(*[F.struct(F.lit(name).alias("measure"), c.alias("note")) for name, c in notes])
    return rows.withColumn("item", place.cast("string")).select("item", F.inline(entries))


def corpus_report(
    df: DataFrame, language: str = "language", file: str = "file", order: str | None = None,
) -> DataFrame:
    """Statistics per file and in total, language shares and both histograms, and with
    ``order`` some sample documents, as ``(section, item, measure, value, note)``; samples have notes
    instead of values."""
    def section(frame: DataFrame, name: str, item, **values) -> DataFrame:
        entries = F.array(
            *[
                F.struct(F.lit(n).alias("measure"), F.col(c).cast("double").alias("value"))
                for n, c in values.items()
            ]
        )
        return frame.select(
            F.lit(name).alias("section"), item.cast("string").alias("item"), F.inline(entries)
        )

    stat_names = {
        "rows": "n_rows", "tokens": "total_tokens", "min": "min_tokens",
        "max": "max_tokens", "mean": "mean_tokens",
    }
    per_file = stats.token_stats_with_total(df, file)
    label = F.when(F.col("is_total") == 1, F.lit("(all)")).otherwise(F.col(file))
    parts = [section(per_file, "tokens", label, **stat_names)]
    if language in df.columns:
        shares = stats.category_shares(df, language)
        parts.append(section(shares, "language", F.col(language), count="cnt", percent="pct"))
    for name, bounds in (("histogram", None), ("histogram_zoom", (0, 2000))):
        bins = stats.length_histogram(df, bounds=bounds)
        parts.append(section(bins, name, F.col("bin"), count="cnt"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    report = report.withColumn("note", F.lit(None).cast("string"))
    if order is not None:
        samples = sample_documents(df, order, file).withColumns(
            {"section": F.lit("sample"), "value": F.lit(None).cast("double")}
        )
        report = report.unionByName(samples)
    return report


def training_examples(
    df: DataFrame, length: int, stride: int, batch_size: int, key: str = "doc_id",
    share: float = 0.9, seed: int = 123, max_tokens: int | None = None,
    n: Column | None = None,
) -> DataFrame:
    """Windows, split exactly, shuffled within each split and batched.

    Incomplete last batches are dropped from the training part only. Split and order
    are decided on (key, start) pairs; the windows themselves move once.
    """
    starts = examples.window_starts(df, length, stride, "clipped", (key,), n, max_tokens)
    split = partial(
        examples.split_exact, share=share, seed=seed, candidates=starts
    )
    cut = examples.windows_clipped(df, length, stride, max_tokens, (key,))
    return examples.batch_shuffled(
        split(cut, key, "start"), key, "start", batch_size=batch_size, seed=seed + 1,
        drop_last=F.col("split") == "train", by=("split",),
        candidates=split(starts, key, "start"),
    )


def perplexity_report(
    both: DataFrame, group: str, text: str = "text", max_length: int | None = None
) -> DataFrame:
    """Raw and clean perplexity and the improvement per group.

    ``both`` has (group, stage, text); the model is learnt from the raw texts. Groups are few;
    their counts stand beside the model's, so no text is read twice.
    """
    keys = [group, "stage"]
    counts = scoring.pair_counts(both, text, max_length, F.col("stage") == "raw", keys)
    scored = scoring.perplexity(scoring.score_groups(scoring.bigram_model(counts), keys), keys)
    scored = written(scored, "perplexity")  # a row per group; both sides of the join read it
    raw, clean = (
        scored.where(F.col("stage") == name).select(group, "perplexity")
        for name in ("raw", "clean")
    )
    return scoring.improvement(raw, clean, group)
