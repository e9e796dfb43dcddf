"""Byte-pair tokens of a corpus."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import patterns as P
from lexmill.functions import udfs
from lexmill.operators.stats import resolve_text_column

MAX_RANKS = 1_000_000
MAX_FAR = 4096  # ids beyond twice the number of tokens


def byte_ranks() -> dict[bytes, int]:
    """The smallest rank table: every byte is its own token."""
    return {bytes([b]): b for b in range(256)}


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Read a rank file (base64 token, blank, rank per line) of checked size. A token or a
    rank that is listed twice is an error."""
    fields = F.split("value", " ")
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    rows = lines.select(
        F.unbase64(fields[0]).alias("token"), fields[1].cast("int").alias("rank")
    ).limit(MAX_RANKS + 1)
    ranks: dict[bytes, int] = {}
    for lines_read, row in enumerate(rows.toLocalIterator(), 1):
        if lines_read > MAX_RANKS:
            raise ValueError(f"rank table has more than {MAX_RANKS} entries")
        if bytes(row.token) in ranks:
            raise ValueError(f"rank table lists a token twice: {bytes(row.token)!r}")
        ranks[bytes(row.token)] = row.rank
    if len(set(ranks.values())) < len(ranks):
        raise ValueError("rank table gives a rank twice")
    return ranks


def _tokenizer(ranks: dict[bytes, int], specials: dict[str, int], policy: str):
    import tiktoken

    encoding = tiktoken.Encoding(
        name="ranks", pat_str=P.BPE_SPLIT, mergeable_ranks=ranks, special_tokens=specials
    )
    options = {
        "text": {"disallowed_special": ()},
        "allow": {"allowed_special": "all"},
        "error": {},
    }[policy]
    return lambda text: encoding.encode_to_numpy(text, **options)


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    """Token arrays (None for null) as one Arrow list column."""
    sizes = [0 if a is None else len(a) for a in arrays]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    present = [a for a in arrays if a is not None]
    flat = np.concatenate(present).astype(np.int32) if present else np.array([], np.int32)
    nulls = pa.array([a is None for a in arrays], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=nulls)


def _encoder(spark: SparkSession, ranks, specials, policy: str, report: bool):
    if policy not in ("text", "allow", "error"):
        raise ValueError(f"unknown special-token policy: {policy}")
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"rank table has more than {MAX_RANKS} entries")
    shared = spark.sparkContext.broadcast((dict(ranks), dict(specials)))

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _tokenizer(*shared.value, policy)  # once per task, not per batch
        for texts in (piece for batch in batches for piece in udfs.pieces(batch)):
            tokens, errors = [], []
            for text in texts.to_pylist():
                try:
                    tokens.append(None if text is None else encode(text))
                    errors.append(None)
                except ValueError as failure:
                    if not report:
                        raise
                    tokens.append(None)
                    errors.append(type(failure).__name__)
            lists = _lists(tokens)
            if report:
                columns = [lists, pa.array(errors, pa.string())]
                yield pa.StructArray.from_arrays(columns, ["tokens", "error"])
            else:
                yield lists

    kind = "tokens array<int>, error string" if report else "array<int>"
    return F.arrow_udf(encode_batches, kind)


def encode(
    df: DataFrame,
    ranks: dict[bytes, int],
    text: str = "text",
    output: str = "tokens",
    policy: str = "text",
    specials: dict[str, int] | None = None,
) -> DataFrame:
    """Add the token ids of ``text``. Special tokens inside the text are encoded as
    plain text (``policy="text"``), as one id (``"allow"``), or fail (``"error"``)."""
    specials = specials or {}
    udf = _encoder(df.sparkSession, ranks, specials, policy, report=False)
    return df.withColumn(output, udf(F.col(text)))


def encode_reported(
    df: DataFrame,
    ranks: dict[bytes, int],
    text: str = "text",
    policy: str = "error",
    specials: dict[str, int] | None = None,
) -> DataFrame:
    """Like ``encode``, but a text that fails gets null ``tokens`` and its ``error``
    while the job goes on."""
    specials = specials or {}
    udf = _encoder(df.sparkSession, ranks, specials, policy, report=True)
    return df.withColumn("_r", udf(F.col(text))).select("*", "_r.tokens", "_r.error").drop("_r")


def file_report(df: DataFrame, file: str) -> DataFrame:
    """Per file: texts, failed texts, and whether the whole file went through."""
    failed = F.count_if(F.col("error").isNotNull())
    return df.groupBy(file).agg(
        F.count(F.lit(1)).alias("n_texts"),
        failed.alias("n_failed"),
        (failed == 0).alias("ok"),
    )


def success_summary(files: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """Files that went through, all files, and time per file (null without files)."""
    total = F.count(F.lit(1))
    mean = F.when(total > 0, F.lit(elapsed_seconds).cast("double") / total)
    return files.agg(
        F.count_if("ok").alias("n_ok"),
        total.alias("n_files"),
        mean.alias("seconds_per_file"),
    )


def decode(
    df: DataFrame,
    ranks: dict[bytes, int],
    tokens: str = "tokens",
    output: str = "text",
    specials: dict[str, int] | None = None,
) -> DataFrame:
    """Add the text of the token ids, inside the JVM and without a shuffle.

    Ids below twice the table's size index an array of byte strings; the few beyond, such as
    special tokens with far-off ids, are told apart one by one. So the size of both follows
    the number of tokens, whatever the largest id."""
    by_id = {i: b.hex() for b, i in ranks.items()}
    by_id.update({i: t.encode().hex() for t, i in (specials or {}).items()})
    if len(by_id) > MAX_RANKS:
        raise ValueError(f"rank table has more than {MAX_RANKS} entries")
    if min(by_id, default=0) < 0:
        raise ValueError("rank table has a negative id")
    dense = min(2 * len(by_id), max(by_id, default=-1) + 1)
    far = {i: h for i, h in by_id.items() if i >= dense}
    if len(far) > MAX_FAR:
        raise ValueError(f"rank table has more than {MAX_FAR} ids beyond twice its size")
    table = [by_id.get(i) for i in range(dense)]
    pieces = F.from_json(F.lit(json.dumps(table)), "array<string>")  # folded to a constant

    def piece(i: Column) -> Column:
        near = F.get(pieces, i)
        if not far:
            return near
        known = F.create_map(*[F.lit(x) for pair in far.items() for x in pair])
        return F.when(i < dense, near).otherwise(F.try_element_at(known, i))

    hexes = F.transform(tokens, piece)
    known = ~F.exists(hexes, lambda h: h.isNull())
    raw = F.unhex(F.array_join(hexes, ""))
    text = F.make_valid_utf8(raw.cast("string"))
    failed = F.raise_error(F.lit("unknown token id")).cast("string")
    resolved = F.when(known, text).when(F.col(tokens).isNotNull(), failed)
    return df.withColumn(output, resolved)


def token_count(tokens="tokens") -> Column:
    column = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.when(column.isNotNull(), F.size(column)).cast("int")


def tokenize_corpus(
    df: DataFrame,
    ranks: dict[bytes, int],
    keep: tuple[str, ...] = ("doc_id",),
    text: str | None = None,
    policy: str = "text",
    specials: dict[str, int] | None = None,
) -> DataFrame:
    """The whole tokenising job: find the text column, encode, count."""
    text = text or resolve_text_column(df.columns)
    encoded = encode(df.select(*keep, text), ranks, text, "tokens", policy, specials)
    return encoded.select(*keep, "tokens").withColumn("token_count", token_count())


def annotate(
    df: DataFrame,
    tokens: str = "token_ids",
    vocab_size: int = P.GPT2_VOCAB_SIZE,
    tokenizer: str = P.GPT2_NAME,
) -> DataFrame:
    return (
        df.withColumn("sequence_length", token_count(tokens))
        .withColumn("vocab_size", F.lit(vocab_size))
        .withColumn("tokenizer", F.lit(tokenizer))
    )


def token_summary(df: DataFrame, key: str, source: str = "source") -> DataFrame:
    """Sequences per source and in total; length, vocabulary and tokeniser of the
    source's first sequence."""
    first = F.min_by(F.struct("sequence_length", "vocab_size", "tokenizer"), key)
    per_source = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"), first.alias("f"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return per_source.select(
        source,
        F.col("n").alias("n_sequences"),
        total.alias("total_sequences"),
        "f.sequence_length",
        "f.vocab_size",
        "f.tokenizer",
    )
