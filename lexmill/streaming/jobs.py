"""The same operators over files as they arrive.

Every job is a Structured Streaming query over a folder of Parquet files with a
checkpoint, so it resumes where it stopped. ``available_now`` jobs end when all files
present have been processed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import cleaning, stats, tokens
from lexmill.operators.examples import windows_padded
from lexmill.session import scratch_path
from lexmill.sources.readers import spread

# Schemas of the input tables (a file stream needs one).
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_stream(spark: SparkSession, path: str, schema: str, pattern: str = "*.parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append the stream to a Parquet table until the input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_spread(stream: DataFrame, step: Callable[[DataFrame], DataFrame], path: str,
               checkpoint: str) -> DataFrame:
    """As ``run_to_table`` for a stateless ``step``, with the rows of every micro-batch over all
    cores first: one large file is one task otherwise. A replayed batch overwrites its own
    folder, so the table holds every batch once."""
    spark = stream.sparkSession

    def append(batch: DataFrame, batch_id: int) -> None:
        step(spread(batch)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(append)
        .start()
    )
    query.awaitTermination()
    schema = step(spark.createDataFrame([], stream.schema)).schema
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)  # without any batch
    return spark.read.schema(schema).parquet(path).select(schema.names)


COMMITTED = "batch_id bigint, slot int"


def committed(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Number and slot of the last snapshot that was written completely."""
    last = spark.read.schema(COMMITTED).parquet(f"{path}/committed").agg(F.max("batch_id").alias("n")).first().n
    return None if last is None else (last, last % 2)


def read_state(spark: SparkSession, path: str, schema) -> DataFrame:
    """The running aggregate as of the last complete micro-batch; no rows before the first."""
    last = committed(spark, path)
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/slot={last[1]}")


def run_state(aggregated: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Keep the running aggregate until the input is used up, and return it.

    Each batch overwrites one of two snapshot folders, the one that does not hold the batch
    before; a row in a small table then says that it is complete. What is returned comes from
    that table alone, so a restart without new input finds the same rows. A batch
    that is replayed after its snapshot was completed leaves it as it is.
    """
    spark = aggregated.sparkSession
    spark.createDataFrame([], COMMITTED).write.mode("ignore").parquet(f"{path}/committed")

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        last = committed(spark, path)
        if last is not None and last[0] >= batch_id:
            return
        slot = batch_id % 2
        batch.write.mode("overwrite").parquet(f"{path}/slot={slot}")
        done = spark.createDataFrame([(batch_id, slot)], COMMITTED).coalesce(1)
        done.write.mode("append").parquet(f"{path}/committed")

    query = (
        aggregated.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(snapshot)
        .start()
    )
    query.awaitTermination()
    return read_state(spark, path, aggregated.schema)


def stream_token_stats(stream: DataFrame, *keys: str, count: str = "token_count") -> DataFrame:
    """Running rows, tokens, minimum, maximum and mean."""
    return stats.token_stats(stream, *keys, count=count)


def stream_clean_tokenize(stream: DataFrame, ranks: dict[bytes, int], key: str = "doc_id",
                          text: str = "text") -> DataFrame:
    """Clean and tokenise; stateless, so every micro-batch is independent."""
    cleaned = cleaning.clean_pdf(stream, text, "clean")
    return tokens.tokenize_corpus(cleaned, ranks, (key,), "clean")


def stream_windows(stream: DataFrame, length: int, key: str = "doc_id",
                   tokens_column: str = "tokens") -> DataFrame:
    return windows_padded(stream, length, (key,), tokens_column)


def stream_progress(stream: DataFrame, path: str, checkpoint: str, file: str = "src_file",
                    count: str = "token_count") -> DataFrame:
    """Rows and tokens per micro-batch and file. A replayed batch overwrites its own
    folder, so the log holds every batch once."""
    spark = stream.sparkSession

    def log(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(file).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(count).alias("n_tokens")
        )
        counted.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(log)
        .start()
    )
    query.awaitTermination()
    schema = f"{file} string, n_rows bigint, n_tokens bigint, batch_id bigint"
    return spark.read.schema(schema).parquet(path)


def fresh_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """Output and checkpoint paths of one run."""
    root = scratch_path(spark, name)
    return f"{root}/table", f"{root}/checkpoint"
