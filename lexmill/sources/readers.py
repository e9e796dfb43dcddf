"""Sources: Parquet corpora, text files, SQL, tables, archives."""

from __future__ import annotations

import io
import lzma
import tarfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType,
    StringType, StructType,
)

from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators.stats import seeded_sample

ARCHIVE_BATCH_CHARS = 16 << 20
_ARROW = {
    BinaryType: pa.binary(), BooleanType: pa.bool_(), ByteType: pa.int8(), DoubleType: pa.float64(),
    FloatType: pa.float32(), IntegerType: pa.int32(), LongType: pa.int64(), ShortType: pa.int16(),
    StringType: pa.string(),
}
PLAIN = tuple(_ARROW)


def read_corpus(spark: SparkSession, path: str, columns: list[str] | None = None,
                pattern: str = "*.parquet") -> DataFrame:
    """Every Parquet file of a folder as one table; only ``columns`` are read."""
    df = spark.read.option("pathGlobFilter", pattern).parquet(path)
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer splits than the cluster has cores,
    as with one small file; a table of many splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_file_name(df: DataFrame, output: str = "src_file") -> DataFrame:
    return df.withColumn(output, F.col("_metadata.file_name"))


def in_batches(df: DataFrame, fn, schema: str, batch_rows: int | None = None) -> DataFrame:
    """Process a table in record batches: ``fn`` takes and gives a pandas frame.

    ``batch_rows`` bounds the rows a call sees; batches are cut inside each task. Columns that
    Arrow and pandas hand over alike (``PLAIN``) are cut before they become a frame, so that a
    task holds the frames of ``batch_rows`` rows, not of a batch.
    """
    given = StructType.fromDDL(schema)
    if batch_rows and all(isinstance(f.dataType, PLAIN) for f in [*df.schema, *given]):
        types = pa.schema([(f.name, _ARROW[type(f.dataType)]) for f in given])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, batch_rows):
                    frame = fn(batch.slice(start, batch_rows).to_pandas())
                    if len(frame) and not any(isinstance(c, str) for c in frame.columns):
                        frame = frame.set_axis(types.names, axis=1)  # by place, as mapInPandas does
                    if len(frame):
                        yield from pa.Table.from_pandas(frame, types, preserve_index=False, safe=False).to_batches()

        return df.mapInArrow(cut, schema)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size = batch_rows or max(len(frame), 1)
            for start in range(0, len(frame), size):
                yield fn(frame.iloc[start : start + size])

    return df.mapInPandas(apply, schema)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and its whole content."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Names and sizes of files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return files.option("recursiveFileLookup", "true").load(path).select("path", "length")


def with_extension(df: DataFrame, *extensions: str, path: str = "path") -> DataFrame:
    wanted = F.lit(False)
    for extension in extensions:
        wanted = wanted | F.endswith(F.col(path), F.lit(extension))
    return df.where(wanted)


def matching_path(df: DataFrame, glob: str, path: str = "path") -> DataFrame:
    """Paths that match a pattern such as ``sample/10BT/*`` (``*`` crosses folders)."""
    escaped = glob.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
    return df.where(F.col(path).like(escaped.replace("*", "%").replace("?", "_")))


def sample_files(df: DataFrame, k: int, seed: int = 42, path: str = "path") -> DataFrame:
    """``k`` files in a seeded random order; ``k=1`` picks a random file."""
    return seeded_sample(df, path, k, seed)


FETCH_ROWS = 10_000


def jdbc_options(url: str, query: str, column: str | None = None, lower: object = None,
                 upper: object = None, parts: int | None = None, **options) -> dict[str, str]:
    """Options of a JDBC read of a user's query.

    With ``column`` the query is read in ``parts`` ranges of that column at once; it must be a
    number, date or timestamp of the query. The bounds only place the cuts: rows beyond
    them, and nulls, are read as well. Without it one task reads everything.
    """
    made = {"url": url, "fetchsize": str(FETCH_ROWS)}
    if column is None:
        if (lower, upper, parts) != (None, None, None):
            raise ValueError("bounds and parts need a column")
        return made | {"query": query} | options
    if lower is None or upper is None or not parts or parts < 1:
        raise ValueError("a column needs lower, upper and parts")
    # A partition column and the option ``query`` exclude each other.
    return made | {
        "dbtable": f"({query.strip().rstrip(';')}) lexmill_query", "partitionColumn": column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(parts),
    } | options


def bounds_query(query: str, column: str) -> str:
    """The query that finds a column's bounds in the database."""
    return (
        f"SELECT MIN({column}) AS least, MAX({column}) AS most "
        f"FROM ({query.strip().rstrip(';')}) lexmill_query"
    )


def read_sql(spark: SparkSession, query: str, url: str | None = None, column: str | None = None,
             lower: object = None, upper: object = None, parts: int | None = None, text: str | None = None,
             **options) -> DataFrame:
    """One column of a user's query as ``text``: the first, or the one named by ``text``. With ``url``
    the query runs in that database over JDBC, otherwise over the session's tables and views.

    ``column`` splits the JDBC read into ranges (see ``jdbc_options``). Bounds that are not
    given are asked for first; ``parts`` is then the cluster's number of cores.
    """
    if url is None:
        df = spark.sql(query)
    else:
        def load(**opts: str) -> DataFrame:
            return spark.read.format("jdbc").options(**opts).load()

        if column is not None:
            parts = parts or spark.sparkContext.defaultParallelism
            if lower is None or upper is None:
                found = load(**jdbc_options(url, bounds_query(query, column), **options)).first()
                lower, upper = (found[0] if lower is None else lower), (found[1] if upper is None else upper)
            if lower is None or upper is None:  # no rows, or only nulls
                column = lower = upper = parts = None
        df = load(**jdbc_options(url, query, column, lower, upper, parts, **options))
    return df.select(F.col(text or df.columns[0]).alias("text"))


def discover_text_table(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """The ``text`` column of the first table (by name) that has one; an empty frame
    where there is none."""
    tables = spark.catalog.listTables(pattern=pattern)
    for table in sorted(tables, key=lambda t: t.name):
        df = spark.table(table.name)
        if "text" in df.columns:
            return df.select("text")
    return spark.createDataFrame([], "text string")


def fill_missing(expected: DataFrame, found: DataFrame, key: str, text: str = "text",
                 placeholder: str = P.MISSING_TEXT) -> DataFrame:
    """Every expected source; a fixed text stands in for the missing ones."""
    return expected.join(found.select(key, text), key, "left").withColumn(
        text, F.coalesce(F.col(text), F.lit(placeholder))
    )


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for content in frame["content"]:
            paths, texts, held = [], [], 0
            for path, text in _members(content):
                paths.append(path)
                texts.append(text)
                held += len(text)
                if held >= ARCHIVE_BATCH_CHARS:
                    yield pd.DataFrame({"path": paths, "text": texts})
                    paths, texts, held = [], [], 0
            yield pd.DataFrame({"path": paths, "text": texts})


def _members(content: bytes) -> Iterator[tuple[str, str]]:
    with tarfile.open(fileobj=io.BytesIO(content), mode="r|*") as outer:
        for packed in outer:
            if not packed.name.endswith(".xz"):
                continue
            stream = lzma.open(outer.extractfile(packed))
            with tarfile.open(fileobj=stream, mode="r|") as inner:
                for member in inner:
                    if member.isfile() and member.name.endswith(".txt"):
                        text = inner.extractfile(member).read().decode("utf-8")
                        yield f"{packed.name}/{member.name}", text


def expand_archives(files: DataFrame) -> DataFrame:
    """Texts inside archives of archives.

    ``files`` has a binary ``content`` per archive (as ``format("binaryFile")`` gives
    it): a tar of ``.xz`` members, each a tar of ``.txt`` members. Members are
    streamed; runs of newlines are squeezed inside the JVM.
    """
    raw = files.select("content").mapInPandas(_expand, "path string, text string")
    return raw.withColumn("text", X.squeeze_newlines("text"))
