"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 256
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table given as one Parquet file or as a folder of them."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of characters outside x20 and x09-x0D, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def number_id(name: str = "doc_id"):
    """An id to compare by: null counts as the largest."""
    return F.coalesce(F.col(name).cast("long"), F.lit((1 << 63) - 1))


LOG_ID_BITS = 24


def with_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Adds ``_d`` (id to compare by), ``_t`` (text) and ``_x``, ``_h``, which ``rows_of`` needs."""
    return docs.withColumns({
        "_d": number_id(key), "_t": F.col(text), "_x": F.xxhash64(number_id(key)), "_h": F.xxhash64(F.col(text)),
    })


def repeated_ids(docs: DataFrame, key: str) -> Bits:
    """Which ids, null among them, may belong to several rows."""
    counted = docs.groupBy(F.xxhash64(number_id(key)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return bitmap(counted.where("n > 1"), "k", LOG_ID_BITS)


def rows_of(batch: pa.RecordBatch, repeated: Bits) -> list[int]:
    """What tells the rows of an id apart: the digest of the text where the id may be
    repeated, else 0. Rows of one id and one text are alike."""
    again = repeated.has(batch.column("_x").to_numpy().view(np.uint64))
    return np.where(again, batch.column("_h").to_numpy(), 0).tolist()


def remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


_HELD: dict[object, object] = {}


def held(kind: object, make: Callable[[], object]):
    """The worker's store of a kind. Workers are reused by later stages, so a worker keeps the
    store of one kind only."""
    if kind not in _HELD:
        release()
        _HELD[kind] = make()
    return _HELD[kind]


def release() -> None:
    """Drop what earlier stages left in this worker."""
    _HELD.clear()
    trim()


def trim() -> None:
    """Give what this worker has freed back to the system, which counts it as used otherwise."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if give:
        give(0)


def trimmed(function):
    """A function of batches after which the worker, which may wait or serve other stages, is trimmed."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        trim()

    return apply


class Bits:
    """A bitmap of fixed size held by every worker: tells keys that surely are not in a
    set. ``2 ** log_bits`` bits, whatever the set's size; a full one filters nothing."""

    def __init__(self, data: np.ndarray, log_bits: int):
        self.data, self.shift = data, np.uint64(64 - log_bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys.astype(np.uint64, copy=False) >> self.shift
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


CHUNK_BITS = 32768  # of Spark's bitmap functions
BITMAP_PARTS = 4


def bitmap(keys: DataFrame, column: str, log_bits: int) -> Bits:
    """The bitmap of a column of 64-bit hashes, from their top bits. It is built by
    Spark in chunks; the driver gets ``2 ** log_bits / 8`` bytes at most, a part at a time."""
    at = F.shiftrightunsigned(F.col(column), 64 - log_bits) + 1
    chunks = keys.groupBy(F.bitmap_bucket_number(at).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b")
    )
    size = max(CHUNK_BITS // 8, (1 << log_bits) // 8)
    data = np.zeros(size, np.uint8)
    for row in chunks.coalesce(BITMAP_PARTS).toLocalIterator():  # a job for each part
        start = (row.n - 1) * (CHUNK_BITS // 8)
        data[start : start + CHUNK_BITS // 8] = np.frombuffer(bytes(row.b), np.uint8)
    return Bits(data, log_bits)
