"""Suffix-array deduplication of bytes by a sparse suffix array on synchronizing positions.

Every position is a suffix; wanted are the suffixes whose first 50 bytes begin in an
earlier document too. The array is sparse: a window of 50 bytes is found through its anchor, the
least digest among its 21-byte pieces (the leftmost one of equals). Equal windows have
equal anchors at equal places, so the anchors' places are a sample chosen by content: about two in 31
positions. The windows of one anchor begin at consecutive positions; they are its run,
30 windows at most.

- A whole text that an earlier document has (by 128 bits of digest) is copied as it is, and takes no part in what
  follows: the earlier one has all of its windows.
- Only windows whose anchor occurs in two documents or more can be repeated. Anchors are
  counted over the whole corpus and looked up in a bitmap of fixed size; a full bitmap costs
  sorting, never results.
- Runs of one anchor that hold the same bytes (by 59 bits of digest beside the anchor's and their length) are a class.
  Where an earlier document has the class, the whole run is copied.
- Where an anchor has several classes, as at the ends of passages, the suffixes at the anchors of each
  class's first documents are sorted, and so are the bytes before them, read backwards.
  Lengths of common prefixes of neighbours cut both orders into intervals: a window that begins ``i``
  bytes before its anchor is named by the interval of its ``50 - i`` bytes from there on and that of the ``i``
  bytes before. Windows of one name are equal, byte for byte, and the least document of a name has it first.

Null text is empty. Ids order the documents; a null id is the largest, and rows of the same id are not earlier than
each other. Where an id is repeated, its rows are told apart by a 64-bit digest of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest as digest

from lexmill.llm.common import bitmap, repeated_ids, rows_of, trimmed, with_rows
from lexmill.llm.substrings import _FIRST, _SECOND, LOG_ROW_BITS, _table, least_of, mixed, rolled
from lexmill.session import written

LENGTH = 50
ANCHOR = 21
RUN = LENGTH - ANCHOR + 1  # windows of one anchor, at most
LOG_BITS = 28
LOG_PLACE_BITS = 27
LOW = np.uint64(63)  # bits of a digest that give way to a position
SIZE = np.uint64(31)  # those that give way to a number of windows
TIES = 50_000
SORTED_ROWS = 20_000


def _bytes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(t, np.uint8) for t in batch.column("_t").cast(pa.binary()).to_pylist()]


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every window: its anchor's digest and place."""
    values = rolled(data.astype(np.uint64) + np.uint64(1), ANCHOR, _FIRST) & ~LOW
    at = np.arange(len(values)).astype(np.uint64) & LOW
    one = least_of(values | at, RUN)
    other = least_of(values | (LOW - at), RUN) & LOW
    begin = np.arange(len(one))
    place = begin + (((one & LOW).astype(np.int64) - begin) & 63)
    ties = np.flatnonzero(place != begin + ((63 - other.astype(np.int64) - begin) & 63))
    views = np.lib.stride_tricks.sliding_window_view(values, RUN)
    for start in range(0, len(ties), TIES):
        part = ties[start : start + TIES]
        place[part] = part + views[part].argmin(axis=1)
    return one & ~LOW, place


def _marked(batch: pa.RecordBatch, firsts, wanted: bool = True) -> pa.RecordBatch:
    """Rows whose id and text are marked as the first with this text, or those that are not."""
    return batch.filter(pa.array(firsts.value.has(batch.column("_k").to_numpy().view(np.uint64)) == wanted))


def _anchors(texts: DataFrame, firsts) -> DataFrame:
    """The upper half of the anchors' digests is counted: a bitmap takes fewer bits still."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(np.unique((anchors(d)[0] >> np.uint64(32)).astype(np.uint32)).view(np.int32),)
                    for d in _bytes(_marked(batch, firsts)) if len(d) >= LENGTH]
            yield _table(made, "i", ["key"])

    return texts.select("_t", "_k").mapInArrow(trimmed(find), "key int")


def runs_of(data: np.ndarray, bits) -> tuple[np.ndarray, ...]:
    """Runs whose anchor may be repeated: anchor, its place, first window, number of windows."""
    keys, place = anchors(data)
    at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    n = np.diff(np.r_[at, len(place)])
    keep = bits.has(keys[at])
    at, n = at[keep], n[keep]
    return keys[at], place[at], at, n


def _runs(texts: DataFrame, firsts, bits, repeated) -> DataFrame:
    """Runs whose anchor ``g`` may be repeated; ``r`` is the digest of their bytes, whose lowest bits are
    the number of windows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (_marked(b, firsts) for b in batches):
            made = []
            for doc, row, data in zip(batch.column("_d").to_pylist(), rows_of(batch, repeated.value), _bytes(batch)):
                if len(data) < LENGTH:
                    continue
                keys, _, at, n = runs_of(data, bits.value)
                whole, ends = data.tobytes(), (at + n + LENGTH - 1).tolist()
                held = np.fromiter((digest(whole[a:b]) for a, b in zip(at.tolist(), ends)), np.uint64, len(at))
                held = held & ~SIZE | n.astype(np.uint64)
                made.append((keys.view(np.int64), held.view(np.int64), np.full(len(at), doc), np.full(len(at), row, np.int64), at.astype(np.int32)))
            yield _table(made, "lllli", ["g", "r", "doc", "row", "at"])

    return texts.mapInArrow(trimmed(find), "g long, r long, doc long, row long, at int")


def place_keys(doc: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    doc, row, at = (x.astype(np.int64).view(np.uint64) for x in (doc, row, at))
    return mixed((doc * _FIRST + row) * _SECOND + at)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = place_keys(*(batch.column(c).to_numpy() for c in ("doc", "row", "at")))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["k"])


def _suffixes(texts: DataFrame, firsts, bits, places, repeated) -> DataFrame:
    """The runs at marked places: bytes from the anchor on, and bytes before it, backwards."""
    names = ["g", "doc", "row", "at", "n", "before", "behind"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (_marked(b, firsts) for b in batches):
            made, before, behind = [], [], []
            for doc, row, data in zip(batch.column("_d").to_pylist(), rows_of(batch, repeated.value), _bytes(batch)):
                if len(data) < LENGTH:
                    continue
                keys, place, at, n = runs_of(data, bits.value)
                docs, rows = np.full(len(at), doc), np.full(len(at), row, np.int64)
                keep = places.value.has(place_keys(docs, rows, at))
                keys, place, at, n, docs, rows = (x[keep] for x in (keys, place, at, n, docs, rows))
                whole = data.tobytes()
                for first, p, many in zip(at.tolist(), place.tolist(), n.tolist()):
                    before.append(whole[first:p][::-1])
                    behind.append(whole[p : first + many - 1 + LENGTH])
                made.append((keys.view(np.int64), docs, rows, at.astype(np.int32), n.astype(np.int32)))
            columns = _table(made, "lllii", names[:5]).columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.binary()), pa.array(behind, pa.binary())], names)

    return texts.mapInArrow(trimmed(find), "g long, doc long, row long, at int, n int, before binary, behind binary")


def common_prefixes(strings: list[bytes], new: np.ndarray, width: int) -> np.ndarray:
    """Of each string in a sorted list, the length of the prefix it shares with the one before;
    -1 where a group begins."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    table = np.zeros((len(strings), width + 1), np.uint8)
    table[np.arange(width + 1) < sizes[:, None]] = np.frombuffer(b"".join(strings), np.uint8)
    other = table[1:] != table[:-1]
    other[:, width] = True
    shared = np.minimum(other.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    return np.where(new, -1, np.r_[-1, shared])


def copied_windows(g: np.ndarray, doc: np.ndarray, n: np.ndarray, before: list[bytes], behind: list[bytes]) -> np.ndarray:
    """A bit for each window of a run (the first is the lowest) that an earlier document holds in
    a run of the same anchor. Runs come sorted by anchor and ``behind``."""
    shift = np.fromiter(map(len, before), np.int64, len(before))  # of the first window
    last = shift - n + 1
    new = np.r_[True, g[1:] != g[:-1]]
    after = common_prefixes(behind, new, LENGTH)
    group = np.cumsum(new)
    keys = group.tolist()
    order = np.array(sorted(range(len(before)), key=lambda j: (keys[j], before[j])), np.int64)
    ahead = common_prefixes([before[j] for j in order.tolist()], new, LENGTH)
    mask = np.zeros(len(g), np.int32)
    for i in range(RUN):
        held = np.flatnonzero((last <= i) & (shift >= i))
        name = np.empty(len(g), np.int64)
        name[order] = np.cumsum(ahead < i)
        name = np.cumsum(after < LENGTH - i)[held] * (len(g) + 1) + name[held]
        by = np.lexsort((doc[held], name))
        first = np.r_[True, name[by][1:] != name[by][:-1]][: len(by)]
        least = doc[held][by][first][np.cumsum(first) - 1]
        hit = held[by[doc[held][by] > least]]
        mask[hit] |= (1 << (shift[hit] - i)).astype(np.int32)
    return mask


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of an anchor, many at once."""

    def done(table: pa.Table) -> pa.RecordBatch:
        g, doc, row, at, n = (table[c].to_numpy() for c in ("g", "doc", "row", "at", "n"))
        mask = copied_windows(g, doc, n, table["before"].to_pylist(), table["behind"].to_pylist())
        hit = np.flatnonzero(mask)
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (doc, row, at, mask)], ["doc", "row", "at", "mask"])

    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= SORTED_ROWS and batch.num_rows:
            table = pa.Table.from_batches(waiting)
            g = table["g"].to_numpy()
            end = int(np.flatnonzero(g == g[-1])[0])  # the last group may go on
            if end:
                yield done(table.slice(0, end))
                waiting, size = table.slice(end).combine_chunks().to_batches(), len(g) - end
    if size:
        yield done(pa.Table.from_batches(waiting))


def _first_texts(texts: DataFrame, repeated) -> tuple:
    """The broadcast bitmap of the rows that have their text first, and the others, as ``doc``, ``row``
    and ``end``. What a bitmap marks in vain is no copy here, and is compared like a first one."""
    least = F.min("_d").over(Window.partitionBy("_h", "_g"))
    rows = written(
        texts.select("_d", "_x", "_h", "_k", F.xxhash64(F.lit(1), "_t").alias("_g"), F.octet_length("_t").cast("long").alias("end"))
        .withColumn("_again", F.col("_d") > least).drop("_g"),
        "texts",
    )
    firsts = texts.sparkSession.sparkContext.broadcast(bitmap(rows.where("not _again"), "_k", LOG_PLACE_BITS))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (_marked(b, firsts, False) for b in batches):
            places = pa.array(rows_of(batch, repeated.value), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_d"), places, batch.column("end")], ["doc", "row", "end"])

    again = rows.where("_again").mapInArrow(tell, "doc long, row long, end long")
    return firsts, again.distinct()  # rows of one id and one text are alike


def copied_positions(texts: DataFrame, firsts, repeated) -> DataFrame:
    """``doc``, ``row``, ``at``, ``mask``: of the windows from ``at`` on, those whose bit is set begin in
    an earlier document too."""
    context = texts.sparkSession.sparkContext
    counted = _anchors(texts, firsts).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    often = counted.where("n > 1").select(F.shiftleft(F.col("key").cast("long"), 32).alias("key"))
    bits = context.broadcast(bitmap(often, "key", LOG_BITS))
    anchor, held = Window.partitionBy("g"), Window.partitionBy("g", "r")
    runs = written(
        _runs(texts, firsts, bits, repeated)
        .withColumn("several", F.min("r").over(anchor) < F.max("r").over(anchor))
        .withColumn("copied", F.col("doc") > F.min("doc").over(held))
        .where("copied or several").select("doc", "row", "at", F.expr(f"int(r & {SIZE})").alias("n"), "copied"),
        "runs",
    )
    places = runs.where("not copied").select("doc", "row", "at").mapInArrow(_places, "k long")
    suffixes = _suffixes(texts, firsts, bits, context.broadcast(bitmap(places, "k", LOG_PLACE_BITS)), repeated)
    single = suffixes.repartition("g").sortWithinPartitions("g", "behind").mapInArrow(
        trimmed(_compare), "doc long, row long, at int, mask int"
    )
    whole = runs.where("copied").select("doc", "row", "at", F.expr("shiftleft(1, n) - 1").alias("mask"))
    return whole.unionByName(single)


def merged(at: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches that the windows cover."""
    bit = (mask[:, None] >> np.arange(RUN)) & 1 == 1
    starts = np.sort((at[:, None] + np.arange(RUN))[bit])
    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + LENGTH])
    return starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]] + LENGTH


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", repeated=None) -> DataFrame:
    """``doc``, ``row`` and ``spans`` (start, end in bytes), the maximal copied runs of a document.
    ``repeated`` is the broadcast of ``repeated_ids``."""
    repeated = repeated or docs.sparkSession.sparkContext.broadcast(repeated_ids(docs, key))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for found in batch.column("w"):
                at, mask = (found.values.field(c).to_numpy().astype(np.int64) for c in ("at", "mask"))
                made.append([{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in merged(at, mask)))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("row"), pa.array(made, kind)], ["doc", "row", "spans"]
            )

    texts = with_rows(docs, key, text).select("_d", "_t", "_x", "_h").where(F.octet_length("_t") >= LENGTH)
    texts = texts.withColumn("_k", F.xxhash64("_d", "_h"))
    firsts, again = _first_texts(texts, repeated)
    found = copied_positions(texts, firsts, repeated).groupBy("doc", "row").agg(F.collect_list(F.struct("at", "mask")).alias("w"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("end")))
    parts = found.mapInArrow(trimmed(merge), "doc long, row long, spans array<struct<start:long,end:long>>")
    return parts.union(again.select("doc", "row", whole.alias("spans")))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with ``spans`` and ``kept`` (binary: a cut may fall within a character). Only texts
    that lose bytes are shuffled, told by a bitmap of their ids; one that it lets through in
    vain comes back unchanged."""
    spark = docs.sparkSession
    repeated = spark.sparkContext.broadcast(repeated_ids(docs, key))
    found = written(spans(docs, key, text, repeated), "spans")
    bits = spark.sparkContext.broadcast(bitmap(found.select(F.xxhash64("doc").alias("k")), "k", LOG_ROW_BITS))
    names = [c for c in docs.columns if c not in ("spans", "kept")]
    others = [F.col(c) for c in names if c != text]
    rows = with_rows(docs.withColumn("_held", F.struct(*others) if others else F.lit(1)), key, text).select("_d", "_t", "_held", "_x", "_h")
    long = T.StructField("_row", T.LongType())
    schema = T.StructType([*(rows.schema[c] for c in ("_d", "_t", "_held")), long])

    def split(wanted: bool) -> DataFrame:
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = batch.filter(pa.array(bits.value.has(batch.column("_x").to_numpy().view(np.uint64)) == wanted))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_d"), part.column("_t"), part.column("_held"), pa.array(rows_of(part, repeated.value), pa.int64())],
                    ["_d", "_t", "_held", "_row"],
                )

        return rows.mapInArrow(trimmed(apply), schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for body, runs in zip(batch.column("_t").to_pylist(), batch.column("spans").to_pylist()):
                data, at, out = (body or "").encode("utf-8", "surrogatepass"), 0, []
                for run in runs:
                    out.append(data[at : run["start"]])
                    at = run["end"]
                kept.append(b"".join(out) + data[at:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_t"), batch.column("_held"), batch.column("spans"), pa.array(kept, pa.binary())],
                ["_t", "_held", "spans", "kept"],
            )

    none = F.array().cast("array<struct<start:long,end:long>>")
    plain = split(False).select("_t", "_held", none.alias("spans"), F.coalesce(F.col("_t"), F.lit("")).cast("binary").alias("kept"))
    joined = split(True).join(found, (F.col("_d") == F.col("doc")) & (F.col("_row") == F.col("row")), "left").select(
        "_t", "_held", F.coalesce("spans", none).alias("spans")
    )
    lost = T.StructType([*joined.schema, T.StructField("kept", T.BinaryType())])
    done = plain.unionByName(joined.mapInArrow(trimmed(cut), lost))
    return done.select(*[F.col("_t").alias(c) if c == text else F.col("_held")[c].alias(c) for c in names], "spans", "kept")
