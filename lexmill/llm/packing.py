"""Packing of token sequences: best-fit decreasing over windows of fixed length.

Texts become byte-pair ids plus an end id. What exceeds a window is cut into full
windows; the rest of each document is packed by best-fit decreasing. That algorithm
looks at lengths only, so the plan is made from the number of pieces of each length
(at most ``window`` numbers): pieces of equal length are placed as one run, and a segment
tree indexed by remaining capacity gives the tightest open window. Each piece then finds
its place from its rank among the pieces of its length, which Spark computes in two
levels, so that one frequent length is not one task.

Null text counts as empty and gives the end id only. Repeated rows are packed one by
one. An empty table gives an empty result. Columns asked for by ``carry`` are kept.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import held, texts_of, trim
from lexmill.llm.wordcache import TextEncoder
from lexmill.session import written

WINDOW = 1024
END_ID = 0
BUCKETS = 1024
# Texts encoded together: the more, the fewer words are looked up again, and the fewer need to be remembered.
GROUP_BYTES, WORDS = 3 << 20, 80_000
# Matches that no Unicode version splits again: printable ASCII, and a space and Latin letters.
LATIN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch


def encoder(path: str, pattern: str) -> TextEncoder:
    """The worker's encoder; ``pattern`` is the one by which the tokenizer splits texts."""
    return held(("packing", path, pattern), lambda: _encoder(path, pattern))


def _encoder(path: str, pattern: str) -> TextEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer, models, pre_tokenizers

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # their strings in a text are ordinary text
    split, tokens = made.pre_tokenizer, made.model.tokenize
    # A match is then one word of the model, whose letters stand for bytes.
    direct = (
        made.normalizer is None and isinstance(made.model, models.BPE)
        and isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space
    )
    letters = byte_letters()

    space, code = letters[32], [struct.pack("<I", i) for i in range(1 + max(made.get_vocab().values()))]

    def one(match: str) -> bytes | None:
        if match.isascii() and match.isprintable():
            found = tokens(match.replace(" ", space))
        elif LATIN(match):
            found = tokens(match.encode().decode("latin-1").translate(letters))
        else:
            return None
        return b"".join([code[t.id] for t in found])

    def ids(matches: list[str]) -> list[bytes]:
        found = list(map(one, matches)) if direct else [None] * len(matches)
        rest = [m for m, x in zip(matches, found) if x is None]
        others = (e.ids for e in made.encode_batch_fast(rest, add_special_tokens=False)) if rest else iter(())
        return [np.array(next(others), "<u4").tobytes() if x is None else x for x in found]

    return TextEncoder(pattern, ids, WORDS)


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for
    themselves, the others for code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def encoded_groups(batches: Iterator[pa.RecordBatch], encode, column: str = "_text"):
    """Each batch with the ids of its texts. Batches are encoded in groups of ``GROUP_BYTES`` of text,
    or of one batch that is larger."""
    group, size = [], 0
    for batch in batches:
        more = batch.column(column).nbytes
        if group and size + more > GROUP_BYTES:
            yield from _encoded(group, encode, column)
            group, size = [], 0
        group.append(batch)
        size += more
    yield from _encoded(group, encode, column)


def _encoded(group: list[pa.RecordBatch], encode, column: str):
    found = iter(encode([t for batch in group for t in texts_of(batch, column)]) if group else ())
    for batch in group:
        yield batch, list(islice(found, batch.num_rows))
    trim()


def pieces(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
           window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``key``, ``start``, ``length``, ``ids`` (binary, little-endian 32 bit) and
    ``doc_tokens`` of each piece: full windows, and one shorter rest where ids are left."""
    kind = docs.schema[key].dataType
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, encoded in encoded_groups(batches, encoder(path, pattern).texts):
            rows, start, length, ids, total = [], [], [], [], []
            for i, found in enumerate(encoded):
                found += end
                n = len(found) // 4
                for at in range(0, n, window):
                    piece = found[4 * at : 4 * (at + window)]
                    rows.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    ids.append(piece)
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                [key, "start", "length", "ids", "doc_tokens"],
            )

    schema = f"`{key}` {kind.simpleString()}, start long, length long, ids binary, doc_tokens long"
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(cut, schema)


class Tightest:
    """Segment tree over capacities: which is the least one, from a given one on, with an
    open window."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.open = [0] * (2 * self.size)

    def change(self, capacity: int, by: int) -> None:
        at = capacity + self.size
        while at:
            self.open[at] += by
            at >>= 1

    def find(self, least: int) -> int | None:
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1:  # up until a right neighbour holds one, then down to its left end
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for so many pieces of each length: rows (length, first rank,
    number of pieces, first sequence, pieces per sequence, offset of the first piece).

    A step uses up a run of equal windows or ends a length, so the number of rows is
    bounded by the number of lengths, not of pieces.
    """
    tree, runs, out, opened = Tightest(window), {}, [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def put(first: int, free: int, sequences: int, each: int) -> None:
            nonlocal rank, left
            n = sequences * each
            out.append((length, rank, n, first, each, window - free))
            rank, left = rank + n, left - n
            if free - each * length:
                runs.setdefault(free - each * length, []).append((first, sequences))
                tree.change(free - each * length, 1)

        while left:
            free = tree.find(length)
            if free is None:
                free, first, sequences = window, opened, -(-left // (window // length))
                opened += sequences
            else:
                first, sequences = runs[free].pop()
                tree.change(free, -1)
            each = free // length
            full = min(sequences, left // each)
            if full:
                put(first, free, full, each)
            rest = sequences - full
            if rest and left:
                put(first + full, free, 1, left)
                full, rest = full + 1, rest - 1
            if rest:
                runs.setdefault(free, []).append((first + full, rest))
                tree.change(free, 1)
    return out


def pack(found: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces (``key``, ``start``,
    ``length`` and any more). The table is written once to the shared folder, as it is
    counted and then placed."""
    found = written(found, "pieces")
    spark = found.sparkSession
    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(counts, window) or [(0, 0, 0, 0, 1, 0)]
    places = spark.createDataFrame(
        rows, "length long, _first long, _n long, _sequence long, _each long, _base long"
    )
    bucketed = found.withColumn("_bucket", F.pmod(F.xxhash64(key, "start"), F.lit(BUCKETS)))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(key, "start")) - 1
    ranked = (
        bucketed.withColumn("_rank", rank)
        .join(offsets, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    return (
        ranked.join(F.broadcast(places), "length")
        .where("_rank >= _first and _rank < _first + _n")
        .withColumn("_rank", F.col("_rank") - F.col("_first"))
        .withColumn("sequence_id", F.col("_sequence") + F.floor(F.col("_rank") / F.col("_each")))
        .withColumn("offset", F.col("_base") + F.col("_rank") % F.col("_each") * F.col("length"))
        .select(*found.columns, "sequence_id", "offset")
    )


def padding(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """``sequence_id``, ``used`` and ``pad``: ids to add so that a sequence has the window's
    length; none where its length is a power of two."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("pad", F.when(power, 0).otherwise(window - F.col("used")))
