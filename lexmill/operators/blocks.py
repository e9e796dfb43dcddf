"""Arrays of many rows as blocks: each distinct value of a block once, beside one row that tells
where the values stand. What a join says of the values is put back without moving each of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_VALUES = 1 << 19
BLOCK_PAIRS = 1 << 22
BLOCK_ROWS = 1 << 15  # places in a block are shorts
BATCH_PAIRS = 1 << 16


def _starts(keys: pa.Array) -> np.ndarray:
    """Where a key differs from the one before; nulls are equal to each other."""
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])


def _sizes(rows: pa.RecordBatch) -> np.ndarray:
    """Lengths of the arrays; null has no values."""
    return pc.fill_null(pc.list_value_length(rows.column("_values")), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _whole(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Of rows ``_key``, ``_values`` (an array), sorted by key in every partition: ``_block`` with each
    distinct value under ``name`` and its number ``_at``, and one row a block without these, with the
    keys, the sizes of the arrays and the numbers of their values. A block has about
    ``BLOCK_VALUES`` values, or one larger key; rows of a key are in one block."""
    key, value = df.schema["_key"].dataType, df.schema["_values"].dataType.elementType
    head = [T.StructField("_keys", T.ArrayType(key)), T.StructField("_sizes", T.ArrayType(T.IntegerType())),
            T.StructField("_codes", T.ArrayType(T.IntegerType()))]
    fields = [T.StructField("_block", T.LongType()), T.StructField(name, value), T.StructField("_at", T.IntegerType()), *head]
    names = [f.name for f in fields]

    def block(number: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        arrays = rows.column("_values")
        found = arrays.flatten().dictionary_encode(null_encoding="encode")
        n = len(found.dictionary)
        keys, sizes, codes = _one(rows.column("_key")), _one(pc.list_value_length(arrays)), _one(found.indices)
        if n:
            # Empty, not null: Spark's Arrow writer passes over all nulls of an array column at each row.
            none = pa.array(np.zeros(n + 1, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)), found.dictionary, pa.array(np.arange(n, dtype=np.int32)),
                 *(pa.ListArray.from_arrays(none, c.values[:0]) for c in (keys, sizes, codes))], names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.nulls(1, found.dictionary.type), pa.nulls(1, pa.int32()), keys, sizes, codes], names)

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rest = TaskContext.get().partitionId() << 33, []

        def blocks_of(rows: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal number
            sizes = _sizes(rows)
            before = (np.cumsum(sizes) - sizes)[starts]
            ends, at = np.r_[starts[1:], len(rows)], 0
            while at < len(starts):
                end = int(np.searchsorted(before, before[at] + BLOCK_VALUES))
                yield from block(number, rows.slice(starts[at], ends[end - 1] - starts[at]))
                number, at = number + 1, end

        for batch in batches:
            if not len(batch):
                continue
            rows = _whole([*rest, batch])
            starts = _starts(rows.column("_key"))
            yield from blocks_of(rows.slice(0, starts[-1]), starts[:-1])
            rest = [rows.slice(starts[-1])]  # its key may go on in the next batch
        for rows in rest:
            yield from blocks_of(rows, np.zeros(1, np.int64))

    return df.mapInArrow(divide, T.StructType(fields))


def _merged(keys: pa.Array, arrays: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Rows that share a key as one: values by place, then in order, null first; null where
    one of the arrays is."""
    starts = _starts(keys)
    if len(starts) == len(keys):
        return keys, arrays
    made = []
    for start, end in zip(starts, np.r_[starts[1:], len(keys)]):
        lists = arrays.slice(start, end - start).to_pylist()
        if end - start > 1 and None not in lists:
            placed = sorted((i, v is not None, v) for found in lists for i, v in enumerate(found))
            lists = [[v for _, _, v in placed]]
        made.append(None if None in lists else lists[0])
    return keys.take(pa.array(starts)), pa.array(made, arrays.type)


def put_back(df: DataFrame, value: str) -> DataFrame:
    """``_key`` and ``_list``, the arrays that ``cut`` took apart, with the column ``value`` for their values."""
    key, kind = df.schema["_keys"].dataType.elementType, df.schema[value].dataType
    schema = T.StructType([T.StructField("_key", key), T.StructField("_list", T.ArrayType(kind))])

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = _whole(parts)
        known = rows.column("_at").is_valid()
        head, each = rows.filter(pc.invert(known)), rows.filter(known)
        place = np.empty(len(each), np.int64)
        place[each.column("_at").to_numpy()] = np.arange(len(each))
        codes = head.column("_codes").flatten().to_numpy()
        sizes = head.column("_sizes").flatten()
        ends = np.cumsum(np.r_[0, pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)], dtype=np.int32)
        values = each.column(value).take(pa.array(place[codes]))
        arrays = pa.ListArray.from_arrays(pa.array(ends), values, mask=sizes.is_null())
        return pa.RecordBatch.from_arrays([*_merged(head.column("_keys").flatten(), arrays)], schema.names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            numbers = batch.column("_block").to_numpy()
            starts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
            for start, end in zip(starts, np.r_[starts[1:], len(batch)]):
                if held and numbers[start] != last:
                    yield block(held)
                    held = []
                held.append(batch.slice(start, end - start))
                last = numbers[start]
        if held:
            yield block(held)

    ordered = df.select("_block", "_at", "_keys", "_sizes", "_codes", value).repartition("_block").sortWithinPartitions("_block")
    return ordered.mapInArrow(join, schema)


def cut_pairs(df: DataFrame) -> DataFrame:
    """Of rows ``_number`` (different longs, mostly ascending), ``_learn`` (true or false) and ``_values`` (an array
    of words without blanks): each ``pair`` of neighbours, joined by a blank, once a block, in order; ``base``, the
    block's first number; and ``at``, for every occurrence how much larger its row's number is, with all bits turned
    (so below zero) where ``_learn`` is false. A block has about ``BLOCK_PAIRS`` values, or one longer row, and
    its numbers are less than ``BLOCK_ROWS`` apart. Few columns, as every one adds to a shuffled row."""
    schema = T.StructType([
        T.StructField("pair", T.StringType()), T.StructField("base", T.LongType()),
        T.StructField("at", T.ArrayType(T.ShortType())),
    ])

    def block(base: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.concatenate([_sizes(p) for p in parts])
        if sizes.max() < 2:
            return
        places = (np.concatenate([p.column("_number").to_numpy() for p in parts]) - base).astype(np.int16)
        learn = np.concatenate([p.column("_learn").to_numpy(zero_copy_only=False) for p in parts])
        places = np.where(learn, places, ~places)
        found = pa.chunked_array([p.column("_values").flatten() for p in parts]).dictionary_encode().unify_dictionaries()
        words = found.chunk(0).dictionary
        order = pc.sort_indices(words).to_numpy()
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        words = words.take(pa.array(order))
        codes = rank[np.concatenate([c.indices.to_numpy() for c in found.chunks])]
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        inside = row[1:] == row[:-1]
        pairs, row = (codes[:-1] * len(words) + codes[1:])[inside], row[:-1][inside]
        order = np.argsort(pairs, kind="stable")
        pairs, at = pairs[order], places[row[order]]
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        first, second = np.divmod(pairs[starts], len(words))
        ends = np.r_[starts, len(pairs)]
        for i in range(0, len(starts), BATCH_PAIRS):
            j = min(i + BATCH_PAIRS, len(starts))
            joined = pc.binary_join_element_wise(
                words.take(pa.array(first[i:j])), words.take(pa.array(second[i:j])), pa.scalar(" ", words.type))
            lists = pa.ListArray.from_arrays((ends[i : j + 1] - ends[i]).astype(np.int32), at[ends[i] : ends[j]])
            yield pa.RecordBatch.from_arrays([joined, pa.array(np.full(j - i, base)), lists], schema.names)

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_values, base = [], 0, 0
        for batch in batches:
            numbers, sizes, at = batch.column("_number").to_numpy(), _sizes(batch), 0
            while at < len(batch):
                base = base if held else int(numbers[at])
                apart = numbers[at:] - base
                fits = (apart >= 0) & (apart < BLOCK_ROWS)
                fits &= held_values + np.cumsum(sizes[at:]) - sizes[at:] < BLOCK_PAIRS
                end = len(batch) if fits.all() else at + int(np.argmin(fits))
                if end > at:
                    held.append(batch.slice(at, end - at))
                    held_values += int(sizes[at:end].sum())
                if end < len(batch):
                    yield from block(base, held)
                    held, held_values = [], 0
                at = end
        if held:
            yield from block(base, held)

    return df.mapInArrow(divide, schema)
