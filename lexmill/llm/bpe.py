"""Byte-level byte-pair encoding and decoding with own merges.

A text is split by the vocabulary's pattern; each match is merged separately, many of them
through one queue. The queue of merges is a bitmap of ranks in three levels of 64-bit words: find-first-set on each
level gives the least rank that waits, a bucket per rank holds the places in a linked list
of the left parts, and places whose pair has changed meanwhile are skipped. The work
per merge does not depend on the length of the match.

A worker remembers the ids of words and matches it has met (bounded); texts are
encoded whole. Null text is empty text, with no ids. Rows stay separate.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexmill.llm.common import held
from lexmill.llm.wordcache import TextEncoder

# Bytes of matches that are merged together; a longer match is merged alone.
GROUP = 1 << 18


class RankQueue:
    """Waiting pairs by rank: bitmaps of 64-bit words in three levels, and a bucket of places
    for each rank. Empty again after every use."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, places: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = places
        word = rank >> 6
        if not self.low[word]:
            if not self.mid[rank >> 12]:
                self.top |= 1 << (rank >> 12)
            self.mid[rank >> 12] |= 1 << (word & 63)
        self.low[word] |= 1 << (rank & 63)

    def take(self) -> tuple[int, list[int]]:
        """Least rank and its places in order, by find-first-set on each level; there must
        be one."""
        top = self.top
        a = (top & -top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        rank = b << 6 | (word & -word).bit_length() - 1
        word &= word - 1
        self.low[b] = word
        if not word:
            word = self.mid[a] = self.mid[a] & (self.mid[a] - 1)
            if not word:
                self.top = top & (top - 1)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.border = max(ranks.values(), default=0) + 1  # no id, and no rank
        self.shift = self.border.bit_length()
        self.queue = RankQueue(self.border)
        self.bytes = {i: token for token, i in ranks.items()}
        # Rank of each pair of ids that makes a token, under both ids in one number.
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << self.shift | right] = rank
        self.single = np.array([ranks.get(bytes([b]), self.border) for b in range(256)], np.int64)
        self.double = np.array(
            [[ranks.get(bytes([a, b]), self.border) for b in range(256)] for a in range(256)], np.int64
        )
        self.texts = TextEncoder(pattern, self._matches).texts

    def _matches(self, matches: list[str]) -> list[bytes]:
        return self.merge_all([m.encode("utf-8", "surrogatepass") for m in matches])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        (ids,) = self.merge_all([piece])
        return list(struct.unpack(f"<{len(ids) // 4}I", ids))

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each match. Matches share the queue, in groups, but never a pair."""
        out: list[bytes | None] = [None] * len(pieces)
        group, size = [], 0
        for n, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[n] = struct.pack("<I", whole)
                continue
            if group and size + len(piece) > GROUP:
                self._group(pieces, group, out)
                group, size = [], 0
            group.append(n)
            size += len(piece)
        if group:
            self._group(pieces, group, out)
        return out

    def _group(self, pieces: list[bytes], group: list[int], out: list[bytes | None]) -> None:
        """The matches lie one behind another with a border before, between and behind them."""
        border = self.border
        joined = [pieces[n] for n in group]
        data = np.frombuffer(b"".join(joined), np.uint8)
        sizes = np.fromiter(map(len, joined), np.int64, len(joined))
        places = np.arange(1, len(data) + 1) + np.repeat(np.arange(len(joined)), sizes)
        ids = np.full(len(data) + len(joined) + 1, border, np.int64)
        ids[places] = self.single[data]
        waiting = np.full(len(ids), border, np.int64)
        close = places[1:] == places[:-1] + 1
        waiting[places[:-1][close]] = self.double[data[:-1], data[1:]][close]
        order = np.argsort(waiting, kind="stable")[: np.count_nonzero(waiting < border)]
        found = waiting[order]
        cuts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
        starts = [*cuts.tolist(), len(order)]
        order = order.tolist()
        for rank, a, b in zip(found[cuts].tolist(), starts, starts[1:]):
            self.queue.open(rank, order[a:b])
        left = np.array(self._merged(ids.tolist(), waiting.tolist()), np.int64)
        alive = (left >= 0) & (left != border)
        ends = (4 * np.cumsum(alive)[np.r_[0, 1 + np.cumsum(sizes + 1) - 1]]).tolist()
        whole = left[alive].astype("<u4").tobytes()
        for n, a, b in zip(group, ends, ends[1:]):
            out[n] = whole[a:b]

    def _merged(self, ids: list[int], waiting: list[int]) -> list[int]:
        """The ids left where no pair waits; -1 where a place was merged into another.
        ``waiting`` has the rank of the pair that starts at a place; entries of the queue
        under another rank are stale."""
        border, shift, get, queue = self.border, self.shift, self.pairs.get, self.queue
        bucket_of = queue.buckets.get
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        while queue.top:
            rank, bucket = queue.take()
            for n, i in enumerate(bucket, 1):
                if waiting[i] != rank:
                    continue
                j, h = after[i], before[i]
                k = after[i] = after[j]
                before[k] = i
                ids[i], ids[j], waiting[j] = rank, -1, border
                waiting[i] = new = get(rank << shift | ids[k], border)
                if new != border:
                    places = bucket_of(new)
                    if places is None:
                        queue.open(new, [i])
                    else:
                        places.append(i)
                waiting[h] = least = get(ids[h] << shift | rank, border)
                if least != border:
                    places = bucket_of(least)
                    if places is None:
                        queue.open(least, [h])
                    else:
                        places.append(h)
                if new < rank or least < rank:  # the lower rank is next
                    if n < len(bucket):
                        queue.open(rank, bucket[n:])
                    break
        return ids

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)])


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a file of base64 tokens and ranks."""
    return held(("bpe", path, pattern), lambda: _encoder(path, pattern))


def _encoder(path: str, pattern: str) -> Encoder:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Encoder(ranks, pattern)


def _add(docs: DataFrame, source: str, output: str, kind: T.DataType, of) -> DataFrame:
    columns = [c for c in docs.columns if c != output]
    schema = T.StructType([*(docs.schema[c] for c in columns), T.StructField(output, kind)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(of(batch.column(source).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), made], [*columns, output]
            )

    return docs.mapInArrow(apply, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", output: str = "ids") -> DataFrame:
    """Adds the ids of each whole text as binary, four little-endian bytes an id."""
    return _add(docs, text, output, T.BinaryType(), lambda ts: encoder(path, pattern).texts([t or "" for t in ts]))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; null ids are none."""
    return _add(docs, ids, output, T.BinaryType(), lambda ids: [encoder(path, pattern).decode(i or b"") for i in ids])
