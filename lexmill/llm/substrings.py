"""Substring deduplication by relative Lempel-Ziv parsing.

The corpus is its own reference. Its windows of 13 words are indexed once: for every
window found in two documents or more, the first place (least document id, then least
position). The index is spread over the cluster by window, each part being a reference
block; a document is parsed against all of them. Parsing is greedy: where a window begins that
an earlier document holds, a factor starts and goes on as long as the reference does; where
it breaks off, the window across the boundary is looked up in turn, so factors may overlap
and no window is missed. The factors' words are the duplicate spans.

Most windows are unique and need not be shuffled. A window's anchor is the least digest
among its word sequences of ``ANCHOR`` words; equal windows have equal anchors, so only
windows whose anchor occurs in two documents or more can be repeated. Anchors are counted
over the whole corpus; a bitmap of fixed size (``LOG_BITS``) tells the workers which may be
repeated. A full bitmap costs shuffling, never results.

What may be repeated goes in runs first: consecutive windows with one anchor, at most
``RUN`` of them. Equal runs are compared as wholes, so the inside of a copied passage costs a
row per run. Only where an anchor has runs of different words, as at the ends of
passages, single windows are compared.

Documents are compared by id; a null id counts as the largest. Documents of the same id
are not earlier than each other and are treated row by row: where an id is repeated, its rows
are told apart by a 64-bit digest of the text. Null and empty texts have no words.
Windows are compared by 96 bits of digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest as digest

from lexmill.llm.common import Bits, bitmap, repeated_ids, rows_of, trimmed, with_rows, words_of
from lexmill.session import written

WINDOW = 13
ANCHOR = 6
RUN = WINDOW - ANCHOR + 1
LOG_BITS = 27
LOG_ROW_BITS = 24
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(codes: np.ndarray) -> np.ndarray:
    """Spread digests, so that their top bits may be used."""
    codes = codes ^ (codes >> np.uint64(32))
    codes = codes * np.uint64(0xD6E8FEB86659FD93)
    codes = codes ^ (codes >> np.uint64(32))
    return codes * np.uint64(0xD6E8FEB86659FD93)


def _power(odd: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(odd), n, 1 << 64))


def rolled(codes: np.ndarray, size: int, odd: np.uint64) -> np.ndarray:
    """Digest of every run of ``size`` codes: a polynomial, put together from runs of 1, 2, 4 and so on."""
    n = max(len(codes) - size + 1, 0)
    out, have, part, long = np.zeros(n, np.uint64), 0, codes, 1
    while have < size:
        if size & long:  # the codes before those that ``out`` has
            out = out + part[size - have - long : size - have - long + n] * _power(odd, have)
            have += long
        if have < size:
            part = part[:-long] * _power(odd, long) + part[long:] if len(part) > long else part[:0]
            long *= 2
    return mixed(out)


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def codes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(digest, words), np.uint64, len(words))


class Windows:
    """The windows of a batch of texts one after another: ``text`` (its place in the batch) and
    ``pos`` (first word) of each. Digests are rolled over the batch at once; what reaches
    over a text's end is left out."""

    def __init__(self, texts: list[str | None]):
        codes = [codes_of(words_of(t)) for t in texts]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        counts = np.maximum(sizes - WINDOW + 1, 0)
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        self.text = np.repeat(np.arange(len(sizes)), counts)
        self.pos = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.at = self.pos + np.repeat(np.cumsum(sizes) - sizes, counts)

    def anchors(self) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, np.uint64)
        return least_of(rolled(self.codes, ANCHOR, _SECOND), WINDOW - ANCHOR + 1)[self.at]

    def digests(self, odd: np.uint64) -> np.ndarray:
        return rolled(self.codes, WINDOW, odd)[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def changes(self, anchors: np.ndarray) -> np.ndarray:
        """Where a text or an anchor begins."""
        if not len(anchors):
            return np.zeros(0, np.int64)
        return np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (self.text[1:] != self.text[:-1])])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        windows = Windows(batch.column("_t").to_pylist())
        anchors = windows.anchors()
        change = windows.changes(anchors)
        parts = np.split(anchors[change], np.flatnonzero(np.diff(windows.text[change])) + 1)
        keys = np.concatenate([np.unique(part) for part in parts])
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


def repeated_anchors(texts: DataFrame, log_bits: int = LOG_BITS) -> Bits:
    """Which anchors may occur in two documents or more."""
    counted = texts.select("_t").mapInArrow(trimmed(_anchors), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return bitmap(counted.where("n > 1"), "key", log_bits)


def _table(made: list[tuple], kinds: str, names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*made)] if made else [np.zeros(0, t) for t in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def runs_of(windows: Windows, bits: Bits) -> tuple[np.ndarray, ...]:
    """Runs of a batch whose anchors may be repeated: anchor, digest of all words, text, first
    window and number of windows. First and last window overlap, so they give all words."""
    anchors = windows.anchors()
    n = len(anchors)
    change = windows.changes(anchors)
    begun = np.repeat(change, np.diff(np.r_[change, n]))
    starts = np.flatnonzero((np.arange(n) - begun) % RUN == 0)
    sizes = np.diff(np.r_[starts, n])
    keep = bits.has(anchors[starts])
    starts, sizes = starts[keep], sizes[keep]
    first = windows.digests(_FIRST) if len(starts) else anchors
    whole = mixed(first[starts] * _SECOND + first[starts + sizes - 1] + sizes.astype(np.uint64))
    return anchors[starts].view(np.int64), whole.view(np.int64), windows.text[starts], windows.pos[starts], sizes


def _places(batch: pa.RecordBatch, repeated: Bits) -> tuple[np.ndarray, np.ndarray]:
    """Document and row of every text of a batch."""
    return batch.column("_d").to_numpy(), np.array(rows_of(batch, repeated), np.int64)


def _runs(texts: DataFrame, bits, repeated) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows = _places(batch, repeated.value)
            anchors, whole, text, pos, sizes = runs_of(Windows(batch.column("_t").to_pylist()), bits.value)
            made = (anchors, whole, docs[text], rows[text], pos.astype(np.int32), sizes.astype(np.int32))
            yield _table([made], "llllii", ["a", "r", "doc", "row", "pos", "n"])

    return texts.mapInArrow(trimmed(find), "a long, r long, doc long, row long, pos int, n int")


def _windows(texts: DataFrame, bits, repeated) -> DataFrame:
    """Windows whose anchors are marked: digests, document and position."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows = _places(batch, repeated.value)
            windows = Windows(batch.column("_t").to_pylist())
            at = np.flatnonzero(bits.value.has(windows.anchors()))
            made = []
            if len(at):
                first, second = windows.digests(_FIRST)[at], windows.digests(_SECOND)[at]
                text = windows.text[at]
                made.append((first.view(np.int64), (second >> np.uint64(32)).astype(np.uint32).view(np.int32),
                             docs[text], rows[text], windows.pos[at].astype(np.int32)))
            yield _table(made, "lilli", ["h", "g", "doc", "row", "pos"])

    return texts.mapInArrow(trimmed(find), "h long, g int, doc long, row long, pos int")


def _firsts(rows: DataFrame, *by: str) -> DataFrame:
    """The first place of each key, and the last document that holds it."""
    found = rows.groupBy(*by).agg(F.min(F.struct("doc", "pos")).alias("ref"), F.max("doc").alias("last"))
    return found.select(*by, F.col("ref.doc").alias("ref_doc"), F.col("ref.pos").alias("ref_pos"), "last")


def copied_runs(docs: DataFrame, repeated, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``row``, ``pos``, ``n``: runs of windows that an earlier document holds, with ``ref_doc`` and
    ``ref_pos``, their first place in the corpus."""
    context = docs.sparkSession.sparkContext
    texts = with_rows(docs, key, text).select("_d", "_t", "_x", "_h")
    runs = written(_runs(texts, context.broadcast(repeated_anchors(texts)), repeated), "runs")
    first = written(_firsts(runs, "a", "r"), "run-index")
    several = first.groupBy("a").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    windows = written(_windows(texts, context.broadcast(bitmap(several, "a", LOG_BITS)), repeated), "windows")
    place = ["doc", "row", "pos", "n", "ref_doc", "ref_pos"]
    whole = runs.join(first.where("last > ref_doc"), ["a", "r"]).where("doc > ref_doc").select(*place)
    index = _firsts(windows, "h", "g").where("last > ref_doc")
    single = windows.join(index, ["h", "g"]).where("doc > ref_doc").withColumn("n", F.lit(1)).select(*place)
    return whole.unionByName(single)


def parse(copied: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Greedy factors of a document from its copied runs (position, windows, reference
    document, position there): (first word, end, reference document, its first word)."""
    out: list[tuple[int, int, int, int]] = []
    for at, n, doc, pos in sorted(copied, key=lambda c: (c[0], -c[1])):
        end = at + n + WINDOW - 1
        if out:
            first, last, ref, ref_first = out[-1]
            if end <= last:
                continue
            if doc == ref and at <= last - WINDOW + 1 and pos - ref_first == at - first:
                out[-1] = (first, end, ref, ref_first)
                continue
        out.append((at, end, doc, pos))
    return out


def chains(text, pos, n, doc, ref) -> tuple[np.ndarray, ...]:
    """Copied runs by text and position; those that go on in the reference where the one
    before breaks off are one."""
    if not len(text):
        return text, pos, n, doc, ref
    order = np.lexsort((-n, pos, text))
    text, pos, n, doc, ref = (x[order] for x in (text, pos, n, doc, ref))
    end, shift = pos + n, ref - pos
    other = (text[1:] != text[:-1]) | (doc[1:] != doc[:-1]) | (shift[1:] != shift[:-1]) | (pos[1:] > end[:-1])
    at = np.flatnonzero(np.r_[True, other])
    return text[at], pos[at], np.maximum.reduceat(end, at) - pos[at], doc[at], ref[at]


FACTOR = "array<struct<start:int,end:int,ref_doc:long,ref_start:int>>"


def factors(docs: DataFrame, key: str = "doc_id", text: str = "text", repeated=None) -> DataFrame:
    """``doc``, ``row`` and ``factors`` (start, end, ref_doc, ref_start in words) of every document
    that copies from an earlier one. One document's windows meet in one row; those of
    rows of one id and one text are the same and count once. ``repeated`` is the broadcast
    of ``repeated_ids``."""
    repeated = repeated or docs.sparkSession.sparkContext.broadcast(repeated_ids(docs, key))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
        for batch in batches:
            made = [[] for _ in range(batch.num_rows)]
            runs = batch.column("w").flatten()
            text = np.repeat(np.arange(batch.num_rows), batch.column("w").value_lengths().to_numpy())
            fields = [runs.field(f).to_numpy().astype(np.int64) for f in ("pos", "n", "ref_doc", "ref_pos")]
            for i, *run in zip(*(x.tolist() for x in chains(text, *fields))):
                made[i].append(run)
            names = ("start", "end", "ref_doc", "ref_start")
            made = [[dict(zip(names, f)) for f in parse(row)] for row in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("row"), pa.array(made, kind)], ["doc", "row", "factors"]
            )

    grouped = copied_runs(docs, repeated, key, text).groupBy("doc", "row").agg(
        F.collect_set(F.struct("pos", "n", "ref_doc", "ref_pos")).alias("w")
    )
    return grouped.mapInArrow(trimmed(apply), f"doc long, row long, factors {FACTOR}")


def kept_words(words: list[bytes], spans: list[dict]) -> list[bytes]:
    """Words outside all factors."""
    out, at = [], 0
    for span in spans:
        if span["start"] > at:
            out += words[at : span["start"]]
        at = max(at, span["end"])
    return out + words[at:]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with ``n_words``, ``n_removed`` and the text without copied words. A text that
    loses words is its other words with single spaces; other texts stay as they are.

    Only texts that lose words are shuffled, told by a bitmap of their ids; a
    text that the bitmap lets through in vain comes back unchanged."""
    spark = docs.sparkSession
    repeated = spark.sparkContext.broadcast(repeated_ids(docs, key))
    found = written(factors(docs, key, text, repeated), "factors")
    hit = bitmap(found.select(F.xxhash64("doc").alias("k")), "k", LOG_ROW_BITS)
    bits = spark.sparkContext.broadcast(hit)
    held = [c for c in docs.columns if c != text and c not in ("n_words", "n_removed")]
    nest = F.struct(*[F.col(c) for c in held]).alias("_held") if held else F.lit(1).alias("_held")
    rows = with_rows(docs.withColumn("_held", nest), key, text).select("_d", "_t", "_held", "_x", "_h")
    names = ["_d", "_row", "_t", "_held", "n_words", "n_removed"]

    def split(wanted: bool):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = bits.value.has(batch.column("_x").to_numpy().view(np.uint64)) == wanted
                part = batch.filter(pa.array(keep))
                sizes = [len(words_of(t)) for t in part.column("_t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_d"), pa.array(rows_of(part, repeated.value), pa.int64()), part.column("_t"), part.column("_held"),
                     pa.array(sizes, pa.int64()), pa.array([0] * len(sizes), pa.int64())], names
                )

        return rows.mapInArrow(trimmed(apply), T.StructType([
            rows.schema["_d"], T.StructField("_row", T.LongType()), rows.schema["_t"], rows.schema["_held"],
            T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        ]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for body, spans in zip(batch.column("_t").to_pylist(), batch.column("factors").to_pylist()):
                words = words_of(body) if spans else []
                left = kept_words(words, spans or [])
                removed.append(len(words) - len(left))
                texts.append(body if not spans else b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_d"), batch.column("_row"), pa.array(texts, pa.string()), batch.column("_held"), batch.column("n_words"),
                 pa.array(removed, pa.int64())], names
            )

    plain = split(False)
    joined = split(True).drop("n_removed").join(
        found, (F.col("_d") == F.col("doc")) & (F.col("_row") == F.col("row")), "left"
    ).select("_d", "_row", "_t", "_held", "n_words", "factors")
    done = plain.unionByName(joined.mapInArrow(trimmed(cut), plain.schema))
    order = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    return done.select(
        *[F.col("_t").alias(c) if c == text else F.col("_held")[c].alias(c) for c in order],
        "n_words", "n_removed",
    )
