"""Scoring of texts: add-one word counts, and a subword lattice.

Words of the training texts are counted over the whole corpus. The pieces of an existing
subword vocabulary weight the lattice: a piece's unigram probability is its share, with
one added, among the pieces of all training words. Words never share pieces, so a
text's probability is the product over its words, each the sum over all of its
segmentations (forward recursion in log space), times that of its length: every word but
the end goes on with the probability seen in training. Characters without a piece are
spelled by the vocabulary's byte pieces.

The lattice is computed once per distinct word of the corpus, in a table spread over
the cluster. Texts look words up in it: the ``HEAD_WORDS`` most frequent short words are
broadcast (a bound on rows and bytes), so no frequent word of up to ``HEAD_BYTES`` bytes is ever
shuffled; all other words go through a join. Texts are read once for it.

Null and empty texts have one token, the end. Rows are scored one by one, repeated ids
included; rows with a null id belong to training. With an empty training set every
word is unknown and pieces are equally likely.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import words_of
from lexmill.session import written

HEAD_WORDS = 200_000
HEAD_BYTES = 48  # longer words are never in the head
FLUSH = 200_000  # distinct words a task holds before it passes their counts on
SPACE = "▁"


def words(text: str | None) -> list[bytes]:
    return [] if not text else text.encode("utf-8", "surrogatepass").lower().split()


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words; words of texts not learnt from are listed with 0."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"]
        )
        held.clear()
        return made

    for batch in batches:
        for text, learn in zip(batch.column("_t").to_pylist(), batch.column("_learn").to_pylist()):
            found = words(text)
            if learn:
                held.update(found)
            else:
                for word in set(found):
                    held[word] += 0
            if len(held) > FLUSH:
                yield out()
    yield out()


def count_words(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """``word`` (binary) and ``c``, its number in the texts to learn from, for every word
    of all texts."""
    rows = docs.select(F.col(text).alias("_t"), learn.alias("_learn"))
    return rows.mapInArrow(_counting, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@functools.cache
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_probabilities(counted: DataFrame, path: str) -> np.ndarray:
    """log10 of each piece's share in the training words. A task sums up before it passes
    anything on; the driver gets one number per piece of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(path)
        total = np.zeros(model.vocab_size(), np.int64)
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            ids = model.encode(texts, num_threads=1)
            sizes = [len(i) for i in ids]
            flat = np.fromiter((i for x in ids for i in x), np.int64, sum(sizes))
            np.add.at(total, flat, np.repeat(batch.column("c").to_numpy(), sizes))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "n"])

    seen = counted.where("c > 0").mapInArrow(count, "piece long, n long")
    found = seen.groupBy("piece").agg(F.sum("n").alias("n")).collect()
    totals = np.ones(_pieces(path).vocab_size())
    for row in found:
        totals[row.piece] += row.n
    return np.log10(totals / totals.sum())


class Lattice:
    """Log10 probability of a word: all segmentations into pieces."""

    def __init__(self, path: str, logs: np.ndarray):
        model = _pieces(path)
        self.pieces, self.byte = {}, [0.0] * 256
        for i in range(model.vocab_size()):
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[3:5], 16)] = float(logs[i])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.pieces[model.id_to_piece(i)] = float(logs[i])
        self.longest = max(map(len, self.pieces), default=1)
        # How far a piece can still reach: every beginning of a piece.
        self.beginnings = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}

    def score(self, word: str) -> float:
        text, get, beginnings = SPACE + word, self.pieces.get, self.beginnings
        n = len(text)
        reach: list[list[float]] = [[] for _ in range(n + 1)]
        reach[0].append(0.0)
        for i in range(n):
            paths, reach[i] = reach[i], []
            if len(paths) == 1:
                here = paths[0]
            else:
                top = max(paths)
                here = top + math.log10(sum(10.0 ** (p - top) for p in paths))
            single = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                part = text[i:j]
                if part not in beginnings:
                    break
                value = get(part)
                if value is not None:
                    reach[j].append(here + value)
                    single = single or j == i + 1
            if not single:
                spelled = text[i].encode("utf-8", "surrogatepass")
                reach[i + 1].append(here + sum(self.byte[b] for b in spelled))
        top = max(reach[n])
        return top + math.log10(sum(10.0 ** (p - top) for p in reach[n]))


def with_lattice(counted: DataFrame, path: str, logs: np.ndarray) -> DataFrame:
    """Adds ``lm``, the lattice's log10 probability of each distinct word."""
    shared = counted.sparkSession.sparkContext.broadcast(logs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(path, shared.value)
        for batch in batches:
            values = [lattice.score(w.decode("utf-8", "replace")) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(values, pa.float64())], ["word", "c", "lm"]
            )

    return counted.mapInArrow(apply, "word binary, c long, lm double")


def frequent(vocabulary: DataFrame) -> DataFrame:
    """The most frequent words, at most ``HEAD_WORDS``: those whose count, of which the first
    six bits matter, is above what a small histogram of such counts tells."""
    high = F.greatest(F.floor(F.log2(F.greatest(F.col("c"), F.lit(1)))) - 5, F.lit(0)).cast("int")
    rough = F.col("c") - F.pmod(F.col("c"), F.call_function("shiftleft", F.lit(1).cast("long"), high))
    most = -1
    left = HEAD_WORDS
    for row in vocabulary.groupBy(rough.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect():
        left -= row.n
        if left < 0:
            most = row.c
            break
    return vocabulary.where(rough > most)


def score(docs: DataFrame, path: str, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (both
    log10) of every text; ``learn`` tells which texts are learnt from."""
    spark = docs.sparkSession
    counted = written(count_words(docs, learn, text), "words")
    logs = piece_probabilities(counted, path)
    vocabulary = written(with_lattice(counted, path, logs), "lattice")
    ends = docs.where(learn).count()
    sums = vocabulary.where("c > 0").agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n_all, v_all = sums.n + ends, sums.v + (1 if ends else 0)
    spare = n_all + v_all + 1
    end_base = math.log10((ends + 1) / spare)
    stop = (ends + 1) / (n_all + 2)
    go_on, end_score = math.log10(1 - stop), math.log10(stop)

    head = frequent(vocabulary.where(F.octet_length("word") <= HEAD_BYTES)).toArrow()
    shared = spark.sparkContext.broadcast(
        (head["word"].to_pylist(), head["c"].to_numpy(), head["lm"].to_numpy())
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text one row of sums over the head, and a row per other word. The text's own row
        has a key with a space, which no word has: it finds nothing, and such rows spread."""
        names, c, lm = shared.value
        at = {w: i for i, w in enumerate(names)}
        base = np.r_[np.log10((c + 1) / spare), 0.0]
        known, lm = np.r_[c > 0, False], np.r_[lm, 0.0]
        for batch in batches:
            rows, ids, own, words_, ns, knowns, bases, scores = [], [], [], [], [], [], [], []
            numbers = batch.column("_row").to_pylist()
            for i, body in enumerate(batch.column("_t").to_pylist()):
                found, number = words(body), numbers[i]
                places = np.fromiter((at.get(w, -1) for w in found), np.int64, len(found))
                rows.append(i)
                ids.append(number)
                own.append(True)
                words_.append(b" %d" % number)
                ns.append(len(found))
                knowns.append(int(known[places].sum()))
                bases.append(float(base[places].sum()))
                scores.append(float(lm[places].sum()))
                rest = Counter([found[j] for j in np.flatnonzero(places < 0).tolist()])
                for word, n in rest.items():
                    rows.append(i)
                    ids.append(number)
                    own.append(False)
                    words_.append(word)
                    ns.append(n)
                    knowns.append(0)
                    bases.append(0.0)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k").take(pa.array(rows, pa.int64())), pa.array(ids, pa.int64()),
                 pa.array(own, pa.bool_()), pa.array(words_, pa.binary()), pa.array(ns, pa.int64()), pa.array(knowns, pa.int64()),
                 pa.array(bases, pa.float64()), pa.array(scores, pa.float64())],
                schema.names,
            )

    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("_k", kind), T.StructField("_row", T.LongType()), T.StructField("own", T.BooleanType()),
        T.StructField("word", T.BinaryType()),
        T.StructField("n", T.LongType()), T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("sub", T.DoubleType()),
    ])
    # The row's number comes from the scan's own partition, whatever stage it runs in.
    numbered = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).withColumn("_row", F.monotonically_increasing_id())
    found = numbered.mapInArrow(look_up, schema)
    looked = found.join(vocabulary, "word", "left").select(
        "_k", "_row",
        F.when(F.col("own"), F.col("n")).otherwise(0).alias("n"),
        F.when(F.col("own"), F.col("known")).when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"),
        F.when(F.col("own"), F.col("base")).otherwise(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(spare)))).alias("base"),
        F.when(F.col("own"), F.col("sub")).otherwise(F.col("n") * F.col("lm")).alias("sub"),
    )
    return (
        looked.groupBy("_k", "_row")
        .agg(*[F.sum(c).alias(c) for c in ("n", "known", "base", "sub")])
        .select(
            F.col("_k").alias(key),
            (F.col("n") + 1).alias("n_tokens"),
            (F.col("known") + (1 if ends else 0)).alias("n_known"),
            F.lit(n_all).cast("long").alias("train_tokens"),
            (F.col("base") + end_base).alias("base_score"),
            (F.col("sub") + F.col("n") * go_on + end_score).alias("score"),
        )
    )
