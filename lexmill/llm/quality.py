"""Quality rules: exact counts of a text, and a calibrated classifier of its words.

The classifier is a logistic regression over hashed words, word pairs and
character n-grams (four and five bytes), trained on labelled texts and calibrated by a
logistic curve on a quarter of them that its weights never saw. Texts are scored whole in
Arrow batches; a text is kept if its probability of good quality is at least
``THRESHOLD`` and no base rule fails.

It is fitted on at most ``PER_CLASS`` labelled texts of each class, chosen by a digest of
their text over all labelled rows. Null text has no words and fails the base rules, as
every text of fewer than ten words does. Rows stay separate; other columns are kept, result
columns replace columns of the same name. Labels that are null are ignored; a document
with contradicting labels counts once for each. Without labelled rows of both classes
every text that passes the base rules is kept, with probability 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest as digest

from lexmill.llm.common import words_of
from lexmill.llm.langid import sample

PER_CLASS = 1500
LOG_FEATURES = 17
THRESHOLD = 0.5
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = re.compile(r"[#*$%&|<>]")  # fixed values
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                   0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that the text holds twice or more, the first one included.
    Digests find the candidates; their words decide."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = sum(codes[i : i + n] * _ODD[i] for i in range(window))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    suspects = order[np.r_[same, False] | np.r_[False, same]]
    seen: dict[tuple, list[int]] = {}
    for at in suspects.tolist():
        seen.setdefault(tuple(words[at : at + window]), []).append(at)
    covered = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            np.add.at(covered, places, 1)
            np.add.at(covered, np.array(places) + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    words = words_of(text)
    if not words:
        return 0, 0, len(_SYMBOLS.findall(text or "")), 0, 0
    lines = [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.split()]
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    return (len(words), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words))


SHIFT = np.uint64(64 - LOG_FEATURES)
ORDERS = (4, 5)


def features(words: list[bytes]) -> np.ndarray:
    """Places of all features of a text, with repeats: words, word pairs, and n-grams of
    the bytes of its lower-cased words between single spaces."""
    if not words:
        return np.zeros(0, np.int32)
    low = b" ".join(words).lower()
    codes = np.fromiter(map(digest, low.split(b" ")), np.uint64, len(words))
    made = [codes, codes[:-1] * _ODD[0] + codes[1:] * _ODD[1]]
    text = np.frombuffer(b" " + low + b" ", np.uint8).astype(np.uint64)
    for order in ORDERS:
        n = max(len(text) - order + 1, 0)
        code = text[:n].copy()
        for i in range(1, order):
            code = (code << np.uint64(8)) | text[i : i + n]
        made.append((code + np.uint64(order)) * _ODD[2])
    return (np.concatenate(made) >> SHIFT).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float  # of the calibration
    offset: float

    def probability(self, value: float) -> float:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * value + self.offset, -50, 50)))


def _rows(labelled: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            for text in batch.column("_t").to_pylist():
                places = features(words_of(text))
                k, n = np.unique(places, return_counts=True)
                keys.append(k.astype(np.int32).tobytes())
                values.append((n / max(len(places), 1)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_l"), batch.column("_h"), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                ["label", "hash", "keys", "values"],
            )

    return labelled.select("_l", "_h", "_t").mapInArrow(
        make, "label int, hash long, keys binary, values binary"
    )


SCALE = 40.0


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
          label: str = "quality", per_class: int = PER_CLASS) -> Model:
    known = labels.where(F.col(label).isin(0, 1)).select(
        F.col(key).alias("_k"), F.col(label).cast("int").alias("_label")
    ).distinct()
    keyed = docs.select(F.col(key).alias("_k"), F.col(text).alias("_text"))
    # Which rows of the sample: ids and digests only are joined with the labels.
    hashed = keyed.where("_text is not null").select("_k", F.xxhash64("_text").alias("_text"))
    small = hashed.join(known, "_k").withColumn("_text", F.col("_text").cast("string"))
    chosen = sample(small, "_text", "_label", per_class).select(
        F.col("_l"), F.col("_h"), F.col("_t").cast("long").alias("_digest")
    )
    rows = keyed.withColumn("_digest", F.xxhash64("_text")).join(F.broadcast(chosen), "_digest")
    rows = rows.select("_l", F.col("_text").alias("_t"), "_h").dropDuplicates(["_l", "_h"])
    found = sorted(_rows(rows).collect(), key=lambda r: (r.hash, r.label))
    classes = {r.label for r in found}
    if classes != {0, 1}:
        return Model(np.zeros(1 << LOG_FEATURES, np.float32), 0.0, 0.0, 50.0)
    data = [(np.frombuffer(r["keys"], np.int32), np.frombuffer(r["values"], np.float32) * SCALE) for r in found]
    wanted = np.array([r.label for r in found], float)
    held = np.array([i % 4 == 3 for i in range(len(found))])
    if len(set(wanted[held])) < 2 or len(set(wanted[~held])) < 2:
        held[:] = True
        fitted = np.ones(len(found), bool)
    else:
        fitted = ~held
    weights, bias = _fit([data[i] for i in np.flatnonzero(fitted)], wanted[fitted])
    values = np.array([weights[k] @ v + bias for k, v in data])
    slope, offset = _calibrate(values[held], wanted[held])
    return Model((weights * SCALE).astype(np.float32), bias, slope, offset)


def _fit(rows: list, wanted: np.ndarray, epochs: int = 12, rate: float = 0.5, decay: float = 1e-5):
    """Logistic regression by stochastic gradient steps scaled per feature."""
    weights, squares, bias = np.zeros(1 << LOG_FEATURES), np.full(1 << LOG_FEATURES, 1e-2), 0.0
    share = len(wanted) / (2.0 * np.array([(wanted == 0).sum(), (wanted == 1).sum()]))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            k, v = rows[i]
            p = 1.0 / (1.0 + np.exp(-np.clip(weights[k] @ v + bias, -50, 50)))
            error = (p - wanted[i]) * share[int(wanted[i])]
            slope = error * v + decay * weights[k]
            squares[k] += slope * slope
            weights[k] -= rate * slope / np.sqrt(squares[k])
            bias -= 0.05 * error
    return weights, bias


def _calibrate(values: np.ndarray, wanted: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through held-out values, with smoothed
    targets."""
    n1, n0 = wanted.sum(), (1 - wanted).sum()
    target = np.where(wanted == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * values + offset, -50, 50)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * values).sum() + 1e-3 * (slope - 1), (p - target).sum()])
        h = np.array([[(w * values * values).sum() + 1e-3, (w * values).sum()], [(w * values).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        slope, offset = slope - np.clip(step[0], -1, 1), offset - np.clip(step[1], -1, 1)
    return float(slope), float(offset)


RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()),
       T.StructField("kept", T.BooleanType())]
)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds the counts, ``base_failed``, ``probability`` and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held = [c for c in docs.columns if c not in RESULT.names]
    schema = T.StructType([*(docs.schema[c] for c in held), *RESULT.fields])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = []
            for body in batch.column(text).to_pylist():
                found = counts(body)
                n, repeats = found[0], found[4]
                failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
                places = features(words_of(body))
                mean = float(model.weights[places].sum(dtype=np.float64)) / max(len(places), 1)
                p = float(model.probability(mean + model.bias))
                rows.append((*found, failed, p, not failed and p >= threshold))
            columns = list(zip(*rows)) or [()] * len(RESULT)
            made = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in held), *made], [*held, *RESULT.names]
            )

    return docs.mapInArrow(apply, schema)
