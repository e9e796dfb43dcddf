"""Language identification in two steps: the family, then the language within it.

Features are hashed n-grams of one to four bytes of the lower-cased text, in which all
but letters is a space; a text's features are shares, so its length does not matter. A
linear support vector machine per family (one against the rest) gives the family; inside
it, one machine for each pair of languages separates the closely related ones by votes.

The machines are fitted on a bounded sample: at most ``PER_LANGUAGE`` texts of each
language, chosen by a digest of their text over all training rows, each as a whole
and as one short passage of it. All texts are scored whole, in Arrow batches.

A text that is null or has no letter is ``und`` with score 0. Rows stay separate, other
columns are kept; an output column replaces one of the same name. With no training rows
every text is ``und``; with a single language every text with letters is that language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import release, texts_of, trimmed

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE = 600
LOG_FEATURES = 16
ORDERS = (1, 2, 3, 4)
PASSAGE = 80  # bytes of the short passages that are learnt as well
SCALE = 12.0

# Languages of one family, by ISO 639-1 code. Others are their own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; the pattern also finds numerals such as a half."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


@dataclass
class Model:
    """Weights: one column per machine. ``families`` maps a family to its languages."""

    families: dict[str, list[str]]
    columns: list[tuple]  # ("family", name) or ("pair", a, b)
    weights: np.ndarray  # features x columns
    bias: np.ndarray


def _prepared(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each between spaces, and where each begins."""
    parts = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(_FOLD) + b"    " for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.r_[0, np.cumsum(sizes)]


def _grams(buffer: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the hashed n-gram that starts at each byte."""
    code = np.zeros(len(buffer), np.uint32)
    for order in ORDERS:
        shifted = np.zeros(len(buffer), np.uint32)
        shifted[: len(buffer) - order + 1] = buffer[order - 1 :]
        code = code * np.uint32(257) + shifted + np.uint32(1)
        yield (code * _MULTIPLIERS[order - 1]) >> np.uint32(32 - LOG_FEATURES)


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text: places and shares."""
    buffer, _ = _prepared([text])
    keys, counts = np.unique(np.concatenate(list(_grams(buffer))), return_counts=True)
    return keys.astype(np.int32), (counts * (SCALE / len(buffer))).astype(np.float32)


def sample(docs: DataFrame, text: str, lang: str, bound: int) -> DataFrame:
    """At most ``bound`` different texts of each language, by a digest of the text. Copies count
    once; texts above an expected share are dropped before any are brought together."""
    keyed = docs.select(F.col(text).alias("_t"), F.col(lang).alias("_l"))
    keyed = keyed.where("_l is not null and _t is not null").withColumn("_h", F.xxhash64("_t"))
    different = keyed.select("_l", "_h").distinct()
    counts = different.groupBy("_l").agg(F.count(F.lit(1)).alias("_n"))
    share = F.shiftrightunsigned("_h", 1).cast("double") / float(1 << 63)
    few = different.join(F.broadcast(counts), "_l").where(share * F.col("_n") < 2.0 * bound)
    rank = F.row_number().over(Window.partitionBy("_l").orderBy("_h"))
    chosen = few.withColumn("_r", rank).where(F.col("_r") <= bound).select("_l", "_h")
    return keyed.join(F.broadcast(chosen), ["_l", "_h"]).dropDuplicates(["_l", "_h"])


def _features(rows: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, keys, values = [], [], []
            for lang, text in zip(batch.column("_l").to_pylist(), batch.column("_t").to_pylist()):
                if not has_letter(text):
                    continue
                at = max(0, len(text) // 2 - PASSAGE // 2)
                for part in {text, text[at : at + PASSAGE]}:
                    k, v = _counted(part)
                    langs.append(lang)
                    keys.append(k.tobytes())
                    values.append(v.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                ["lang", "keys", "values"],
            )

    return rows.select("_l", "_t").mapInArrow(trimmed(make), "lang string, keys binary, values binary")


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int,
                epochs: int = 8, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """A linear support vector machine by dual coordinate descent (hinge loss)."""
    weights, bias = np.zeros(size, np.float64), 0.0
    alpha = np.zeros(len(rows))
    share = len(signs) / (2.0 * np.maximum([(signs < 0).sum(), (signs > 0).sum()], 1))
    bounds = cost * np.where(signs > 0, share[1], share[0])
    norms = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            keys, values = rows[i]
            slope = signs[i] * (weights[keys] @ values + bias) - 1.0
            new = min(max(alpha[i] - slope / norms[i], 0.0), bounds[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[keys] += step * values
                bias += step
                alpha[i] = new
    return weights, bias


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """The model from labelled rows. The driver gets the features of the sample only."""
    found = _features(sample(docs, text, lang, per_language)).collect()
    found = sorted(found, key=lambda r: (r.lang, bytes(r["keys"]), bytes(r["values"])))
    rows = [(np.frombuffer(r["keys"], np.int32), np.frombuffer(r["values"], np.float32)) for r in found]
    names = np.array([r.lang for r in found], object)
    families: dict[str, list[str]] = {}
    for name in sorted(set(names)):
        families.setdefault(FAMILY.get(name, name), []).append(name)
    of = np.array([FAMILY.get(n, n) for n in names], object)
    columns, machines = [], []
    if len(families) > 1:
        for family in families:
            columns.append(("family", family))
            machines.append(fit_machine(rows, np.where(of == family, 1.0, -1.0), 1 << LOG_FEATURES))
    for members in families.values():
        for a, b in combinations(members, 2):
            own = [i for i, n in enumerate(names) if n in (a, b)]
            columns.append(("pair", a, b))
            signs = np.where(names[own] == a, 1.0, -1.0)
            machines.append(fit_machine([rows[i] for i in own], signs, 1 << LOG_FEATURES))
    weights = np.stack([w for w, _ in machines], 1) if machines else np.zeros((1 << LOG_FEATURES, 0))
    return Model(families, columns, weights.astype(np.float32), np.array([b for _, b in machines]))


def decisions(texts: list[str], model: Model) -> np.ndarray:
    """Values of all machines for each text."""
    buffer, starts = _prepared(texts)
    out = np.zeros((len(texts), len(model.columns)))
    if not len(texts):
        return out
    for grams in _grams(buffer):
        for c in range(len(model.columns)):
            out[:, c] += np.add.reduceat(model.weights[:, c][grams], starts[:-1], dtype=np.float64)
    return out * (SCALE / np.diff(starts))[:, None] + model.bias


def choose(text: str | None, values: np.ndarray, model: Model) -> tuple[str, float]:
    if not text or not model.families or not has_letter(text):
        return UNKNOWN, 0.0
    certain = lambda margin: 1.0 / (1.0 + np.exp(-2.0 * np.clip(margin, -30, 30)))
    families = {c[1]: values[i] for i, c in enumerate(model.columns) if c[0] == "family"}
    family = max(sorted(families), key=families.get) if families else next(iter(model.families))
    score = certain(families[family]) if families else 1.0
    members = model.families[family]
    votes = dict.fromkeys(members, 0)
    margins = dict.fromkeys(members, 0.0)
    for i, c in enumerate(model.columns):
        if c[0] == "pair" and c[1] in votes:
            votes[c[1] if values[i] >= 0 else c[2]] += 1
            margins[c[1]] += values[i]
            margins[c[2]] -= values[i]
    best = max(members, key=lambda m: (votes[m], margins[m]))
    if len(members) > 1:
        score *= certain(margins[best] / (len(members) - 1))
    return best, float(score)


def predict(docs: DataFrame, model: Model, lang_output: str = "lang_pred", score_output: str = "score",
            text: str = "text") -> DataFrame:
    """Adds language and score (0 to 1) of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in (lang_output, score_output)]
    schema = T.StructType(
        [*(docs.schema[c] for c in kept), T.StructField(lang_output, T.StringType()),
         T.StructField(score_output, T.DoubleType())]
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts = texts_of(batch, text)
            values = decisions(texts, held.value)
            found = [choose(t, v, held.value) for t, v in zip(texts, values)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                [*kept, lang_output, score_output],
            )

    return docs.mapInArrow(trimmed(apply), schema)
