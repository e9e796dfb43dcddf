"""Hard negatives by inner product, found with coordinate pruning in length buckets.

Vectors are sorted by length and cut into buckets of ``BUCKET`` rows; a bucket keeps its
longest length and, for every coordinate of the normalised vectors, its rows sorted by it. An
anchor that asks for scores of at least ``t`` skips a bucket whose longest row, were it
parallel, cannot reach ``t``. In other buckets ``t`` is a least cosine ``c``, and a row that reaches it has
each coordinate within ``q * c`` plus or minus ``sqrt((1 - c^2) (1 - q^2))``, ``q`` being the anchor's: a
range in that coordinate's sorted list. The lists of the anchor's ``FOCUS`` largest
coordinates give candidate sets, which are intersected from the narrowest on, and what is left is
verified exactly. Where all ranges are wide the whole bucket is verified, for all such
anchors in one product.

Anchors go round in blocks of at most about ``ANCHORS``, sent to all tasks; a task
walks its buckets from long to short and raises each anchor's threshold to the worst of the best it has
found. Positives come first; their scores then bound the range in which negatives are asked
for. Only the best rows a task found for an anchor leave it.

Components are floor(``SCALE`` * x) in double precision, and scores exact integers. Rows with a null
id, label or vector, or a null or non-finite component, or one of 2^31 and more after
scaling (scores would not fit a long), take no part. Scores beyond a long count as its limits. Rows that
repeat an id count once, with the least label and vector. Vectors of different lengths are
compared as if the shorter ended in zeros; empty ones score 0. Ties go to the smaller id. An empty
table, and anchors without positives or negatives, give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import written

SCALE = 256
LARGEST = 2.0**31
BUCKET = 4096
ANCHORS = 16384  # sent to the tasks at a time, on average
AT_ONCE = 512  # anchors multiplied with a whole bucket at a time
FOCUS = 6
NARROW = 0.125  # share of a bucket up to which candidates are intersected
SLACK = 1e-6  # of rounding in normalised coordinates
LONG = (-(1 << 63), (1 << 63) - 1)


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """``id``, ``label`` and ``v`` (scaled) of the rows that take part."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x * SCALE)
    fine = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    )
    whole = fine.withColumn("v", F.transform("v", lambda x: F.floor(x).cast("double")))
    return whole.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    made = np.zeros((len(vectors), width))
    for row, v in zip(made, vectors):
        row[: len(v)] = v
    return made


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The values of a list column, row by row, without copies."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


class Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray], width: int):
        order = np.argsort(ids)  # so that stable sorts by score leave ties by id
        self.ids, self.labels = ids[order], labels[order]
        self.v = _matrix([vectors[i] for i in order], width)
        lengths = np.linalg.norm(self.v, axis=1)
        self.longest = float(lengths.max())
        unit = self.v / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").astype(np.uint16)
        self.sorted = np.take_along_axis(unit, self.order.astype(np.int64), axis=0)
        self.unit = unit


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole doubles, as longs."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[-1]
    if largest < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if largest < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    found = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return np.clip(found, *LONG).astype(np.int64)


class Anchors:
    """A block of anchors, each with its focus coordinates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.width = max((len(v) for v in vectors), default=0)
        self.fit(self.width)

    def fit(self, width: int) -> None:
        self.v = _matrix(self.vectors, width)
        self.lengths = np.linalg.norm(self.v, axis=1)
        self.unit = self.v / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]
        self.fitted = width


def candidates(anchors: Anchors, bucket: Bucket, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Which rows may reach each anchor's threshold: (anchors, rows). ``None`` for rows means
    the whole bucket; a narrow anchor comes alone."""
    reach = anchors.lengths * bucket.longest
    open_ = np.flatnonzero(least <= reach * (1 + SLACK) + SLACK)
    if not len(open_):
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        c = np.where(reach[open_] > 0, least[open_] / reach[open_], -1.0)
    pruned = c > 0  # a threshold of zero or less bounds no coordinate
    yield_whole = [open_[~pruned]]
    rows, c = open_[pruned], np.minimum(c[pruned], 1.0)
    if len(rows) and anchors.focus.shape[1]:
        focus = anchors.focus[rows]
        q = np.take_along_axis(anchors.unit[rows], focus, axis=1)
        spread = np.sqrt(np.maximum(1 - c * c, 0))[:, None] * np.sqrt(np.maximum(1 - q * q, 0))
        # Rows at least as parallel as c allow any coordinate between the two angles.
        low = np.where(q <= -c[:, None], -1.0, q * c[:, None] - spread) - SLACK
        high = np.where(q >= c[:, None], 1.0, q * c[:, None] + spread) + SLACK
        first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            first[at] = np.searchsorted(bucket.sorted[:, f], low[at], "left")
            last[at] = np.searchsorted(bucket.sorted[:, f], high[at], "right")
        narrow = (last - first).min(axis=1) <= NARROW * len(bucket.ids)
        yield_whole.append(rows[~narrow])
        for i in np.flatnonzero(narrow):
            kept = None
            for j in np.argsort(last[i] - first[i], kind="stable"):
                found = np.sort(bucket.order[first[i, j] : last[i, j], focus[i, j]])
                kept = found if kept is None else np.intersect1d(kept, found, assume_unique=True)
                if not len(kept):
                    break
            if len(kept):
                yield rows[i : i + 1], kept
    else:
        yield_whole.append(rows)
    wide = np.concatenate(yield_whole)
    for i in range(0, len(wide), AT_ONCE):
        yield wide[i : i + AT_ONCE], None


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best, ties by the order they have, which is by id."""
    if len(scores) > 4 * k:
        worst = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= worst)
        scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Best:
    """The best rows found so far for every (anchor, slot)."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            both = np.concatenate([self.scores[at], scores]), np.concatenate([self.ids[at], ids])
            self.scores[at], self.ids[at] = _first(*both, self.k)

    def worst(self, at: int) -> float:
        return float(self.scores[at][-1]) if len(self.scores[at]) == self.k else -math.inf


def _buckets(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[Bucket]:
    """Buckets as they lie in the table, one per run of rows with one number."""
    held: list[pa.RecordBatch] = []

    def made() -> Bucket:
        ids, labels = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("id", "label"))
        vectors = [v for b in held for v in _lists(b.column("v"))]
        width = max(anchors.fitted, max((len(v) for v in vectors), default=0))
        if width > anchors.fitted:
            anchors.fit(width)
        return Bucket(ids, labels, vectors, width)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            room = BUCKET - sum(b.num_rows for b in held)
            held.append(batch.slice(at, room))
            at += room
            if sum(b.num_rows for b in held) == BUCKET:
                yield made()
                held = []
    if held:
        yield made()


def _search(index: DataFrame, shared, same: bool, k: int) -> DataFrame:
    """Best rows of every task: ``anchor``, ``slot``, ``id``, ``score``.

    With ``same`` the slot is 0 and rows have the anchor's label. Otherwise slots are the
    anchor's positives, and rows have another label and a score in the positive's range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, ranges = shared.value
        anchors = Anchors(ids, labels, vectors)
        slots = np.arange(len(ids) + 1) if same else np.cumsum([0] + [len(r) for r in ranges])
        best = Best(int(slots[-1]), k)
        lowest = np.full(len(ids), -math.inf) if same else np.array([min((r[0] for r in rs), default=math.inf) for rs in ranges])
        for bucket in _buckets(batches, anchors):
            for some, rows in candidates(anchors, bucket, lowest):
                v = bucket.v if rows is None else bucket.v[rows]
                ids_of = bucket.ids if rows is None else bucket.ids[rows]
                labels_of = bucket.labels if rows is None else bucket.labels[rows]
                for a, scores in zip(some, exact(anchors.v[some], v)):
                    fits = (labels_of == labels[a]) == same
                    if same:
                        fits &= (ids_of != ids[a]) & (scores >= lowest[a])
                        best.add(a, *_first(scores[fits], ids_of[fits], k))
                        lowest[a] = best.worst(a)
                        continue
                    fits &= scores >= lowest[a]
                    scores, found = scores[fits], ids_of[fits]
                    if not len(scores):
                        continue
                    asked = []
                    for at, (low, high) in zip(range(slots[a], slots[a + 1]), ranges[a]):
                        inside = (scores >= low) & (scores <= high)
                        best.add(at, *_first(scores[inside], found[inside], k))
                        asked.append(max(low, best.worst(at)))
                    lowest[a] = min(asked)
        sizes = [len(s) for s in best.scores]
        owner = np.repeat(np.arange(len(ids)), np.diff(slots))
        slot = np.arange(slots[-1]) - np.repeat(slots[:-1], np.diff(slots))
        columns = [np.repeat(ids[owner], sizes), np.repeat(slot, sizes)]
        columns += [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (best.ids, best.scores)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "slot", "id", "score"])

    found = index.mapInArrow(run, "anchor long, slot long, id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _range(score: int, low: int, high: int) -> tuple[float, float]:
    """Whole scores s with low * score <= 100 * s <= high * score; infinite where there are none."""
    least, most = -(-low * score // 100), high * score // 100
    return (least, most) if least <= most else (math.inf, -math.inf)


def mine(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """For every anchor (a condition on ``id``) and each of its ``positives`` best rows of the same
    label, the ``negatives`` best of another label whose score lies between ``low`` and
    ``high`` percent of the positive's."""
    spark = rows.sparkSession
    fine = written(usable(rows, key, label, vector), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    # Long rows first, in ranges: a file holds rows of similar length, a task reads it from the top.
    index = written(fine.withColumn("_l", -length).repartitionByRange("_l").sortWithinPartitions("_l", "id").drop("_l"), "buckets")
    anchors = fine.where(is_anchor)
    rounds = max(1, math.ceil(anchors.count() / ANCHORS))
    found = None
    for n in range(rounds):
        block = anchors.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == n).orderBy("id").toArrow()
        if block.num_rows > 2 * ANCHORS:
            raise ValueError("anchors are dealt unevenly")
        ids, labels = block["id"].to_numpy(), block["label"].to_numpy()
        vectors = [v for chunk in block["v"].chunks for v in _lists(chunk)]
        shared = spark.sparkContext.broadcast((ids, labels, vectors, None))
        near = written(_search(index, shared, True, positives), "positives")
        shared.unpersist()
        place = {int(a): i for i, a in enumerate(ids)}
        ranges: list[list] = [[] for _ in place]
        for row in near.orderBy("anchor", "rank").collect():  # at most ``positives`` an anchor
            ranges[place[row.anchor]].append(_range(row.score, low, high))
        shared = spark.sparkContext.broadcast((ids, labels, vectors, ranges))
        far = _search(index, shared, False, negatives)
        named = near.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        made = written(
            far.join(named, ["anchor", "slot"]).select(
                F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            ),
            "negatives",
        )
        shared.unpersist()
        found = made if found is None else found.union(made)
    return found
