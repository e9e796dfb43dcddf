"""Approximate nearest neighbours by cosine: NN-descent, and greedy graph search.

Equal vectors are one point first. A start graph comes from a few random projections:
points are ordered by a projection and compared with those of their block. Each round of
NN-descent then brings the neighbours of a point, and the points it is a neighbour of,
together, and tells each of them about better neighbours among the others; pairs that
met in an earlier round are skipped. A popular point's list is split at random into parts of
bounded size, others each round, so no point is dropped and no part grows with the data.
Rounds go on until at most ``SETTLED`` of the graph's entries are new.

A query walks the graph: in each round the best points of its beam that were not yet
opened are opened, their neighbours in the graph (both directions) are measured,
and the beam keeps the best, until no query has a point in its beam that is not opened. It starts from its own point where the query is one of the
points, and from ``ENTRIES`` fixed points. Points travel as one byte per component; the last
beam is measured again on the original vectors in double precision.

Rows with a null id and vectors that are null, zero, or hold a null or a component that is not
finite take no part, nor do vectors of another length than the most frequent one, as they have
no cosine with the others. Very large and very small vectors count by their direction. Of equal vectors
the smaller ids come first, and a query never finds its own row. Rows that repeat an id
count once, with their least vector. Fewer points than asked for give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import written

NEIGHBOURS = 24
SETTLED = 0.001
MOST_ROUNDS = 200  # only guards against a loop that does not end; reaching it is an error
PROJECTIONS = 3
BLOCK = 256
PART = 64  # members that are compared in one part
ENTRIES = 64
BEAM = 160
OPENED = 24  # points a query opens in a round
MOST_HOPS = 1000  # a guard as well


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (array of doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    ).groupBy("id").agg(F.min("v").alias("v"))
    # Cosines do not change with length. Powers of two, in two steps, keep every component exact
    # and bring the largest near 1, so that no product overflows or vanishes.
    power = F.floor(F.log2(F.array_max(F.transform("v", lambda x: F.abs(x)))))
    half = F.floor(power / 2)
    fine = fine.withColumns({"_a": F.pow(F.lit(2.0), -half), "_b": F.pow(F.lit(2.0), half - power)}).select(
        "id", F.transform("v", lambda x: x * F.col("_a") * F.col("_b")).alias("v")
    )
    sizes = fine.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("k"))
    most = sizes.orderBy(F.desc("k"), "n").limit(1).collect()
    return fine.where(F.size("v") == (most[0].n if most else 0))


def _packed(v: np.ndarray) -> np.ndarray:
    return np.rint(v * (127.0 / np.abs(v).max(1, keepdims=True))).astype(np.int8)


def _unit(codes: list[bytes] | pa.Array) -> np.ndarray:
    """Unit vectors of packed ones."""
    v = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1).astype(np.float32)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            v = np.array(batch.column("v").to_pylist(), np.float64)
            made = pa.array([row.tobytes() for row in _packed(v)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), made], ["id", "code"])


def points_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points (``id``, ``code``), one for equal vectors under their least id, and the members
    of each point (``point``, ``id``)."""
    vectors = vectors.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    firsts = vectors.groupBy("v").agg(F.min("id").alias("point"))
    points = written(firsts.select(F.col("point").alias("id"), "v").mapInArrow(_pack, "id long, code binary"), "points")
    return points, vectors.join(firsts, "v").select("point", "id")


def _best(pairs: DataFrame, k: int, by: str = "a", to: str = "b") -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("sim"), to)
    return pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def start_graph(points: DataFrame, k: int) -> DataFrame:
    """Pairs (``a``, ``b``, ``sim``) within blocks along random projections."""

    def project(seed: int):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    v = _unit(batch.column("code").to_pylist())
                    along = v @ np.random.default_rng(seed).standard_normal(v.shape[1]).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(along.astype(np.float64))], ["id", "code", "at"])

        return apply

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, codes = [], []

        def out() -> pa.RecordBatch:
            n = len(ids)
            v, names = _unit(codes), np.array(ids, np.int64)
            sims = v @ v.T
            np.fill_diagonal(sims, -2)
            most = min(k, n - 1)
            at = np.argpartition(-sims, most - 1, axis=1)[:, :most] if most > 0 else np.zeros((n, 0), np.int64)
            rows = np.repeat(np.arange(n), at.shape[1])
            flat = at.ravel()
            return pa.RecordBatch.from_arrays(
                [pa.array(names[rows]), pa.array(names[flat]), pa.array(sims[rows, flat].astype(np.float32))], ["a", "b", "sim"]
            )

        for batch in batches:
            for i, c in zip(batch.column("id").to_pylist(), batch.column("code").to_pylist()):
                ids.append(i)
                codes.append(c)
                if len(ids) == 2 * BLOCK:  # the last block of a task is never small
                    keep = ids[BLOCK:], codes[BLOCK:]
                    ids, codes = ids[:BLOCK], codes[:BLOCK]
                    yield out()
                    ids, codes = keep
        if ids:
            yield out()

    made = None
    for seed in range(PROJECTIONS):
        ranged = points.mapInArrow(project(seed), "id long, code binary, at double").repartitionByRange("at", "id").sortWithinPartitions("at", "id")
        part = ranged.select("id", "code").mapInArrow(compare, "a long, b long, sim float")
        made = part if made is None else made.unionByName(part)
    return _best(made.groupBy("a", "b").agg(F.max("sim").alias("sim")), k)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each part against each other: pairs that improve one of them."""
    for batch in batches:
        out = []
        for row in batch.column("members").to_pylist():
            if len(row) < 2:
                continue
            names = np.array([m["id"] for m in row], np.int64)
            worst = np.array([m["worst"] for m in row], np.float32)
            new = np.array([m["new"] for m in row], bool)
            v = _unit([m["code"] for m in row])
            sims = v @ v.T
            good = (sims > worst[:, None]) & (new[:, None] | new[None, :]) & (names[:, None] != names[None, :])
            a, b = np.nonzero(good)
            out.append((names[a], names[b], sims[a, b]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, t) for t in "llf"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "sim"])


def build(points: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """The neighbour graph: (``a``, ``b``, ``sim``), up to ``k`` rows of each point."""
    graph = written(start_graph(points, k).withColumn("new", F.lit(True)), "graph")
    for turn in range(MOST_ROUNDS):
        pairs = graph.select(F.col("a").alias("center"), F.col("b").alias("id"), "new")
        met = pairs.unionByName(
            graph.select(F.col("b").alias("center"), F.col("a").alias("id"), "new")
        ).groupBy("center", "id").agg(F.max("new").alias("new"))
        degrees = met.groupBy("center").agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("any")).where("any")
        worst = graph.groupBy("a").agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("n"))
        known = points.join(
            worst.select(F.col("a").alias("id"), F.when(F.col("n") < k, -2.0).otherwise(F.col("worst")).cast("float").alias("worst")),
            "id", "left",
        ).select("id", "code", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"))
        parts = met.join(degrees.select("center", "n"), "center").withColumn(
            "part", F.pmod(F.xxhash64("center", "id", F.lit(turn)), F.ceil(F.col("n") / PART))
        )
        gathered = parts.join(known, "id").groupBy("center", "part").agg(
            F.collect_list(F.struct("id", "worst", "new", "code")).alias("members")
        )
        better = gathered.select("members").mapInArrow(_meet, "a long, b long, sim float")
        better = better.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("new", F.lit(True))
        old = graph.withColumn("new", F.lit(False))
        joined = old.unionByName(better).groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
        graph = written(_best(joined, k), "graph")
        share = graph.agg(F.avg(F.col("new").cast("double")).alias("share")).first().share
        if (share or 0.0) <= SETTLED:
            return graph
    raise RuntimeError(f"the neighbour graph has not settled in {MOST_ROUNDS} rounds")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of a query with the neighbours of the points it opened."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            names = np.array([m["id"] for m in row["members"]], np.int64)
            sims = _unit([m["code"] for m in row["members"]]) @ _unit([row["query_code"]])[0]
            out.append((np.full(len(names), row["query"], np.int64), names, sims.astype(np.float32)))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, t) for t in "llf"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "point", "sim"])


def _enter(names: list[int], codes: list[bytes]):
    """Similarity of every query with the fixed entry points."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and names:
                sims = _unit(batch.column("query_code").to_pylist()) @ _unit(codes).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("query").to_numpy(), len(names))),
                     pa.array(np.tile(np.array(names, np.int64), batch.num_rows)),
                     pa.array(sims.ravel().astype(np.float32))],
                    ["query", "point", "sim"],
                )

    return apply


def search(queries: DataFrame, points: DataFrame, graph: DataFrame, beam: int = BEAM) -> DataFrame:
    """``query``, ``point`` and approximate ``sim`` of the last beam. ``queries`` has ``query``,
    ``query_code`` and ``own``, the query's own point or null."""
    ends = graph.select("a", "b").union(graph.select("b", "a")).distinct()
    # A popular point's neighbours are kept in parts too; opening it opens all parts.
    parts = ends.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    lists = ends.join(parts, "a").join(points.withColumnRenamed("id", "b"), "b").groupBy(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    ).agg(F.collect_list(F.struct(F.col("b").alias("id"), "code")).alias("members"))
    lists = written(lists.select(F.col("a").alias("point"), "members"), "lists")
    entries = points.orderBy(F.xxhash64("id"), "id").limit(ENTRIES).collect()
    first = queries.select("query", "query_code").mapInArrow(
        _enter([e.id for e in entries], [bytes(e.code) for e in entries]), "query long, point long, sim float"
    )
    own = queries.where("own is not null").select("query", F.col("own").alias("point"), F.lit(2.0).cast("float").alias("sim"))
    state = first.unionByName(own).groupBy("query", "point").agg(F.max("sim").alias("sim"))
    state = written(_best(state.withColumn("open", F.lit(False)), beam, "query", "point"), "beam")
    for _ in range(MOST_HOPS):
        order = Window.partitionBy("query", "open").orderBy(F.desc("sim"), "point")
        marked = state.withColumn("now", ~F.col("open") & (F.row_number().over(order) <= OPENED))
        opened = marked.where("now").select("query", "point").join(queries.select("query", "query_code"), "query")
        seen = opened.join(lists, "point").select("query", "query_code", "members").mapInArrow(_walk, "query long, point long, sim float")
        seen = seen.withColumn("open", F.lit(False))
        after = marked.select("query", "point", "sim", (F.col("open") | F.col("now")).alias("open")).unionByName(seen)
        after = after.groupBy("query", "point").agg(F.max("sim").alias("sim"), F.max("open").alias("open"))
        state = written(_best(after, beam, "query", "point"), "beam")
        if state.where("not open").isEmpty():
            return state.select("query", "point", "sim")
    raise RuntimeError(f"the search has not ended in {MOST_HOPS} hops")


def nearest(rows: DataFrame, wanted, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` of the ``k`` nearest other rows of each row for
    which the condition ``wanted`` holds on its key ``id``."""
    vectors = written(usable(rows, key, vector), "vectors")
    points, members = points_of(vectors)
    members = written(members, "members")
    graph = build(points)
    queries = written(
        members.where(wanted).select(F.col("id").alias("query"), F.col("point").alias("own"))
        .join(points.select(F.col("id").alias("own"), F.col("code").alias("query_code")), "own"), "queries",
    )
    beams = search(queries, points, graph)
    # Of a point with many members the k + 1 least ids can be among the nearest.
    rank = F.row_number().over(Window.partitionBy("point").orderBy("id"))
    few = members.withColumn("_r", rank).where(F.col("_r") <= k + 1).select("point", "id")
    own = queries.select("query", F.col("own").alias("point"))
    found = beams.select("query", "point").union(own).distinct().join(
        few, "point").where("query <> id").select("query", "id")
    left = vectors.select(F.col("id").alias("query"), F.col("v").alias("x"))
    right = vectors.select("id", F.col("v").alias("y"))
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    cosine = dot(F.col("x"), F.col("y")) / (F.sqrt(dot(F.col("x"), F.col("x"))) * F.sqrt(dot(F.col("y"), F.col("y"))))
    scored = found.join(right, "id").join(left, "query").select("query", "id", cosine.alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score"
    )
