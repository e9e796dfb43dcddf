"""Similarity join on word shingles: adaptive prefixes with several required matches.

A document is its set of distinct shingles, as 64-bit digests. Two documents link when the
Jaccard similarity of their sets reaches the threshold. In any order common to
all documents, two linked sets share at least ``m`` of the first ``n - ceil(t * n) + m`` of
their ``n`` shingles; ``m`` is free for each document, and a pair needs the smaller of its two
``m``. Here ``m`` grows with the estimated cost of a document's candidates: with the length
of its prefix, and with the frequent shingles in it. A longer prefix with more required
matches then replaces verifications.

The order puts frequent shingles last. Which are frequent is counted over the whole
corpus: tasks pass on what they meet ``LOCAL`` times or more, and the ``HEAD`` most frequent
make the (broadcast, bounded) head of the order; the rest is ordered by digest. The order
decides costs only, never results.

Documents of equal sets form a class first and go on as one. Classes are then linked
in rounds. In the star rounds every class is verified against one other class, always the
least one of a shingle's list, so a group of thousands of near copies costs a verification
each, not one per pair. The first round takes the one that most others meet, the class's
leader. The last round takes all pairs of a list that are still in different components,
except those inside the list's largest component.

Variants of one text that are too far from each other to link share nearly all of their
shingles, prefixes too. Where ``CROWD`` or more of one leader are in several components, they
are therefore compared by their differences from the leader's set, of size ``d``, in star rounds
of their own before their pairs are taken: two
sets link when their differences differ in at most ``h = (1 - t) / (1 + t) * (n1 + n2)``
places, so the differences share at least ``(d1 + d2 - h) / 2``, and the same prefixes with
several required matches apply to them. Where this bound is not positive, both link with the
leader (for ``t`` of a third or more; below it there are no crowds), which the first round has
found. No link between different components is lost.

Documents of fewer words than a shingle are one shingle, those without words are linked
with nothing. Null text has no words. A class is linked under a number of its own (64 bits of
its digest), so rows of a null or repeated id are linked each by its own text. Ids are only labels, the
least of a class or component; a null id counts as larger than all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import bitmap, number_id, release, trimmed, words_of
from lexmill.llm.graphs import components
from lexmill.llm.substrings import _FIRST, codes_of, mixed, rolled
from lexmill.session import written

LOCAL = 3
HEAD = 1 << 19
BLOCK = 1 << 21  # shingles that a task counts at a time
PER_MATCH = 8  # prefix shingles for each further required match
MOST_MATCHES = 12
STARS = 2
INNER_STARS = 5
CROWD = 64
LOG_BITS = 24


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingles; A-Z are lower-cased."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return np.zeros(0, np.uint64)
    codes = codes_of(words)
    if len(words) < size:
        return mixed(rolled(codes, len(words), _FIRST) + np.uint64(len(words)))
    return np.unique(rolled(codes, size, _FIRST))


def _frequent(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The head of the order: shingles (sorted) and their estimated counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held, total = [], 0

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = n >= LOCAL
            return pa.RecordBatch.from_arrays([pa.array(keys[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["token", "n"])

        for batch in batches:
            for text in batch.column("_t").to_pylist():
                held.append(shingles(text, size))
                total += len(held[-1])
            if total > BLOCK:
                yield out()
                held, total = [], 0
        yield out()

    found = texts.select("_t").mapInArrow(trimmed(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    head = found.orderBy(F.desc("n"), "token").limit(HEAD).toArrow()
    keys = head["token"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], head["n"].to_numpy()[order]


def needed(n: int, threshold: int) -> int:
    """Least overlap of a set of ``n`` with any linked one; ``threshold`` in percent."""
    return -(-threshold * n // 100)


def prefix(found: np.ndarray, threshold: int, head: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """First shingles of a set in the common order, and how many a partner has to share."""
    n = len(found)
    if not n:
        return found, 0
    rank = np.zeros(n, np.int64)
    if len(head):
        at = np.minimum(np.searchsorted(head, found), len(head) - 1)
        rank = np.where(head[at] == found, counts[at], 0)
    order = np.lexsort((found, rank))
    short = n - needed(n, threshold) + 1
    frequent = int((rank[order[:short]] > 0).sum())
    matches = max(1, min(1 + short // PER_MATCH + frequent, MOST_MATCHES, needed(n, threshold)))
    return found[order[: short + matches - 1]], matches


def _classes(texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """``doc``, ``hash`` (of the text), ``n``, ``class`` (digest of the set), ``m`` and ``prefix`` of every row."""
    shared = texts.sparkSession.sparkContext.broadcast(_frequent(texts, size))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        head, counts = shared.value
        for batch in batches:
            ns, classes, ms, prefixes = [], [], [], []
            for text in batch.column("_t").to_pylist():
                found = shingles(text, size)
                first, matches = prefix(found, threshold, head, counts)
                ns.append(len(found))
                classes.append(md5(found.tobytes()).digest() if len(found) else None)
                ms.append(matches)
                prefixes.append(first.view(np.int64))
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_d"), batch.column("_h"), pa.array(ns, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(ms, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc", "hash", "n", "class", "m", "prefix"],
            )

    return written(texts.mapInArrow(trimmed(make), "doc long, hash long, n long, class binary, m int, prefix array<long>"), "shingles")


def _number(digests) -> np.ndarray:
    """Numbers of classes from their digests."""
    return np.frombuffer(b"".join(d[:8] for d in digests), ">i8").astype(np.int64)


def _sets(reps: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``rep`` and ``set`` of the classes ``rep`` asked for (and of a few more), made again from the
    texts of their least documents, which a bitmap tells. Each class once."""
    keys = classes.join(reps.distinct(), "rep", "left_semi").select(F.xxhash64("first.doc", "first.hash").alias("k"))
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(keys, "k", LOG_BITS))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(bits.value.has(batch.column("_x").to_numpy().view(np.uint64))))
            made = [m for m in (shingles(t, size).tobytes() for t in part.column("_t").to_pylist()) if m]
            reps = _number(md5(m).digest() for m in made)
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(made, pa.binary())], ["rep", "set"])

    found = texts.withColumn("_x", F.xxhash64("_d", "_h")).mapInArrow(trimmed(sets), "rep long, set binary")
    return found.groupBy("rep").agg(F.any_value("set").alias("set"))


def _with_sets(pairs: DataFrame, a: str, b: str, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Adds the sets ``x`` and ``y`` of the classes ``a`` and ``b``."""
    found = _sets(pairs.select(F.explode(F.array(a, b)).alias("rep")), classes, texts, size)
    left = found.select(F.col("rep").alias(a), F.col("set").alias("x"))
    right = found.select(F.col("rep").alias(b), F.col("set").alias("y"))
    return pairs.join(left, a).join(right, b).select(a, b, "x", "y")


def _both(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column("x"), batch.column("y")):
        yield np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """Pairs (``a``, ``b``) that reach the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in _both(batch):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= threshold * (len(x) + len(y) - both))
            part = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    return _with_sets(pairs, "a", "b", classes, texts, size).mapInArrow(trimmed(check), "a long, b long")


def _differences(crowds: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``rep``, ``crowd``, ``n`` (of the member's set) and ``tokens``, the difference between the member's
    set and its leader's."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(len(x), np.setxor1d(x, y, assume_unique=True).view(np.int64)) for x, y in _both(batch)]
            flat = np.concatenate([d for _, d in made]) if made else np.zeros(0, np.int64)
            ends = np.cumsum([0, *(len(d) for _, d in made)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("crowd"), pa.array([n for n, _ in made], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["rep", "crowd", "n", "tokens"],
            )

    found = _with_sets(crowds, "rep", "crowd", classes, texts, size)
    return written(found.mapInArrow(trimmed(differ), "rep long, crowd long, n long, tokens array<long>"), "differences")


def _rare_first(differences: DataFrame, threshold: int) -> DataFrame:
    """``rep``, ``crowd``, ``n``, ``d`` and the first ``token``s of each difference with their ``pos``, those rare
    in the crowd first."""
    tokens = differences.select("rep", "crowd", "n", F.size("tokens").cast("long").alias("d"), F.explode("tokens").alias("token"))
    often = tokens.groupBy("crowd", "token").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("often", "token")) - 1
    # A partner's difference is at most (1 - t) / t * n shorter, and one more for the second match.
    first = tokens.join(often, ["crowd", "token"]).withColumn("pos", place).where(
        (F.col("pos") - 1) * threshold <= F.col("n") * (100 - threshold)
    )
    return written(first.select("rep", "crowd", "n", "d", "token", "pos"), "inner")


def _linked_inside(pairs: DataFrame, differences: DataFrame, threshold: int) -> DataFrame:
    """Pairs (``a``, ``b``) of a crowd that link, by their differences from the leader alone: two sets
    differ where these do."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
            apart = np.fromiter((len(set(p) ^ set(q)) for p, q in zip(x, y)), np.int64, len(x))
            good = apart * (100 + threshold) <= batch.column("sizes").to_numpy() * (100 - threshold)
            part = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    left = differences.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("x"))
    right = differences.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"), "x", "y")
    return written(both.mapInArrow(trimmed(check), "a long, b long"), "links")


def _inside(differences: DataFrame, links: DataFrame | None, labels: DataFrame, threshold: int) -> tuple[DataFrame | None, DataFrame]:
    """Links within crowds, joined to ``links``, and the labels they lead to. Star rounds first: every
    member is compared with one other, a pivot of the token lists they share, another pivot each
    round. They join most of a dense crowd; all pairs are then taken between what is left apart."""
    scale = 100 + threshold
    sizes = (F.col("n") + F.col("other_n")) * (100 - threshold)
    tokens = _rare_first(differences, threshold)
    near = (F.col("n") * 100 >= F.col("other_n") * threshold) & (F.col("other_n") * 100 >= F.col("n") * threshold)

    def within(of: str, other: str):
        places = 2 * (F.col(f"{of}pos") - 1) - F.col(f"{of}d") + F.col(f"{other}d")
        return places * scale <= sizes

    possible = near & within("", "other_") & within("other_", "")
    two = (F.col("d") + F.col("other_d") - 2) * scale > sizes
    least = F.when(two, 2).otherwise(1)
    for turn in range(INNER_STARS + 1):
        label = labels.withColumnRenamed("node", "rep")
        own = tokens.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        if turn < INNER_STARS:
            columns = ["rep", "n", "d", "pos", "component"]
            first = F.struct(F.xxhash64("rep", F.lit(turn)).alias("rank"), *columns)
            pivots = own.groupBy("crowd", "token").agg(
                F.min(first).alias("p"), F.min("component").alias("lo"), F.max("component").alias("hi")
            ).where("lo <> hi").select("crowd", "token", *[F.col(f"p.{c}").alias(f"other_{c}") for c in columns])
            met = own.join(pivots, ["crowd", "token"]).where(possible & (F.col("component") != F.col("other_component")))
            shared = met.groupBy("rep", "other_rep").agg(F.count(F.lit(1)).alias("k"), F.min(least).alias("least"))
            best = shared.where("k >= least").groupBy("rep").agg(
                F.max_by("other_rep", F.struct("k", "other_rep")).alias("pivot")
            )
            pairs = best.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
        else:
            pairs = _pairs(_across(own, ["crowd", "token"]).where(possible), least)
        found = _linked_inside(written(pairs, "pairs"), differences, threshold)
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return links, labels


def _across(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of rows of equal ``keys`` and different components, each once, with the second
    one's columns as ``other_``."""
    sizes = rows.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("k"))
    most = sizes.groupBy(*keys).agg(
        F.max_by("component", F.struct("k", "component")).alias("main"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").drop("parts")
    several = rows.join(most, keys)
    right = several.select(*keys, *(F.col(c).alias(f"other_{c}") for c in rows.columns if c not in keys))
    return several.where("component <> main").join(right, keys).where(
        "component <> other_component and (other_component = main or rep < other_rep)"
    )


def _pairs(met: DataFrame, least) -> DataFrame:
    """Pairs that meet as often as ``least`` says."""
    return (
        met.groupBy(F.least("rep", "other_rep").alias("a"), F.greatest("rep", "other_rep").alias("b"))
        .agg(F.count(F.lit(1)).alias("k"), F.min(least).alias("least"))
        .where("k >= least").select("a", "b")
    )


def link(docs: DataFrame, size: int, threshold: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``n_shingles``, ``class_id`` (least document of the same set), ``component_id``,
    ``hash`` (of the text) and ``first`` (least ``doc`` and ``hash`` of the component, null without
    words) of every row; ``threshold`` in percent."""
    spark = docs.sparkSession
    texts = docs.select(number_id(key).alias("_d"), F.col(text).alias("_t"), F.xxhash64(F.col(text)).alias("_h"))
    rows = _classes(texts, size, threshold)
    full = rows.where("class is not null")
    classes = written(
        full.groupBy("class").agg(
            F.min(F.struct("doc", "hash")).alias("first"), F.max("n").alias("n"), F.max("m").alias("m"),
            F.any_value("prefix").alias("prefix"),
        ).withColumn("rep", F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("long")),
        "classes",
    )
    tokens = classes.select("rep", "n", "m", F.posexplode("prefix").alias("pos", "token"))
    lists = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    live = written(tokens.join(lists.select("token"), "token"), "prefixes")

    def near(other: str):
        return (F.col("n") * 100 >= F.col(other) * threshold) & (F.col(other) * 100 >= F.col("n") * threshold)

    links = None
    labels = spark.createDataFrame([], "node long, component long")
    for star in range(STARS + 1):
        label = labels.withColumnRenamed("node", "rep")
        own = live.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        if star < STARS:
            rank = F.xxhash64("rep", F.lit(star)) if star else F.col("rep")
            first = F.struct(rank.alias("rank"), "rep", "n", "component")
            pivots = own.groupBy("token").agg(
                F.min(first).alias("p"), F.min("component").alias("lo"), F.max("component").alias("hi")
            ).where("lo <> hi").select(
                "token", F.col("p.rep").alias("pivot"), F.col("p.n").alias("other_n"), F.col("p.component").alias("other")
            )
            met = own.join(pivots, "token").where(near("other_n") & (F.col("component") != F.col("other")))
            shared = met.groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("k"), F.max("m").alias("m")).where("k >= m")
            if star:
                best = shared.groupBy("rep").agg(F.max_by("pivot", F.struct("k", "pivot")).alias("pivot"))
            else:
                shared = written(shared, "shared")
                heard = shared.groupBy("pivot").agg(F.count(F.lit(1)).alias("k"))
                best = shared.select("rep", "pivot").join(heard, "pivot").groupBy("rep").agg(
                    F.max_by("pivot", F.struct("k", "pivot")).alias("pivot")
                )
                best = leaders = written(best, "leaders")
            pairs = best.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
        else:
            led = leaders.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            crowded = led.groupBy("pivot").agg(
                F.count(F.lit(1)).alias("k"), F.min("component").alias("lo"), F.max("component").alias("hi")
            ).where((F.col("k") >= CROWD) & F.expr("lo <> hi") & F.lit(3 * threshold > 100)).select("pivot")
            crowds = written(
                leaders.join(crowded, "pivot").select("rep", F.col("pivot").alias("crowd")), "crowds"
            )
            if not crowds.isEmpty():
                links, labels = _inside(_differences(crowds, classes, texts, size), links, labels, threshold)
                label = labels.withColumnRenamed("node", "rep")
                own = live.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            scale = 100 + threshold
            met = _across(own.join(crowds, "rep", "left"), ["token"])
            matches = F.least("m", "other_m")

            def reached(of: str):  # the place of the last required match in one of the sets
                other = "other_n" if of == "" else "n"
                after = F.col(f"{of}pos") - matches + 1
                return after * scale <= F.col(f"{of}n") * 100 - F.col(other) * threshold

            apart = F.coalesce(F.col("crowd") != F.col("other_crowd"), F.lit(True))
            pairs = _pairs(met.where(near("other_n") & apart & reached("") & reached("other_")), matches)
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            continue
        found = written(_verified(pairs, classes, texts, size, threshold), "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    members = classes.select("class", "rep", "first").join(
        labels.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("component", F.coalesce("component", "rep"))
    leasts = members.groupBy("component").agg(F.min("first").alias("least"))
    named = members.join(leasts, "component").select("class", F.col("first.doc").alias("class_id"), "least")
    return (
        rows.select("doc", "hash", F.col("n").alias("n_shingles"), "class").join(named, "class", "left")
        .select("doc", "n_shingles", F.coalesce("class_id", "doc").alias("class_id"),
                F.coalesce("least.doc", "doc").alias("component_id"), "hash", F.col("least").alias("first"))
    )


def representatives(docs: DataFrame, size: int, similarity: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group the document with the least id, and of several with that id the one whose
    text has the least digest. Rows that repeat an id and its text are one document and stay or go
    together; rows without an id are a document each, so one of equal ones stays."""
    found = written(link(docs, size, round(100 * similarity), key, text), "groups")
    gone = written(
        found.where("first is not null and (doc <> first.doc or hash <> first.hash)").select("doc", "hash").distinct(), "gone"
    )
    keyed = docs.withColumns({"_doc_key": number_id(key), "_hash": F.xxhash64(F.col(text))})
    left = lambda rows: rows.join(
        gone, (rows["_doc_key"] == gone["doc"]) & (rows["_hash"] == gone["hash"]), "left_anti")
    without = found.where(f"first is not null and doc = first.doc and hash = first.hash and doc = {(1 << 63) - 1}")
    again = written(without.groupBy("hash").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "again")
    if again.isEmpty():
        return left(keyed).select(*docs.columns)
    equal = F.col(key).isNull() & F.col("_repeated").isNotNull()
    marked = left(keyed).join(again.select(F.col("hash").alias("_hash"), F.lit(1).alias("_repeated")), "_hash", "left")
    one = marked.where(equal).dropDuplicates(["_hash"])
    return marked.where(~equal).unionByName(one).select(*docs.columns)
