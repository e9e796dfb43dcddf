"""Spelling variants: words one inserted, deleted or replaced code point apart.

Permuterm rotations: a word is closed by a terminator, and all its rotations are made. Turned so
that the edited character comes last, words that differ in it share the rest as a prefix:
``brown`` and ``brawn`` are ``wn$bro`` and ``wn$bra``, and ``wn$br`` itself is the whole rotation of
``brwn``, from which the character is missing. Each rotation therefore goes to two places of
the sorted order: to itself, and to its prefix that skips the edited character. Equal places lie
together and are scanned as a group. A place fixes all but one character, so a group holds at most one
word per character of the alphabet and one more; no group grows with the number of words.

Each pair differing by a replacement meets at one place. A word and what is left without one
character of a run of equal ones (``aab``, ``ab``) meet at every character of that run; only the first
counts. Groups give every member its number of neighbours and the best of them, no pairs
are made; sums and bests are then put together by word.

Words are compared by code point, without folding case. Null words take no part, repeated
words count with the sum of their ``n``, words that hold the terminator (U+0001) have no
neighbours. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import written

END = "\u0001"
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, text: str = "text", name: str = "run") -> DataFrame:
    """Every maximal run of letters of every text, A-Z in lower case; a null text has none."""
    found = docs.withColumn(name, F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))))
    lowered = F.when(F.col(name).rlike("[A-Z]"), F.translate(F.col(name), UPPER, LOWER)).otherwise(F.col(name))
    return found.withColumn(name, lowered)


def counted(words: DataFrame, word: Column, shortest: int = 5, least: int = 3) -> DataFrame:
    """``word`` and ``n``: words of at least ``shortest`` code points that occur at least
    ``least`` times."""
    found = words.select(word.alias("word")).where(F.length("word") >= shortest)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _places(words: DataFrame) -> DataFrame:
    """``key``, ``c`` (the skipped character, empty where the rotation is whole) and ``n``."""
    marked = F.concat("word", F.lit(END))
    turned = F.transform(
        F.sequence(F.lit(1), F.length(marked)),
        lambda i: F.concat(F.substr(marked, i), F.substr(marked, F.lit(1), i - 1)),
    )
    rotations = words.where(~F.contains("word", F.lit(END))).select("n", F.explode(turned).alias("r"))
    last = F.right(F.col("r"), F.lit(1))
    both = F.array(
        F.struct(F.col("r").alias("key"), F.lit("").alias("c")),
        F.struct(F.left(F.col("r"), F.length("r") - 1).alias("key"), last.alias("c")),
    )
    return rotations.select("n", F.inline(both)).where(F.col("c") != END)


def _met(words: DataFrame) -> DataFrame:
    """For every word of every group of several: ``word``, ``near`` (how many others count here)
    and ``best`` (the other of largest ``n``, the least of several)."""
    own = Window.partitionBy("key")
    groups = _places(words).withColumn("k", F.count(F.lit(1)).over(own)).where("k > 1")
    # Rows of a key are together and sorted already: gathering them moves nothing.
    gathered = groups.groupBy("key").agg(F.collect_list(F.struct("c", "n")).alias("members"))
    cut = F.instr("key", END)
    word = F.concat(F.substr(F.col("key"), cut + 1), F.col("m")["c"], F.left(F.col("key"), cut - 1))
    ranked = F.array_sort(
        F.transform(
            "members",
            lambda m: F.struct(
                (-m["n"]).alias("less"),
                F.concat(F.substr(F.col("key"), cut + 1), m["c"], F.left(F.col("key"), cut - 1)).alias("word"),
            ),
        )
    )
    # The last character of the place: a neighbour that would repeat it is met elsewhere too.
    again = F.right(F.col("key"), F.lit(1))
    several = gathered.select(
        "key", "members", ranked.alias("ranked"),
        F.exists("members", lambda m: m["c"] == "").alias("whole"),
        F.exists("members", lambda m: m["c"] == F.right(F.col("key"), F.lit(1))).alias("repeats"),
    )
    each = several.select("*", F.explode("members").alias("m"))
    replaced = F.size("members") - F.col("whole").cast("int")  # members with a character
    near = F.when(F.col("m")["c"] == "", replaced - F.col("repeats").cast("int")).otherwise(
        replaced - 1 + (F.col("whole") & (F.col("m")["c"] != again)).cast("int")
    )
    first, second = F.col("ranked")[0], F.col("ranked")[1]
    return each.withColumn("word", word).select(
        "word", near.cast("long").alias("near"),
        F.when(first["word"] == F.col("word"), second).otherwise(first).alias("best"),
    )


def neighbours(words: DataFrame) -> DataFrame:
    """Adds ``n_near``, ``near_best`` and ``near_n`` (null without neighbours) to ``word`` and ``n``."""
    whole = written(
        words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words"
    )
    none = F.lit(None).cast("struct<less:bigint,word:string>")
    alone = whole.select("word", "n", F.lit(0).cast("long").alias("near"), none.alias("best"))
    met = _met(whole).select("word", F.lit(None).cast("long").alias("n"), "near", "best")
    found = alone.union(met).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )
    return found.select(
        "word", "n", "n_near", F.col("best")["word"].alias("near_best"), (-F.col("best")["less"]).alias("near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for every word that has a ``form``: the end of its chain of forms,
    which must not have cycles. Each round follows two ways at once, so the rounds grow with
    the logarithm of the longest chain."""
    now = written(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = written(
            now.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
            ),
            "roots",
        )
        if after.where("_moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form`` (the near word of largest ``n``, the least of several, if that
    ``n`` is at least ``factor`` times the word's), ``form_n`` and ``root``. ``factor`` is 2 or more,
    so forms rise and chains end."""
    if factor < 2:
        raise ValueError("factor must be 2 or more")
    near = neighbours(words)
    rises = F.col("near_n") >= factor * F.col("n")
    found = written(
        near.select(
            "word", "n", "n_near", F.when(rises, F.col("near_best")).alias("form"),
            F.when(rises, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(found)
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
