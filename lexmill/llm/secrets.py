"""Secret scans: fixed patterns, and a battery of randomness tests. Spark functions only.

Every text gets its base spans (three patterns) and, from the battery, spans of strings
that look drawn at random. A candidate is a maximal run of 20 or more characters
``A-Za-z0-9+/_=-`` holding a digit and a letter. Its encoding is inferred (hex, base32,
base64) and tested:

* alphabet uniformity: chi-squared over the symbols of the encoding;
* runs: changes between digit, upper and lower case, against what identifiers made of
  words show (``ORDINARY_SWITCH`` per step); its tail is the p-value of the candidate;
* serial correlation of neighbouring symbols.

A candidate passes if neither uniformity nor independence is refuted and its p-value is
under the Benjamini-Hochberg threshold of its own length band over the whole corpus, as
short strings have less power and other base rates than long ones.

Null and empty texts, and texts without matches, have empty span lists. Rows are never
merged: repeated rows are scanned one by one. Columns other than the text are kept; the
result columns named in each function replace columns of the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order of ties.
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

BANDS = (20, 24, 32, 48, 64, 128)  # lower ends of the length bands
ORDINARY_SWITCH = 0.15  # class changes per step in ordinary identifiers
REFUTED = 3.5  # standard deviations from random that refute a test
FDR = 0.001
BINS = 400  # of -ln(p), a tenth each
BLOCK = 256

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums(lengths: Column) -> Column:
    """Sum of all earlier lengths at each place, in blocks so that texts with many
    matches stay cheap."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x),
    )
    before = F.aggregate(
        blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )
    return _let(
        before,
        lambda offset: F.transform(
            F.sequence(F.lit(0), F.size(lengths) - 1),
            lambda i: F.get(offset, F.floor(i / BLOCK).cast("int"))
            + F.aggregate(
                F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK),
                F.lit(0), lambda a, x: a + x,
            ),
        ),
    )


def matched(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of leftmost matches that do not overlap, in characters. ``keep`` takes a
    match and tells whether it counts; a dropped match still uses up its characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)),
        found,
        lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("n"), m.alias("m")),
    )

    def placed(pairs: Column) -> Column:
        starts = _let(F.transform(pairs, lambda x: x["g"] + x["n"]), _sums)
        return F.zip_with(
            starts,
            pairs,
            lambda s, x: F.struct(
                (s + x["g"]).alias("start"), F.lit(kind).alias("kind"),
                (s + x["g"] + x["n"]).alias("end"), x["m"].alias("m"),
            ),
        )

    spans = _let(pairs, placed)
    spans = F.filter(spans, lambda x: keep(x["m"])) if keep else spans
    spans = F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation)."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(700.0))))


# For each encoding: number, its pattern, its symbols in the order of their values.
HEX_SYMBOLS = "0123456789abcdef"
BASE32_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def battery(token: Column) -> Column:
    """Statistics of a candidate: encoding, length, p-value (1 where a test refutes
    randomness)."""
    bare = F.rtrim(token, F.lit("="))
    hexed = bare.rlike("^[0-9a-f]+$") | bare.rlike("^[0-9A-F]+$")
    based32 = bare.rlike("^[A-Z2-7]+$")
    encoding = F.when(hexed, 0).when(based32, 1).otherwise(2)
    symbols = (
        F.when(encoding == 0, HEX_SYMBOLS).when(encoding == 1, BASE32_SYMBOLS).otherwise(BASE64_SYMBOLS)
    )
    plain = F.translate(F.when(hexed, F.lower(bare)).otherwise(bare), "_-", "/+")
    values = F.transform(
        F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.instr(symbols, c) - 1
    )
    classes = F.translate(
        bare,
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        "U" * 26 + "l" * 26 + "0" * 10 + "----",
    )
    given = F.struct(
        encoding.alias("encoding"), F.length(symbols).alias("k"), values.alias("values"),
        (F.length(F.regexp_replace(classes, r"(.)\1*", "x")) - 1).alias("switches"),
    )
    return _let(given, _tested)


def _tested(x: Column) -> Column:
    values, k, n = x["values"], x["k"], F.size(x["values"])
    squares = F.aggregate(
        F.transform(
            F.sequence(F.lit(0), k - 1),
            lambda s: F.size(F.filter(values, lambda v: v == s)).cast("double"),
        ),
        F.lit(0.0), lambda a, c: a + c * c,
    )
    uniform = (squares * k / n - n - (k - 1)) / F.sqrt(2.0 * (k - 1))
    steps = F.greatest(n - 1, F.lit(1))
    z = (x["switches"] - 0.5 - ORDINARY_SWITCH * steps) / F.sqrt(
        ORDINARY_SWITCH * (1 - ORDINARY_SWITCH) * steps
    )

    def correlation(mean: Column) -> Column:
        spread = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
        joint = F.aggregate(
            F.zip_with(F.slice(values, F.lit(1), steps), F.slice(values, F.lit(2), steps),
                       lambda a, b: (a - mean) * (b - mean)),
            F.lit(0.0), lambda a, v: a + v,
        )
        return F.when(spread > 0, joint / spread * F.sqrt(n.cast("double"))).otherwise(99.0)

    serial = _let(F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n, correlation)
    p = F.when((uniform > REFUTED) | (F.abs(serial) > REFUTED), 1.0).otherwise(_tail(z))
    band = reduce(
        lambda c, b: F.when(n >= b[1], b[0]).otherwise(c), enumerate(BANDS), F.lit(0)
    )
    level = F.least(F.lit(BINS - 1), F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * 10)).cast("int")
    return F.struct((x["encoding"] * len(BANDS) + band).alias("cell"), level.alias("level"))


def _candidates(text: Column) -> Column:
    """Candidate spans with their battery, as an array."""
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    spans = matched(text, CANDIDATE, 3, mixed)
    return F.transform(
        spans,
        lambda x: F.struct(
            x.alias("span"),
            battery(F.substring(text, x["start"] + 1, x["end"] - x["start"])).alias("test"),
        ),
    )


def thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[int, int]:
    """Least level that is a discovery, for each encoding and length band.

    Benjamini-Hochberg over the counts of (cell, level): a table of a few thousand rows
    whatever the corpus, of which the driver gets one row per cell (18).
    """
    from pyspark.sql import Window

    tests = docs.select(F.explode(_candidates(F.col(text))).alias("c")).select("c.test.*")
    counts = tests.groupBy("cell", "level").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("cell")
    found = (
        counts.withColumn("m", F.sum("n").over(whole))
        .withColumn("k", F.sum("n").over(whole.orderBy(F.desc("level"))))
        .where(F.exp(F.col("level") / F.lit(-10.0)) <= F.col("k") * fdr / F.col("m"))
        .groupBy("cell").agg(F.min("level").alias("level"))
    )
    return {row.cell: row.level for row in found.collect()}


def scan(docs: DataFrame, text: str = "text", fdr: float = FDR) -> DataFrame:
    """Adds ``base_spans`` and ``spans`` (start, kind, end; sorted by start, then kind).
    Two passes: the thresholds of the corpus, then the texts themselves; no shuffle of
    texts."""
    least = thresholds(docs, text, fdr)
    body = F.coalesce(F.col(text), F.lit(""))
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8
    base = F.array_sort(
        F.concat(matched(body, ASSIGN, 0, long_value), matched(body, ACCESS, 1), matched(body, HEX, 2))
    )
    if least:
        limit = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
        passed = F.filter(
            _candidates(body), lambda c: c["test"]["level"] >= F.element_at(limit, c["test"]["cell"])
        )
        random = F.transform(passed, lambda c: c["span"])
    else:
        random = F.array().cast(SPAN)
    return docs.withColumn("base_spans", base).withColumn(
        "spans", F.array_sort(F.concat("base_spans", random))
    )


def rendered(spans: str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>", fdr: float = FDR) -> DataFrame:
    """Texts with every span replaced by a mark; overlapping spans share one. Null texts
    stay null, all other columns stay as they are."""
    body = F.col(text)
    state = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.concat(
                a["out"],
                F.when(
                    s["start"] >= a["at"],
                    F.concat(F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)),
                ).otherwise(""),
            ).alias("out"),
        ),
    )
    held = [c for c in docs.columns if c != text]
    inner = docs.select(F.col(text), F.struct(*held).alias("_held")) if held else docs
    found = scan(inner, text, fdr).withColumn("_state", F.when(F.size("spans") > 0, state))
    cut = F.concat(
        F.col("_state.out"), F.substring(body, F.col("_state.at") + 1, F.length(body))
    )
    done = F.when(F.size("spans") > 0, cut).otherwise(body).alias(text)
    return found.select(*[done if c == text else F.col("_held")[c].alias(c) for c in docs.columns])
