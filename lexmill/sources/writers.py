"""Sinks: text by source and stage, token tables by input file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.session import written

MANIFEST = "_manifest"
FILE_CHARS = 1 << 27
# Fixed values of the text files: a line holds one text.
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
NULL = "\\N"
EMPTY = "\\E"  # as a folder name


def escaped(text: Column) -> Column:
    """A text as one line; a null is a mark that no text gives."""
    line = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)
    return F.coalesce(line, F.lit(NULL))


def unescaped(line: Column) -> Column:
    """What ``escaped`` was given. Doubled backslashes are found first, from the left."""

    def plain(part: Column) -> Column:
        return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), ESCAPES[1:], part)

    parts = F.transform(F.split(line, r"\\\\", -1), plain)
    return F.when(line != NULL, F.array_join(parts, "\\"))


def _folder(value: Column) -> Column:
    """A folder name for any value: null and empty have names of their own."""
    text = value.cast("string")
    marked = F.when(F.startswith(text, F.lit("\\")), F.concat(F.lit("\\"), text)).otherwise(text)
    return F.coalesce(F.when(text == "", EMPTY).otherwise(marked), F.lit(NULL))


def _value(name: Column) -> Column:
    return F.when(name == EMPTY, "").when(
        name != NULL, F.when(F.startswith(name, F.lit("\\\\")), F.substr(name, F.lit(2))).otherwise(name)
    )


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _dealt(rows: DataFrame, by: list[str], file_chars: int) -> DataFrame:
    """Adds ``_part``, 0 where a group fits in one file. A larger group is dealt by digest of line and
    row to as many parts as make about half a file each."""
    totals = rows.groupBy(*by).agg(F.ceil(F.sum("_size") / file_chars).alias("_k"))
    dealt = rows.alias("r").join(written(totals, "groups").alias("t"), _same("r", "t", by)).select("r.*", "_k")
    part = F.when(F.col("_k") <= 1, 0).otherwise(F.pmod(F.xxhash64("_line", "_row"), F.col("_k") * 2))
    return dealt.withColumn("_part", part).drop("_k")


def _numbered(dealt: DataFrame, by: list[str], file_chars: int) -> DataFrame:
    """Adds ``_cut``, 0 where a part fits in one file. Only lines of a larger part are shuffled,
    to be cut along a running sum; so no window holds more than a part, however large the group
    or often a line."""
    columns = [*by, "_part"]
    over = F.sum("_size") > file_chars
    parts = dealt.groupBy(*columns).agg(over.alias("_over"))
    told = dealt.alias("r").join(written(parts, "parts").alias("t"), _same("r", "t", columns)).select("r.*", "_over")
    whole = Window.partitionBy(*columns).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(whole), F.lit(0))
    fit = told.where(~F.col("_over")).withColumn("_cut", F.lit(0).cast("bigint"))
    large = told.where("_over").withColumn("_cut", F.floor(before / file_chars).cast("bigint"))
    return fit.unionByName(large).drop("_over")


def write_text(df: DataFrame, path: str, text: str = "text", by: tuple[str, ...] = ("source", "stage"),
               file_chars: int = FILE_CHARS) -> DataFrame:
    """Texts as text files, one text a line with line ends escaped: one file for every source
    and stage, several numbered ones where the texts have more than ``file_chars``
    characters (a file then has at most that and one text). Returns the manifest, which
    also lies beside the files: ``by``, ``file`` (its number), ``n_texts`` and ``n_chars``."""
    line = escaped(F.col(text))
    sized = df.select(*[F.col(c).cast("string").alias(c) for c in by], line.alias("_line"))
    sized = sized.withColumns({"_size": F.length("_line").cast("bigint"), "_row": F.monotonically_increasing_id()})
    placed = _numbered(written(_dealt(sized, list(by), file_chars).drop("_row"), "text"), list(by), file_chars)
    files = placed.groupBy(*by, "_part", "_cut").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum("_size").cast("bigint").alias("n_chars")
    )
    order = Window.partitionBy(*by).orderBy("_part", "_cut")
    numbered = written(files.withColumn("file", F.row_number().over(order) - 1), "files")  # small, so joined by broadcast
    same = _same("p", "f", [*by, "_part", "_cut"])
    lines = placed.alias("p").join(numbered.alias("f"), same).select(
        *[_folder(F.col(f"p.{c}")).alias(c) for c in by], "file", F.col("_line").alias("value")
    )
    lines.repartition(*by, "file").write.partitionBy(*by, "file").text(path)
    numbered.select(*by, "file", "n_texts", "n_chars").coalesce(1).write.parquet(f"{path}/{MANIFEST}")
    return read_manifest(df.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_text(spark: SparkSession, path: str, by: tuple[str, ...] = ("source", "stage"),
              text: str = "text") -> DataFrame:
    """The rows that ``write_text`` was given, with ``file``."""
    folders = ", ".join(f"`{c}` string" for c in by)
    lines = spark.read.schema(f"value string, {folders}, file int").text(path)
    return lines.select(*[_value(F.col(c)).alias(c) for c in by], "file", unescaped(F.col("value")).alias(text))


def write_tokens(df: DataFrame, path: str, by_file: bool = False, file: str = "src_file") -> None:
    """Token table as Parquet. ``by_file`` gives every input file its own folder;
    tasks then hold one range of files each, split further where a file is large."""
    if by_file:
        spread = df.hint("rebalance", F.col(file))
        spread.write.partitionBy(file).parquet(path)
    else:
        df.write.parquet(path)
