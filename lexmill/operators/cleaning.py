"""Whole cleaning chains: DataFrame in, DataFrame out.

Every chain works on one column through successive projections, so that no step's
expression is evaluated twice, and sends text to Python only for rows that need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.functions import udfs


def _only_where(df: DataFrame, column: str, needed: Column, fn) -> DataFrame:
    """Apply an Arrow function to the rows that need it; others pass a null."""
    routed = fn(F.when(needed, F.col(column)))
    return df.withColumn(column, F.coalesce(routed, F.col(column)))


def nfc(df: DataFrame, column: str) -> DataFrame:
    """Unicode NFC. Text without a character from U+0300 on is NFC already."""
    return _only_where(df, column, F.col(column).rlike(P.MAYBE_NOT_NFC), udfs.nfc)


def unescape_entities(df: DataFrame, column: str) -> DataFrame:
    return _only_where(df, column, F.col(column).contains("&"), udfs.unescape)


def normalize(df: DataFrame, text: str = "text", output: str | None = None) -> DataFrame:
    """Lower case, NFC, no control characters, single blanks."""
    output = output or text
    df = nfc(df.withColumn(output, F.lower(F.col(text))), output)
    return df.withColumn(output, X.collapse_blanks(X.strip_control(output)))


def html_text(
    df: DataFrame, text: str = "html", output: str | None = None, parser: str = "native"
) -> DataFrame:
    """Visible text of a page. ``native`` uses patterns inside the JVM; ``exact``
    follows the element nesting with the standard library's parser."""
    output = output or text
    if parser == "exact":
        return df.withColumn(output, udfs.parsed_html_text(F.col(text)))
    if parser != "native":
        raise ValueError(f"unknown parser: {parser}")
    for step in (X.drop_html_elements, X.drop_html_comments, X.strip_tags):
        df, text = df.withColumn(output, step(text)), output
    return unescape_entities(df, output)


def clean_web(
    df: DataFrame,
    text: str = "html",
    output: str = "clean",
    parser: str = "native",
    whole_words: bool = False,
) -> DataFrame:
    df = normalize(html_text(df, text, output, parser), output)
    cleaned = X.drop_nav_words(X.drop_boilerplate(output), whole_words)
    return _drop_addresses(df.withColumn(output, cleaned), output, X.strip)


def clean_pdf(
    df: DataFrame, text: str = "text", output: str = "clean", keep_paragraphs: bool = False
) -> DataFrame:
    # Form feeds are gone with the other control characters.
    df = normalize(df, text, output)
    df = _where(df, output, "page ", X.drop_page_numbers)
    df = _where(df, output, "[", X.drop_ref_numbers)
    df = _where(df, output, "-\n", X.dehyphenate)
    lines = X.trim_lines(X.collapse_blanks(X.unwrap_lines(output)), keep_paragraphs)
    df = df.withColumn(output, X.drop_header_words(lines))
    return _drop_addresses(df, output, lambda c: X.strip(X.collapse_blanks(c)))


def _where(df: DataFrame, column: str, needle: str, step) -> DataFrame:
    """Run a pattern only over texts that contain what every match of it contains."""
    text = F.col(column)
    return df.withColumn(column, F.when(F.contains(text, F.lit(needle)), step(text)).otherwise(text))


def _drop_addresses(df: DataFrame, column: str, finish) -> DataFrame:
    df = _where(df, column, "http", X.drop_urls)
    df = _where(df, column, "@", X.drop_emails)
    return df.withColumn(column, finish(F.col(column)))
