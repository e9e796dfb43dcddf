"""Cleaning steps as column expressions; each step is usable alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import patterns as P
from lexmill.functions.arrays import let


def _column(text) -> Column:
    return F.col(text) if isinstance(text, str) else text


def _drop(text, *patterns: str) -> Column:
    return reduce(lambda c, p: F.regexp_replace(c, p, ""), patterns, _column(text))


def upto_last(text, mark: str) -> Column:
    """The text up to and including the last ``mark``."""
    column = _column(text)
    tail = F.length(F.substring_index(column, mark, -1))
    return F.substr(column, F.lit(1), F.length(column) - tail)


def _before_last(text, mark: str, step) -> Column:
    """Apply ``step`` up to the last ``mark``. What follows cannot hold a match that
    ends in ``mark``, and searching it would retry from every possible start."""
    column = _column(text)
    return F.concat(step(upto_last(column, mark)), F.substring_index(column, mark, -1))


# -- normalising -------------------------------------------------------------


def strip_control(text) -> Column:
    """Drop control, format and private-use characters except newline and tab."""
    return _drop(text, P.CONTROL)


def collapse_blanks(text) -> Column:
    return F.regexp_replace(_column(text), P.BLANKS, " ")


def strip(text) -> Column:
    """Trim Unicode white space at both ends (linear, unlike an anchored pattern)."""
    return F.btrim(_column(text), F.lit(P.SPACES))


def squeeze_newlines(text) -> Column:
    return strip(F.regexp_replace(_column(text), P.NEWLINES_3, "\n\n"))


# -- web pages ---------------------------------------------------------------


def drop_elements(text, element: str) -> Column:
    """Remove elements of a kind, from each open mark to the next end mark behind it.

    Linear whatever the marks: the text is cut once behind every end mark, and only the first
    open mark of each piece matters. One that has its ``>`` is closed by the end mark of its piece. In
    one without, the ``>`` of that end mark is its own, so the element goes on to the end of the
    next piece; where there is none, it is not closed and stays. The state that runs
    over the pieces is a string with one character each: ``k`` keep, ``c`` cut behind the
    open mark, ``o`` the same and go on, ``d`` drop, ``t`` the tail without an end mark.
    """

    def parts(piece: Column) -> Column:
        return F.struct(
            piece.alias("piece"), F.split(piece, P.open_mark(element), 2).alias("cut"),
            (~F.rlike(piece, F.lit(P.end_mark(element)))).alias("tail"),
        )

    def state(part: Column) -> Column:
        behind = part["cut"][1]
        return (
            F.when(part["tail"], "t").when(F.size(part["cut"]) < 2, "k")
            .when(F.instr(behind, ">") < F.length(behind), "c").otherwise("o")
        )

    def joined(cut: Column) -> Column:
        states = F.array_join(F.transform(cut, state), "")
        running = F.regexp_replace(F.regexp_replace(states, "o[^t]", "od"), "o(?!d)", "k")
        with_state = F.arrays_zip(
            cut.alias("part"), F.regexp_extract_all(running, F.lit("."), F.lit(0)).alias("state")
        )
        return F.array_join(
            F.transform(
                with_state,
                lambda z: F.when(z["state"] == "d", "")
                .when(z["state"].isin("k", "t"), z["part"]["piece"]).otherwise(z["part"]["cut"][0]),
            ),
            "",
        )

    def removed(whole: Column) -> Column:
        pieces = F.regexp_extract_all(whole, F.lit(P.upto_end_marks(element)), F.lit(0))
        cut = let(F.transform(pieces, parts), joined)
        return F.when(F.rlike(whole, F.lit(P.end_mark(element))), cut).otherwise(whole)

    return let(_column(text), removed)


def drop_html_elements(text) -> Column:
    return reduce(drop_elements, P.HIDDEN_ELEMENTS, _column(text))


def drop_html_comments(text) -> Column:
    return _before_last(text, "-->", lambda c: _drop(c, P.HTML_COMMENT))


def strip_tags(text) -> Column:
    """Every tag becomes one space."""
    return _before_last(text, ">", lambda c: F.regexp_replace(c, P.HTML_TAG, " "))


def drop_boilerplate(text) -> Column:
    return _drop(text, *P.BOILERPLATE)


def drop_nav_words(text, whole_words: bool = False) -> Column:
    """Remove navigation words, also inside longer words unless ``whole_words``."""
    if whole_words:
        return _drop(text, f"(?<!{P.W})(?:{P.NAV_WORDS})(?!{P.W})")
    return _drop(text, P.NAV_WORDS)


def drop_urls(text) -> Column:
    return _drop(text, P.URL)


def drop_emails(text) -> Column:
    return _drop(text, P.EMAIL)


# -- page text ---------------------------------------------------------------


def drop_page_numbers(text) -> Column:
    return _drop(text, P.PAGE_N_OF_M, P.PAGE_N)


def drop_formfeeds(text) -> Column:
    return F.replace(_column(text), F.lit("\f"), F.lit(""))


def drop_ref_numbers(text) -> Column:
    return _drop(text, P.REF_NUMBERS)


def dehyphenate(text) -> Column:
    return _drop(text, P.HYPHEN_BREAK)


def unwrap_lines(text) -> Column:
    """Single newlines become blanks; longer runs become exactly two newlines.

    U+0001 stands in for the runs: normalised text cannot contain it.
    """
    marked = F.regexp_replace(_column(text), P.NEWLINE_RUN, "\x01")
    single = F.replace(marked, F.lit("\n"), F.lit(" "))
    return F.replace(single, F.lit("\x01"), F.lit("\n\n"))


def trim_lines(text, keep_paragraphs: bool = False) -> Column:
    """Trim every line of unwrapped text. By default this also deletes the
    paragraph breaks, gluing paragraphs; ``keep_paragraphs`` leaves them."""
    glue = "\n\n" if keep_paragraphs else ""
    return strip(F.regexp_replace(_column(text), P.PARAGRAPH_BREAK, glue))


def drop_header_words(text) -> Column:
    return _drop(text, P.HEADER_WORDS)


# -- slicing and formatting --------------------------------------------------


def preview(text, length: int = 200) -> Column:
    return F.concat(F.substring(_column(text), 1, length), F.lit("..."))


def preview_truncated(text, length: int = 500) -> Column:
    column = _column(text)
    return (
        F.when(F.length(column) > length, preview(column, length))
        .when(F.length(column) == 0, F.lit("(empty)"))
        .otherwise(column)
    )


def skip_prefix(text, n: int) -> Column:
    column = _column(text)
    return F.substr(column, F.lit(n + 1))


def format_change(change, decimals: int | None = None) -> Column:
    """Signed change: whole numbers as ``+3``, fractions as ``+3.00``."""
    pattern = "%+d" if decimals is None else f"%+.{decimals}f"
    return F.format_string(pattern, _column(change))


def format_count(value, decimals: int = 0) -> Column:
    return F.format_number(_column(value), decimals)


def percent(part, whole) -> Column:
    return _column(part) / _column(whole) * 100.0


# -- tokens ------------------------------------------------------------------


def words(text) -> Column:
    return F.regexp_extract_all(F.lower(_column(text)), F.lit(P.WORD), F.lit(0))


def sentences(text) -> Column:
    """Pieces between runs of ``.!?``; empty pieces are kept."""
    return F.split(_column(text), P.SENTENCE_END, -1)


def count_matches(text, pattern: str) -> Column:
    return F.regexp_count(_column(text), F.lit(pattern))


def count_chars(text, chars: str) -> Column:
    """Occurrences of any of ``chars`` without running a pattern."""
    column = _column(text)
    return F.length(column) - F.length(F.translate(column, chars, ""))


def special_chars(text) -> Column:
    return F.regexp_extract_all(_column(text), F.lit(P.SPECIAL_CHAR), F.lit(0))


def split_punct(text, delimiters: str = P.DELIMITERS_V2) -> Column:
    """Words and punctuation marks in order; white space is dropped."""
    return F.regexp_extract_all(
        _column(text), F.lit(P.split_pattern(delimiters)), F.lit(0)
    )
