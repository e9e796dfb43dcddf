"""Check-side SQL fragments (DuckDB dialect), built from the same pattern texts.

The check's pattern engine has no look-around, so rules that need it are spelled in
another way here.
"""

from __future__ import annotations

from lexmill.catalog.registry import NOISE
from lexmill.functions import patterns as P


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rr(expr: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(to)}, 'g')"


def drop(expr: str, *patterns: str) -> str:
    for pattern in patterns:
        expr = rr(expr, pattern)
    return expr


def strip(expr: str) -> str:
    return f"trim({expr}, {q(P.SPACES)})"


def count(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {q(pattern)}))"


def noisy(expr: str = "text") -> str:
    for old, new in NOISE:
        expr = f"replace({expr}, {q(old)}, {q(new)})"
    return expr


def control(expr: str) -> str:
    return drop(expr, P.CONTROL)


def blanks(expr: str) -> str:
    return rr(expr, P.BLANKS, " ")


def normalized(expr: str) -> str:
    return blanks(control(f"nfc_normalize(lower({expr}))"))


HTML_ELEMENTS = tuple(rf"(?is)<{e}\b[^>]*>.*?</{e}\s*>" for e in P.HIDDEN_ELEMENTS)


def html_bare(expr: str) -> str:
    return rr(drop(expr, *HTML_ELEMENTS, P.HTML_COMMENT), P.HTML_TAG, " ")


def unescaped(expr: str) -> str:
    """The entities that occur in the tables, decoded twice; the final semicolon may
    be missing."""
    for _ in range(2):
        for entity, char in (
            ("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"),
            ("nbsp", "\xa0"), ("amp", "&"),
        ):
            expr = rr(expr, f"&{entity};?", char)
    return expr


EMAIL = rf"[{P.EMAIL_CHARS}]+@[{P.EMAIL_CHARS}]+\.{P.W}+"


def clean_web(expr: str) -> str:
    text = normalized(unescaped(html_bare(expr)))
    return strip(drop(text, *P.BOILERPLATE, P.NAV_WORDS, P.URL, EMAIL))


def ref_numbers(expr: str) -> str:
    """Bracketed numbers are marked, unmarked where they touch a word, and deleted."""
    marked = rr(expr, rf"(\[[{P.DIGIT_CHARS}{P.SPACE_CHARS},]+\])", "\x02\\1\x03")
    left = rr(marked, f"({P.W})\x02", "\\1\x04")
    right = rr(left, f"\x03({P.W})", "\x05\\1")
    gone = rr(right, "\x02[^\x02-\x05]*\x03", "")
    return rr(gone, "[\x02-\x05]", "")


def dehyphenated(expr: str) -> str:
    for _ in range(2):
        expr = rr(expr, rf"({P.W})-\n({P.W})", r"\1\2")
    return expr


def unwrapped(expr: str) -> str:
    marked = rr(expr, P.NEWLINE_RUN, "\x01")
    return f"replace(replace({marked}, {q(chr(10))}, ' '), {q(chr(1))}, {q(chr(10) * 2)})"


def lines_trimmed(expr: str) -> str:
    return strip(rr(expr, rf"{P.WS}*\n\n{P.WS}*", ""))


def clean_pdf(expr: str) -> str:
    text = drop(normalized(expr), P.PAGE_N_OF_M, P.PAGE_N)
    text = blanks(unwrapped(dehyphenated(ref_numbers(text))))
    text = drop(lines_trimmed(text), P.HEADER_WORDS, P.URL, EMAIL)
    return strip(blanks(text))


def words(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {q(P.WORD)})"


def split_punct(expr: str, delimiters: str = P.DELIMITERS_V2) -> str:
    marked = rr(expr, rf"([{delimiters}]|--|{P.WS})", "\x01\\1\x01")
    return (
        f"list_filter(string_split({marked}, {q(chr(1))}), "
        f"lambda t: trim(t, {q(P.SPACES)}) <> '')"
    )


def metrics(text: str) -> dict[str, str]:
    w = words(text)
    return {
        "char_count": f"length({text})",
        "word_count": f"len({w})",
        "sent_count": f"{count(text, P.SENTENCE_END)} + 1",
        "avg_word_length": (
            f"case when len({w}) = 0 then 0.0 else "
            f"length(array_to_string({w}, ''))::double / len({w}) end"
        ),
        "vocab_size": f"len(list_distinct({w}))",
        "whitespace_count": count(text, P.WS),
        "newline_count": count(text, r"\n"),
        "html_tags": count(text, P.TAG),
        "page_numbers": count(text, P.PAGE_MARK),
    }
