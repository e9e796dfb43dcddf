"""Expected values are worked out by hand from the cleaning rules."""

from __future__ import annotations

import html
import re
import time
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import column
from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators import cleaning


def run(texts, step, *values):
    return column(texts(*values).select("id", step("text").alias("text")), "text")


def test_normalize(texts):
    given_ = ["A­B​\r\n\tC  d", "é", None, "x\x7fy", "a  b"]
    found = column(cleaning.normalize(texts(*given_)), "text")
    assert found == ["ab\n c d", "é", None, "xy", "a  b"]


def test_normalize_twice_is_once(texts):
    df = cleaning.normalize(texts("Á\tB​  c", "Å ngstrom"))
    assert column(cleaning.normalize(df), "text") == column(df, "text")


@pytest.mark.parametrize(
    "step, value, expected",
    [
        (X.drop_nav_words, "research the homepage", "re the page"),
        (lambda c: X.drop_nav_words(c, True), "research the home page", "research the  page"),
        (X.drop_urls, "see http://a.b/c?d=1&e=~f#top x", "see ~f#top x"),
        (X.drop_emails, "mail foo.bar@ex-a.co.uk now", "mail  now"),
        (X.drop_emails, "a@b.c-d@e.f", ""),
        (X.drop_emails, "a@b and c@.d", "a@b and c@.d"),
        (X.drop_boilerplate, "our cookie policy share on facebook", "our  "),
        (X.drop_page_numbers, "page 3 of 10 intro page 4", " intro "),
        (X.drop_ref_numbers, "text [1, 2] more x[1] [3]y [4]", "text  more x[1] [3]y "),
        (X.dehyphenate, "exam-\nple a-\nb-\nc -\nd", "example abc -\nd"),
        (X.unwrap_lines, "a\nb\n\n\nc", "a b\n\nc"),
        (X.trim_lines, " a \n\n b ", "ab"),
        (lambda c: X.trim_lines(c, True), " a \n\n b ", "a\n\nb"),
        (X.drop_header_words, "drafted by confidential", "ed by "),
        (X.squeeze_newlines, "\n\na\n\n\n\nb\n\nc ", "a\n\nb\n\nc"),
        (X.strip, "  a b \x1c\n", "a b"),
        (X.drop_html_comments, "a<!-- x\n<b> -->c", "ac"),
        (X.drop_html_comments, "a<!-- x --><!-- open <b>", "a<!-- open <b>"),
        (X.strip_tags, "a<b>c</b\n>d < e <f", "a c d < e <f"),
        (X.strip_tags, "no tags < here", "no tags < here"),
        (X.drop_html_elements, "a<SCRIPT x>b</b\n</script >c<style>d</style>e", "ace"),
        (X.preview_truncated, "", "(empty)"),
        (X.preview_truncated, "x" * 500, "x" * 500),
        (X.preview_truncated, "x" * 501, "x" * 500 + "..."),
        (X.preview, "ab", "ab..."),
        (lambda c: X.skip_prefix(c, 2), "abcd", "cd"),
    ],
)
def test_steps(texts, step, value, expected):
    assert run(texts, step, value, None) == [expected, None]


def test_clean_pdf(texts):
    cases = {
        "a\nb": "a b",
        "a\n\nb": "ab",
        "exam-\nple": "example",
        "text [1, 2] more x[1]": "text more x[1]",
        "Page 3 of 10 intro Page 4": "intro",
        "Drafted DRAFT report": "ed report",
    }
    assert column(cleaning.clean_pdf(texts(*cases)), "clean") == list(cases.values())
    kept = cleaning.clean_pdf(texts("a\n\nb"), keep_paragraphs=True)
    assert column(kept, "clean") == ["a\n\nb"]


def test_entities_are_decoded_twice(texts):
    df = cleaning.unescape_entities(texts("&amp;copy;", "a & b", "&lt;p&gt;", None), "text")
    assert column(df, "text") == ["©", "a & b", "<p>", None]


def test_clean_web_parsers(texts):
    page = (
        "<html><head><style>p{}</style><meta charset=x></head><body><!-- no -->"
        "<p>Hello &amp; Wörld</p><script>var a='<b>';</script> mail a@b.cd</body></html>"
    )
    for parser in ("native", "exact"):
        found = column(cleaning.clean_web(texts(page), "text", parser=parser), "clean")
        assert [re.sub(r"\s+", " ", t) for t in found] == ["hello & wörld mail"]


def test_unclosed_element_swallows_its_parent(texts):
    page = "<div>a<noscript>b<p>c</p></div>d &lt;!-- e"
    df = cleaning.html_text(texts(page), "text", parser="exact")
    assert column(df, "text") == ["a"]


def test_unknown_parser(texts):
    with pytest.raises(ValueError):
        cleaning.html_text(texts("a"), "text", parser="other")


ALPHABET = st.sampled_from(list("aB1_ .-@\n\t[],:/héé​　\x1c&;<>"))


def expected_words(text):
    return re.findall(r"\w+", text.lower())


def expected_strip_control(text):
    return "".join(c for c in text if unicodedata.category(c)[0] != "C" or c in "\n\t")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=40, max_size=60))
def test_patterns_agree_with_unicode_rules(texts, samples):
    df = texts(*samples).select(
        "id",
        X.strip_control("text").alias("control"),
        X.drop_emails("text").alias("emails"),
        X.count_chars("text", P.SPACES).alias("spaces"),
        X.strip("text").alias("strip"),
        X.split_punct("text").alias("split"),
        X.sentences("text").alias("sentences"),
    )
    rows = sorted(df.collect(), key=lambda r: r.id)
    for text, row in zip(samples, rows):
        assert row.control == expected_strip_control(text)
        assert row.emails == re.sub(r"[\w.-]+@[\w.-]+\.\w+", "", text.replace("́", "́"))
        assert row.spaces == len(re.findall(r"\s", text))
        assert row.strip == text.strip()
        pieces = re.split(r"""([,.:;?_!"()']|--|\s)""", text)
        assert row.split == [p.strip() for p in pieces if p.strip()]
        assert row.sentences == re.split(r"[.!?]+", text)


def test_entities_match_the_standard_table(texts):
    samples = ["&eacute;", "&#233;", "&nosuch;", "&amp;amp;", "&copy 2020"]
    df = cleaning.unescape_entities(texts(*samples), "text")
    assert column(df, "text") == [html.unescape(html.unescape(s)) for s in samples]


def test_long_runs_stay_linear(texts):
    """Texts that make naive patterns quadratic or overflow the stack."""
    run_ = "a" * 400_000
    spaces = "  " * 200_000
    angles = "<" * 400_000
    df = texts(run_, spaces + "x", angles, run_ + "@", "-" + "a-" * 200_000)
    web = texts("<a" * 200_000, "<!--" * 100_000, "&" * 100_000)
    assert cleaning.clean_web(web, "text").where("length(clean) > 0").count() == 3
    cleaned = cleaning.clean_pdf(df).select("id", "clean").collect()
    assert {r.id: len(r.clean) for r in cleaned}[0] == 400_000
    measured = df.select(
        "id",
        X.split_punct("text")[0].alias("first"),
        X.count_matches(X.upto_last("text", ">"), P.TAG).alias("tags"),
    ).collect()
    assert {r.id: r.tags for r in measured}[2] == 0


MARKS = st.sampled_from([
    "<script>", "<script ", "</script>", "</SCRIPT \n>", "<script", ">", "x", "<style a=b>", "</style>", "<noscript>",
    "</noscript", "\n", "<scripts>", "é", "</script",
])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(MARKS, max_size=20).map("".join), min_size=100, max_size=200))
def test_elements_end_at_the_next_end_mark(texts, samples):
    def expected(page):
        for element in P.HIDDEN_ELEMENTS:
            page = re.sub(rf"(?is)<{element}\b[^>]*>.*?</{element}\s*>", "", page)
        return page

    assert run(texts, X.drop_html_elements, *samples, None) == [*map(expected, samples), None]


@pytest.mark.parametrize("mark, end", [
    ("<script>", ""), ("<style>", ""), ("<noscript>", ""), ("<script ", ""), ("<script ", "</script>"),
    ("</script>", ""), ("<script </script>", ""), ("<script>a</script>b", ""), ("<style ", "</style></style>"),
])
def test_a_megabyte_of_marks_is_linear(texts, mark, end):
    page = texts(mark * (1_000_000 // len(mark)) + end)
    run(texts, X.drop_html_elements, mark)  # compiled before the clock starts
    start = time.perf_counter()
    page.select(X.drop_html_elements("text").alias("text")).collect()
    assert time.perf_counter() - start < 3
