"""Normalising and cleaning steps, each alone and in their chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import sql as S
from lexmill.catalog.registry import documents, noisy_documents, query
from lexmill.catalog.registry import pages as web_pages
from lexmill.functions import patterns as P
from lexmill.functions import text as X
from lexmill.operators import cleaning


def _on_noisy(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS text FROM (SELECT doc_id, {S.noisy()} AS text FROM documents)"


def _on_lower(expr: str) -> str:
    return (
        f"SELECT doc_id, {expr} AS text FROM "
        f"(SELECT doc_id, {S.normalized(S.noisy())} AS text FROM documents)"
    )


def _noisy_step(name: str, step, sql: str) -> None:
    @query(name, _on_noisy(sql))
    def run(spark, folder):
        return noisy_documents(spark, folder).select("doc_id", step("text").alias("text"))


def _lower_step(name: str, step, sql: str) -> None:
    @query(name, _on_lower(sql))
    def run(spark, folder):
        docs = cleaning.normalize(noisy_documents(spark, folder))
        return docs.select("doc_id", step("text").alias("text"))


_noisy_step("lowercase", F.lower, "lower(text)")
_noisy_step("strip_control", X.strip_control, S.control("text"))
_noisy_step("collapse_blanks", X.collapse_blanks, S.blanks("text"))
_noisy_step("drop_formfeed", X.drop_formfeeds, "replace(text, chr(12), '')")
_noisy_step("strip", X.strip, S.strip("text"))
_noisy_step(
    "squeeze_newlines", X.squeeze_newlines, S.strip(S.rr("text", P.NEWLINES_3, "\n\n"))
)


@query("nfc", _on_noisy("nfc_normalize(text)"))
def nfc(spark, folder):
    return cleaning.nfc(noisy_documents(spark, folder), "text").select("doc_id", "text")


@query("normalize_text", _on_noisy(S.normalized("text")))
def normalize_text(spark, folder):
    return cleaning.normalize(noisy_documents(spark, folder)).select("doc_id", "text")


_lower_step("drop_page_numbers", X.drop_page_numbers, S.drop("text", P.PAGE_N_OF_M, P.PAGE_N))
_lower_step("drop_ref_numbers", X.drop_ref_numbers, S.ref_numbers("text"))
_lower_step("dehyphenate", X.dehyphenate, S.dehyphenated("text"))
_lower_step("unwrap_lines", X.unwrap_lines, S.unwrapped("text"))
_lower_step(
    "trim_lines",
    lambda c: X.trim_lines(X.unwrap_lines(c)),
    S.lines_trimmed(S.unwrapped("text")),
)
_lower_step("drop_headers", X.drop_header_words, S.drop("text", P.HEADER_WORDS))
_lower_step("drop_urls", X.drop_urls, S.drop("text", P.URL))
_lower_step("drop_emails", X.drop_emails, S.drop("text", S.EMAIL))


@query("clean_pdf", _on_noisy(S.clean_pdf("text")))
def clean_pdf(spark, folder):
    docs = cleaning.clean_pdf(noisy_documents(spark, folder), "text", "text")
    return docs.select("doc_id", "text")


@query("clean_documents", f"SELECT doc_id, {S.clean_pdf('text')} AS clean FROM documents")
def clean_documents(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return cleaning.clean_pdf(docs).select("doc_id", "clean")


# -- pages -------------------------------------------------------------------


def _page_step(name: str, step, sql: str) -> None:
    @query(name, f"SELECT page_id, {sql} AS text FROM pages")
    def run(spark, folder):
        return web_pages(spark, folder).select("page_id", step("html").alias("text"))


_page_step("html_drop_elements", X.drop_html_elements, S.drop("html", *S.HTML_ELEMENTS))
_page_step("html_drop_comments", X.drop_html_comments, S.drop("html", P.HTML_COMMENT))
_page_step("strip_tags", X.strip_tags, S.rr("html", P.HTML_TAG, " "))


@query("html_text", f"SELECT page_id, {S.unescaped(S.html_bare('html'))} AS text FROM pages")
def html_text(spark, folder):
    pages = web_pages(spark, folder)
    return cleaning.html_text(pages, "html", "text").select("page_id", "text")


# Joining text nodes by one blank and replacing tags by one blank differ in blanks only.
@query(
    "html_text_exact",
    "SELECT page_id, "
    + S.strip(S.rr(S.unescaped(S.html_bare("html")), f"{P.WS}+", " "))
    + " AS text FROM pages",
)
def html_text_exact(spark, folder):
    pages = cleaning.html_text(web_pages(spark, folder), "html", "text", "exact")
    single = X.strip(F.regexp_replace("text", f"{P.WS}+", " "))
    return pages.select("page_id", single.alias("text"))


@query("unescape_entities", f"SELECT page_id, {S.unescaped('html')} AS text FROM pages")
def unescape_entities(spark, folder):
    pages = web_pages(spark, folder).select("page_id", F.col("html").alias("text"))
    return cleaning.unescape_entities(pages, "text")


_FOOTER = " Cookie Policy subscribe to our newsletter share on example home research "


def _boiler(spark, folder):
    text = F.lower(F.concat("html", F.lit(_FOOTER), "url", F.lit(_FOOTER)))
    return web_pages(spark, folder).select("page_id", text.alias("text"))


_BOILER = (
    f"(SELECT page_id, lower(html || {S.q(_FOOTER)} || url || {S.q(_FOOTER)}) AS text FROM pages)"
)


@query("drop_boilerplate", f"SELECT page_id, {S.drop('text', *P.BOILERPLATE)} AS text FROM {_BOILER}")
def drop_boilerplate(spark, folder):
    return _boiler(spark, folder).select("page_id", X.drop_boilerplate("text").alias("text"))


@query("drop_nav_words", f"SELECT page_id, {S.drop('text', P.NAV_WORDS)} AS text FROM {_BOILER}")
def drop_nav_words(spark, folder):
    return _boiler(spark, folder).select("page_id", X.drop_nav_words("text").alias("text"))


_WEB = f"html || {S.q(_FOOTER)} || url || ' me@example.org '"


@query("clean_web", f"SELECT page_id, {S.clean_web(_WEB)} AS clean FROM pages")
def clean_web(spark, folder):
    raw = F.concat("html", F.lit(_FOOTER), "url", F.lit(" me@example.org "))
    pages = web_pages(spark, folder).select("page_id", raw.alias("html"))
    return cleaning.clean_web(pages).select("page_id", "clean")
