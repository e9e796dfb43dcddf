"""The few per-row helpers Spark has no built-in for, as Arrow functions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements removed with their content, and elements without an end tag.
DROPPED_ELEMENTS = frozenset({"script", "style", "noscript"})
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
PIECE_BYTES = 1 << 20  # of text that is held as Python values at a time


def pieces(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """A batch of texts in slices that begin within ``size`` bytes each, so that a slice holds
    about that much and at most one longer text, however large the batch."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(before, before[start] + size))
        yield texts.slice(start, end - start)
        start = end


def by_pieces(kind):
    """An Arrow function of texts that works on a bounded part of a batch at a time, and hands
    its result over before it goes on."""

    def wrap(fn: Callable[[pa.Array], pa.Array]):
        def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield from map(fn, pieces(texts))

        apply.__name__ = fn.__name__
        return F.arrow_udf(apply, kind)

    return wrap


def _map_strings(fn):
    def apply(values: pa.Array) -> pa.Array:
        return pa.array(
            [None if v is None else fn(v) for v in values.to_pylist()], pa.string()
        )

    return apply


@by_pieces(StringType())
def nfc(values: pa.Array) -> pa.Array:
    return _map_strings(lambda v: unicodedata.normalize("NFC", v))(values)


@by_pieces(StringType())
def unescape(values: pa.Array) -> pa.Array:
    """Decode entities twice: once as the parser would, once more afterwards."""
    return _map_strings(lambda v: html.unescape(html.unescape(v)))(values)


class _TextNodes(HTMLParser):
    """Collects text nodes outside dropped elements.

    An element left open ends where its nearest open ancestor ends, so an unclosed
    ``<noscript>`` swallows the rest of that ancestor.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.nodes: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID_ELEMENTS:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        # A text node that spells out a comment mark is dropped whole.
        if "<!--" not in data and DROPPED_ELEMENTS.isdisjoint(self.open):
            self.nodes.append(data)


def _parse_text(page: str) -> str:
    parser = _TextNodes()
    parser.feed(page)
    parser.close()
    return html.unescape(" ".join(parser.nodes))


@by_pieces(StringType())
def parsed_html_text(values: pa.Array) -> pa.Array:
    return _map_strings(_parse_text)(values)
