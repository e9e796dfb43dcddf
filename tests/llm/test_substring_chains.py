"""Copied runs put together before parsing leave out no word."""

from __future__ import annotations

import random

import numpy as np

from lexmill.llm import substrings


def _words(factors):
    return {w for first, end, *_ in factors for w in range(first, end)}


def test_chains_cover_the_same_words():
    rng = random.Random(5)
    for _ in range(300):
        copied = []
        for _ in range(rng.randrange(1, 30)):
            pos, doc = rng.randrange(60), rng.randrange(3)
            copied.append((pos, rng.randrange(1, 8), doc, pos + 10 * doc + rng.randrange(2)))
        copied = list(set(copied))
        columns = [np.array(c, np.int64) for c in zip(*copied)]
        text, *runs = substrings.chains(np.zeros(len(copied), np.int64), *columns)
        put = list(zip(*(c.tolist() for c in runs)))
        assert len(put) <= len(copied)
        assert _words(substrings.parse(put)) == _words(substrings.parse(copied)) == {
            w for pos, n, *_ in copied for w in range(pos, pos + n + substrings.WINDOW - 1)
        }


def test_windows_of_a_batch_are_those_of_its_texts():
    texts = [None, "", "a b c", " ".join(map(str, range(13))), "x " * 40, "short", " ".join(map(str, range(30)))]
    batch = substrings.Windows(texts)
    alone = [substrings.Windows([t]) for t in texts]
    assert batch.text.tolist() == [i for i, w in enumerate(alone) for _ in w.pos]
    assert batch.pos.tolist() == [p for w in alone for p in w.pos.tolist()]
    for made in (substrings.Windows.anchors, lambda w: w.digests(substrings._FIRST)):
        assert made(batch).tolist() == [x for w in alone for x in made(w).tolist()]
    assert not len(substrings.Windows([]).anchors())
