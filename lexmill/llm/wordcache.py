"""Whole texts encoded through remembered words and matches."""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Entries in each of two generations; one takes about 200 bytes, at most 900.
WORDS, MATCHES = 400_000, 50_000
LONGEST = 32  # longer words and matches are not remembered
# With this choice in a pattern, a space and letters up to the end are one match.
LETTERS = r" ?\p{L}+"
# With this one too, a run of such marks behind the letters is one match.
MARKS, ASCII_MARKS = r" ?[^\s\p{L}\p{N}]+", string.punctuation


class Recent:
    """A bounded store in two generations: what is still used moves to the new one. Each
    holds ``size`` entries and at most one update more."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def put(self, key: str, value: bytes) -> None:
        self.update(((key, value),))

    def update(self, entries) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new.update(entries)

    def find(self, key: str) -> bytes | None:
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value


def closed(part: str) -> bool:
    """Whether a match surely ends with this part: no match of the pattern goes on from
    another character into white space, so a text may be cut behind it."""
    return bool(part) and not part[-1].isspace()


class TextEncoder:
    """Ids of whole texts, as little-endian 32-bit integers. A text is split by ``pattern``
    and each match encoded by ``encode``, which takes and gives a list. Words between
    single spaces, and matches, are looked up first."""

    def __init__(self, pattern: str, encode: Callable[[list[str]], list[bytes]], size: int = WORDS):
        self.match, self.encode = regex.compile(pattern).findall, encode
        self.words, self.matches = Recent(size), Recent(MATCHES)
        choices = pattern.split("|")
        self.letters, self.marks = LETTERS in choices, {LETTERS, MARKS} <= set(choices)

    def texts(self, texts: list[str]) -> list[bytes]:
        """Arrow numbers the distinct words of the batch; the ids of each are looked up once, and
        Arrow strings them together."""
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = parts.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each
        ids = self._known(words)
        joined = pa.array(ids, pa.large_binary()).take(coded.indices)
        raw, places = memoryview(joined.buffers()[2] or b""), np.frombuffer(joined.buffers()[1], np.int64)
        ends, numbers = parts.offsets.to_numpy(), coded.indices.to_numpy()
        # Texts with a part that a match may go beyond are put together part by part.
        odd = np.searchsorted(ends, np.flatnonzero(joined.is_null().to_numpy(zero_copy_only=False)), "right") - 1
        odd, out = set(odd.tolist()), []
        for i, (at, end) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
            if i in odd:
                mine = numbers[at:end].tolist()
                out.append(self._one([words[n] for n in mine], [ids[n] for n in mine]))
            else:
                out.append(self._plain(words[numbers[at]]) + raw[places[at + 1] : places[end]])
        return out

    def _known(self, words: list[str]) -> list[bytes | None]:
        """Ids of the distinct words of a batch behind a space; none of what may go on behind the
        word. Only words of letters are remembered, and encoded together. Such a word and
        the marks behind it are two matches; others are split by the pattern."""
        # The store itself, not its keys: the words are looked up, the store is not gone through.
        new, old = self.words.new.get, self.words.old.get
        out = list(map(new, words))
        fresh, seen, plain, marked, split = {}, {}, [], [], {}
        for i in [i for i, ids in enumerate(out) if ids is None]:
            word = words[i]
            if self.letters and word.isalpha():
                ids = out[i] = old(word)
                if ids is None:
                    fresh[word] = None
                    plain.append(i)
                else:
                    seen[word] = ids
            elif closed(word):
                stem = word.rstrip(ASCII_MARKS) if self.marks else word
                if len(stem) < len(word) and stem.isalpha():
                    ids = new(stem)
                    if ids is None:
                        ids = old(stem)
                        if ids is None:
                            fresh[stem] = None
                        else:
                            seen[stem] = ids
                    marked.append((i, stem, word[len(stem) :], ids))
                else:
                    split[i] = self.match(" " + word)
        if fresh:
            fresh = dict(zip(fresh, self.encode([" " + word for word in fresh])))
        of = self._matched({m for ms in split.values() for m in ms}.union([m[2] for m in marked]))
        for i in plain:
            out[i] = fresh[words[i]]
        for i, stem, marks, ids in marked:
            out[i] = (fresh[stem] if ids is None else ids) + of[marks]
        for i, ms in split.items():
            out[i] = of[ms[0]] if len(ms) == 1 else b"".join([of[m] for m in ms])
        self.words.update(seen)
        self.words.update([(word, ids) for word, ids in fresh.items() if len(word) < LONGEST])
        return out

    def _matched(self, matches: set[str]) -> dict[str, bytes]:
        """Ids of matches. A word's match with the space before it is kept under the word."""
        known, new, find, of_word = {}, [], self.matches.find, self.words.find
        for m in matches:
            word = self.letters and m[0] == " " and m[1:].isalpha()
            ids = of_word(m[1:]) if word else find(m)
            if ids is None:
                new.append((m, word))
            else:
                known[m] = ids
        if new:
            for (m, word), ids in zip(new, self.encode([m for m, _ in new])):
                known[m] = ids
                if len(m) < LONGEST:
                    if word:
                        self.words.put(m[1:], ids)
                    else:
                        self.matches.put(m, ids)
        return known

    def _plain(self, text: str) -> bytes:
        matches = self.match(text)
        known = self._matched(set(matches))
        return b"".join([known[m] for m in matches])

    def _one(self, parts: list[str], found: list[bytes | None]) -> bytes:
        """A text from its parts and their ids; a part without any waits for the next."""
        out, group = [], parts[0]
        for part, ids in zip(parts[1:], found[1:]):
            if group is not None:
                if not closed(group):
                    group += " " + part
                    continue
                out.append(self._plain(group))
                group = None
            if ids is not None:
                out.append(ids)
            else:
                group = " " + part
        if group is not None:
            out.append(self._plain(group))
        return b"".join(out)
