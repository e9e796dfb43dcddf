from __future__ import annotations

import time

from lexmill.llm.wordcache import TextEncoder


def test_a_full_store_does_not_slow_small_batches():
    """A batch looks its own words up; what the store holds is not gone through."""
    made = TextEncoder(r" ?\p{L}+|\s+|[^\s\p{L}]+", lambda ms: [m.encode() for m in ms])
    made.words.new = {f"w{i}": b"x" for i in range(300_000)}
    start = time.process_time()
    for _ in range(300):
        assert made.texts(["ab cd ef"]) == [b"ab cd ef"]
    assert time.process_time() - start < 1
