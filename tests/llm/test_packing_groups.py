"""Words with marks behind them are not split by the pattern, batches are encoded in groups, and
the store is small; the ids are those of whole texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from lexmill.llm import packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
TEXTS = ["", " ", "one, two. one two, größer!!", "it's we'll. DON'T'' x", " a  b. \n c.\nd e\n", "...  ,. 12. 日本.",
         "\x1c a\x85. b", "x" * 40 + ". " + "y" * 40, "end ", "ª. º,", "“quoted”. (a) 'b' c's."]


def expected(texts):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    return [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_marks_behind_words_need_no_pattern():
    made, seen = packing._encoder(PATH, PATTERN), []
    match = made.match
    made.match = lambda text: seen.append(text) or match(text)
    texts = ["plain words, with marks. And größer!!", *TEXTS]
    assert made.texts(texts) == made.texts(texts) == expected(texts)
    assert not {" words,", " marks.", " größer!!"} & set(seen)
    assert made.words.size <= 100_000


def test_batches_are_encoded_in_groups(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"_text": pa.array(t, pa.string())}) for t in (["a b", None], TEXTS, ["c"], [])]
    monkeypatch.setattr(packing, "GROUP_BYTES", batches[0].nbytes + batches[1].nbytes)
    encode, sizes = packing._encoder(PATH, PATTERN).texts, []
    found = list(packing.encoded_groups(iter(batches), lambda texts: sizes.append(len(texts)) or encode(texts)))
    assert [b for b, _ in found] == batches and sizes == [2 + len(TEXTS), 1]
    assert [x for _, ids in found for x in ids] == expected(["a b", "", *TEXTS, "c"])
    assert not list(packing.encoded_groups(iter([]), encode))
