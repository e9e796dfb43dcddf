"""Matches go to the tokenizer's model as they are; the ids are those of whole texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import tokenizers

from lexmill.llm import common, packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = ["", " ", "  a", "naïve café ª º µ", "it's we'll DON'T", "<|endoftext|> x", "日本語 текст 123 ½ ²",
       "\x1c\x1d a\x85b", "a b 　", "!!!  ...", "ǅ ʼn ɏ ɐ ñ×÷", "\t\ttab\n\n x\r\n", "😀😀", "x" * 5000]


def test_plain_matches_are_not_split_again(monkeypatch):
    real, sent = tokenizers.Tokenizer, []

    class Counted:
        def __init__(self, made):
            self.__dict__["made"] = made

        def __getattr__(self, name):
            return getattr(self.made, name)

        def __setattr__(self, name, value):
            setattr(self.made, name, value)

        def encode_batch_fast(self, matches, **options):
            sent.extend(matches)
            return self.made.encode_batch_fast(matches, **options)

        @staticmethod
        def from_file(path):
            return Counted(real.from_file(path))

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    found = packing._encoder(PATH, PATTERN).texts(["plain words, größer Ärger 12", *ODD])
    whole = real.from_file(PATH)
    whole.encode_special_tokens = True
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                for t in ["plain words, größer Ärger 12", *ODD]]
    assert found == expected
    assert sent and not {" words", ",", " größer", " Ärger", " 12"} & set(sent)


def test_a_worker_is_trimmed_behind_a_function_and_at_another_store(monkeypatch):
    trims = []
    monkeypatch.setattr(common, "trim", lambda: trims.append(1))
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    assert list(common.trimmed(lambda batches: batches)(iter([batch, batch]))) == [batch, batch] and trims == [1]
    monkeypatch.setattr(common, "_HELD", {})
    assert common.held("one", lambda: 1) == common.held("one", lambda: 2) == 1 and len(trims) == 2
    assert common.held("two", lambda: 2) == 2 and len(trims) == 3
