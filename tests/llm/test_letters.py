from __future__ import annotations

import numpy as np

from lexmill.llm import langid


def test_numerals_are_not_letters():
    model = langid.Model({"aa": ["aa"]}, [], np.zeros((1, 0)), np.zeros(0))
    assert langid.choose("½ ² ① 12", np.zeros(0), model) == ("und", 0.0)
    assert langid.choose("½ é", np.zeros(0), model)[0] == "aa" and langid.choose("日", np.zeros(0), model)[0] == "aa"
