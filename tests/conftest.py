from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A frame (id, text) of the given texts."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "id long, text string")

    return make


@pytest.fixture
def token_rows(spark):
    """A frame (doc_id, tokens) of the given token lists."""

    def make(*lists):
        return spark.createDataFrame(list(enumerate(lists)), "doc_id long, tokens array<int>")

    return make


def column(df, name, key="id"):
    """Values of one column in key order."""
    return [row[name] for row in sorted(df.collect(), key=lambda r: r[key])]
