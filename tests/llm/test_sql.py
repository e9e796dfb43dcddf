"""Queries of this subpackage that have SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import check_sql
from lexmill.llm import oracles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check_sql.connect(FOLDER)


@pytest.mark.parametrize("name", list(oracles.ORACLE))
def test_query(spark, db, name):
    assert check_sql.compare(spark, db, name, FOLDER) is None
