"""All registered queries against their SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import check_sql
from lexmill.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check_sql.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert check_sql.compare(spark, db, name, FOLDER) is None


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
