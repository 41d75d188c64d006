"""Every registered query against its SQL form on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


CATALOG = oracle.entry.catalog


def test_every_query_has_a_sql_form():
    assert set(CATALOG.QUERIES) == set(CATALOG.SQL)
    assert set(CATALOG.QUERIES) <= set(oracle.entry.queries())


@pytest.mark.parametrize("name", list(CATALOG.QUERIES))
def test_matches_sql(spark, duck, name):
    _, _, problem = oracle.compare(spark, duck, name, FOLDER)
    assert not problem
