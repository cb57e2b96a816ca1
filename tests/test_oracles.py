"""Every registered query against its DuckDB twin."""

import pytest

from harness.compare import compare, duck
from harness.oracle import ORACLES
from harness.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) == []
