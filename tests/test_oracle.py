"""Every registered query against its SQL, rows, names and types."""

import pytest
from compare import compare, connect

from alambique.plans.catalog import QUERIES
from alambique.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, small_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], small_dir) == ""
