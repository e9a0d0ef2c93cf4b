"""Queries that SQL can express, against their SQL."""

import pytest
from compare import compare, connect

from alambique.llm.oracle import ORACLES
from alambique.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


def test_all_are_there():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, small_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], small_dir) == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op9")])
def test_native_queries_run_no_python(spark, small_dir, name):
    text = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
