"""Every registered query against its SQL, at sf0.01."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tripmill.bindings.oracle import ORACLE
from tripmill.bindings.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf_dir, duck, plan):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, duck, ORACLE[name]) == []
    text = plan(df)
    for slow in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert slow not in text


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [row["hour"] for row in rows] == list(range(24))
    assert sum(row["counts"] for row in rows) == 854
