"""Every core query against its SQL equivalent on another engine."""

import pytest
from compare import connect, difference

from vellum.plans.queries import oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.count() > 0


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, write_tables, name, tmp_path_factory):
    global _EMPTY
    if "_EMPTY" not in globals():
        _EMPTY = write_tables()
    assert QUERIES[name](spark, _EMPTY).count() == 0
