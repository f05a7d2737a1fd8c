"""Every check with SQL gives the same rows on Spark and on DuckDB."""

import pytest

from checks import catalog
from checks.compare import compare, duck

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def connection(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_check(spark, data, connection, name):
    df = catalog.queries()[name](spark, data)
    if name in ORACLES:
        assert compare(df, connection, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_oracle_names_are_queries():
    assert set(ORACLES) <= set(catalog.queries())
