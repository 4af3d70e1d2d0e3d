"""Every registered query runs, and those with SQL give the same values in DuckDB."""

import pytest
from compare import connect, difference

import checks.catalog  # noqa: F401
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0
