"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from docspark import workload
from compare import connect, differences

QUERIES, ORACLES = workload.queries(), workload.oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "chunks", "chars", "longest"]
    assert df.count() > 0
