"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "feature", "mean", "z"] and df.count() == 27 * 4
