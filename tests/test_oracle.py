"""Every registered query with SQL must equal its DuckDB twin on the
smallest test-data scale (the driver repeats this at sf0.01)."""

import os

import pytest

from oracle_compare import compare, duck_conn

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _names():
    import __spark_entry__ as e

    return sorted(e.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as e

    r = compare(spark, con, name, e.queries()[name], e.oracle_sql()[name], SF)
    assert r["cols_ok"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["exact"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 150
