from pathlib import Path

import pytest

import __spark_entry__ as registered
from verification.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_its_oracle(spark, con, name):
    df = registered.queries()[name](spark, SF_DIR)
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    result = compare(df, con, sql)
    assert isinstance(result, int) and result > 0, result
