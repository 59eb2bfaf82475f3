import pytest

import __spark_entry__ as contract
from tools.check_oracles import compare, connect

CHECKED = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(CHECKED) <= set(contract.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, sf_dir, name):
    ok, message = compare(spark, con, name, sf_dir)
    assert ok, message


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["word", "n"] and df.count() > 0
