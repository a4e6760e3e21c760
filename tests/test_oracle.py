"""Every named query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
from oracle_check import connect, difference

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, duck, name):
    result = contract.queries()[name](spark, small).toPandas()
    assert difference(result, duck.execute(SQL[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 5
