"""Each registered query against the same question in SQL."""

import pytest

from contract.compare import connect, differences
from contract.oracle import ORACLE_SQL
from contract.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    assert differences(spark, duck, name, sf_dir) == []


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 246
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries()) >= set(QUERIES)
