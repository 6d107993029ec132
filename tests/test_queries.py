"""Every registered query with a SQL equivalent gives the same rows as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    assert differences(got, duck.execute(oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_gives_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0
