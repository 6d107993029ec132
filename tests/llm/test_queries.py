"""Queries that SQL can express, against DuckDB; and what is registered."""

import re

import pytest

import __spark_entry__
from ontime.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(ORACLE[name]).df()) is None


def test_one_query_for_each_operator():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(ORACLE) <= set(QUERIES)
