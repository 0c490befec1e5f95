"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__
from compare import DATA, compare, duck
from wattloom.llm.oracle import ORACLE

SMALL = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(__spark_entry__.queries()[name](spark, SMALL), duck(SMALL), __spark_entry__.oracle_sql()[name]) == []
