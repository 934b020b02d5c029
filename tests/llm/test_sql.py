"""Queries that SQL can express against their statements."""

import pytest
from compare import database, difference, type_difference
from conftest import SMALL

from tallyfold.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    con = database(SMALL)
    df = queries.REGISTRY[name](spark, SMALL)
    assert difference(df, con, queries.SQL[name]) is None
    assert type_difference(df, con, queries.SQL[name]) is None
