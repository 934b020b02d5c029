"""Every registered query against its SQL statement on the smallest tables."""

import __spark_entry__ as entry_points
import pytest
from compare import database, difference, type_difference
from conftest import SMALL

from tallyfold.plans import REGISTRY

QUERIES = REGISTRY
SQL = {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert difference(df, con, SQL[name]) is None
    assert type_difference(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "movie_id", "title", "five_star_count", "average_score"
    ]
