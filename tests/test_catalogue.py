import pytest

from compare import check, connect
from rigweave.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, name):
    check(QUERIES[name](spark, folder), connect(folder), SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() >= 0


def test_sql_belongs_to_queries():
    assert SQL.keys() <= QUERIES.keys()
