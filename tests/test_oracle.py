"""Every registered query of the listing operators against its SQL."""

import pytest
from conftest import SMALL
from oracle import connection, same

from terrane.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    same(registry.queries()[name](spark, SMALL), SQL[name], con)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_query_without_sql(spark, name):
    assert registry.queries()[name](spark, SMALL).count() > 0
