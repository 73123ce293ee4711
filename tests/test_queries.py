"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.compare import difference, duck
from checks.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    count, diff = difference(spark, con, name, SF)
    assert not diff, diff
    assert count > 0
