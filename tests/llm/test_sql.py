"""Queries that SQL can say, against DuckDB on the smallest tables."""

from collections import Counter

import pytest

from checks.compare import duck
from ledgerspark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    cursor = duck(SF).execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    want = Counter(cursor.fetchall())
    assert Counter(map(tuple, got.select(*columns).collect())) == want
    assert want
